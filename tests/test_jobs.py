"""End-to-end jobs: round trip, idempotence, failures, views, modes."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF
from snapvault.operators.projections import add_snapshot, project_strings
from snapvault.plans.chunks import check_ranges, file_ranges
from snapvault.plans.jobs import ExportConfig, export_tables, export_views, plan_export, run_export, validate_export
from snapvault.sources.tables import ParquetSource, scan_exported

KEYS = {"orders": ["o_orderkey"], "conversations": ["conv_id", "turn"], "customer": ["c_custkey"]}
SMALL = ["orders", "lineitem", "conversations", "customer", "region"]


def _src(spark):
    return ParquetSource(spark, SF, keys=KEYS, database="shop",
                         views={"vw_orders": "SELECT * FROM orders", "vw_aspnet_x": "SELECT 1"})


class _Subset(ParquetSource):
    def table_names(self):
        return SMALL


def _subset(spark):
    return _Subset(spark, SF, keys=KEYS, database="shop")


@pytest.mark.parametrize("mode", ["incremental", "full"])
def test_round_trip(spark, tmp_dir, mode):
    src = _subset(spark)
    cfg = ExportConfig(database="shop", output_root=tmp_dir, mode=mode, snapshot="20240101000000Z",
                       target_mb=0.05, order_by_key=True)
    res = run_export(src, cfg)
    assert {r["status"] for r in res.status.collect()} == {"OK"}
    assert {r["status"] for r in res.validation.collect()} == {"MATCH"}
    for name in SMALL:
        expected = add_snapshot(project_strings(src.table("dbo", name)), "20240101000000Z")
        back = spark.read.parquet(cfg.table_path(name)).select(*expected.columns)
        assert expected.exceptAll(back).count() == 0 and back.exceptAll(expected).count() == 0, name


def test_rerun_is_idempotent(spark, tmp_dir):
    src = _subset(spark)
    cfg = ExportConfig(database="shop", output_root=tmp_dir, snapshot="20240101000000Z", target_mb=0.05)
    run_export(src, cfg)
    first = spark.read.parquet(cfg.table_path("orders")).count()
    run_export(src, cfg)
    assert spark.read.parquet(cfg.table_path("orders")).count() == first
    stored = spark.read.parquet(cfg.validation_location)
    assert stored.count() == len(SMALL)


def test_failed_table_does_not_stop_the_run(spark, tmp_dir):
    src = _subset(spark)
    cfg = ExportConfig(database="shop", output_root=tmp_dir, snapshot="20240101000000Z")
    plan = plan_export(src, cfg)
    bad = {"table_schema": "dbo", "table_name": "missing", "primary_key": [], "rows": 0,
           "rows_per_chunk": 0, "n_chunks": 1}
    status = export_tables(src, plan, cfg, extra_tables=[bad])
    got = {r["table_name"]: r["status"] for r in status.collect()}
    assert got.pop("missing") == "FAILED" and set(got.values()) == {"OK"}
    msg = status.where("table_name = 'missing'").first()["message"]
    assert msg.startswith("Failed to extract data for missing table.")
    validation = {r["table_name"]: r["status"] for r in validate_export(spark, plan, status, cfg).collect()}
    assert set(validation.values()) == {"MATCH"}


def test_keep_row_number_and_typed_mode(spark, tmp_dir):
    src = _subset(spark)
    cfg = ExportConfig(database="shop", output_root=tmp_dir, snapshot="20240101000000Z", target_mb=0.05,
                       keep_row_number=True, typed=True, tables_to_export=["dbo.orders"])
    res = run_export(src, cfg)
    assert [r["table_name"] for r in res.status.collect()] == ["orders"]
    back = spark.read.parquet(cfg.table_path("orders"))
    types = dict(back.dtypes)
    assert types["o_orderkey"] == "bigint" and types["o_totalprice"] == "double" and types["rn"] == "bigint"
    first = back.orderBy("rn").first()
    assert first["rn"] == 1 and first["o_orderkey"] == src.table("dbo", "orders").agg(F.min("o_orderkey")).first()[0]


def test_bound_chunks_are_files(spark, tmp_dir):
    src = _subset(spark)
    cfg = ExportConfig("shop", tmp_dir, mode="full", target_mb=0.02, tables_to_export=["dbo.orders"], size_estimate="exact",
                       keep_row_number=True, bind_chunks=True, partition_mb=0.05)
    res = run_export(src, cfg)
    assert {r["status"] for r in res.status.collect()} == {"OK"}
    ranges = file_ranges(scan_exported(spark, cfg.table_path("orders")), ["o_orderkey"])
    checked = check_ranges(plan_export(src, cfg).chunks.where("table_name = 'orders'"), ranges).collect()
    assert len(checked) > 2 and {r["status"] for r in checked} == {"BOUND"}
    with pytest.raises(ValueError):
        ExportConfig("shop", tmp_dir, bind_chunks=True)


def test_register_entries(spark, tmp_dir):
    src = _subset(spark)
    cfg = ExportConfig(database="sv_jobs_db", output_root=tmp_dir, snapshot="20240101000000Z",
                       register=True, tables_to_export=["orders", "region"])
    run_export(src, cfg)
    assert spark.table("sv_jobs_db.orders").count() == src.table("dbo", "orders").count()
    assert spark.table("sv_jobs_db.region").count() == 5


def test_export_views(spark, tmp_dir):
    cfg = ExportConfig(database="shop", output_root=tmp_dir, snapshot="20240101000000Z", get_views=True)
    views = export_views(_src(spark), cfg)
    assert [tuple(r) for r in views.orderBy("view_name").collect()] == [
        ("vw_orders", "SELECT * FROM orders", "20240101000000Z")]


def test_name_collision_is_refused(spark, catalog, tmp_dir):
    class FixtureSource:
        def __init__(self, s):
            self.spark = s

        def catalog(self, profile=True):
            return catalog

    cfg = ExportConfig(database="db", output_root=tmp_dir)
    with pytest.raises(ValueError, match="Customers"):
        plan_export(FixtureSource(spark), cfg)


def test_bad_mode_is_refused(tmp_dir):
    with pytest.raises(ValueError):
        ExportConfig(database="db", output_root=tmp_dir, mode="delta")


@pytest.mark.parametrize("mode", ["incremental", "full"])
def test_empty_table_is_written_and_counted_zero(spark, tmp_dir, mode):
    src_dir = os.path.join(tmp_dir, "src")
    os.makedirs(src_dir)
    spark.read.parquet(f"{SF}/region.parquet").where("r_regionkey < 0").coalesce(1) \
        .write.parquet(os.path.join(src_dir, "empty_region"))
    spark.read.parquet(f"{SF}/nation.parquet").write.parquet(os.path.join(src_dir, "nation"))
    src = ParquetSource(spark, src_dir, keys={"nation": ["n_nationkey"]})
    cfg = ExportConfig(database="shop", output_root=os.path.join(tmp_dir, "out"), mode=mode,
                       snapshot="20240101000000Z")
    res = run_export(src, cfg)
    got = {r["table_name"]: (r["original_row_count"], r["exported_row_count"], r["status"])
           for r in res.validation.collect()}
    assert got == {"empty_region": (0, 0, "MATCH"), "nation": (25, 25, "MATCH")}
    back = spark.read.parquet(cfg.table_path("empty_region"))
    assert back.count() == 0 and "r_name" in back.columns


def test_slow_table_times_out_and_run_goes_on(spark, tmp_dir):
    import time as _time

    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    @F.udf(T.StringType())
    def slow(x):  # test-only: makes one table's export take long
        _time.sleep(1.0)
        return str(x)

    class Slow(ParquetSource):
        def table_names(self):
            return ["region", "nation"]

        def table_for_export(self, schema, name, pk, n_chunks):
            df = super().table_for_export(schema, name, pk, n_chunks)
            return df.withColumn("n_name", slow("n_name")).repartition(1) if name == "nation" else df

    cfg = ExportConfig(database="shop", output_root=tmp_dir, snapshot="20240101000000Z", table_timeout_s=3)
    t0 = _time.time()
    res = run_export(Slow(spark, SF), cfg)
    assert _time.time() - t0 < 25 * 1.0  # cancelled well before 25 rows x 1 s
    got = {r["table_name"]: r["status"] for r in res.status.collect()}
    assert got == {"region": "OK", "nation": "TIMED_OUT"}
    val = {r["table_name"]: r["status"] for r in res.validation.collect()}
    assert val["region"] == "MATCH" and val["nation"] in ("MISMATCH", "NOT_EXPORTED")


def test_schema_drift_between_runs_updates_the_entry(spark, tmp_dir):
    from snapvault.sources.tables import scan_exported
    src_dir = os.path.join(tmp_dir, "src")
    region = spark.read.parquet(f"{SF}/region.parquet")
    region.write.parquet(os.path.join(src_dir, "region"))
    src = ParquetSource(spark, src_dir, keys={"region": ["r_regionkey"]})
    out = os.path.join(tmp_dir, "out")
    run_export(src, ExportConfig(database="sv_drift_db", output_root=out, snapshot="20240101000000Z",
                                 register=True))
    assert "r_comment" not in spark.table("sv_drift_db.region").columns
    # the source gains a column
    region.withColumn("r_comment", F.concat(F.lit("note "), F.col("r_name"))) \
        .write.mode("overwrite").parquet(os.path.join(src_dir, "region"))
    res = run_export(src, ExportConfig(database="sv_drift_db", output_root=out, snapshot="20240201000000Z",
                                       register=True))
    assert {r["status"] for r in res.validation.collect()} == {"MATCH"}
    table = spark.table("sv_drift_db.region")
    assert "r_comment" in table.columns and table.count() == 10
    both = scan_exported(spark, os.path.join(out, "sv_drift_db", "region"), merge_schema=True)
    per_snap = {r[0]: r[1] for r in both.groupBy("extraction_timestamp").agg(F.count("r_comment")).collect()}
    assert per_snap == {"20240101000000Z": 0, "20240201000000Z": 5}


def test_sorted_tables_are_cut_by_rows_in_memory(spark):
    """Packed columns take little on storage but their full width in a sort."""
    from snapvault.plans.jobs import sort_partitions, task_partitions
    cfg = ExportConfig(database="d", output_root="/unused", target_mb=1, partition_mb=256)
    df = spark.createDataFrame([(1, 2.0, "x")], "a long, b double, s string")
    meta = {"n_chunks": 10, "rows": 30_000_000, "rows_per_chunk": 3_000_000}  # 10 MB stored
    assert task_partitions(meta, cfg) == 1
    assert sort_partitions(df, meta, cfg) >= 30_000_000 * 3 * 8 / (256 << 20)
    six = {"n_chunks": 60, "rows": 180_000_000, "rows_per_chunk": 3_000_000}
    assert 5 <= sort_partitions(df, six, cfg) / sort_partitions(df, meta, cfg) <= 6  # rows of a task stay as many
