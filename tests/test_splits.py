"""Split predicates put every row into one split; sources list through the file system."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF
from snapvault.sources.tables import (
    JdbcSource, ParquetSource, key_range_predicates, scan_query, sql_literal, whole_bounds, with_rest,
)


def _splits(df, predicates):
    return [df.where(F.expr(p)).count() for p in predicates]


def test_key_ranges_tile_composite_keys_with_a_hot_value_and_nulls(spark):
    rows = [("hot", k) for k in range(60)] + [(f"o'{k}", k) for k in range(30)] + [(None, 1), ("hot", None), (None, None)]
    df = spark.createDataFrame(rows, "tenant string, id int")
    preds = key_range_predicates(["tenant", "id"], [["hot", 19], ["hot", 39], ["hot", 59], ["o'2", 2]])
    sizes = _splits(df, preds)
    assert sum(sizes) == len(rows)
    neighbours = [f"({a}) AND ({b})" for a, b in zip(preds, preds[1:])]
    assert _splits(df, neighbours) == [0] * len(neighbours)
    assert sizes[:3] == [20 + 3, 20, 20]  # the hot tenant is split, NULL keys are in the first
    assert key_range_predicates(["a"], []) == []


def test_hash_splits_keep_null_and_negative_residues(spark):
    df = spark.createDataFrame([(k,) for k in range(-10, 10)] + [(None,)], "k int")
    plain = [f"k % 3 = {i}" for i in range(3)]
    assert sum(_splits(df, plain)) < 21
    assert sum(_splits(df, with_rest(plain))) == 21
    assert with_rest(plain[:1]) == plain[:1]


def test_bounds_literals_and_quoting(spark):
    assert whole_bounds(Decimal("1.50"), Decimal("9.10")) == (1, 10) and whole_bounds(-1.5, 2.0) == (-2, 2)
    assert whole_bounds(3, 7) == (3, 7)
    assert sql_literal("a'b") == "'a''b'" and sql_literal(Decimal("1.5")) == "1.5" and sql_literal(b"\x01") == "0x01"
    server = JdbcSource(spark, "jdbc:none")
    assert server.qualified("dbo", "Order ]Details") == "[dbo].[Order ]]Details]"
    assert JdbcSource(spark, "jdbc:none", dialect="generic").qualified(None, 'a"b') == '"a""b"'


def test_source_by_uri_opens_only_named_tables(spark):
    src = ParquetSource(spark, f"file:{SF}")
    assert "orders" in src.table_names() and src.table("dbo", "region").count() == 5
    spark.sql("DROP VIEW IF EXISTS nation")
    spark.range(3).createOrReplaceTempView("nation")
    try:
        assert scan_query(src, "SELECT * FROM region").count() == 5
        assert spark.table("nation").count() == 3  # not overwritten
    finally:
        spark.catalog.dropTempView("nation")


@pytest.mark.parametrize("failures, status", [(1, "OK"), (5, "FAILED")])
def test_failed_table_is_tried_again(spark, tmp_dir, monkeypatch, failures, status):
    from snapvault.plans import jobs

    src = ParquetSource(spark, SF, keys={"region": ["r_regionkey"]}, database="shop")
    cfg = jobs.ExportConfig(database="shop", output_root=tmp_dir, tables_to_export=["dbo.region"], retry_wait_s=0.0)
    plan = jobs.plan_export(src, cfg)
    calls, real = [], jobs._prepare_table

    def flaky(*args):
        calls.append(1)
        if len(calls) <= failures:
            raise ConnectionError("dropped")
        return real(*args)

    monkeypatch.setattr(jobs, "_prepare_table", flaky)
    assert [r["status"] for r in jobs.export_tables(src, plan, cfg).collect()] == [status]
    assert len(calls) == min(failures + 1, 3)


def test_limit_between_two_jobs_stops_the_write(spark, tmp_dir, monkeypatch):
    import time

    from snapvault.plans import jobs
    from snapvault.sinks.writers import path_exists

    src = ParquetSource(spark, SF, keys={"region": ["r_regionkey"]}, database="shop")
    cfg = jobs.ExportConfig(database="shop", output_root=tmp_dir, tables_to_export=["dbo.region"], table_timeout_s=0.3)
    plan = jobs.plan_export(src, cfg)
    real = jobs._prepare_table
    monkeypatch.setattr(jobs, "_prepare_table", lambda *a: (time.sleep(1), real(*a))[1])
    assert [r["status"] for r in jobs.export_tables(src, plan, cfg).collect()] == ["TIMED_OUT"]
    assert not path_exists(spark, cfg.table_path("region"))


def test_counts_are_stored_before_the_export_and_by_schema(spark, tmp_dir, monkeypatch):
    from snapvault.operators.validation import init_validation, reconcile_counts
    from snapvault.plans import jobs

    src = ParquetSource(spark, SF, keys={"region": ["r_regionkey"]}, database="shop")
    cfg = jobs.ExportConfig(database="shop", output_root=tmp_dir, tables_to_export=["dbo.region"])
    monkeypatch.setattr(jobs, "export_tables", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        jobs.run_export(src, cfg)
    stored = {r["table_name"]: r for r in spark.read.parquet(cfg.validation_location).collect()}
    assert stored["region"]["original_row_count"] == 5 and stored["region"]["exported_row_count"] is None
    stats = spark.createDataFrame([("a", "t", 10), ("b", "t", 99)], "table_schema string, table_name string, original_row_count long")
    exported = spark.createDataFrame([("a", "t", "S", 10)], "table_schema string, table_name string, "
                                     "extraction_timestamp string, exported_row_count long")
    got = {r["table_schema"]: r["status"] for r in reconcile_counts(init_validation(stats, "S"), exported).collect()}
    assert got == {"a": "MATCH", "b": "NOT_EXPORTED"}
