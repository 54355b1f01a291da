"""Counts, reconciliation, history and drift."""

import os

from conftest import SF
from snapvault.operators import validation as VA
from snapvault.operators.projections import project_strings
from snapvault.sinks.writers import write_full, write_incremental


def test_count_exported_modes(spark, tmp_dir):
    orders = project_strings(spark.read.parquet(f"{SF}/orders.parquet"))
    inc, full = os.path.join(tmp_dir, "inc"), os.path.join(tmp_dir, "full")
    write_incremental(orders, inc, "20240101000000Z")
    finished = orders.where("o_orderstatus = 'F'")
    write_incremental(finished, inc, "20240201000000Z")
    n_finished = finished.count()
    write_full(orders.withColumn("extraction_timestamp", orders.o_orderkey.cast("string")), full)
    per_snap = {(r[0], r[1]): r[2] for r in VA.count_exported(spark, {"orders": inc}).collect()}
    assert per_snap == {("orders", "20240101000000Z"): 1500, ("orders", "20240201000000Z"): n_finished}
    one = VA.count_exported(spark, {"orders": inc}, snapshot="20240201000000Z").first()
    assert one["exported_row_count"] == n_finished
    assert VA.count_exported(spark, {"orders": full}, "full").first()["exported_row_count"] == 1500


def test_reconcile_upsert_latest(spark):
    stats = spark.createDataFrame([("a", 10), ("b", 20), ("aspnet_Users", 5)], "table_name string, original_row_count long")
    init = VA.init_validation(stats, "20240101000000Z")
    exported = spark.createDataFrame([("a", "20240101000000Z", 10), ("b", "20240101000000Z", 19)],
                                     "table_name string, extraction_timestamp string, exported_row_count long")
    rec = {r["table_name"]: (r["exported_row_count"], r["status"]) for r in VA.reconcile_counts(init, exported).collect()}
    assert rec == {"a": (10, "MATCH"), "b": (19, "MISMATCH"), "aspnet_Users": (None, "NOT_EXPORTED")}
    updates = VA.reconcile_counts(init, exported).drop("status")
    older = VA.init_validation(stats, "20231201000000Z")
    table = VA.upsert_validation(init.unionByName(older), updates)
    assert table.count() == 6
    again = VA.upsert_validation(table, updates)  # idempotent
    assert again.exceptAll(table).count() == 0 and table.exceptAll(again).count() == 0
    latest = {r["table_name"]: (r["extraction_timestamp"], r["exported_row_count"])
              for r in VA.latest_per_table(table).collect()}
    assert latest == {"a": ("20240101000000Z", 10), "b": ("20240101000000Z", 19),
                      "aspnet_Users": ("20240101000000Z", None)}


def test_schema_drift(spark):
    old = VA.columns_frame(spark, [("Id", "INT"), ("Name", "string"), ("rn", "bigint")])
    same = VA.columns_frame(spark, [("name", "STRING"), ("id", "int")])
    assert VA.schema_drift(old, same).count() == 0
    new = VA.columns_frame(spark, [("id", "bigint"), ("name", "string"), ("note", "string")])
    got = sorted(tuple(r) for r in VA.schema_drift(old, new).collect())
    assert got == [("id", "bigint", "added"), ("id", "int", "removed"), ("note", "string", "added")]


def test_mode_is_checked():
    import pytest
    with pytest.raises(ValueError):
        VA.check_mode("incrementl")


def test_count_exported_many_tables_in_batches(spark, tmp_dir):
    from snapvault.operators import validation as mod
    orders = project_strings(spark.read.parquet(f"{SF}/orders.parquet"))
    paths = {}
    for i in range(5):
        paths[f"t{i}"] = os.path.join(tmp_dir, f"t{i}")
        write_incremental(orders, paths[f"t{i}"], "20240101000000Z")
    got = {r["table_name"]: r["exported_row_count"] for r in mod.count_exported(spark, paths).collect()}
    assert got == {f"t{i}": 1500 for i in range(5)}


def test_count_exported_in_batches_reports_empty_and_missing_tables(spark, tmp_dir):
    from snapvault.operators import validation as mod
    orders = project_strings(spark.read.parquet(f"{SF}/orders.parquet"))
    snap = "20240101000000Z"
    paths = {}
    for i in range(3):
        paths[f"t{i}"] = os.path.join(tmp_dir, f"t{i}")
        write_incremental(orders, paths[f"t{i}"], snap)
    paths["empty"] = os.path.join(tmp_dir, "empty")
    write_incremental(orders.where("false"), paths["empty"], snap)  # schema-only snapshot
    paths["gone"] = os.path.join(tmp_dir, "never_written")
    got = {r["table_name"]: (r["extraction_timestamp"], r["exported_row_count"])
           for r in mod.count_exported(spark, paths, "incremental", snap).collect()}
    assert got == {"t0": (snap, 1500), "t1": (snap, 1500), "t2": (snap, 1500), "empty": (snap, 0), "gone": (snap, 0)}
    full = {r["table_name"]: r["exported_row_count"]
            for r in mod.count_exported(spark, {"t0": paths["t0"], "empty": paths["empty"]}, "full").collect()}
    assert full == {"t0": 1500, "empty": 0}


def test_counts_of_few_and_many_tables_have_one_plan(spark, tmp_dir):
    import re
    paths = {}
    for i in range(30):
        paths[f"t{i:02d}"] = os.path.join(tmp_dir, f"t {i}")  # a name that file metadata spells with %20
        write_incremental(spark.range(i), paths[f"t{i:02d}"], "20240101000000Z")

    def nodes(some):
        plan = VA.count_exported(spark, some)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ReadSchema: struct<>") == len(some)  # no column is read
        return plan.count("Exchange"), plan.count("HashAggregate"), plan.count("Union")

    few = dict(list(paths.items())[:3])
    assert nodes(few) == nodes(paths) == (1, 2, 1)  # one shuffle, however many tables
    got = {r["table_name"]: r["exported_row_count"] for r in VA.count_exported(spark, paths, snapshot="20240101000000Z").collect()}
    assert got == {f"t{i:02d}": i for i in range(30)}


def test_latest_keeps_schemas_apart(spark):
    rows = [("a", "t", 1, 1, "20240101000000Z"), ("a", "t", 2, 2, "20240201000000Z"), ("b", "t", 3, 3, "20240101000000Z")]
    df = spark.createDataFrame(rows, "table_schema string, table_name string, original_row_count long, exported_row_count long, extraction_timestamp string")
    got = {(r["table_schema"], r["table_name"]): r["original_row_count"] for r in VA.latest_per_table(df).collect()}
    assert got == {("a", "t"): 2, ("b", "t"): 3}


def test_interleaved_runs_keep_each_others_rows(spark, tmp_dir, monkeypatch):
    from concurrent.futures import ThreadPoolExecutor
    from snapvault.plans import jobs
    from snapvault.sources.tables import scan_exported
    cfg = jobs.ExportConfig(database="shop", output_root=tmp_dir, snapshot="20240101000000Z")

    def rows(name, n):
        return spark.createDataFrame([("dbo", name, n, n, cfg.snapshot)], jobs.STORED_SCHEMA)

    # the second run commits after the first one has read the partition and before it writes
    plain, late = jobs.write_incremental, []

    def write(df, location, snapshot, expected_version):
        if not late:
            late.append(1)
            jobs.store_validation(spark, rows("b", 2), cfg, tried=[("dbo", "b")])
        return plain(df, location, snapshot, expected_version=expected_version)
    with monkeypatch.context() as m:
        m.setattr(jobs, "write_incremental", write)
        jobs.store_validation(spark, rows("a", 1), cfg, tried=[("dbo", "a")])
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda k: jobs.store_validation(spark, rows(f"t{k}", k), cfg, tried=[("dbo", f"t{k}")]), range(4)))
    got = {r["table_name"]: r["exported_row_count"] for r in scan_exported(spark, cfg.validation_location).collect()}
    assert got == {"a": 1, "b": 2, "t0": 0, "t1": 1, "t2": 2, "t3": 3}
    # a table of the same name in another schema is not taken for a tried one
    jobs.store_validation(spark, spark.createDataFrame([("hr", "a", 9, None, cfg.snapshot)], jobs.STORED_SCHEMA), cfg, tried=[("hr", "a")])
    assert scan_exported(spark, cfg.validation_location).where("table_name = 'a'").count() == 2
