"""Physical plans: the properties the design relies on at scale."""

import os

from pyspark.sql import functions as F

from conftest import SF
from snapvault.operators.projections import add_snapshot, filter_pattern, project_strings
from snapvault.operators.validation import count_exported
from snapvault.sinks.writers import write_incremental
from snapvault.sources.tables import ParquetSource, scan_query


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_export_projection_has_no_shuffle(spark):
    df = add_snapshot(project_strings(spark.read.parquet(f"{SF}/lineitem.parquet")), "20240101000000Z")
    plan = plan_of(df)
    assert "Exchange" not in plan
    assert "*(1)" in plan  # the projection runs inside whole-stage codegen
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_pruning_and_pushdown_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet").where(F.col("o_orderkey") > 100).select("o_orderkey")
    plan = plan_of(df)
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,100)]" in plan
    pat = filter_pattern(spark.read.parquet(f"{SF}/part.parquet"), "p_name", ["%ring"]).select("p_partkey")
    assert "Exchange" not in plan_of(pat)


def test_counts_read_no_columns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders")
    write_incremental(project_strings(spark.read.parquet(f"{SF}/orders.parquet")), path, "20240101000000Z")
    plan = plan_of(count_exported(spark, {"orders": path}, snapshot="20240101000000Z"))
    assert "ReadSchema: struct<>" in plan
    assert "PartitionFilters: [isnotnull(extraction_timestamp" in plan


def test_small_join_side_is_broadcast_by_size(spark):
    src = ParquetSource(spark, SF)
    df = scan_query(src, "SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final


def test_catalog_frames_are_local_and_joined_by_broadcast(spark):
    from snapvault.operators.metadata import primary_keys, table_stats
    cat = ParquetSource(spark, SF, keys={"orders": ["o_orderkey"]}).catalog(["orders", "nation"], profile="files")
    assert "LocalTableScan" in plan_of(cat.sys_tables)
    for df in (table_stats(cat), primary_keys(cat)):
        df.collect()  # AQE's final plan: joins re-planned on measured sizes
        plan = plan_of(df).split("== Initial Plan ==")[0]
        assert "BroadcastHashJoin" in plan
        assert "SortMergeJoin" not in plan and "Scan ExistingRDD" not in plan
    assert {r["table_name"]: r["original_row_count"] for r in table_stats(cat).collect()} == {
        "orders": spark.read.parquet(f"{SF}/orders.parquet").count(),
        "nation": spark.read.parquet(f"{SF}/nation.parquet").count(),
    }
