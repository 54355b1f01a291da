"""A second run must not lose what the first one stored."""

import os

from conftest import SF
from snapvault.plans.jobs import ExportConfig, run_export
from snapvault.sinks.writers import register_table, table_columns, write_full, write_incremental
from snapvault.sources.tables import ParquetSource

SNAP = "20240101000000Z"


def test_second_allow_list_keeps_the_first_runs_counts(spark, tmp_dir):
    src = ParquetSource(spark, SF, keys={"region": ["r_regionkey"], "nation": ["n_nationkey"]}, database="shop")
    for name in ("dbo.region", "dbo.nation"):
        cfg = ExportConfig(database="shop", output_root=tmp_dir, mode="incremental", snapshot=SNAP, tables_to_export=[name])
        run_export(src, cfg)
    rows = {r["table_name"]: r for r in spark.read.parquet(cfg.validation_location).collect()}
    assert rows["region"]["exported_row_count"] == 5 and rows["nation"]["exported_row_count"] == 25
    assert rows["orders"]["exported_row_count"] is None


def test_snapshot_rewritten_with_fewer_rows_then_none(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    for n in (5, 2, 0):
        write_incremental(spark.range(n), path, SNAP)
        assert spark.read.parquet(path).count() == n


def test_registered_table_reads_after_rerun_and_mode_switch(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS reruns")
    path, both = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    df = spark.range(3).selectExpr("id", f"'{SNAP}' AS extraction_timestamp")
    for expected in ("created", "unchanged"):
        write_full(df, path)
        assert register_table(spark, "reruns", "t", table_columns(df, "full"), path, "full") == expected
        assert spark.table("reruns.t").count() == 3
    write_incremental(df, both)
    assert register_table(spark, "reruns", "t", table_columns(df, "incremental"), both, "incremental") == "updated"
    assert spark.table("reruns.t").count() == 3
