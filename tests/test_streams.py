"""Streams with availableNow equal their batch counterparts."""

import os
import shutil

from pyspark.sql import functions as F

from conftest import SF
from snapvault.streaming import streams as S


def _status_events(df):
    return df.select(
        F.lit("database.export").alias("source"),
        F.lit("Step Functions Execution Status Change").alias("detail_type"),
        F.struct(
            F.concat(F.lit("arn:x:"), F.col("event_id").cast("string")).alias("executionArn"),
            F.when(F.col("event_type") == "view", "arn:m:other").otherwise("arn:m:export").alias("stateMachineArn"),
            F.col("event_type").alias("name"),
            F.when(F.col("event_type") == "error", "FAILED")
             .when(F.col("event_type") == "click", "TIMED_OUT")
             .otherwise("SUCCEEDED").alias("status"),
            F.col("ts").cast("string").alias("time"),
            F.lit("t").alias("table"),
        ).alias("detail"))


def test_failure_stream_equals_batch(spark, tmp_dir):
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    S.stream_failures(_status_events(stream), tmp_dir, machines=["arn:m:export"])
    got = spark.read.parquet(os.path.join(tmp_dir, "alerts"))
    batch = S.failure_alerts(_status_events(spark.read.parquet(f"{SF}/events.parquet")), machines=["arn:m:export"])
    assert got.count() > 0 and set(r["Status"] for r in got.collect()) == {"FAILED", "TIMED_OUT"}
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    assert got.columns == S.ALERT_COLUMNS


def test_landing_stream_routes_by_suffix(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    for name in ("shop.BAK", "other.bak", "notes.txt"):
        with open(os.path.join(landing, name), "wb") as fh:
            fh.write(b"x" * 10)
    out = os.path.join(tmp_dir, "out")
    S.stream_landing(spark, landing, out, "shop")
    acc = sorted(r["file_name"] for r in spark.read.parquet(os.path.join(out, "accepted")).collect())
    rej = sorted(r["file_name"] for r in spark.read.parquet(os.path.join(out, "rejected")).collect())
    assert acc == ["other.bak", "shop.BAK"] and rej == ["notes.txt"]
    ids = {r["extraction_timestamp"] for r in spark.read.parquet(os.path.join(out, "accepted")).collect()}
    assert all(len(i) == 15 and i.endswith("Z") for i in ids)
    # a new arrival is picked up by the next run; old files are not repeated
    shutil.copy(os.path.join(landing, "shop.BAK"), os.path.join(landing, "late.bak"))
    S.stream_landing(spark, landing, out, "shop")
    acc = sorted(r["file_name"] for r in spark.read.parquet(os.path.join(out, "accepted")).collect())
    assert acc == ["late.bak", "other.bak", "shop.BAK"]


def test_retention_tiers(spark):
    snaps = spark.createDataFrame(
        [("t", "20240101000000Z"), ("t", "20230901000000Z"), ("t", "20221201000000Z"), ("t", "20211231000000Z")],
        "table_name string, extraction_timestamp string")
    got = {r["extraction_timestamp"]: (r["age_days"], r["tier"]) for r in S.retention_tiers(snaps, "2024-01-31").collect()}
    assert got == {"20240101000000Z": (30, "STANDARD"), "20230901000000Z": (152, "INFREQUENT"),
                   "20221201000000Z": (426, "ARCHIVE"), "20211231000000Z": (761, "EXPIRED")}


def test_status_events_from_runs(spark):
    status = spark.createDataFrame([("db", "a", "OK"), ("db", "b", "TIMED_OUT"), ("db", "c", "FAILED")],
                                   "database string, table_name string, status string")
    ev = S.status_events_from_runs(status, "arn:m:export", F.lit("2024-01-01T00:00:00Z"))
    alerts = S.failure_alerts(ev, machines=["arn:m:export"]).collect()
    assert sorted(r["ExecutionName"] for r in alerts) == [
        "Failed to extract data for b table.", "Failed to extract data for c table."]


def test_failed_tables_reach_the_alert_stream(spark, tmp_dir):
    from snapvault.plans.jobs import ExportConfig, run_export
    from snapvault.sources.tables import ParquetSource

    class Flaky(ParquetSource):
        def table_names(self):
            return ["region", "nation"]

        def table_for_export(self, schema, name, pk, n_chunks):
            if name == "nation":
                raise OSError("connection reset while reading nation")
            return super().table_for_export(schema, name, pk, n_chunks)

    events_dir = os.path.join(tmp_dir, "events")
    cfg = ExportConfig(database="shop", output_root=os.path.join(tmp_dir, "out"), snapshot="20240101000000Z",
                       events_path=events_dir, machine_arn="arn:m:export")
    res = run_export(Flaky(spark, SF, keys={"region": ["r_regionkey"]}), cfg)
    assert {r["table_name"]: r["status"] for r in res.status.collect()} == {"region": "OK", "nation": "FAILED"}
    assert {r["table_name"]: r["status"] for r in res.validation.collect()} == {
        "region": "MATCH", "nation": "NOT_EXPORTED"}
    stream = spark.readStream.schema(S.STATUS_EVENT_SCHEMA).parquet(events_dir)
    S.stream_failures(stream, os.path.join(tmp_dir, "alerts"), machines=["arn:m:export"])
    alerts = spark.read.parquet(os.path.join(tmp_dir, "alerts", "alerts")).collect()
    assert [(a["ExecutionName"], a["Status"]) for a in alerts] == [
        ("Failed to extract data for nation table.", "FAILED")]


def test_expire_snapshots(spark, tmp_dir):
    from snapvault.operators.projections import project_strings
    from snapvault.sinks.writers import write_incremental
    path = os.path.join(tmp_dir, "region")
    region = project_strings(spark.read.parquet(f"{SF}/region.parquet"))
    for snap in ("20240101000000Z", "20210101000000Z"):
        write_incremental(region, path, snap)
    dry = {r["extraction_timestamp"]: r["tier"] for r in S.expire_snapshots(spark, path, "region", "2024-02-01").collect()}
    assert dry == {"20240101000000Z": "STANDARD", "20210101000000Z": "EXPIRED"}
    assert spark.read.parquet(path).count() == 10  # dry run deletes nothing
    S.expire_snapshots(spark, path, "region", "2024-02-01", dry_run=False)
    left = {r[0] for r in spark.read.parquet(path).select("extraction_timestamp").distinct().collect()}
    assert left == {"20240101000000Z"}


def test_expiry_in_files_and_catalog_resumes_after_a_crash(spark, tmp_dir, monkeypatch):
    import pytest
    from snapvault.sinks.writers import ensure_database, register_table, table_columns, write_incremental
    from snapvault.sources.tables import scan_exported
    path, db = os.path.join(tmp_dir, "t"), "sv_expiry"
    df = spark.range(3).selectExpr("id", "'20200101000000Z' AS extraction_timestamp")
    for snap in ("20200101000000Z", "20210101000000Z", "20240101000000Z"):
        write_incremental(df.drop("extraction_timestamp"), path, snap)
    ensure_database(spark, db)
    register_table(spark, db, "t", table_columns(df, "incremental"), path, "incremental")

    def agree():
        listed = {r["extraction_timestamp"] for r in S.snapshot_partitions(spark, path, "t").collect()}
        known = {r["partition"].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {db}.t").collect()}
        return listed, known
    assert agree() == ({"20200101000000Z", "20210101000000Z", "20240101000000Z"},) * 2

    def die(*args):
        raise KeyboardInterrupt()
    with monkeypatch.context() as m:  # after the first catalog partition is dropped, before its files are
        m.setattr(S, "forget_snapshot", die)
        with pytest.raises(KeyboardInterrupt):
            S.expire_snapshots(spark, path, "t", "2024-02-01", dry_run=False, catalog_table=f"{db}.t")
    S.expire_snapshots(spark, path, "t", "2020-02-01", dry_run=False, catalog_table=f"{db}.t")  # nothing new: only resumes
    assert agree() == ({"20240101000000Z"},) * 2
    assert scan_exported(spark, path).count() == spark.table(f"{db}.t").count() == 3
