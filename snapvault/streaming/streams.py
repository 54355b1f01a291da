"""Structured Streaming jobs around the export.

* ``stream_landing``: files arriving in a landing folder start export runs.
  The file source lists new files (``binaryFile`` format; the content column
  is never selected, so no file body is read), checks the suffix, derives the
  run parameters (snapshot id from the file's modification time, UTC) and
  sends files with a wrong suffix to a reject output.
* ``stream_failures``: run-status events in, alerts out, for failed,
  timed-out and aborted runs of known state machines.

Both are stateless per-row streams: no watermark or state store is needed,
and the checkpoint in the shared folder makes them restartable (exactly-once
with the Parquet file sink).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault.commits import Files, forget_snapshot
from snapvault.functions.fixed import (
    FAILED_STATES,
    RETENTION_ARCHIVE_DAYS,
    RETENTION_EXPIRE_DAYS,
    RETENTION_INFREQUENT_DAYS,
    SNAPSHOT_COLUMN,
    SNAPSHOT_FORMAT,
    STATUS_DETAIL_TYPE,
)
from snapvault.functions.values import is_landing_key, snapshot_id
from snapvault.session import local_frame

STATUS_EVENT_SCHEMA = (
    "source string, detail_type string, "
    "detail struct<executionArn: string, stateMachineArn: string, name: string, "
    "status: string, time: string, table: string>"
)
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
ALERT_COLUMNS = ["StateMachineARN", "ExecutionARN", "ExecutionName", "Status", "Time"]


# ---------------------------------------------------------------- landing

def landing_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """Streaming DataFrame: one row per new file in ``folder`` (path, time, size)."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select("path", "modificationTime", "length")


def landing_runs(files: DataFrame, database: str, suffix: str = ".bak",
                 output_root: str | None = None) -> DataFrame:
    """Run parameters per landed file; ``accepted`` tells whether its suffix fits."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.col("path").alias("landing_path"),
        name.alias("file_name"),
        F.col("length").alias("file_bytes"),
        is_landing_key(name, suffix).alias("accepted"),
        F.lit(database).alias("database"),
        snapshot_id("modificationTime").alias("extraction_timestamp"),
        F.lit(output_root).cast("string").alias("output_root"),
    )


def stream_landing(spark: SparkSession, folder: str, out: str, database: str,
                   suffix: str = ".bak", glob: str | None = None, available_now: bool = True,
                   output_root: str | None = None):
    """Run the landing stream into ``out/accepted`` and ``out/rejected``.

    Each micro-batch overwrites its own ``batch_id=N`` folder, so a batch
    replayed after a failure replaces its output instead of adding to it
    (exactly once, together with the checkpoint).  Returns the finished
    (``available_now``) or running query.
    """
    runs = landing_runs(landing_files(spark, folder, glob), database, suffix, output_root)

    def route(batch: DataFrame, epoch: int) -> None:
        for kind, cond in (("accepted", "accepted"), ("rejected", "NOT accepted")):
            target = os.path.join(out, kind, f"batch_id={epoch}")
            batch.where(cond).write.mode("overwrite").parquet(target)

    writer = (runs.writeStream.foreachBatch(route)
              .option("checkpointLocation", os.path.join(out, "_checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


# ---------------------------------------------------------------- failures

def failure_alerts(events: DataFrame, sources=("aws.states", "database.export"),
                   machines: list[str] | None = None, states=FAILED_STATES) -> DataFrame:
    """Keep failed/timed-out/aborted status events of known machines; project 5 fields.

    Works on batch and streaming DataFrames alike (a filter and a select).
    """
    cond = (F.col("source").isin(*sources) & (F.col("detail_type") == STATUS_DETAIL_TYPE)
            & F.col("detail.status").isin(*states))
    if machines is not None:
        cond = cond & F.col("detail.stateMachineArn").isin(*machines)
    return events.where(cond).select(
        F.col("detail.stateMachineArn").alias("StateMachineARN"),
        F.col("detail.executionArn").alias("ExecutionARN"),
        F.col("detail.name").alias("ExecutionName"),
        F.col("detail.status").alias("Status"),
        F.col("detail.time").alias("Time"),
    )


def stream_failures(events: DataFrame, out: str, sources=("aws.states", "database.export"),
                    machines: list[str] | None = None, available_now: bool = True):
    """Run the alert stream from a streaming status-event DataFrame to Parquet at ``out``."""
    alerts = failure_alerts(events, sources, machines)
    writer = (alerts.writeStream.format("parquet")
              .option("path", os.path.join(out, "alerts"))
              .option("checkpointLocation", os.path.join(out, "_checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def status_events_from_runs(status: DataFrame, machine_arn: str, time_col=None) -> DataFrame:
    """Turn per-table run status rows into status events (one per non-OK table)."""
    time_value = time_col if time_col is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return status.where(F.col("status") != "OK").select(
        F.lit("database.export").alias("source"),
        F.lit(STATUS_DETAIL_TYPE).alias("detail_type"),
        F.struct(
            F.concat(F.lit(machine_arn + ":"), F.col("table_name")).alias("executionArn"),
            F.lit(machine_arn).alias("stateMachineArn"),
            F.format_string("Failed to extract data for %s table.", F.col("table_name")).alias("name"),
            F.col("status").alias("status"),
            time_value.alias("time"),
            F.col("table_name").alias("table"),
        ).alias("detail"),
    )


# ---------------------------------------------------------------- retention

def retention_tiers(snapshots: DataFrame, as_of) -> DataFrame:
    """Age class of every snapshot on ``as_of`` (a date or date text).

    ``STANDARD`` below 90 days, ``INFREQUENT`` from 90, ``ARCHIVE`` from 365,
    ``EXPIRED`` from 730 (the caller deletes expired partitions).
    """
    when = F.to_timestamp("extraction_timestamp", SNAPSHOT_FORMAT)
    as_of_col = as_of if not isinstance(as_of, str) else F.to_date(F.lit(as_of))
    age = F.datediff(as_of_col, F.to_date(when))
    tier = (F.when(age >= RETENTION_EXPIRE_DAYS, "EXPIRED")
            .when(age >= RETENTION_ARCHIVE_DAYS, "ARCHIVE")
            .when(age >= RETENTION_INFREQUENT_DAYS, "INFREQUENT")
            .otherwise("STANDARD"))
    return snapshots.select("table_name", "extraction_timestamp",
                            age.cast("int").alias("age_days"), tier.alias("tier"))


def snapshot_partitions(spark: SparkSession, table_path: str, table_name: str) -> DataFrame:
    """Snapshot partitions of an exported table, from the file listing (no data read)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(table_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prefix = "extraction_timestamp="
    snaps = []
    if fs.exists(root):
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith(prefix):
                snaps.append((table_name, name[len(prefix):], status.getPath().toString()))
    return local_frame(spark, snaps, "table_name string, extraction_timestamp string, path string")


def expire_snapshots(spark: SparkSession, table_path: str, table_name: str, as_of,
                     dry_run: bool = True, catalog_table: str | None = None) -> DataFrame:
    """Classify a table's snapshots and delete the expired ones, from the files and from the catalog.

    Returns the tiers (with each partition's path).  With ``dry_run`` (the
    default) nothing is deleted: the caller sees what would go.

    An expired snapshot is marked first (an empty file ``_expired/<snapshot>``
    below the table), then its catalog partition is dropped (``catalog_table``,
    as ``database.table``), then its log and files, and the mark last.  A run
    that dies in between leaves the mark, and the next one goes on from it.
    """
    parts = snapshot_partitions(spark, table_path, table_name)
    tiers = retention_tiers(parts, as_of).join(parts.select("extraction_timestamp", "path"),
                                               "extraction_timestamp")
    if not dry_run:
        # what is returned is what was there before
        tiers = local_frame(spark, tiers.collect(), tiers.schema)  # one row a snapshot
        root = table_path.rstrip("/")
        files = Files(spark, root)
        marks = f"{root}/_expired"
        files.make_folder(marks)
        for row in tiers.where(F.col("tier") == "EXPIRED").select("extraction_timestamp").collect():
            files.put_if_absent(f"{marks}/{row[0]}", "")
        for snapshot, is_folder, _ in files.list(marks):
            if is_folder or snapshot.startswith(".") or snapshot.endswith(".tmp"):
                continue
            if catalog_table:
                spark.sql(f"ALTER TABLE {catalog_table} DROP IF EXISTS PARTITION ({SNAPSHOT_COLUMN} = '{snapshot}')")
            forget_snapshot(spark, root, snapshot)
            files.delete(f"{marks}/{snapshot}")
    return tiers
