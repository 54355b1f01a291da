"""User-facing jobs: plan, export, validate, export views, or all in order.

The driver only loops over table *names* (catalog metadata, bounded by the
number of tables); every row of data moves inside Spark tasks.  Tables are
exported concurrently from a small driver thread pool (``max_concurrency``),
each as its own Spark job, so one failing table records ``FAILED`` in the
run status instead of stopping the rest.
"""

from __future__ import annotations

import datetime as _dt
import math
import os
import random
import threading
import time
import traceback
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault.commits import CommitConflict, version_of
from snapvault.functions.fixed import (
    DEFAULT_MAX_CONCURRENCY,
    DEFAULT_TARGET_FILE_MB,
    FAILURE_MESSAGE_FORMAT,
    ROW_NUMBER_COLUMN,
    ROWVERSION_TYPES,
    SNAPSHOT_COLUMN,
    SNAPSHOT_FORMAT_PY,
)
from snapvault.functions.values import map_type
from snapvault.operators.metadata import primary_keys, table_stats, view_definitions
from snapvault.operators.numbering import key_ordered, row_number_pk
from snapvault.operators.projections import add_snapshot, filter_allowlist, project_strings, project_typed
from snapvault.operators.validation import (
    VALIDATION_SCHEMA,
    check_mode,
    count_exported,
    init_validation,
    reconcile_counts,
    upsert_validation,
)
from snapvault.plans.chunks import chunk_files, plan_chunks, plan_tables, table_sizes
from snapvault.session import local_frame
from snapvault.streaming.streams import status_events_from_runs
from snapvault.sources.catalog import fixed_width
from snapvault.sources.tables import scan_exported
from snapvault.sinks.writers import (
    path_exists, ensure_database,
    register_table,
    refresh_partitions,
    table_columns,
    target_records_per_file,
    write_full,
    write_incremental,
    write_views,
)

STORED_SCHEMA = "table_schema string, " + VALIDATION_SCHEMA
STATUS_SCHEMA = "database string, table_name string, status string, message string, output_path string"


def new_snapshot_id(now: _dt.datetime | None = None) -> str:
    """Snapshot id for a run started now (UTC)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now.astimezone(_dt.timezone.utc).strftime(SNAPSHOT_FORMAT_PY)


@dataclass
class ExportConfig:
    database: str
    output_root: str
    mode: str = "incremental"
    snapshot: str | None = None
    target_mb: float = DEFAULT_TARGET_FILE_MB
    max_concurrency: int = DEFAULT_MAX_CONCURRENCY
    tables_to_export: list[str] = field(default_factory=list)
    get_views: bool = False
    register: bool = False
    null_policy: str = "preserve"
    typed: bool = False
    keep_row_number: bool = False
    order_by_key: bool = False
    size_column: str = "reserved"
    validation_path: str | None = None
    # how a file-backed source measures table sizes for chunk planning:
    # "files" (footers + storage sizes, no data read) or "exact" (one scan)
    size_estimate: str = "files"
    # data per task when a table is re-partitioned (key order, numbering) or
    # read over JDBC; files stay at target_mb through maxRecordsPerFile
    partition_mb: float = 256.0
    # every planned row range of a keyed table is one file (needs keep_row_number; one more shuffle)
    bind_chunks: bool = False
    # cut files that are off target_mb by more than a factor of two anew before the commit
    fit_files: bool = False
    # where failed tables are reported as status events (read by stream_failures)
    events_path: str | None = None
    machine_arn: str = "snapvault:export"
    # per-table time limit in seconds: the table's Spark jobs are cancelled and
    # it is recorded as TIMED_OUT; the run goes on (None: no limit)
    table_timeout_s: float | None = None
    # a table whose export fails is tried again this often, so many seconds apart
    # (not after its time limit)
    retries: int = 2
    retry_wait_s: float = 5.0

    def __post_init__(self):
        check_mode(self.mode)
        if self.bind_chunks and (self.fit_files or not self.keep_row_number):
            raise ValueError("bind_chunks needs keep_row_number and excludes fit_files")
        if self.snapshot is None:
            self.snapshot = new_snapshot_id()

    def table_path(self, table: str) -> str:
        return os.path.join(self.output_root, self.database, table) + "/"

    @property
    def validation_location(self) -> str:
        return self.validation_path or os.path.join(self.output_root, self.database, "table_export_validation")


@dataclass
class ExportPlan:
    stats: DataFrame        # table_schema, table_name, original_row_count
    keys: DataFrame         # table_schema, table_name, primary_key
    chunks: DataFrame       # PLAN_COLUMNS
    validation: DataFrame   # initial validation rows
    tables: list[dict]      # per-table metadata on the driver (names, keys, sizes)
    catalog: object
    columns: dict = field(default_factory=dict)  # (schema, table) -> [(column, source type, target type)]


def plan_export(source, cfg: ExportConfig) -> ExportPlan:
    """Scan the catalog and plan chunks for every table to export."""
    spark = source.spark
    cat = source.catalog(profile=cfg.size_estimate)
    stats = table_stats(cat).cache()
    keys = filter_allowlist(primary_keys(cat), cfg.tables_to_export)
    sizes = table_sizes(cat.space_used, cfg.size_column)
    chunks = plan_chunks(sizes, keys, cfg.database, cfg.target_mb)  # lazy: for inspection
    validation = init_validation(stats, cfg.snapshot)
    # one row per table (names, keys, sizes): the only thing the driver holds
    per_table = plan_tables(sizes, keys, cfg.target_mb).select(
        "table_schema", "table_name", "primary_key", "rows", "rows_per_chunk", "n_chunks")
    tables = sorted((r.asDict() for r in per_table.collect()),
                    key=lambda m: (m["table_schema"], m["table_name"]))
    # exported tables are named without their schema: two schemas with one
    # table name would share a path, so refuse that up front
    seen: dict[str, int] = {}
    for m in tables:
        seen[m["table_name"]] = seen.get(m["table_name"], 0) + 1
    clashes = sorted(n for n, c in seen.items() if c > 1)
    if clashes:
        raise ValueError(f"table names exported from several schemas: {clashes}")
    # column metadata the export needs, in one small job: only the
    # row-version columns, or every column's target type in typed mode
    columns: dict = {}
    info = cat.info_columns
    if not cfg.typed:
        info = info.where(F.lower("data_type").isin(*ROWVERSION_TYPES))
    for r in info.select("table_schema", "table_name", "column_name", "data_type",
                         map_type("data_type").alias("target")).collect():
        columns.setdefault((r["table_schema"], r["table_name"]), []).append(
            (r["column_name"], r["data_type"], r["target"]))
    if cfg.register:
        ensure_database(spark, cfg.database, comment=f"Catalog for {cfg.database}")
    return ExportPlan(stats, keys, chunks, validation, tables, cat, columns)


def task_partitions(meta: dict, cfg: ExportConfig) -> int:
    """Tasks for one table: about ``partition_mb`` of data each.

    A chunk holds about ``target_mb``, so a table of ``n_chunks`` chunks
    holds about ``n_chunks * target_mb``; each task then writes several
    chunk-sized files (``maxRecordsPerFile``) of contiguous keys.
    """
    n_chunks = int(meta.get("n_chunks") or 1)
    rows, per_chunk = int(meta.get("rows") or 0), int(meta.get("rows_per_chunk") or 0)
    if per_chunk > 0:
        # a keyless table is planned as one chunk, but its data still spans
        # rows / rows_per_chunk chunk-sized files: size its tasks by that
        n_chunks = max(n_chunks, math.ceil(rows / per_chunk))
    return max(1, math.ceil(n_chunks * float(cfg.target_mb) / float(cfg.partition_mb)))


#: Bytes that a value takes in a row in memory, what a text takes besides, and what a row and its sort entry do.
VALUE_BYTES, TEXT_BYTES, ROW_BYTES = 8, 16, 40
#: A text's bytes in memory for one byte on storage, where files are compressed.
UNPACKED = 4


def sort_partitions(df: DataFrame, meta: dict, cfg: ExportConfig) -> int:
    """Tasks for a table that is sorted: about ``partition_mb`` of rows in memory each.

    Files hold columns packed (repeated values take next to nothing there), a
    sort holds rows: every row's fixed part counts in full, and stored bytes as
    what they unpack to.
    """
    texts = sum(not fixed_width(f.dataType) for f in df.schema.fields)
    width = ROW_BYTES + VALUE_BYTES * len(df.columns) + TEXT_BYTES * texts
    fixed = int(meta.get("rows") or 0) * width / (float(cfg.partition_mb) * (1 << 20))
    stored = task_partitions(meta, cfg)
    return max(stored, math.ceil(fixed + UNPACKED * (stored_mb(meta, cfg) / float(cfg.partition_mb) if texts else 0)))


def stored_mb(meta: dict, cfg: ExportConfig) -> float:
    """About what a table takes on storage: its rows over the rows of ``target_mb``."""
    rows, per_chunk = int(meta.get("rows") or 0), int(meta.get("rows_per_chunk") or 0)
    return rows / per_chunk * float(cfg.target_mb) if per_chunk else 0.0


def _prepare_table(source, plan: ExportPlan, cfg: ExportConfig, meta: dict) -> DataFrame:
    schema, table, pk = meta["table_schema"], meta["table_name"], list(meta["primary_key"] or [])
    tasks = task_partitions(meta, cfg)
    df = source.table_for_export(schema, table, pk, tasks)
    cols = plan.columns.get((schema, table), [])
    rv = [name for name, source_type, _ in cols if source_type.lower() in ROWVERSION_TYPES]
    if pk and (cfg.keep_row_number or cfg.order_by_key):
        tasks = sort_partitions(df, meta, cfg)
    if cfg.keep_row_number and pk:
        df = row_number_pk(df, pk, num_partitions=tasks)
        if cfg.bind_chunks and meta["rows_per_chunk"]:
            df = chunk_files(df, meta["rows_per_chunk"], meta["n_chunks"], tasks)
    elif cfg.order_by_key and pk:
        df = key_ordered(df, pk, tasks)
    if cfg.typed:
        targets = {name: target for name, _, target in cols if name not in rv}
        keep = [c for c in df.columns if c in targets or c == ROW_NUMBER_COLUMN]
        df = project_strings(df, cfg.null_policy, rv, exclude=keep)
        df = project_typed(df, targets)
    else:
        df = project_strings(df, cfg.null_policy, rv, exclude=[ROW_NUMBER_COLUMN])
    return add_snapshot(df, cfg.snapshot)


def _job_group(spark: SparkSession, group: str, text: str) -> bool:
    """Put this thread's Spark jobs in a cancellable group; False if unsupported."""
    try:
        spark.sparkContext.setJobGroup(group, text, interruptOnCancel=True)
        return True
    except Exception:  # remote sessions: no job groups
        return False


def export_table(source, plan: ExportPlan, cfg: ExportConfig, meta: dict) -> tuple:
    table = meta["table_name"]
    path = cfg.table_path(table)
    spark = source.spark
    group = f"snapvault-{cfg.database}-{table}-{uuid.uuid4().hex[:8]}"
    grouped = _job_group(spark, group, f"export {cfg.database}.{table} snapshot {cfg.snapshot}")
    expired = threading.Event()
    timer = None
    if cfg.table_timeout_s and grouped:
        def cancel():
            expired.set()
            spark.sparkContext.cancelJobGroup(group)
        timer = threading.Timer(float(cfg.table_timeout_s), cancel)
        timer.daemon = True
        timer.start()
    timed_out = (cfg.database, table, "TIMED_OUT", FAILURE_MESSAGE_FORMAT % table, path)
    try:
        for attempt in range(1 + max(0, int(cfg.retries))):
            try:
                done = _export_one(source, plan, cfg, meta, table, path, expired)
                return timed_out if expired.is_set() else done
            except (AnalysisException, ValueError):  # a missing table or a bad setting fails again
                raise
            except Exception:
                # the limit covers all attempts together
                if attempt == cfg.retries or expired.wait(float(cfg.retry_wait_s)):
                    raise
    except Exception as exc:  # recorded per table; the run goes on
        if expired.is_set():
            return timed_out
        detail = "".join(traceback.format_exception_only(type(exc), exc)).strip()
        return (cfg.database, table, "FAILED", (FAILURE_MESSAGE_FORMAT % table) + " " + detail, path)
    finally:
        if timer is not None:
            timer.cancel()
        if grouped:
            for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
                spark.sparkContext.setLocalProperty(key, None)


def _export_one(source, plan: ExportPlan, cfg: ExportConfig, meta: dict, table: str, path: str,
                expired: threading.Event) -> tuple:
    df = _prepare_table(source, plan, cfg, meta)
    limit = target_records_per_file(meta["rows_per_chunk"])
    target = int(cfg.target_mb * (1 << 20)) if cfg.fit_files else None
    if expired.is_set():  # the limit passed between two jobs, when there was none to cancel
        raise TimeoutError(table)
    if cfg.mode == "full":
        write_full(df, path, limit, target)
    else:
        write_incremental(df, path, cfg.snapshot, limit, target_bytes=target)
    if cfg.register:
        register_table(source.spark, cfg.database, table, table_columns(df, cfg.mode), path, cfg.mode,
                       ", ".join(meta["primary_key"] or []),
                       f"Imported from {source.database}.{meta['table_schema']}.{table}")
        if cfg.mode == "incremental":
            refresh_partitions(source.spark, cfg.database, table)
    return (cfg.database, table, "OK", None, path)


def export_tables(source, plan: ExportPlan, cfg: ExportConfig, extra_tables: list[dict] | None = None) -> DataFrame:
    """Export every planned table; returns the run status (one row per table)."""
    metas = list(plan.tables) + list(extra_tables or [])
    workers = max(1, int(cfg.max_concurrency))
    with ThreadPoolExecutor(max_workers=workers) as pool:
        results = list(pool.map(lambda m: export_table(source, plan, cfg, m), metas))
    return local_frame(source.spark, results, STATUS_SCHEMA)


def validate_export(spark: SparkSession, plan: ExportPlan, status: DataFrame, cfg: ExportConfig,
                    write: bool = True) -> DataFrame:
    """Count what arrived, set it beside the source counts, store the result.

    The validation table keeps history, partitioned by snapshot; this run's
    rows are merged into its snapshot by one commit, so re-running the
    validation is idempotent.
    """
    # every table that got to write is counted: a timed-out table shows what
    # arrived (MISMATCH); a failed one counts as not exported
    exported = {r["table_name"]: r["output_path"]
                for r in status.where(F.col("status").isin("OK", "TIMED_OUT"))
                .select("table_name", "output_path").collect()}
    schemas = local_frame(spark, [(m["table_schema"], m["table_name"]) for m in plan.tables],
                          "table_schema string, table_name string")
    # exported names are unique (plan_export refuses clashes), so each has one schema
    counts = count_exported(spark, exported, cfg.mode, cfg.snapshot).join(schemas, "table_name")
    reconciled = reconcile_counts(plan.validation, counts)
    # one row per table: catalog metadata, held once for the write and the caller
    reconciled = local_frame(spark, reconciled.collect(), reconciled.schema)
    if write:
        names = [r["table_name"] for r in status.select("table_name").collect()]
        schema_of = {m["table_name"]: m["table_schema"] for m in plan.tables}
        store_validation(spark, reconciled, cfg, tried=[(schema_of[n], n) for n in names if n in schema_of])
    return reconciled


def store_validation(spark: SparkSession, rows: DataFrame, cfg: ExportConfig, tried=(), attempts: int = 20) -> None:
    """Upsert ``rows`` into this snapshot's partition of the validation table.

    A table that an earlier run of the snapshot counted and that is not among
    the ``tried`` ones keeps its stored count.  The partition is committed only
    if no other run has committed it since it was read; otherwise it is read
    and merged again, so runs at the same time keep each other's rows.
    """
    updates = rows.select(*[c.split()[0] for c in STORED_SCHEMA.split(", ")])
    location = cfg.validation_location
    keys = ["table_schema", "table_name", SNAPSHOT_COLUMN]
    names = local_frame(spark, [(s, t) for s, t in tried], "table_schema string, table_name string")
    for attempt in range(attempts):
        version = version_of(spark, location, cfg.snapshot)
        if path_exists(spark, f"{location}/{SNAPSHOT_COLUMN}={cfg.snapshot}"):
            existing = scan_exported(spark, location, cfg.snapshot).select(*updates.columns)
        else:
            existing = local_frame(spark, [], STORED_SCHEMA)
        known = existing.where("exported_row_count is not null").join(names, ["table_schema", "table_name"], "left_anti")
        kept = updates.join(known.select(*keys), keys, "left_anti").select(*existing.columns)
        merged = upsert_validation(existing, kept, keys)
        # one row per table; taken to the driver before the partition just read is replaced
        merged = local_frame(spark, merged.collect(), merged.schema).coalesce(1)
        try:
            write_incremental(merged, location, cfg.snapshot, expected_version=version)
            break
        except CommitConflict:
            if attempt == attempts - 1:
                raise
            time.sleep(random.uniform(0.05, 0.3) * (attempt + 1))
    if cfg.register:
        name = os.path.basename(location.rstrip("/"))
        register_table(spark, cfg.database, name, table_columns(merged, "incremental"), location, "incremental")
        refresh_partitions(spark, cfg.database, name)


def export_views(source, cfg: ExportConfig) -> DataFrame:
    """Write view names and definitions (text) with the snapshot id."""
    cat = source.catalog(profile=False) if hasattr(source, "catalog") else source
    views = view_definitions(cat.sys_views, cat.sys_sql_modules)
    out = add_snapshot(project_strings(views, cfg.null_policy), cfg.snapshot)
    path = cfg.table_path("view_definitions")
    write_views(out, path)
    return source.spark.read.parquet(path)


@dataclass
class RunResult:
    plan: ExportPlan
    status: DataFrame
    validation: DataFrame
    views: DataFrame | None = None


def run_export(source, cfg: ExportConfig) -> RunResult:
    """Plan, export, validate and (optionally) export views, in that order."""
    plan = plan_export(source, cfg)
    # what the source held is on record even if the run dies while it exports
    store_validation(source.spark, plan.validation, cfg)
    status = export_tables(source, plan, cfg)  # driver-side rows already, one per table
    if cfg.events_path:
        # one event per failed table, appended where the alert stream listens
        events = status_events_from_runs(status, cfg.machine_arn)
        events.write.mode("append").parquet(cfg.events_path)
    validation = validate_export(source.spark, plan, status, cfg)
    views = export_views(source, cfg) if cfg.get_views else None
    return RunResult(plan, status, validation, views)
