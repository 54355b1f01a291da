"""

Every query reads the given tables (or what Spark derives from them) in
full.  The test folder plays the source database: each Parquet file is one
table of schema ``dbo``; primary keys are declared below.  Queries that
export write to a fresh folder under the shared checkpoint folder and read
the result back.
"""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from snapvault.functions.values import (  # noqa: E402
    decode_text, failure_message, is_landing_key, long_to_rowversion, map_type, num_chunks,
    parse_size_kb, row_size_kb, rows_per_chunk, rowversion_hex, snapshot_id, split_name, target_path,
)
from snapvault.operators.metadata import (  # noqa: E402
    key_string, list_columns, list_schemas, list_tables, primary_keys, table_stats,
)
from snapvault.operators.numbering import row_number_pk, scan_chunked  # noqa: E402
from snapvault.operators.projections import (  # noqa: E402
    add_snapshot, drop_row_number, filter_allowlist, filter_pattern, filter_row_range,
    filter_snapshot, project_strings, project_typed,
)
from snapvault.operators.validation import (  # noqa: E402
    columns_frame, count_exported, init_validation, latest_per_table, reconcile_counts,
    schema_drift, upsert_validation,
)
from snapvault.plans.chunks import (  # noqa: E402
    check_ranges, chunk_files, distinct_tables, file_ranges, plan_chunks, plan_tables, table_sizes,
)
from snapvault.plans.jobs import ExportConfig, export_tables, plan_export, run_export, validate_export  # noqa: E402
from snapvault.session import prepare, scratch_path  # noqa: E402
from snapvault.sinks.writers import (  # noqa: E402
    ensure_database, register_table, table_columns, write_full, write_incremental,
)
from snapvault.sources.tables import ParquetSource, scan_exported, scan_full, scan_query  # noqa: E402
from snapvault.streaming.streams import failure_alerts, landing_runs, landing_files, retention_tiers  # noqa: E402

# Fixed values of the test source (the given tables).
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
    "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
    "events": ["event_id"], "documents": ["doc_id"], "embeddings": ["vec_id"],
    "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}  # lineitem has no unique key: exported as one keyless chunk
DATABASE = "shop"
SNAP_1 = "20240101000000Z"
SNAP_2 = "20240201000000Z"
TARGET_MB = 0.25          # small file target so sf0.01 tables split into several chunks
CHUNK_ROWS = 1000         # fixed chunk size for the row-range queries
RANGE_START, RANGE_END = 21, 60  # rows of one chunk
AS_OF = "2001-06-01"
PART_PATTERNS = ["%ring", "RED%", "b_ue%"]
ALLOWLIST = ["dbo.orders", "dbo.lineitem", "customer"]


def _src(spark: SparkSession, sf_dir: str) -> ParquetSource:
    prepare(spark)
    return ParquetSource(spark, sf_dir, keys=KEYS, database=DATABASE)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _strings_with_snapshot(df: DataFrame, snap: str) -> DataFrame:
    return add_snapshot(project_strings(df), snap)


def _export_two_snapshots(spark, sf_dir, name, label) -> str:
    """Write ``name`` as snapshot 1, again as snapshot 1 (a retry), then snapshot 2."""
    path = scratch_path(spark, label)
    df = _t(spark, sf_dir, name)
    write_incremental(_strings_with_snapshot(df, SNAP_1), path)
    write_incremental(_strings_with_snapshot(df, SNAP_1), path)  # idempotent retry
    write_incremental(_strings_with_snapshot(df, SNAP_2), path)
    return path


def _export_all(spark, sf_dir, label, snapshots=(SNAP_1, SNAP_2), tables=None) -> dict[str, str]:
    """Export tables as snapshots: one write job per table, tables concurrently."""
    root = scratch_path(spark, label)
    src = _src(spark, sf_dir)
    names = list(tables or TABLES)

    def one(name):
        path = os.path.join(root, name)
        table = project_strings(src.table("dbo", name))
        both = reduce(DataFrame.unionByName, [add_snapshot(table, s) for s in snapshots])
        write_incremental(both, path)
        return name, path

    with ThreadPoolExecutor(max_workers=8) as pool:
        return dict(pool.map(one, names))


def _stats(spark, sf_dir) -> DataFrame:
    """Row counts per table; footers answer them, no data is read."""
    return table_stats(_src(spark, sf_dir).catalog(profile="files")).select("table_name", "original_row_count")


def _sizes(spark, sf_dir) -> DataFrame:
    return table_sizes(_src(spark, sf_dir).catalog().space_used)


def _plan(spark, sf_dir) -> DataFrame:
    cat = _src(spark, sf_dir).catalog()
    return plan_chunks(table_sizes(cat.space_used), primary_keys(cat), DATABASE, TARGET_MB)


# ---------------------------------------------------------------- scans

def q_scan_full(spark, sf_dir):
    return scan_full(_src(spark, sf_dir), "lineitem")


def q_scan_query(spark, sf_dir):
    return scan_query(_src(spark, sf_dir), SCAN_QUERY_SQL)


SCAN_QUERY_SQL = (
    "SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, c.c_name, c.c_mktsegment "
    "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"
)


def q_scan_chunked(spark, sf_dir):
    return scan_chunked(_t(spark, sf_dir, "orders"), ["o_orderkey"], CHUNK_ROWS)


def q_row_number_pk(spark, sf_dir):
    return row_number_pk(_t(spark, sf_dir, "conversations"), ["conv_id", "turn"])


def q_filter_row_range(spark, sf_dir):
    """One chunk's ``rn BETWEEN start AND end`` over the numbered table (the row range is the feature)."""
    numbered = row_number_pk(_t(spark, sf_dir, "conversations"), ["conv_id", "turn"])
    return filter_row_range(numbered, F.lit(RANGE_START), F.lit(RANGE_END))


def q_list_schemas(spark, sf_dir):
    return list_schemas(_src(spark, sf_dir).catalog(profile=False).sys_schemas)


def q_list_tables(spark, sf_dir):
    return list_tables(_src(spark, sf_dir).catalog(profile=False).info_tables)


def q_list_columns(spark, sf_dir):
    cols = list_columns(_src(spark, sf_dir).catalog(profile=False).info_columns)
    return cols.select("table_name", "column_name", "data_type")


def q_scan_exported(spark, sf_dir):
    return scan_exported(spark, _export_two_snapshots(spark, sf_dir, "orders", "scan-exported"))


def q_filter_snapshot(spark, sf_dir):
    path = _export_two_snapshots(spark, sf_dir, "orders", "filter-snapshot")
    return filter_snapshot(scan_exported(spark, path), SNAP_2)


# ---------------------------------------------------------------- filters, projections

def q_filter_pattern(spark, sf_dir):
    return filter_pattern(_t(spark, sf_dir, "part"), "p_name", PART_PATTERNS)


def q_filter_allowlist(spark, sf_dir):
    cat = _src(spark, sf_dir).catalog(profile="files")
    stats = table_stats(cat)
    return filter_allowlist(stats, ALLOWLIST).select("table_name", "original_row_count")


def q_project_strings(spark, sf_dir):
    return project_strings(_t(spark, sf_dir, "orders"))


def q_project_typed(spark, sf_dir):
    src = _src(spark, sf_dir)
    cols = src.catalog(["orders"], profile=False).info_columns
    targets = {r["column_name"]: r["t"] for r in
               cols.select("column_name", map_type("data_type").alias("t")).collect()}  # 6 names
    return project_typed(project_strings(src.table("dbo", "orders")), targets)


def q_map_type(spark, sf_dir):
    cols = _src(spark, sf_dir).catalog(profile=False).info_columns
    return cols.select("table_name", "column_name", "data_type", map_type("data_type").alias("target_type"))


def q_add_snapshot(spark, sf_dir):
    return add_snapshot(_t(spark, sf_dir, "events"), SNAP_1)


def q_drop_row_number(spark, sf_dir):
    return drop_row_number(row_number_pk(_t(spark, sf_dir, "orders"), ["o_orderkey"]))


# ---------------------------------------------------------------- catalog joins, aggregates

def q_primary_keys(spark, sf_dir):
    pk = key_string(primary_keys(_src(spark, sf_dir).catalog(profile=False)))
    return pk.select("table_schema", "table_name", "source_primary_key",
                     F.size("primary_key").alias("key_columns"))


def q_key_string(spark, sf_dir):
    pk = key_string(primary_keys(_src(spark, sf_dir).catalog(profile=False)))
    return pk.select("table_name", "source_primary_key")


def q_table_stats(spark, sf_dir):
    return _stats(spark, sf_dir)


def q_distinct_tables(spark, sf_dir):
    return distinct_tables(_plan(spark, sf_dir))


# ---------------------------------------------------------------- scalar functions

def q_decode_text(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    # every second text ends in a byte that UTF-8 doesn't allow there
    stray = F.when(F.col("doc_id") % 2 == 0, F.lit(b"\x80")).otherwise(F.lit(b""))
    return docs.select("doc_id", decode_text(F.concat(F.encode("text", "UTF-8"), stray), prefer="utf-8").alias("decoded"))


def q_decode_text_cp1252(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    return docs.select("doc_id", decode_text(F.encode("text", "UTF-8")).alias("decoded"))


def q_rowversion_hex(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    return orders.select("o_orderkey", rowversion_hex(long_to_rowversion("o_orderkey")).alias("rowversion"))


def q_parse_size_kb(spark, sf_dir):
    space = _src(spark, sf_dir).catalog().space_used
    return space.select("table_name", F.col("rows").cast("long").alias("rows"),
                        parse_size_kb("reserved").alias("size_kb"))


def q_rows_per_chunk(spark, sf_dir):
    s = _sizes(spark, sf_dir)
    return s.select("table_name", "rows", "size_kb", row_size_kb("rows", "size_kb").alias("row_kb"),
                    rows_per_chunk("rows", "size_kb", TARGET_MB).alias("rows_per_chunk"))


def q_num_chunks(spark, sf_dir):
    s = _sizes(spark, sf_dir).withColumn("rows_per_chunk", rows_per_chunk("rows", "size_kb", TARGET_MB))
    return s.select("table_name", "rows", "rows_per_chunk",
                    num_chunks("rows", "rows_per_chunk").alias("num_chunks"))


def q_map_split_name(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    schema, table = split_name("url")
    return pages.select("page_id", schema.alias("name_schema"), table.alias("name_table"))


def q_snapshot_id(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", snapshot_id("ts").alias("extraction_timestamp"))


def q_is_landing_key(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    return pages.select("page_id", is_landing_key("url", "#top").alias("accepted"))


def q_target_path(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer")
    return cust.select("c_custkey", target_path("exports", F.col("c_mktsegment"), F.col("c_name")).alias("path"))


def q_failure_message(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer")
    return cust.select("c_custkey", failure_message("c_name").alias("message"))


# ---------------------------------------------------------------- plans, sinks

def q_plan_chunks(spark, sf_dir):
    return _plan(spark, sf_dir)


def q_chunk_files(spark, sf_dir):
    """Export orders with one file for each planned row range, and check plan and files against each other."""
    cat = _src(spark, sf_dir).catalog(["orders"])
    sizes, keys = table_sizes(cat.space_used), primary_keys(cat).where("table_name = 'orders'")
    one = plan_tables(sizes, keys, TARGET_MB).first()  # one row: the table's
    path = scratch_path(spark, "chunk-files")
    numbered = row_number_pk(_t(spark, sf_dir, "orders"), ["o_orderkey"])
    write_full(chunk_files(numbered, one["rows_per_chunk"], one["n_chunks"], 3), path, one["rows_per_chunk"])
    plan = plan_chunks(sizes, keys, DATABASE, TARGET_MB)
    return check_ranges(plan, file_ranges(spark.read.parquet(path), ["o_orderkey"])).select(
        "chunk_index", "start_row", "end_row", "n_rows", F.col("first_key.o_orderkey").alias("first_key"),
        F.col("last_key.o_orderkey").alias("last_key"), "status")


def q_write_full(spark, sf_dir):
    path = scratch_path(spark, "write-full")
    df = _strings_with_snapshot(_t(spark, sf_dir, "orders"), SNAP_1)
    write_full(df, path)
    write_full(df, path)  # a rerun replaces, never appends
    return spark.read.parquet(path)


def q_write_incremental(spark, sf_dir):
    return spark.read.parquet(_export_two_snapshots(spark, sf_dir, "orders", "write-incremental"))


def q_target_file_size(spark, sf_dir):
    """Export lineitem with the planned per-file row limit; check every file keeps it."""
    cat = _src(spark, sf_dir).catalog(["lineitem"])
    plan = plan_chunks(table_sizes(cat.space_used), primary_keys(cat), DATABASE, TARGET_MB)
    limit = plan.agg(F.max("rows_per_chunk")).first()[0]  # one number
    path = scratch_path(spark, "target-file-size")
    write_full(_strings_with_snapshot(_t(spark, sf_dir, "lineitem"), SNAP_1), path, limit)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).count()
    return per_file.agg(
        F.sum("count").cast("long").alias("rows"),
        F.bool_and(F.col("count") <= F.lit(limit)).alias("within_limit"),  # every file
    ).select(F.lit("lineitem").alias("table_name"), "rows", "within_limit")


def q_target_file_bytes(spark, sf_dir):
    """Export documents (1 to thousands of words a row) with files of a target size in bytes; check every file but the smallest."""
    docs = _strings_with_snapshot(_t(spark, sf_dir, "documents"), SNAP_1)
    path, target = scratch_path(spark, "target-file-bytes"), 64 << 10
    write_full(docs, path, target_bytes=target)
    back = spark.read.parquet(path)
    per_file = (back.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("size"),
                            F.octet_length("text").alias("text_bytes"))
                .groupBy("f").agg(F.first("size").alias("size"), F.count("*").alias("rows"), F.sum("text_bytes").alias("b")))
    # a row longer than the target is a file of its own
    fits = (F.col("size") <= 2 * target) | (F.col("rows") == 1)
    return per_file.agg(
        F.sum("rows").cast("long").alias("rows"), F.sum("b").cast("long").alias("text_bytes"), F.bool_and(fits).alias("none_above"),
        (F.count_if(F.col("size") < target / 2) <= 1).alias("one_below_at_most"))


def q_register_table(spark, sf_dir):
    path = scratch_path(spark, "register-table")
    df = _strings_with_snapshot(_t(spark, sf_dir, "orders"), SNAP_1)
    write_incremental(df, path)
    db = "sv_" + os.path.basename(path).replace("-", "_")
    ensure_database(spark, db, comment=f"Catalog for {DATABASE}", location=path + "_db")
    register_table(spark, db, "orders", table_columns(df, "incremental"), path, "incremental", "o_orderkey",
                   f"Imported from {DATABASE}.dbo.orders")
    return spark.table(f"{db}.orders")


def q_count_exported(spark, sf_dir):
    return count_exported(spark, _export_all(spark, sf_dir, "count-exported"), "incremental")


def q_init_validation(spark, sf_dir):
    return init_validation(_stats(spark, sf_dir), SNAP_1)


def q_reconcile_counts(spark, sf_dir):
    exported_tables = [t for t in TABLES if t not in ("documents", "pages")]
    paths = _export_all(spark, sf_dir, "reconcile", (SNAP_1,), exported_tables)
    counts = count_exported(spark, paths, "incremental", SNAP_1)
    return reconcile_counts(init_validation(_stats(spark, sf_dir), SNAP_1), counts)


def q_upsert_validation(spark, sf_dir):
    stats = _stats(spark, sf_dir)
    existing = init_validation(stats, SNAP_1).unionByName(init_validation(stats, SNAP_2))
    counts = count_exported(spark, _export_all(spark, sf_dir, "upsert", (SNAP_2,)), "incremental", SNAP_2)
    updates = reconcile_counts(init_validation(stats, SNAP_2), counts).drop("status")
    return upsert_validation(existing, updates)


def q_latest_per_table(spark, sf_dir):
    stats = _stats(spark, sf_dir)
    counts = count_exported(spark, _export_all(spark, sf_dir, "latest"), "incremental")
    history = reconcile_counts(
        init_validation(stats, SNAP_1).unionByName(init_validation(stats, SNAP_2)), counts).drop("status")
    return latest_per_table(history)


def q_schema_drift(spark, sf_dir):
    src = _t(spark, sf_dir, "orders")
    exported = _strings_with_snapshot(src, SNAP_1).withColumn("rn", F.lit(0).cast("long"))  # only names and types count
    return schema_drift(columns_frame(spark, src), columns_frame(spark, exported))


# ---------------------------------------------------------------- jobs, status, streams

def q_run_status(spark, sf_dir):
    src = _src(spark, sf_dir)
    cfg = ExportConfig(database=DATABASE, output_root=scratch_path(spark, "run-status"),
                       snapshot=SNAP_1, target_mb=TARGET_MB)
    plan = plan_export(src, cfg)
    missing = {"table_schema": "dbo", "table_name": "missing_table", "primary_key": [],
               "rows": 0, "rows_per_chunk": 0, "n_chunks": 1}
    return export_tables(src, plan, cfg, extra_tables=[missing]).select("database", "table_name", "status")


def q_run_export(spark, sf_dir):
    src = _src(spark, sf_dir)
    cfg = ExportConfig(database=DATABASE, output_root=scratch_path(spark, "run-export"),
                       snapshot=SNAP_1, target_mb=TARGET_MB, mode="incremental")
    return run_export(src, cfg).validation


def q_validate_export(spark, sf_dir):
    """Export in full mode, then validate twice: the stored table stays the same."""
    src = _src(spark, sf_dir)
    cfg = ExportConfig(database=DATABASE, output_root=scratch_path(spark, "validate"),
                       snapshot=SNAP_2, target_mb=TARGET_MB, mode="full", order_by_key=True)
    plan = plan_export(src, cfg)
    status = export_tables(src, plan, cfg)
    validate_export(spark, plan, status, cfg)
    validate_export(spark, plan, status, cfg)
    return spark.read.parquet(cfg.validation_location)


def _events_as_status(df: DataFrame) -> DataFrame:
    """Map rows of ``events`` to run-status events: errors are failed runs."""
    return df.select(
        F.lit("database.export").alias("source"),
        F.lit("Step Functions Execution Status Change").alias("detail_type"),
        F.struct(
            F.concat(F.lit("arn:execution:"), F.col("event_id").cast("string")).alias("executionArn"),
            F.lit("arn:machine:export").alias("stateMachineArn"),
            F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("name"),
            F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("status"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
            F.col("event_type").alias("table"),
        ).alias("detail"),
    )


def q_stream_failures(spark, sf_dir):
    prepare(spark)
    schema = _t(spark, sf_dir, "events").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .option("maxFilesPerTrigger", 1).parquet(sf_dir))
    out = scratch_path(spark, "stream-failures")
    alerts = failure_alerts(_events_as_status(stream), machines=["arn:machine:export"])
    q = (alerts.writeStream.format("parquet").option("path", os.path.join(out, "alerts"))
         .option("checkpointLocation", os.path.join(out, "_checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(os.path.join(out, "alerts"))


def q_stream_landing(spark, sf_dir):
    prepare(spark)
    out = scratch_path(spark, "stream-landing")
    runs = landing_runs(landing_files(spark, sf_dir), DATABASE, ".parquet")
    q = (runs.writeStream.format("parquet").option("path", os.path.join(out, "runs"))
         .option("checkpointLocation", os.path.join(out, "_checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(os.path.join(out, "runs")).select("file_name", "accepted", "database")


def q_retention_tiers(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    snaps = orders.select(F.lit("orders").alias("table_name"),
                          snapshot_id("o_orderdate").alias("extraction_timestamp")).distinct()
    return retention_tiers(snaps, AS_OF)


# ---------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: snapshot every sf0.001 table, validate, return the reconciliation."""
    return q_run_export(spark, "/root/testdata/sf0.001").drop("table_schema")  # one schema here


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries of the library itself."""
    return {
        "scan_full": q_scan_full,
        "scan_chunked": q_scan_chunked,
        "scan_query": q_scan_query,
        "list_schemas": q_list_schemas,
        "list_tables": q_list_tables,
        "list_columns": q_list_columns,
        "scan_exported": q_scan_exported,
        "filter_pattern": q_filter_pattern,
        "filter_allowlist": q_filter_allowlist,
        "filter_row_range": q_filter_row_range,
        "filter_snapshot": q_filter_snapshot,
        "project_strings": q_project_strings,
        "project_typed": q_project_typed,
        "add_snapshot": q_add_snapshot,
        "drop_row_number": q_drop_row_number,
        "primary_keys": q_primary_keys,
        "table_stats": q_table_stats,
        "reconcile_counts": q_reconcile_counts,
        "count_exported": q_count_exported,
        "key_string": q_key_string,
        "distinct_tables": q_distinct_tables,
        "row_number_pk": q_row_number_pk,
        "latest_per_table": q_latest_per_table,
        "schema_drift": q_schema_drift,
        "decode_text": q_decode_text,
        "decode_text_cp1252": q_decode_text_cp1252,
        "rowversion_hex": q_rowversion_hex,
        "parse_size_kb": q_parse_size_kb,
        "rows_per_chunk": q_rows_per_chunk,
        "num_chunks": q_num_chunks,
        "map_type": q_map_type,
        "split_name": q_map_split_name,
        "snapshot_id": q_snapshot_id,
        "is_landing_key": q_is_landing_key,
        "target_path": q_target_path,
        "failure_message": q_failure_message,
        "plan_chunks": q_plan_chunks,
        "chunk_files": q_chunk_files,
        "write_full": q_write_full,
        "write_incremental": q_write_incremental,
        "target_file_size": q_target_file_size,
        "target_file_bytes": q_target_file_bytes,
        "register_table": q_register_table,
        "init_validation": q_init_validation,
        "upsert_validation": q_upsert_validation,
        "stream_landing": q_stream_landing,
        "stream_failures": q_stream_failures,
        "run_status": q_run_status,
        "retention_tiers": q_retention_tiers,
        "run_export": q_run_export,
        "validate_export": q_validate_export,
    }


# ---------------------------------------------------------------- DuckDB oracles

def _parquet_schema(name: str):
    import pyarrow.parquet as pq
    for sf in ("sf0.01", "sf0.001", "sf0.1"):
        p = f"/root/testdata/{sf}/{name}.parquet"
        if os.path.exists(p):
            return pq.read_schema(p)
    raise FileNotFoundError(name)


def _byte_expr(field) -> str:
    import pyarrow as pa
    c, t = f'"{field.name}"', field.type
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return f"COALESCE(strlen({c}), 0)"
    if pa.types.is_list(t):
        width = 4 if t.value_type.bit_width == 32 else 8
        return f"COALESCE(len({c}) * {width}, 0)"
    if pa.types.is_boolean(t) or t.bit_width == 8:
        width = 1
    elif t.bit_width == 16:
        width = 2
    elif t.bit_width == 32:
        width = 4
    else:
        width = 8
    return f"CASE WHEN {c} IS NULL THEN 0 ELSE {width} END"


def _counts_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS original_row_count FROM {t}" for t in TABLES)


def _sizes_sql() -> str:
    parts = []
    for t in TABLES:
        row_bytes = " + ".join(_byte_expr(f) for f in _parquet_schema(t))
        parts.append(
            f"SELECT 'dbo' AS table_schema, '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows, "
            f"CAST(CEIL(COALESCE(SUM({row_bytes}), 0) / 1024.0) AS DOUBLE) AS size_kb FROM {t}")
    return " UNION ALL ".join(parts)


def _keys_sql() -> str:
    rows = []
    for t in TABLES:
        pk = KEYS.get(t, [])
        rows.append(f"('dbo', '{t}', '{', '.join(pk)}', {len(pk)})")
    return ("SELECT * FROM (VALUES " + ", ".join(rows) +
            ") AS k(table_schema, table_name, source_primary_key, key_columns)")


def _rpc_sql(target_mb: float) -> str:
    return (f"CASE WHEN rows > 0 AND size_kb > 0 THEN CAST(GREATEST(FLOOR({target_mb} * 1024.0 / (size_kb / rows)), 1) "
            f"AS BIGINT) ELSE CAST(0 AS BIGINT) END")


def _plan_sql() -> str:
    return f"""
WITH s AS ({_sizes_sql()}),
k AS ({_keys_sql()}),
j AS (
  SELECT k.table_schema, k.table_name, k.key_columns, s.rows, {_rpc_sql(TARGET_MB)} AS rpc
  FROM k LEFT JOIN s USING (table_schema, table_name)),
n AS (
  SELECT *, CASE WHEN rows = 0 OR key_columns = 0 OR rpc = 0 THEN 1
                 ELSE CAST((rows + rpc - 1) // rpc AS INTEGER) END AS n_chunks FROM j),
c AS (SELECT *, UNNEST(range(0, n_chunks)) AS chunk_index FROM n)
SELECT '{DATABASE}' AS database, table_schema, table_name, rows, rpc AS rows_per_chunk,
       CAST(chunk_index AS INTEGER) AS chunk_index,
       CAST(CASE WHEN key_columns > 0 AND rpc > 0 THEN chunk_index * rpc + 1 ELSE 1 END AS BIGINT) AS start_row,
       CAST(CASE WHEN key_columns > 0 AND rpc > 0 THEN LEAST(chunk_index * rpc + rpc, rows) ELSE rows END AS BIGINT)
         AS end_row
FROM c"""


def _strings_sql(table: str, extra: str = "") -> str:
    cols = ", ".join(f'CAST("{f.name}" AS VARCHAR) AS "{f.name}"' for f in _parquet_schema(table))
    return f"SELECT {cols}{extra} FROM {table}"


_SOURCE_TYPE = """CASE upper(column_type)
  WHEN 'BOOLEAN' THEN 'bit' WHEN 'TINYINT' THEN 'tinyint' WHEN 'SMALLINT' THEN 'smallint'
  WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'FLOAT' THEN 'real'
  WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'nvarchar' WHEN 'BLOB' THEN 'varbinary'
  WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP' THEN 'datetime2' ELSE 'varbinary' END"""

_MAP_TYPE = """CASE WHEN t = 'bit' THEN 'boolean'
  WHEN t IN ('tinyint', 'smallint', 'int') THEN 'int' WHEN t = 'bigint' THEN 'bigint'
  WHEN t LIKE '%float%' OR t LIKE '%real%' OR t LIKE '%double%' THEN 'double'
  WHEN t LIKE '%decimal%' OR t LIKE '%numeric%' THEN 'decimal'
  WHEN t LIKE '%char%' OR t LIKE '%text%' THEN 'string'
  WHEN t IN ('timestamp', 'rowversion') THEN 'string'
  WHEN t LIKE '%date%' OR t LIKE '%time%' THEN 'timestamp' ELSE 'string' END"""


def _columns_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, column_name, {_SOURCE_TYPE} AS data_type FROM (DESCRIBE {t})" for t in TABLES)


def _export_counts_sql(snaps, tables=None) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{s}' AS extraction_timestamp, CAST(COUNT(*) AS BIGINT) AS exported_row_count "
        f"FROM {t}" for t in (tables or TABLES) for s in snaps)


#: Fixed values of the published windows-1252 table: byte -> code point where it differs from Latin-1.
CP1252_CODE_POINTS = {
    0x80: 0x20AC, 0x82: 0x201A, 0x83: 0x0192, 0x84: 0x201E, 0x85: 0x2026, 0x86: 0x2020, 0x87: 0x2021,
    0x88: 0x02C6, 0x89: 0x2030, 0x8A: 0x0160, 0x8B: 0x2039, 0x8C: 0x0152, 0x8E: 0x017D, 0x91: 0x2018,
    0x92: 0x2019, 0x93: 0x201C, 0x94: 0x201D, 0x95: 0x2022, 0x96: 0x2013, 0x97: 0x2014, 0x98: 0x02DC,
    0x99: 0x2122, 0x9A: 0x0161, 0x9B: 0x203A, 0x9C: 0x0153, 0x9E: 0x017E, 0x9F: 0x0178}
CP1252_NO_CHARACTER = [0x81, 0x8D, 0x8F, 0x90, 0x9D]


def _cp1252_decode_sql(stray: bool = False) -> str:
    """cp1252-first decoding of each text's UTF-8 bytes, spelled out in SQL.

    ``stray``: UTF-8 first, even ids with the byte 80 at the end (no UTF-8 then).

    The UTF-8 bytes are rebuilt from code points; a text whose bytes include
    a byte cp1252 leaves undefined falls back to UTF-8 (the text itself);
    otherwise every byte maps through cp1252 (the published table).
    """
    undefined = ", ".join(map(str, CP1252_NO_CHARACTER))
    cases = " ".join(f"WHEN {byte} THEN chr({point})" for byte, point in CP1252_CODE_POINTS.items())
    u = "unicode(ch)"
    utf8 = (f"CASE WHEN {u} < 128 THEN [{u}] "
            f"WHEN {u} < 2048 THEN [192 | ({u} >> 6), 128 | ({u} & 63)] "
            f"WHEN {u} < 65536 THEN [224 | ({u} >> 12), 128 | (({u} >> 6) & 63), 128 | ({u} & 63)] "
            f"ELSE [240 | ({u} >> 18), 128 | (({u} >> 12) & 63), 128 | (({u} >> 6) & 63), 128 | ({u} & 63)] END")
    more, whole, fallback = "", "", "text"
    if stray:
        more = " || CASE WHEN doc_id % 2 = 0 THEN [128] ELSE [] END"
        whole = " WHEN doc_id % 2 <> 0 THEN text"
        fallback = "array_to_string(list_transform(bytes, lambda x: chr(x)), '')"
    return f"""
WITH b AS (
  SELECT doc_id, text,
         flatten(list_transform(list_filter(string_split(text, ''), lambda ch: ch <> ''), lambda ch: {utf8})){more} AS bytes
  FROM documents)
SELECT doc_id,
       CASE WHEN text IS NULL THEN NULL{whole}
            WHEN list_has_any(bytes, [{undefined}]) THEN {fallback}
            ELSE array_to_string(list_transform(bytes, lambda x: CASE x {cases} ELSE chr(x) END), '') END AS decoded
FROM b"""


def core_oracles() -> dict[str, str]:
    """DuckDB statements equal in value to each query.

    A count column that holds NULLs (exported counts not known yet) reaches
    pandas as float64 from Spark, since Spark's conversion has no nullable
    integer; the oracles state those same values as DOUBLE so both sides
    compare in one representation (NULL -> NaN, 40 -> 40.0).
    """
    orders_strings = _strings_sql("orders")
    orders_snap = lambda s: _strings_sql("orders", f", '{s}' AS extraction_timestamp")
    not_pattern = " OR ".join(f"p_name ILIKE '{p}'" for p in PART_PATTERNS)
    counts = _counts_sql()
    exported_tables = [t for t in TABLES if t not in ("documents", "pages")]
    return {
        "scan_full": "SELECT * FROM lineitem",
        "scan_chunked": (
            f"SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS rn, "
            f"CAST((ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1) // {CHUNK_ROWS} AS INTEGER) AS chunk_index "
            f"FROM orders"),
        "scan_query": SCAN_QUERY_SQL,
        "list_schemas": "SELECT 'dbo' AS schema_name",
        "list_tables": " UNION ALL ".join(
            f"SELECT 'dbo' AS table_schema, '{t}' AS table_name" for t in TABLES),
        "list_columns": _columns_sql(),
        "scan_exported": f"{orders_snap(SNAP_1)} UNION ALL {orders_snap(SNAP_2)}",
        "filter_pattern": f"SELECT * FROM part WHERE NOT COALESCE({not_pattern}, FALSE)",
        "filter_allowlist": f"SELECT * FROM ({counts}) WHERE table_name IN ('orders', 'lineitem', 'customer')",
        "filter_row_range": f"""
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY conv_id, turn) AS rn FROM conversations)
WHERE rn BETWEEN {RANGE_START} AND {RANGE_END}""",
        "filter_snapshot": orders_snap(SNAP_2),
        "project_strings": orders_strings,
        "project_typed": "SELECT * FROM orders",
        "add_snapshot": f"SELECT *, '{SNAP_1}' AS extraction_timestamp FROM events",
        "drop_row_number": "SELECT * FROM orders",
        "primary_keys": _keys_sql(),
        "key_string": f"SELECT table_name, source_primary_key FROM ({_keys_sql()})",
        "table_stats": counts,
        "reconcile_counts": f"""
WITH o AS ({counts}), e AS ({_export_counts_sql([SNAP_1], exported_tables)})
SELECT o.table_name, o.original_row_count, CAST(e.exported_row_count AS DOUBLE) AS exported_row_count,
       '{SNAP_1}' AS extraction_timestamp,
       CASE WHEN e.exported_row_count IS NULL THEN 'NOT_EXPORTED'
            WHEN e.exported_row_count = o.original_row_count THEN 'MATCH' ELSE 'MISMATCH' END AS status
FROM o LEFT JOIN e ON o.table_name = e.table_name""",
        "count_exported": _export_counts_sql([SNAP_1, SNAP_2]),
        "distinct_tables": f"SELECT DISTINCT database, table_name FROM ({_plan_sql()})",
        "row_number_pk": "SELECT *, ROW_NUMBER() OVER (ORDER BY conv_id, turn) AS rn FROM conversations",
        "latest_per_table": f"""
SELECT table_name, original_row_count, original_row_count AS exported_row_count,
       '{SNAP_2}' AS extraction_timestamp FROM ({counts})""",
        "schema_drift": """
WITH d AS (SELECT lower(column_name) AS name,
                  CASE upper(column_type) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                       WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
                       WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp'
                       ELSE lower(column_type) END AS type
           FROM (DESCRIBE orders)),
e AS (SELECT name, 'string' AS type FROM d UNION ALL SELECT 'extraction_timestamp', 'string')
SELECT name, type, 'removed' AS side FROM (SELECT * FROM d EXCEPT ALL SELECT * FROM e)
UNION ALL
SELECT name, type, 'added' AS side FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM d)""",
        "decode_text": _cp1252_decode_sql(stray=True),
        "decode_text_cp1252": _cp1252_decode_sql(),
        "stream_landing": " UNION ALL ".join(
            f"SELECT '{t}.parquet' AS file_name, TRUE AS accepted, '{DATABASE}' AS database" for t in TABLES),
        "rowversion_hex": "SELECT o_orderkey, lower(printf('%016x', o_orderkey)) AS rowversion FROM orders",
        "parse_size_kb": f"SELECT table_name, rows, size_kb FROM ({_sizes_sql()})",
        "rows_per_chunk": f"""
SELECT table_name, rows, size_kb,
       CASE WHEN rows > 0 AND size_kb > 0 THEN size_kb / rows ELSE 0.0 END AS row_kb,
       {_rpc_sql(TARGET_MB)} AS rows_per_chunk
FROM ({_sizes_sql()})""",
        "num_chunks": f"""
SELECT table_name, rows, rows_per_chunk,
       CAST(CASE WHEN rows_per_chunk > 0 THEN (rows + rows_per_chunk - 1) // rows_per_chunk ELSE 1 END AS INTEGER)
         AS num_chunks
FROM (SELECT table_name, rows, {_rpc_sql(TARGET_MB)} AS rows_per_chunk FROM ({_sizes_sql()}))""",
        "map_type": f"SELECT table_name, column_name, data_type, {_MAP_TYPE} AS target_type "
                    f"FROM (SELECT *, data_type AS t FROM ({_columns_sql()}))",
        "split_name": """
SELECT page_id,
       CASE WHEN instr(url, '.') > 0 THEN split_part(url, '.', 1) END AS name_schema,
       CASE WHEN instr(url, '.') > 0 THEN substr(url, instr(url, '.') + 1) ELSE url END AS name_table
FROM pages""",
        "snapshot_id": "SELECT event_id, strftime(ts, '%Y%m%d%H%M%SZ') AS extraction_timestamp FROM events",
        "is_landing_key": "SELECT page_id, ends_with(lower(url), '#top') AS accepted FROM pages",
        "target_path": "SELECT c_custkey, 'exports/' || c_mktsegment || '/' || c_name || '/' AS path FROM customer",
        "failure_message": "SELECT c_custkey, 'Failed to extract data for ' || c_name || ' table.' AS message "
                           "FROM customer",
        "plan_chunks": _plan_sql(),
        "chunk_files": f"""
SELECT p.chunk_index, p.start_row, p.end_row, COUNT(*) AS n_rows, MIN(o_orderkey) AS first_key,
       MAX(o_orderkey) AS last_key, 'BOUND' AS status
FROM ({_plan_sql()}) p JOIN (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS rn FROM orders) o
  ON o.rn BETWEEN p.start_row AND p.end_row
WHERE p.table_name = 'orders' GROUP BY ALL""",
        "write_full": orders_snap(SNAP_1),
        "write_incremental": f"{orders_snap(SNAP_1)} UNION ALL {orders_snap(SNAP_2)}",
        "target_file_size": "SELECT 'lineitem' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows, TRUE AS within_limit "
                            "FROM lineitem",
        "target_file_bytes": "SELECT COUNT(*) AS rows, CAST(SUM(octet_length(encode(text))) AS BIGINT) AS text_bytes, "
                             "TRUE AS none_above, TRUE AS one_below_at_most FROM documents",
        "register_table": orders_snap(SNAP_1),
        "init_validation": f"SELECT table_name, original_row_count, CAST(NULL AS DOUBLE) AS exported_row_count, "
                           f"'{SNAP_1}' AS extraction_timestamp FROM ({counts})",
        "upsert_validation": f"""
SELECT table_name, original_row_count, CAST(NULL AS DOUBLE) AS exported_row_count,
       '{SNAP_1}' AS extraction_timestamp FROM ({counts})
UNION ALL
SELECT table_name, original_row_count, CAST(original_row_count AS DOUBLE) AS exported_row_count,
       '{SNAP_2}' AS extraction_timestamp FROM ({counts})""",
        "stream_failures": """
SELECT 'arn:machine:export' AS StateMachineARN, 'arn:execution:' || CAST(event_id AS VARCHAR) AS ExecutionARN,
       'run-' || CAST(event_id AS VARCHAR) AS ExecutionName, 'FAILED' AS Status,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS Time
FROM events WHERE event_type = 'error'""",
        "run_status": " UNION ALL ".join(
            [f"SELECT '{DATABASE}' AS database, '{t}' AS table_name, 'OK' AS status" for t in TABLES]
            + [f"SELECT '{DATABASE}' AS database, 'missing_table' AS table_name, 'FAILED' AS status"]),
        "retention_tiers": f"""
WITH s AS (SELECT DISTINCT 'orders' AS table_name, strftime(o_orderdate, '%Y%m%d%H%M%SZ') AS extraction_timestamp,
                  CAST(o_orderdate AS DATE) AS d FROM orders),
a AS (SELECT table_name, extraction_timestamp, CAST(date_diff('day', d, DATE '{AS_OF}') AS INTEGER) AS age_days FROM s)
SELECT table_name, extraction_timestamp, age_days,
       CASE WHEN age_days >= 730 THEN 'EXPIRED' WHEN age_days >= 365 THEN 'ARCHIVE'
            WHEN age_days >= 90 THEN 'INFREQUENT' ELSE 'STANDARD' END AS tier
FROM a""",
        "run_export": f"""
SELECT 'dbo' AS table_schema, table_name, original_row_count, original_row_count AS exported_row_count,
       '{SNAP_1}' AS extraction_timestamp, 'MATCH' AS status FROM ({counts})""",
        "validate_export": f"""
SELECT 'dbo' AS table_schema, table_name, original_row_count, original_row_count AS exported_row_count,
       '{SNAP_2}' AS extraction_timestamp FROM ({counts})""",
    }


# ---------------------------------------------------------------- training-data operators, when they are there

def _training() -> tuple[dict, dict]:
    """Queries and oracles of the training-data package and its pipeline.

    None where those files, or a module that they need, are absent: the
    library's own queries work all the same.
    """
    try:
        import corpus_pipeline
        from snapvault.llm import queries as training
    except ModuleNotFoundError as absent:
        warnings.warn(f"no training-data queries: {absent}", stacklevel=2)
        return {}, {}
    oracles = dict(training.oracle_sql())
    if corpus_pipeline.ORACLE_SQL:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**training.queries(), "pipeline": corpus_pipeline.run}, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**core_queries(), **_training()[0]}


def oracle_sql() -> dict[str, str]:
    return {**core_oracles(), **_training()[1]}
