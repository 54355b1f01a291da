"""Row-count validation: exported counts, reconciliation, history, drift."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault.functions.fixed import ROW_NUMBER_COLUMN, SNAPSHOT_COLUMN
from snapvault.session import local_frame
from snapvault.sources.catalog import grouped_counts, tagged_rows
from snapvault.sources.tables import scan_exported

VALIDATION_SCHEMA = (
    "table_name string, original_row_count long, exported_row_count long, extraction_timestamp string"
)
MODES = ("full", "incremental")
#: Nothing was written at the path: no folder, or one without a file to take the schema from.
NOT_WRITTEN = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return mode


def count_exported(spark: SparkSession, tables: dict[str, str], mode: str = "incremental",
                   snapshot: str | None = None) -> DataFrame:
    """``COUNT(*)`` per exported table: per snapshot (incremental) or whole (full).

    ``tables`` maps table name -> export path.  Every table's committed rows are
    tagged with its name (and snapshot) without reading column data, and one
    ``groupBy`` over their union counts them all: one map stage with partial
    aggregation and one small shuffle, lazy and of one kind for any number of
    tables.  A snapshot filter prunes partitions; an empty or absent table (or
    snapshot) still reports 0.
    """
    check_mode(mode)

    def open_table(item):
        name, path = item
        try:
            return name, scan_exported(spark, path, snapshot if mode == "incremental" else None)
        except AnalysisException as exc:
            if exc.getCondition() not in NOT_WRITTEN:
                raise
            return name, None

    # opening a table reads its log, its listing and one footer on the driver: I/O
    # bound, so tables are opened concurrently
    items = sorted(tables.items())
    with ThreadPoolExecutor(max_workers=min(16, max(1, len(items)))) as pool:
        opened = list(pool.map(open_table, items))
    per_snapshot = mode == "incremental" and snapshot is None
    keys = ["table_name", SNAPSHOT_COLUMN]
    tagged = [tagged_rows(df, {"table_name": name, SNAPSHOT_COLUMN: F.col(SNAPSHOT_COLUMN) if per_snapshot else F.lit(snapshot)})
              for name, df in opened if df is not None]
    # tables that must report 0: all of them, or (by snapshot) those where nothing readable lies
    expected = local_frame(spark, [(name, snapshot) for name, df in opened if df is None or not per_snapshot],
                           "table_name string, extraction_timestamp string")
    return (grouped_counts(tagged, keys, expected)
            .select("table_name", SNAPSHOT_COLUMN, F.col("rows").alias("exported_row_count")))


def init_validation(stats: DataFrame, snapshot: str) -> DataFrame:
    """One row per source table: original count, exported count not yet known.

    ``table_schema`` is carried along where ``stats`` has it.
    """
    return stats.select(
        *[c for c in ("table_schema", "table_name") if c in stats.columns],
        F.col("original_row_count").cast("long"),
        F.lit(None).cast("long").alias("exported_row_count"),
        F.lit(snapshot).alias(SNAPSHOT_COLUMN),
    )


def reconcile_counts(original: DataFrame, exported: DataFrame) -> DataFrame:
    """Original beside exported count per (table, snapshot), with a status.

    Tables counted at the source but never exported keep a NULL exported
    count and the status ``NOT_EXPORTED``; otherwise ``MATCH``/``MISMATCH``.
    One left join replaces a lookup per table.  Where both sides name the
    schema, tables of one name in two schemas are kept apart.
    """
    schema = ["table_schema"] if "table_schema" in original.columns and "table_schema" in exported.columns else []
    keys = schema + ["table_name", SNAPSHOT_COLUMN]
    exp = exported.select(*keys, F.col("exported_row_count").alias("__exp"))
    joined = original.drop("exported_row_count").join(exp, keys, "left")
    status = (F.when(F.col("__exp").isNull(), "NOT_EXPORTED")
              .when(F.col("__exp") == F.col("original_row_count"), "MATCH")
              .otherwise("MISMATCH"))
    return joined.select(
        *schema, "table_name",
        F.col("original_row_count").cast("long"),
        F.col("__exp").cast("long").alias("exported_row_count"),
        SNAPSHOT_COLUMN,
        status.alias("status"),
    )


def upsert_validation(existing: DataFrame, updates: DataFrame,
                      keys=("table_name", SNAPSHOT_COLUMN)) -> DataFrame:
    """Replace rows of ``existing`` that share ``keys`` with ``updates``.

    An anti join keeps the untouched rows; the union adds the new ones.  The
    writer then replaces only the affected snapshots, each by one commit, and
    re-running it gives the same table.
    """
    cols = existing.columns
    kept = existing.join(updates.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*cols).unionByName(updates.select(*cols))


def latest_per_table(validation: DataFrame) -> DataFrame:
    """The newest validation record per table (largest snapshot id).

    Where the records name the schema, tables of one name in two schemas are
    kept apart.
    """
    keys = [c for c in ("table_schema", "table_name") if c in validation.columns]
    others = [c for c in validation.columns if c not in (*keys, SNAPSHOT_COLUMN)]
    latest = validation.groupBy(*keys).agg(
        F.max_by(F.struct(*others, SNAPSHOT_COLUMN), F.col(SNAPSHOT_COLUMN)).alias("__r"))
    return latest.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in others + [SNAPSHOT_COLUMN]])


def columns_frame(spark: SparkSession, df_or_pairs) -> DataFrame:
    """(name, type) rows of a DataFrame's schema, or of literal pairs."""
    if isinstance(df_or_pairs, DataFrame):
        pairs = [(f.name, f.dataType.simpleString()) for f in df_or_pairs.schema.fields]
    else:
        pairs = list(df_or_pairs)
    return local_frame(spark, pairs, "name string, type string")


def schema_drift(old: DataFrame, new: DataFrame, ignore=(ROW_NUMBER_COLUMN,)) -> DataFrame:
    """(name, type) pairs present on one side only, compared lower-cased.

    ``old`` and ``new`` have columns ``name`` and ``type``; the helper column
    ``rn`` is ignored.  The result has a ``side`` column: ``removed`` (only in
    ``old``) or ``added`` (only in ``new``).  Empty means no drift.
    """
    def norm(df):
        out = df.select(F.lower("name").alias("name"), F.lower("type").alias("type"))
        return out.where(~F.col("name").isin(*[i.lower() for i in ignore]))
    o, n = norm(old), norm(new)
    return (o.exceptAll(n).withColumn("side", F.lit("removed"))
            .unionByName(n.exceptAll(o).withColumn("side", F.lit("added"))))
