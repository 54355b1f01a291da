"""Chunk planning: how many rows per file, how many chunks, which row ranges.

The plan is a DataFrame (one row per chunk) built from the table statistics,
the space report and the key map with one join and one ``explode`` of a
``sequence``: no driver loop over tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapvault.functions.fixed import DEFAULT_TARGET_FILE_MB, ROW_NUMBER_COLUMN
from snapvault.functions.values import num_chunks, parse_size_kb, row_size_kb, rows_per_chunk

PLAN_COLUMNS = ["database", "table_schema", "table_name", "rows", "rows_per_chunk",
                "chunk_index", "start_row", "end_row"]


def table_sizes(space_used: DataFrame, size_column: str = "reserved") -> DataFrame:
    """Parse the space report: rows and size in KB per table.

    ``size_column`` picks the figure used for the row size (``reserved``,
    the allocated space, by default; ``data`` is the other choice).
    """
    return space_used.select(
        "table_schema", "table_name",
        F.regexp_replace("rows", ",", "").cast("long").alias("rows"),
        parse_size_kb(size_column).alias("size_kb"),
    )


def plan_tables(sizes: DataFrame, keys: DataFrame, target_mb: float = DEFAULT_TARGET_FILE_MB,
                at_least_one: bool = True) -> DataFrame:
    """One row per table to export: rows, rows per chunk and chunk count.

    ``sizes``: table_schema, table_name, rows, size_kb (``table_sizes``).
    ``keys``: table_schema, table_name, primary_key array (``primary_keys``).
    Keyless and empty tables get one chunk.
    """
    joined = keys.join(sizes, ["table_schema", "table_name"], "left").select(
        "table_schema", "table_name", "primary_key",
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.coalesce("size_kb", F.lit(0.0)).alias("size_kb"),
    )
    keyed = F.size("primary_key") > 0
    with_n = joined.select(
        "*",
        row_size_kb("rows", "size_kb").alias("row_kb"),
        rows_per_chunk("rows", "size_kb", target_mb, at_least_one).alias("rows_per_chunk"),
    )
    return with_n.withColumn(
        "n_chunks",
        F.when(F.col("rows") == 0, F.lit(1))
        .when(~keyed | (F.col("rows_per_chunk") == 0), F.lit(1))
        .otherwise(num_chunks("rows", "rows_per_chunk")),
    )


def plan_chunks(sizes: DataFrame, keys: DataFrame, database: str,
                target_mb: float = DEFAULT_TARGET_FILE_MB, at_least_one: bool = True) -> DataFrame:
    """One row per chunk to export.

    * keyed table: ``ceil(rows / rows_per_chunk)`` chunks of consecutive
      key-ordered row numbers, ``[i*n + 1, min((i+1)*n, rows)]``;
    * keyless table with rows: one chunk with all rows;
    * empty table: one chunk with the empty range ``[1, 0]``, so an empty
      table (with its schema) is still written and counted as 0.

    ``sizes``: table_schema, table_name, rows, size_kb (``table_sizes``).
    ``keys``: table_schema, table_name, primary_key array (``primary_keys``).
    Only tables present in ``keys`` (the export list) are planned.
    """
    keyed = F.size("primary_key") > 0
    with_n = plan_tables(sizes, keys, target_mb, at_least_one)
    chunks = with_n.withColumn("chunk_index", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
    start = F.when(keyed & (F.col("rows_per_chunk") > 0),
                   F.col("chunk_index").cast("long") * F.col("rows_per_chunk") + 1).otherwise(F.lit(1).cast("long"))
    end = F.when(keyed & (F.col("rows_per_chunk") > 0),
                 F.least(start + F.col("rows_per_chunk") - 1, F.col("rows"))).otherwise(F.col("rows"))
    return chunks.select(
        F.lit(database).alias("database"),
        "table_schema", "table_name", "rows",
        F.col("rows_per_chunk").cast("long").alias("rows_per_chunk"),
        F.col("chunk_index").cast("int").alias("chunk_index"),
        start.cast("long").alias("start_row"),
        end.cast("long").alias("end_row"),
    )


def chunk_files(numbered: DataFrame, per_chunk: int, n_chunks: int, tasks: int,
                column: str = ROW_NUMBER_COLUMN) -> DataFrame:
    """A numbered table whose partitions begin and end where planned chunks do.

    Each of about ``tasks`` partitions holds a whole number of chunks in order
    of their row numbers, so a writer with ``maxRecordsPerFile = per_chunk``
    makes every chunk a file of its own.  Rows beyond the plan (the source has
    grown since) go on in the last partition.
    """
    each = max(1, -(-int(n_chunks) // max(1, int(tasks))))
    parts = -(-int(n_chunks) // each)
    part = F.least(F.floor((F.col(column) - 1) / (int(per_chunk) * each)), F.lit(parts - 1)).cast("int")
    return (numbered.withColumn("__sv_part", part).repartitionById(parts, F.col("__sv_part"))
            .sortWithinPartitions(column).drop("__sv_part"))


def file_ranges(exported: DataFrame, pk: list[str], column: str = ROW_NUMBER_COLUMN) -> DataFrame:
    """One row per file of a table that keeps its row numbers: first and last row and key, and its rows.

    ``exported`` comes straight from a reader (``scan_exported``).  Only the
    key and the row number are read, and summed up by file before the shuffle.
    """
    key = F.struct(*[F.col(f"`{c}`") for c in pk])
    row = F.col(f"`{column}`").cast("long")
    return exported.groupBy(F.input_file_name().alias("file")).agg(
        F.min(row).alias("first_row"), F.max(row).alias("last_row"), F.count("*").alias("n_rows"),
        F.min_by(key, row).alias("first_key"), F.max_by(key, row).alias("last_key"))


def check_ranges(chunks: DataFrame, ranges: DataFrame) -> DataFrame:
    """Planned chunks of one table against its files.

    status: ``BOUND`` (one file holds the range and nothing else), ``SPLIT``
    (a file begins the range but is not all of it), ``MISSING`` (no file begins
    it; an empty range is bound without one) or ``UNPLANNED`` (a file that
    begins elsewhere).
    """
    planned = chunks.select("chunk_index", "start_row", "end_row")
    files = ranges.where("n_rows > 0")
    status = (F.when(F.col("start_row").isNull(), "UNPLANNED")
              .when(F.col("first_row").isNull(), F.when(F.col("end_row") < F.col("start_row"), "BOUND").otherwise("MISSING"))
              .when((F.col("last_row") == F.col("end_row"))
                    & (F.col("n_rows") == F.col("end_row") - F.col("start_row") + 1), "BOUND").otherwise("SPLIT"))
    return (planned.join(files, F.col("start_row") == F.col("first_row"), "full")
            .select("chunk_index", "start_row", "end_row", "file", "n_rows", "first_key", "last_key", status.alias("status")))


def distinct_tables(chunks: DataFrame, keys=("database", "table_name")) -> DataFrame:
    """Unique (database, table) pairs of a chunk list or chunk results."""
    return chunks.select(*keys).distinct()
