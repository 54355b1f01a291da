"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapvault.session import scratch_path

#: Rows and bytes of one Arrow batch: a few MB of text, so that very long texts stay within memory.
BATCH_ROWS = 10000
BATCH_BYTES = 8 << 20
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def arrow_limits(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches handed to Python by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str, codec: str | None = None, free: bool = False) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts lineage, survives lost executors.

    ``codec``: the files' compression, where the session's own is not wanted.
    ``free``: the shuffles behind ``df`` go when it is written, not when the
    driver happens to collect its garbage.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write if codec is None else df.write.option("compression", codec)
    conf = df.sparkSession.conf
    before = conf.get(_FREE, None)
    if free:
        conf.set(_FREE, "true")
    try:
        writer.parquet(path)
    finally:
        if free:
            conf.unset(_FREE) if before is None else conf.set(_FREE, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(text_col: str) -> Column:
    """The text's UTF-8 bytes (the cast copies nothing); null becomes empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")


def text_hash(text_col: str) -> Column:
    """Tells rows apart that repeat an id with another text; null equals empty."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` named in ``kept`` (``id_col``, ``text_hash``), each once; columns unchanged.

    The row number runs on the join's own partitioning, so it adds no
    shuffle.  Null ids match null ids.
    """
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    tagged = docs.withColumn("__h", text_hash(text_col)).alias("d")
    names = kept.select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__kh")).distinct()
    joined = tagged.join(names, F.col(f"d.`{id_col}`").eqNullSafe(F.col("__id")) & (F.col("d.__h") == F.col("__kh")),
                         "left_semi")
    w = Window.partitionBy(F.col(f"`{id_col}`"), F.col("__h")).orderBy(F.lit(0))
    return (joined.withColumn("__n", F.row_number().over(w)).where("__n = 1")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def by_bytes(rows: list, most: int = 4 << 20):
    """Runs (start, end) of ``rows`` (strings or bytes) of about ``most`` characters, one row at least."""
    start, size = 0, 0
    for k, r in enumerate(rows):
        size += len(r)
        if size >= most:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(rows):
        yield start, len(rows)


#: The memories of the owners last used in this process, most recent last.
_MEMORIES: list = []
OWNERS = 2


def remembered(owner, now: set, most: int) -> dict:
    """``owner``'s memory of what it has worked out, kept between tasks of a process.

    Beyond ``most`` entries only those in use now stay: frequent ones do, and
    the memory stays bounded.  Only the ``OWNERS`` last used owners keep one,
    so a long-lived worker doesn't gather the memories of earlier jobs.
    """
    at = next((k for k, (o, _) in enumerate(_MEMORIES) if o is owner), None)
    known = {} if at is None else _MEMORIES.pop(at)[1]
    if len(known) + len(now) > most:
        known = {u: known[u] for u in now if u in known}
    _MEMORIES.append((owner, known))
    del _MEMORIES[:-OWNERS]
    return known
