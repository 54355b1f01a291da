"""Global row numbers in primary-key order, and key-ordered chunks.

``ROW_NUMBER() OVER (ORDER BY pk)`` without ``PARTITION BY`` makes Spark put
the whole table in one task.  The scalable plan copies no data:

1. a sample of the keys (its size follows the number of ranges) is drawn by a
   hash of the keys, so the same rows give the same sample; its quantiles are
   the ranges' splitters.  They are stored below the shared folder and enter
   every later plan as one constant;
2. a row's range is found by binary search among the splitters, in native
   expressions.  One pass over the key columns counts each range (partial
   aggregation, one row per range); the running totals are stored: they are the
   ranges' offsets;
3. the table is shuffled once, each range to the partition of its own number,
   and sorted there; ``rn = offset[range] + position in the partition``.

A row's range depends on its key and the stored splitters alone, so a retried
task, a lost executor or a second job over the frame give the same numbers;
the table itself is never checkpointed.  A key value that several splitters
share (a hot key) is split by input position: rows with equal keys are numbered
in input order, which is stable where the input is (a scan of files); elsewhere
keys should be unique, or the input stored first.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapvault.functions.fixed import ROW_NUMBER_COLUMN
from snapvault.session import scratch_path

_TIE = "__sv_tie"
_RANGE = "__sv_range"
_OFF = "__sv_offset"
_CHUNK = "chunk_index"
#: Sampled keys per range, and bytes of one range where the caller names no number of ranges.
SAMPLE_PER_RANGE = 60
RANGE_BYTES = 256 << 20
#: Bits of ``monotonically_increasing_id`` that hold the position within a partition.
_POSITION = (1 << 33) - 1


def _order(pk):
    return [F.col(c).asc_nulls_first() for c in pk]


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def planned_ranges(df: DataFrame) -> int:
    """About ``RANGE_BYTES`` a range, by the size of what the plan reads (files: their bytes; no job).

    Where Spark knows no size (rows of the driver's own), the session's number
    of shuffle partitions.
    """
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if size >= 1 << 60:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(math.ceil(size / RANGE_BYTES), min(spark.sparkContext.defaultParallelism, max(1, size >> 20)))


def _key_type(df: DataFrame, pk: list[str]) -> T.StructType:
    fields = [T.StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(pk)]
    return T.StructType([*fields, T.StructField("tie", T.LongType())])


def key_splitters(df: DataFrame, pk: list[str], n: int) -> tuple[Column, int] | None:
    """The stored splitters of ``n`` ranges as one constant array of (key..., tie), and their number.

    ``df`` has the tie column.  None if there is nothing to split.

    ``tie`` is null where no other splitter has the key: then all rows of that
    key fall on one side, whatever their position.
    """
    kind = _key_type(df, pk)
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(pk)], F.col(_TIE).alias("tie"))
    drawn = (df.select(key.alias("key")).withColumn("h", F.xxhash64("key")).orderBy("h", "key")
             .limit(max(1000, n * SAMPLE_PER_RANGE)))
    # the sample's order and the quantiles: bounded by the number of ranges
    ranked = drawn.select("key", F.row_number().over(Window.orderBy("key")).alias("r"), F.count(F.lit(1)).over(Window.partitionBy()).alias("m"))
    at = F.floor(F.col("r") * n / F.col("m"))
    picked = (ranked.where((at > F.floor((F.col("r") - 1) * n / F.col("m"))) & (F.col("r") < F.col("m")))
              .select("key", "r"))
    same = [F.col(f"key.k{i}") for i in range(len(pk))]
    alone = F.row_number().over(Window.partitionBy(*same).orderBy("r")) == 1  # the first of a key takes all its rows
    tied = picked.select("r", F.struct(*[F.col(f"key.k{i}").alias(f"k{i}") for i in range(len(pk))],
                                       F.when(~alone, F.col("key.tie")).alias("tie")).alias("key"))
    stored = _kept(tied, "splitters")
    # one row: the constant that every plan gets; n - 1 keys
    text = stored.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("r", "key"))), lambda x: x["key"]),
                                _JSON).alias("j")).first()["j"]
    if not text or not json.loads(text):
        return None
    return F.from_json(F.lit(text), T.ArrayType(kind), _JSON), len(json.loads(text))


_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
         "ignoreNullFields": "false", "allowNonNumericNumbers": "true"}


def range_of(df: DataFrame, pk: list[str], splitters: Column, n: int) -> Column:
    """How many of the ``n`` splitters the row's key has reached: binary search, a step a bit."""
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(pk)], F.col(_TIE).alias("tie"))
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])

    def step(at, more):
        reached = F.element_at(splitters, F.least(at + more, F.lit(n))) <= key
        return at + F.when((at + more <= n) & reached, more).otherwise(F.lit(0))
    return F.reduce(steps, F.lit(0), step)


def row_number_pk(df: DataFrame, pk: list[str], column: str = ROW_NUMBER_COLUMN,
                  num_partitions: int | None = None, method: str = "range") -> DataFrame:
    """Add ``column`` = 1-based row number in ``pk`` order.

    ``method="range"`` is the distributed plan described above, over
    ``num_partitions`` ranges (default: by the size of the data);
    ``method="window"`` is the single-task window (small tables, tests).
    """
    if not pk:
        raise ValueError("row_number_pk needs at least one key column")
    if method == "window":
        return df.withColumn(column, F.row_number().over(Window.orderBy(*_order(pk))).cast("long"))
    if method != "range":
        raise ValueError("method must be 'range' or 'window'")
    n = max(1, int(num_partitions or planned_ranges(df)))
    keyed = df.withColumn(_TIE, F.monotonically_increasing_id())
    found = key_splitters(keyed, pk, n) if n > 1 else None
    number = range_of(keyed, pk, *found).cast("int") if found else F.lit(0)
    ranged = keyed.withColumn(_RANGE, number)
    counts = ranged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))
    offsets = _kept(counts.select(_RANGE, F.coalesce(before, F.lit(0)).alias(_OFF)), "range-offsets")
    placed = (ranged.repartitionById(n, F.col(_RANGE)).sortWithinPartitions(*_order(pk), F.col(_TIE).asc())
              .withColumn("__sv_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION))))
    numbered = placed.join(F.broadcast(offsets), _RANGE)  # one row a range
    return numbered.select(*df.columns, (F.col(_OFF) + F.col("__sv_at") + 1).cast("long").alias(column))


def scan_chunked(df: DataFrame, pk: list[str], rows_per_chunk: int, keep_row_number: bool = True,
                 method: str = "range", num_partitions: int | None = None) -> DataFrame:
    """Number rows by key and tag each with its chunk (``rn`` ranges of ``rows_per_chunk``).

    Chunk ``i`` holds ``rn`` in ``[i*rows_per_chunk + 1, (i+1)*rows_per_chunk]``,
    the same rows a ``rn BETWEEN a AND b`` query per chunk returns, but the
    table is numbered once instead of once per chunk.
    """
    if rows_per_chunk <= 0:
        raise ValueError("rows_per_chunk must be positive")
    numbered = row_number_pk(df, pk, ROW_NUMBER_COLUMN, num_partitions=num_partitions, method=method)
    out = numbered.withColumn(_CHUNK, ((F.col(ROW_NUMBER_COLUMN) - 1) / F.lit(rows_per_chunk)).cast("int"))
    return out if keep_row_number else out.drop(ROW_NUMBER_COLUMN)


def key_ordered(df: DataFrame, pk: list[str], num_chunks: int) -> DataFrame:
    """Key-ordered output partitions of about equal size, without numbering.

    One range shuffle into ``num_chunks`` partitions, each sorted: every
    partition holds a contiguous key range, and the files a task writes
    (cut by ``maxRecordsPerFile``) hold contiguous sub-ranges in key order.
    This is what an export needs when it wants key-ordered files but not the
    ``rn`` column.
    """
    order = _order(pk) + [F.col(_TIE).asc()]  # ties split by input position (hot keys)
    keyed = df.withColumn(_TIE, F.monotonically_increasing_id())
    return keyed.repartitionByRange(max(1, int(num_chunks)), *order).sortWithinPartitions(*order).drop(_TIE)
