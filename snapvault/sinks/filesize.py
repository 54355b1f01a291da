"""Files of a target size in bytes, whatever the rows' sizes.

A limit on records makes files of even size only where rows are.  After a staged
write its files are listed, and those below half or above twice the target are
cut anew, all together: a row's place in bytes is where its file begins among
them plus its share of that file, and every ``target_bytes`` begin a new file.
So small files are joined, large ones split, and files that fit are not read
again.

A file may hold any number of rows: shares are summed by blocks of row numbers,
so no window holds more than a block.  A task sorts about ``TASK_BYTES`` of the
files and writes all new files of these, however small the target is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType

from snapvault.commits import Files
from snapvault.session import local_frame

SLACK = 2.0
BLOCK_ROWS = 65536
TASK_BYTES = 32 << 20
PIECE = "_sv_piece"


def off_target(sizes: list[tuple[str, int]], target_bytes: int, slack: float = SLACK) -> list[tuple[str, int]]:
    """The files that are not within ``slack`` times the target, by name."""
    return sorted((n, s) for n, s in sizes if not target_bytes / slack <= s <= target_bytes * slack)


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes before compression."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            total = total + 4 + F.coalesce(F.octet_length(col), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType)):
            total = total + 4 + 8 * F.coalesce(F.greatest(F.size(col), F.lit(0)), F.lit(0))
        else:
            total = total + 8
    return total


def placed_by_bytes(spark: SparkSession, folder: str, files: list[tuple[str, int]], target_bytes: int,
                    block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """The rows of ``files``, each with its new file's number (``PIECE``), and how many those are."""
    total = sum(s for _, s in files)
    pieces = max(1, round(total / target_bytes))
    starts, at = [], 0
    for name, size in files:
        starts.append((name, at, size))
        at += size
    begins = local_frame(spark, starts, "_sv_file string, _sv_start long, _sv_size long")
    read = spark.read.parquet(*[f"{folder}/{n}" for n, _ in files])
    names = read.columns
    place = read.metadataColumn("_metadata")
    rows = read.select(*[F.col(f"`{c}`") for c in names], place["file_name"].alias("_sv_file"),
                       place["row_index"].alias("_sv_row"), row_bytes(read).alias("_sv_bytes"))
    rows = rows.withColumn("_sv_block", F.floor(F.col("_sv_row") / block_rows))
    in_file = Window.partitionBy("_sv_file")
    blocks = (rows.groupBy("_sv_file", "_sv_block").agg(F.sum("_sv_bytes").alias("_sv_sum"))
              .withColumn("_sv_all", F.sum("_sv_sum").over(in_file))
              .withColumn("_sv_before", F.sum("_sv_sum").over(in_file.orderBy("_sv_block")) - F.col("_sv_sum"))
              .drop("_sv_sum").join(begins, "_sv_file"))
    in_block = Window.partitionBy("_sv_file", "_sv_block").orderBy("_sv_row")
    # a row belongs where its middle lies, so that rounding favours neither neighbour
    inside = F.col("_sv_before") + F.sum("_sv_bytes").over(in_block) - F.col("_sv_bytes") / 2
    at_byte = F.col("_sv_start") + inside / F.col("_sv_all") * F.col("_sv_size")
    piece = F.least(F.floor(at_byte * pieces / total), F.lit(pieces - 1)).cast("int")
    return rows.join(blocks, ["_sv_file", "_sv_block"]).withColumn(PIECE, piece), pieces


def _in_order(placed: DataFrame, pieces: int, tasks: int) -> DataFrame:
    """Rows in their files' order, ``tasks`` partitions of whole new files one after the other."""
    return (placed.repartitionById(tasks, F.floor(F.col(PIECE).cast("long") * tasks / pieces).cast("int"))
            .sortWithinPartitions(PIECE, "_sv_start", "_sv_row").drop("_sv_file", "_sv_block", *_HELPERS))


_HELPERS = ["_sv_row", "_sv_bytes", "_sv_all", "_sv_before", "_sv_start", "_sv_size"]


def cut_by_bytes(spark: SparkSession, folder: str, files: list[tuple[str, int]], target_bytes: int,
                 block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """The rows of ``files`` in their order, one partition for each new file, and how many those are."""
    placed, pieces = placed_by_bytes(spark, folder, files, target_bytes, block_rows)
    return _in_order(placed, pieces, pieces).drop(PIECE), pieces


def fit_files(spark: SparkSession, stage: str, target_bytes: int) -> list[tuple[str, str]]:
    """Cut the staged files that are off the target anew.

    Gives the files written for them: (place below ``stage``, name to take).
    """
    files = Files(spark, stage)
    off = off_target(files.sizes(stage), target_bytes)
    if not off or (len(off) == 1 and off[0][1] < target_bytes * SLACK):
        return []
    placed, pieces = placed_by_bytes(spark, stage, off, target_bytes)
    total = sum(s for _, s in off)
    tasks = min(pieces, max(math.ceil(total / TASK_BYTES), spark.sparkContext.defaultParallelism))
    aside = "_fit"  # Spark's readers skip it
    _in_order(placed, pieces, tasks).write.partitionBy(PIECE).parquet(f"{stage}/{aside}")
    files.delete_all([f"{stage}/{name}" for name, _ in off])
    # a task's files have one name, each in its number's folder
    prefix = f"{PIECE}="
    return [(f"{aside}/{folder}/{name}", f"part-{folder[len(prefix):].zfill(9)}-{name}")
            for folder, name in files.inside(f"{stage}/{aside}", f"{prefix}*")]
