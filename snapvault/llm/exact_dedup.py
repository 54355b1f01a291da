"""Exact dedup with Patricia-trie owners.

Each input task inserts its normalised texts into tries (one for each length
and content-hash bucket) and sends every distinct text on once, with the
smallest and largest id and the row count: a text that a third of all rows
share reaches the shuffle once a task.  Texts are then dealt by (length,
content-hash bucket) and inserted, as full byte strings, into one trie at a
time; a terminal node holds the owner.  A trie that outgrows its budget spills
its heaviest subtree: those strings go, unmerged, into another round that
deals them by more hash bits.  Rows find their owner by a join on (SHA-256,
length), which Spark can split when a group is hot.

Cases: null text equals empty text; a null id never owns a group unless the
whole group has none; of rows that repeat both id and text, one is kept; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapvault.llm.common import arrow_limits, stored, text_hash, utf8
from snapvault.llm.patricia import Patricia

BUCKET_BITS = 8
PARTIAL = "n_bytes long, hash long, sha string, body binary, low long, high long, n_rows long"
OWNERS = "n_bytes long, hash long, sha string, body binary, low long, high long, n_rows long, spilled boolean"


def merge_owners(a: tuple, b: tuple) -> tuple:
    """(smallest id, largest id, rows); a null id counts as a row only."""
    low = a[0] if b[0] is None else b[0] if a[0] is None else min(a[0], b[0])
    high = a[1] if b[1] is None else b[1] if a[1] is None else max(a[1], b[1])
    return (low, high, a[2] + b[2])


def _rows(out: list, spilled: bool | None = None) -> pa.RecordBatch:
    """Arrow rows of (string, owner) pairs; resolved owners drop the string."""
    hashes = [xxhash.xxh64_intdigest(k) & (2**63 - 1) for k, _ in out]
    cols = {
        "n_bytes": pa.array([len(k) for k, _ in out], pa.int64()),
        "hash": pa.array(hashes, pa.int64()),
        "sha": pa.array([hashlib.sha256(k).hexdigest() for k, _ in out], pa.string()),
        "body": pa.array([k if spilled is not False else None for k, _ in out], pa.binary()),
        "low": pa.array([o[0] for _, o in out], pa.int64()),
        "high": pa.array([o[1] for _, o in out], pa.int64()),
        "n_rows": pa.array([o[2] for _, o in out], pa.int64()),
    }
    if spilled is not None:
        cols["spilled"] = pa.array([spilled] * len(out), pa.bool_())
    return pa.RecordBatch.from_pydict(cols)


def _chunks(pairs, spilled, most=8 << 20):
    """Batches of bounded bytes."""
    out, size = [], 0
    for pair in pairs:
        out.append(pair)
        size += len(pair[0])
        if size >= most or len(out) >= 2000:
            yield _rows(out, spilled)
            out, size = [], 0
    if out:
        yield _rows(out, spilled)


def _combine(budget: int):
    """Map side: distinct texts of the task so far; tries are emptied when they outgrow the budget."""

    def run(batches):
        tries: dict = {}
        held = 0
        for batch in batches:
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = body.lower()  # bytes: A-Z only
                bucket = (len(key), xxhash.xxh64_intdigest(key) & ((1 << BUCKET_BITS) - 1))
                trie = tries.get(bucket)
                if trie is None:
                    trie = tries[bucket] = Patricia()
                before = trie.bytes
                trie.insert(key, (i, i, 1), merge_owners)
                held += trie.bytes - before
            if held > budget:
                for trie in tries.values():
                    yield from _chunks(trie.items(), None)
                tries, held = {}, 0
        for trie in tries.values():
            yield from _chunks(trie.items(), None)

    return run


def _packed(batches):
    """Join the many small batches of single tries into larger ones."""
    wait, rows, size = [], 0, 0
    for b in batches:
        wait.append(b)
        rows, size = rows + b.num_rows, size + b.nbytes
        if rows >= 2000 or size >= 8 << 20:
            yield from pa.Table.from_batches(wait).combine_chunks().to_batches()
            wait, rows, size = [], 0, 0
    if wait:
        yield from pa.Table.from_batches(wait).combine_chunks().to_batches()


def _resolve(budget: int):
    """Reduce side: rows come sorted by (length, bucket); one trie at a time."""

    def run(batches):
        trie, group, late = Patricia(), None, []
        late_bytes = 0
        for batch in batches:
            for n, bucket, body, low, high, rows in zip(*(batch.column(c).to_pylist() for c in range(6))):
                if (n, bucket) != group:
                    yield from _chunks(trie.items(), False)
                    trie, group = Patricia(), (n, bucket)
                if not trie.insert(body, (low, high, rows), merge_owners):
                    late.append((body, (low, high, rows)))
                    late_bytes += len(body)
                if trie.bytes > budget and trie.strings > 1:
                    cut = trie.evict()
                    late.extend(cut)
                    late_bytes += sum(len(k) for k, _ in cut)
                if late_bytes > budget // 4:
                    yield from _chunks(late, True)
                    late, late_bytes = [], 0
        yield from _chunks(trie.items(), False)
        yield from _chunks(late, True)

    return run


def trie_owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 64 << 20) -> DataFrame:
    """One row for each distinct normalised text: n_bytes, sha, low, high, n_rows."""
    spark = docs.sparkSession
    arrow_limits(spark)
    combine, resolve = _combine(budget), _resolve(budget)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), utf8(f"`{text_col}`").alias("body"))
    todo = texts.mapInArrow(lambda it: _packed(combine(it)), PARTIAL)
    rounds, bits = [], BUCKET_BITS
    while True:
        # each round deals by other and more hash bits, so a spilled subtree's strings part
        dealt = (todo.withColumn("bucket", F.shiftright("hash", bits) if rounds else F.col("hash"))
                 .withColumn("bucket", F.col("bucket") % (1 << min(40, bits)))
                 .select("n_bytes", "bucket", "body", "low", "high", "n_rows"))
        done = stored(dealt.repartition("n_bytes", "bucket").sortWithinPartitions("n_bytes", "bucket")
                      .mapInArrow(lambda it: _packed(resolve(it)), OWNERS), "exact-owners")
        rounds.append(done.where(~F.col("spilled")))
        todo = done.where("spilled").drop("spilled")
        if todo.isEmpty():
            break
        bits += BUCKET_BITS
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out.select("n_bytes", "sha", "low", "high", "n_rows")


def _digest(batches):
    for batch in batches:
        bodies = [b.lower() for b in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(2),
            pa.array([len(b) for b in bodies], pa.int64()),
            pa.array([hashlib.sha256(b).hexdigest() for b in bodies], pa.string()),
        ], names=["id", "text_hash", "n_bytes", "text_sha256"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                budget: int = 64 << 20) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, n_bytes, text_hash.

    Texts are equal when identical after lower-casing A-Z; ``keep`` names
    which id owns a group, ``smallest`` or ``largest``.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    owners = trie_owners(docs, id_col, text_col, budget)
    owners = owners.select(F.col("n_bytes").alias("o_bytes"), F.col("sha").alias("o_sha"),
                           F.col("low" if keep == "smallest" else "high").alias("keep_id"),
                           F.col("n_rows").alias("group_size"))
    members = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), utf8(f"`{text_col}`").alias("body"),
                          text_hash(f"`{text_col}`").alias("text_hash")).mapInArrow(
        _digest, "id long, text_hash long, n_bytes long, text_sha256 string")
    # of rows that repeat an id and a text, the first counts
    nth = F.row_number().over(Window.partitionBy("id", "text_sha256").orderBy("text_hash"))
    members = members.withColumn("nth", nth)
    joined = members.join(owners, (F.col("text_sha256") == F.col("o_sha")) & (F.col("n_bytes") == F.col("o_bytes")))
    return joined.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256", "n_bytes", "text_hash")
