"""SimHash near-dedup: fingerprints, a range join on segment popcounts, connected groups.

A fingerprint's 64 bits are 32 segments of two bits.  Segment popcounts embed
it in a grid: the Manhattan distance of two popcount vectors never exceeds the
Hamming distance of the fingerprints.  The range join cuts the 32 axes into
``max_bits + groups_equal`` groups: two vectors within Manhattan distance
``max_bits`` agree exactly on at least ``groups_equal`` of them, so they meet
in a cell of the grid spanned by those groups.  Candidates of a cell pass the
Manhattan bound and then the exact bit distance.

Only distinct fingerprints are joined: copies, and near copies that share a
fingerprint, are one point, whatever their ids.  A cell sends no pairs but the
edges of a forest that connects what it connects (at most one a point), and
components grow by alternating large-star and small-star steps over written edge tables.

Cases: null text equals empty text; texts without words have fingerprint zero
and are linked like any other; repeated rows are documents of their own; an id with
several texts has a row for each, in that text's component; a null id is
carried through and never names a component unless all of it are null;
an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import arrow_limits, stored, text_hash, utf8

SEED = 42
_LOW = np.uint64(0x5555555555555555)
#: Manhattan distance of the popcount fields in two bytes.
_BYTE = np.arange(256)
_FIELDS = np.stack([(_BYTE >> s) & 3 for s in (0, 2, 4, 6)], axis=1)
_L1 = np.abs(_FIELDS[:, None, :] - _FIELDS[None, :, :]).sum(axis=2).astype(np.uint8)


def fingerprint(body: bytes, shingle: int = 4) -> int:
    """SimHash of the word shingles of A-Z lower-cased text, repeats included."""
    words = body.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    n = len(words)
    h64 = xxhash.xxh64_intdigest
    if n <= shingle:
        hashes = [h64(line, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.empty(n, np.int64)
        starts[0] = 0
        starts[1:] = ends[:-1] + 1
        hashes = [h64(line[a:b], SEED) for a, b in zip(starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def popcounts(fp: np.ndarray) -> np.ndarray:
    """The 32 two-bit popcounts, packed: a field holds 0, 1 or 2."""
    return fp - ((fp >> np.uint64(1)) & _LOW)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of packed popcounts."""
    x, y = a.view(np.uint8).reshape(-1, 8), b.view(np.uint8).reshape(-1, 8)
    return _L1[x, y].sum(axis=1, dtype=np.int64)


def cell_masks(max_bits: int, groups_equal: int = 4) -> list[int]:
    """Field masks of the grids: every choice of ``groups_equal`` of the axis groups."""
    n = max_bits + groups_equal
    if n > 32:
        raise ValueError("more axis groups than axes")
    groups = [sum(3 << (2 * axis) for axis in range(32) if axis % n == g) for g in range(n)]
    return [sum(groups[g] for g in chosen) for chosen in combinations(range(n), groups_equal)]


def _fingerprints(shingle: int):
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(x, shingle) for x in b.column("body").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "text_hash", "fp"])

    return run


def _cells(masks: list[int]):
    mask = np.array(masks, np.uint64)
    salt = np.arange(1, len(masks) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def run(batches):
        for b in batches:
            fp = np.asarray(b.column("fp")).view(np.uint64)
            node = np.asarray(b.column("node"))
            packed = popcounts(fp)
            for at in range(0, len(fp), 4096):
                part = packed[at:at + 4096]
                # the grid's number and the cell's coordinates, mixed: other cells that share a key by
                # chance cost a comparison only, as every candidate is verified
                key = (part[:, None] & mask[None, :]) ^ salt[None, :]
                key = (key ^ (key >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
                k = len(masks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(fp[at:at + 4096], k).view(np.int64)),
                     pa.array(np.repeat(node[at:at + 4096], k))], names=["cell", "fp", "node"])

    return run


def near(fp: np.ndarray, packed: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs are within the bit distance: Manhattan bound first, then exactly."""
    ok = manhattan(packed[i], packed[j]) <= max_bits
    ok[ok] = np.bitwise_count(fp[i[ok]] ^ fp[j[ok]]) <= max_bits
    return ok


def forest(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges that connect what links within one cell connect, at most one a point.

    Each point reached is expanded once against the points not yet reached, so
    a dense cell costs few passes; memory is one row of distances.
    """
    packed = popcounts(fp)
    left = np.arange(len(fp))
    edges = []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            hit = near(fp, packed, np.full(len(left), x), left, max_bits)
            found = left[hit]
            left = left[~hit]
            edges.extend((x, int(y)) for y in found)
            queue.extend(found.tolist())
    return edges


def _links(max_bits: int, small: int = 32):
    """Rows come sorted by cell. Cells of up to ``small`` points are compared at once, shifted against themselves."""

    def pairs(cell, fp, node):
        if len(cell) < 2:
            return None
        packed = popcounts(fp)
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        size = np.diff(np.r_[starts, len(cell)])
        rows_size = np.repeat(size, size)
        a, b = [], []
        few = rows_size <= small
        for shift in range(1, min(small, int(size.max(initial=0)))):
            i = np.flatnonzero((cell[shift:] == cell[:-shift]) & few[:-shift])
            if not len(i):
                break
            ok = near(fp, packed, i, i + shift, max_bits)
            a.append(node[i[ok]])
            b.append(node[i[ok] + shift])
        for s, n in zip(starts[size > small].tolist(), size[size > small].tolist()):
            edges = forest(fp[s:s + n], max_bits)
            if edges:
                e = np.array(edges)
                a.append(node[s + e[:, 0]])
                b.append(node[s + e[:, 1]])
        if not a:
            return None
        a, b = np.concatenate(a), np.concatenate(b)
        e = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["u", "v"])

    def run(batches):
        rest: list = []  # the open cell's rows so far
        for b in batches:
            cell = np.asarray(b.column("cell"))
            cols = [cell, np.asarray(b.column("fp")).view(np.uint64), np.asarray(b.column("node"))]
            if not len(cell):
                continue
            cut = int(np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])[-1])
            if cut == 0 and rest and rest[-1][0][0] == cell[0]:
                rest.append(cols)
                continue
            done = [*rest, [c[:cut] for c in cols]]
            out = pairs(*(np.concatenate(x) for x in zip(*done)))
            if out is not None and out.num_rows:
                yield out
            rest = [[c[cut:] for c in cols]]
        if rest:
            out = pairs(*(np.concatenate(x) for x in zip(*rest)))
            if out is not None and out.num_rows:
                yield out

    return run


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of ``edges`` (u, v) reaches.

    Alternates large-star (larger neighbours join the smallest neighbour) and
    small-star (smaller ones do) until no edge changes; a star's centre is
    found by a min that is combined before the shuffle, so a hot node sends a
    row a task.  The edge table of each round is written to the shared folder.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                 "links")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("m", "u").alias("m"))
        large = (both.where("v > u").join(low, F.col("u") == F.col("x"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        starred = large.join(low, F.col("u") == F.col("x"))
        small = (starred.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select(F.col("x").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct())
        after = stored(small, "links")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003),
                         F.sum(F.xxhash64("v", "u") % 1000033)).first()
        now = after
        if tuple(mark) == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(mark)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                   max_bits: int = 4, groups_equal: int = 4) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id, text_hash."""
    arrow_limits(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_hash(f"`{text_col}`").alias("text_hash"),
                       utf8(f"`{text_col}`").alias("body"))
    prints = stored(rows.mapInArrow(_fingerprints(shingle), "doc_id long, text_hash long, fp long"), "fingerprints")
    # one point a fingerprint, which is its own node: an id that repeats with other texts joins nothing, and
    # fingerprints that only null ids have link others all the same
    points = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    cells = points.select("fp", F.col("fp").alias("node")).mapInArrow(_cells(cell_masks(max_bits, groups_equal)),
                                                                    "cell long, fp long, node long")
    links = (cells.repartition("cell").sortWithinPartitions("cell")
             .mapInArrow(_links(max_bits), "u long, v long").distinct())
    roots = components(links)
    p = points.join(roots, F.col("fp") == F.col("node"), "left")
    p = p.select(F.col("fp").alias("p_fp"), "least", F.coalesce("root", "fp").alias("p_root"))
    # the smallest id that is not null names a component
    names = p.groupBy("p_root").agg(F.min("least").alias("component_id")).withColumnRenamed("p_root", "n_root")
    p = p.join(names, F.col("p_root") == F.col("n_root")).select("p_fp", "component_id")
    return (prints.join(p, F.col("fp") == F.col("p_fp"))
            .select(F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id", "text_hash"))
