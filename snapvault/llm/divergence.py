"""Source divergence audit over a k2-tree (k = 2) of the group-term count matrix.

Groups are the occurring (lang, source); a language keeps the terms that enough
of its documents have.  A group's rate of a term is a whole number,
1 + floor(10^9 (count + 1) / (N + V)), and its divergence against a rate q is
floor((p - q)^2 / q); all arithmetic is exact.

Counts are summed in Spark by (lang, term), so that a term's groups, its
documents and its counts in the language meet without another shuffle.  Each
language's kept terms are spread over chunks of about ``CHUNK`` counts, and the
groups over blocks of ``ROWS``; a task has the groups of two blocks in one
chunk and puts their counts into a quadtree: a node is kept only where a
quadrant holds a count, so an absent child is an all-zero quadrant.  Terms are
numbered so that those of the same groups stand together, which makes such
quadrants large.  All pairs of groups go down the tree together, a frontier of
(rows of one, rows of the other, columns) at a time: where both quadrants are
all zero, every cell has the groups' rates of an absent term, so the whole
quadrant is priced at once as width times that value; nonzero leaves are priced
cell by cell.  A term's own divergence from its language's rate is taken at the
same leaves.  Tasks give partial sums of pairs and their first ``top`` terms,
which Spark adds up and ranks.

Cases: null text, lang and source are ''; a group without kept terms, and a
language without any, still has its pairs (value 0 where V is 0) and no terms; a
language with one group has no pairs; equal values rank by the item's UTF-8
bytes; repeated rows are documents of their own; long texts are read whole; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapvault.llm.common import arrow_limits, stored, utf8

MIN_DOCS, TOP = 3, 200
UNIT = 1_000_000_000
CHUNK = 1 << 19        # counts of one chunk of terms
ROWS = 64              # groups of one block
COLUMNS = 2048         # terms of one tree
HELD = 400_000         # terms a task counts before it hands them on
_MARK = np.uint64(0x9E3779B97F4A7C15)  # odd, so that sums of its multiples tell sets of rows apart
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text: bytes) -> list[bytes]:
    """Terms of UTF-8 bytes, A-Z in lower case (bytes beyond ASCII are those of whole characters)."""
    return _TERM.findall(text.lower())


def _count(batches):
    """(lang, source, term, n, docs), summed within the task as far as memory goes."""
    held: dict[tuple, dict] = {}
    size = 0

    def out():
        for (lang, source), terms in held.items():
            keys = list(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array([source] * len(keys), pa.string()), pa.array(keys, pa.binary()),
                 pa.array([terms[t][0] for t in keys], pa.int64()), pa.array([terms[t][1] for t in keys], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    for b in batches:
        langs, sources = b.column("lang").to_pylist(), b.column("source").to_pylist()
        for text, lang, source in zip(b.column("body").to_pylist(), langs, sources):
            terms = held.setdefault((lang, source), {})
            size -= len(terms)
            for t, n in Counter(terms_of(text)).items():
                have = terms.get(t)
                terms[t] = (n, 1) if have is None else (have[0] + n, have[1] + 1)
            size += len(terms)
            if size > HELD:
                yield from out()
                held, size = {}, 0
    yield from out()


def rates(count: np.ndarray, total: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / (N + V)), in whole numbers (split so that nothing overflows)."""
    number, below = count + 1, np.maximum(total + kept, 1)
    whole, rest = np.divmod(number, below)
    out = 1 + whole * UNIT
    # rest * 10^9 in two steps (31250 * 32000), each remainder below the divisor
    a, r = np.divmod(rest * 31_250, below)
    b, _ = np.divmod(r * 32_000, below)
    return out + a * 32_000 + b


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


class CountTree:
    """A k2-tree of a sparse count matrix: at each level the numbers of the nonzero quadrants, in order."""

    def __init__(self, row: np.ndarray, column: np.ndarray, n_rows: int, n_columns: int):
        self.n_rows, self.n_columns = n_rows, n_columns
        self.depth = max(int(max(n_rows, n_columns, 1) - 1).bit_length(), 0)
        cell = (row.astype(np.int64) << self.depth) | column
        self.levels = []  # from the root: quadrants of 2^(depth - level) rows and columns that hold a count
        for level in range(self.depth + 1):
            half = self.depth - level
            quadrant = ((cell >> (self.depth + half)) << level) | ((cell & ((1 << self.depth) - 1)) >> half)
            self.levels.append(np.unique(quadrant))

    def holds(self, level: int, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Whether these quadrants hold a count."""
        nodes = self.levels[level]
        if not len(nodes):
            return np.zeros(len(row), bool)
        wanted = (row << level) | column
        at = np.minimum(np.searchsorted(nodes, wanted), len(nodes) - 1)
        return nodes[at] == wanted


def descend(tree: CountTree, low: np.ndarray, high: np.ndarray):
    """All pairs of a row of ``low`` and one of ``high`` (masks of rows) down the tree at once.

    Gives (zero, a, b, column), each pair once with a < b: the number of columns in all-zero quadrants of each pair (a
    matrix), and the leaves that are nonzero for one of the two.
    """
    zero = np.zeros((tree.n_rows + 1, tree.n_rows + 1), np.int64)  # differences of ranges
    a, b, c = (np.zeros(1, np.int64) for _ in range(3))
    masks = []
    for mask in (low, high):
        levels = [np.concatenate([mask, np.zeros((1 << tree.depth) - tree.n_rows, bool)])]
        for _ in range(tree.depth):
            levels.insert(0, levels[0].reshape(-1, 2).any(axis=1))
        masks.append(levels)
    for level in range(tree.depth + 1):
        side = 1 << (tree.depth - level)
        in_low, in_high = masks[0][level], masks[1][level]
        inside = (c * side < tree.n_columns) & (a <= b) & (in_low[a] & in_high[b] | in_high[a] & in_low[b])
        a, b, c = a[inside], b[inside], c[inside]
        some = tree.holds(level, a, c) | tree.holds(level, b, c)
        ea, eb, ec = a[~some], b[~some], c[~some]
        if len(ea):
            width = np.minimum((ec + 1) * side, tree.n_columns) - ec * side
            lo_a, hi_a = ea * side, np.minimum((ea + 1) * side, tree.n_rows)
            lo_b, hi_b = eb * side, np.minimum((eb + 1) * side, tree.n_rows)
            for x, y, sign in ((lo_a, lo_b, 1), (hi_a, lo_b, -1), (lo_a, hi_b, -1), (hi_a, hi_b, 1)):
                np.add.at(zero, (x, y), sign * width)
        a, b, c = a[some], b[some], c[some]
        if level == tree.depth:
            break
        corner = np.arange(8)
        a, b, c = ((np.repeat(v * 2, 8) + np.tile(corner >> s & 1, len(v))) for v, s in ((a, 2), (b, 1), (c, 0)))
    zero = zero.cumsum(axis=0).cumsum(axis=1)[:tree.n_rows, :tree.n_rows]
    apart = a < b
    return zero, a[apart], b[apart], c[apart]


def _audit(top: int):
    """Partial sums of pairs and first terms of two blocks of groups in a chunk of terms."""
    def audit(key, table):
        lang, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
        heads = table.filter(pa.compute.is_null(table.column("term")))
        sources, at = np.unique(np.array(heads.column("source").to_pylist(), dtype=object), return_index=True)
        g = len(sources)
        number = {s: j for j, s in enumerate(sources.tolist())}
        block = heads.column("block").to_numpy()[at]
        total, kept, lang_total = (heads.column(c).to_numpy()[at] for c in ("total", "kept", "lang_total"))
        cells = table.filter(pa.compute.is_valid(table.column("term")))
        coded = cells.column("term").combine_chunks().dictionary_encode()
        names, column = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.array([number[s] for s in cells.column("source").to_pylist()], np.int64)
        n, lang_n = cells.column("n").to_numpy(), cells.column("lang_n").to_numpy()
        sums = np.zeros((g, g), np.int64)
        blank = rates(np.zeros(g, np.int64), total, kept)
        # terms of the same groups next to each other: they share all-zero quadrants
        pattern = np.zeros(len(names), np.uint64)
        np.bitwise_xor.at(pattern, column, _MARK * (row.astype(np.uint64) + np.uint64(1)))
        place = np.empty(len(names), np.int64)
        place[np.argsort(pattern, kind="stable")] = np.arange(len(names))
        order = np.argsort(place[column], kind="stable")
        ends = np.searchsorted(place[column][order], np.arange(0, len(names) + COLUMNS, COLUMNS))
        blank_value = divergence(blank[:, None], blank[None, :])
        own = []  # (cells, values) above the language's rate
        for start, i, j in zip(range(0, len(names), COLUMNS), ends, ends[1:]):
            few = order[i:j]
            r, c, width = row[few], place[column[few]] - start, min(COLUMNS, len(names) - start)
            rate = np.repeat(blank[:, None], width, axis=1)
            rate[r, c] = rates(n[few], total[r], kept[r])
            tree = CountTree(r, c, g, width)
            zero, a, b, leaf = descend(tree, block == low, block == high)
            for x, y in ((a, b), (b, a)):
                np.add.at(sums, (x, y), divergence(rate[x, leaf], rate[y, leaf]))
            zero = np.triu(zero, 1)
            sums += (zero + zero.T) * blank_value
            if low == high:
                p, q = rate[r, c], rates(lang_n[few], lang_total[r], kept[r])
                own.append((few[p > q], divergence(p, q)[p > q]))
        best = _first(row, names, column, own, top)
        pairs = [(j, k) for j in range(g) for k in range(g) if j != k and {block[j], block[k]} == {low, high}]
        source = [sources[j] for j, _ in pairs] + [sources[j] for j, _, _ in best]
        more = [None] * len(best)
        return pa.table({
            "lang": pa.array([lang] * len(source), pa.string()), "source": pa.array(source, pa.string()),
            "part": pa.array(["pair"] * len(pairs) + ["term"] * len(best), pa.string()),
            "item": pa.array([sources[k] for _, k in pairs] + [t.decode() for _, _, t in best], pa.string()),
            "value": pa.array([int(sums[j, k]) for j, k in pairs] + [v for _, v, _ in best], pa.int64()),
            "columns": pa.array([len(names)] * len(pairs) + more, pa.int64()),
            "kept": pa.array([int(kept[j]) for j, _ in pairs] + more, pa.int64()),
            "blank": pa.array([int(blank_value[j, k]) for j, k in pairs] + more, pa.int64())})
    return audit


def _first(row: np.ndarray, names: pa.Array, column: np.ndarray, own: list[tuple], top: int) -> list[tuple]:
    """(group, value, term) of the first ``top`` terms of each group: greatest value, then least bytes."""
    if not own:
        return []
    cell, value = (np.concatenate(x) for x in zip(*own))
    out = []
    for j in np.unique(row[cell]).tolist():
        mine = np.flatnonzero(row[cell] == j)
        if len(mine) > top:
            least = np.partition(value[mine], len(mine) - top)[len(mine) - top]
            mine = mine[value[mine] >= least]
        terms = names.take(pa.array(column[cell[mine]])).to_pylist()
        out.extend((j, v, t) for v, t in sorted(zip(value[mine].tolist(), terms), key=lambda x: (-x[0], x[1]))[:top])
    return out


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term (bytes), n, lang_n, is_first: one row for each group that has a kept term; one shuffle."""
    arrow_limits(docs.sparkSession)
    text = docs.select(utf8("text").alias("body"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    counted = text.mapInArrow(_count, "lang string, source string, term binary, n long, docs long")
    # hashed by (lang, term) once: the sums by group and the windows over the term need no other shuffle
    summed = (counted.repartition("lang", "term").groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    w = Window.partitionBy("lang", "term")
    return (summed.withColumn("all_docs", F.sum("docs").over(w)).withColumn("lang_n", F.sum("n").over(w))
            .withColumn("is_first", (F.row_number().over(w.orderBy("source")) == 1).cast("int"))
            .where(F.col("all_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "is_first"))


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    counts = stored(kept_counts(docs, min_docs), "divergence-counts", "zstd")
    by_lang = counts.groupBy("lang").agg(F.sum("is_first").alias("kept"), F.sum("n").alias("lang_total"), F.count("*").alias("cells"))
    by_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = (every.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left")
              .select("lang", "source", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                                          for c in ("total", "kept", "lang_total", "cells")])
              .withColumn("block", F.floor((F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1) / ROWS).cast("int"))
              .withColumn("blocks", F.max("block").over(Window.partitionBy("lang")) + 1)
              .withColumn("chunks", F.floor(F.col("cells") / CHUNK).cast("int") + 1))
    groups = stored(groups, "divergence-groups")
    # every pair of blocks, every chunk: the groups' heads go to all tasks that have their block, the counts to their chunk's
    tasks = (groups.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))
    head = (tasks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("lang", "chunk", "low", "high", "source", "block", "total", "kept", "lang_total",
                    F.lit(None).cast("binary").alias("term"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("lang_n")))
    cells = (counts.join(tasks, ["lang", "source"])
             .select("lang", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int").alias("chunk"), "low", "high", "source", "block",
                     F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("kept"), F.lit(0).cast("long").alias("lang_total"),
                     "term", "n", "lang_n"))
    partial = (head.unionByName(cells).groupBy("lang", "chunk", "low", "high")
               .applyInArrow(_audit(top), "lang string, source string, part string, item string, value long, columns long, "
                                          "kept long, blank long"))
    # terms that neither block has in a chunk were sent to no task: all-zero columns, priced alike
    values = (partial.groupBy("lang", "source", "part", "item")
              .agg(F.sum("value").alias("value"), (F.max("kept") - F.sum("columns")).alias("rest"), F.max("blank").alias("blank"))
              .withColumn("value", F.col("value") + F.coalesce(F.col("rest") * F.col("blank"), F.lit(0))))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (values.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= top))
            .select("lang", "source", "part", "item", "value", "rank"))
