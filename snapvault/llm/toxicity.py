"""Toxicity by the nearest labelled examples: whole texts, and passage by passage.

Whole texts (``fit_texts``, ``with_text_score``): every text's TF-IDF vector, over
all its words with their counts, is searched in a block-max inverted index of the
labelled texts' vectors (``snapvault.llm.nearest``); its k nearest by exact cosine
vote with their labels.  The log odds of this vote and those of the passages below
are added, the former times a factor fitted on the examples (one abusive word is
lost among hundreds of others, so whole texts alone find half of the toxic ones).

``fit`` and ``with_score`` are the passages alone.

A text's passages are its distinct words in lower case; an example is a passage
of labelled texts, with the number of distinct texts that have it and how many
of these are toxic.  A passage's terms are the word and its beginnings of 3 and 5
characters, weighed by plain TF-IDF (document frequencies over the examples;
terms that no example has count nothing) and scaled to unit length.  Labels are
no part of a weight: they only vote.

``BlockMaxIndex`` finds a passage's nearest examples exactly.  Examples are
numbered in order and cut into blocks; each term keeps the greatest weight it
has in each block.  Blocks are visited by falling bound (the sum of query weight
times block maximum) until no bound reaches the k-th best cosine; the others are
skipped.  Two passages with a common term begin alike, so the index is sharded
by the first characters: each shard is built and searched in its own Spark task,
every frequency is local to it, and neither postings nor texts reach the driver.

The k nearest examples vote with weights that fall with their distance, each as
often as distinct texts have it, smoothed by the overall rate.  A text's
evidence is the sum of its two strongest passages' log odds over that rate; a
monotone calibration makes it a probability.  The calibration is fitted on the
examples' texts, each scored with the counts of its own fifth left out.

Bounds (parameters): ``max_examples`` distinct labelled texts, drawn by a hash
of their ids and texts, and ``max_bytes`` of them.  What reaches the driver and
is broadcast is one row for each word and word beginning of these examples, and
the posting (example, count) of each of their words.

Cases: null text equals empty text; a text without a passage that resembles any
example gets the toxic rate of such examples; without any labelled example every
score is 0.5; null labels and ids teach nothing; an id with both labels counts
as toxic, a text with both as one example of each; equally near examples count
by their order; repeated rows are scored one by one; an empty table gives no
rows.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapvault.llm.common import arrow_limits, by_bytes, remembered, stored
from snapvault.llm.nearest import TextIndex, spans

MAX_EXAMPLES = 20_000
MAX_BYTES = 256 << 20
BEGINNINGS = (3, 5)
SHARDS = 64
BLOCK = 64             # examples of one block
NEIGHBOURS = 15
FOLDS = 5
NEAR = 0.05            # added to a distance before its inverse is the vote's weight
SMOOTH = 1.0           # votes of the overall rate that every passage gets
STRONGEST = 2
LEAST = 0.1            # part of the whole texts' log odds that counts on any examples
THRESHOLD = 0.7
MEMORY = 100_000
BATCH = 2 << 20        # bytes of texts in a task's batch, beside the indexes it holds
TOGETHER = 1 << 20     # characters searched at once
_WORD = re.compile(r"\w+")


def passages(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def terms_of(passage: str) -> list[str]:
    """The word and its beginnings (marked by a star, which no word has); of an entry that is a beginning, those up to it."""
    if passage.endswith("*"):
        return [passage[:n] + "*" for n in BEGINNINGS if len(passage) > n]
    return [passage] + [passage[:n] + "*" for n in BEGINNINGS if len(passage) >= n]


class BlockMaxIndex:
    """Exact top-k by TF-IDF cosine over bags of terms (dicts of counts), with per-block maxima of each term's weight.

    ``n_all``: examples the frequencies are over, where this index holds a shard that has all examples of its terms.
    """

    def __init__(self, bags: list[dict], n_all: int | None = None, block: int = BLOCK):
        self.n, self.block = len(bags), block
        self.n_blocks = -(-self.n // block)
        self.visited = self.skipped = 0
        df = Counter()
        for b in bags:
            df.update(b.keys())
        n_all = self.n if n_all is None else n_all
        self.idf = {t: math.log((1 + n_all) / (1 + c)) + 1 for t, c in df.items()}
        held: dict[str, tuple[list, list]] = {t: ([], []) for t in df}
        for row, b in enumerate(bags):
            unit = self.unit(b)
            for t, w in unit.items():
                at, weights = held[t]
                at.append(row)
                weights.append(w)
        self.held, self.postings = held, {}

    def _posted(self, term: str):
        """A term's postings by block, cut when it is first searched."""
        if term not in self.postings:
            at, weights = self.held[term]
            self.postings[term] = self._blocks(np.array(at, np.int64), np.array(weights))
        return self.postings[term]

    def _blocks(self, at: np.ndarray, weights: np.ndarray):
        """(blocks, greatest weight in each, places and weights in each)."""
        number = at // self.block
        start = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        ends = np.append(start[1:], len(at)).tolist()
        inside = {b: (at[i:j] - b * self.block, weights[i:j]) for b, i, j in zip(number[start].tolist(), start.tolist(), ends)}
        return number[start], np.maximum.reduceat(weights, start), inside

    def unit(self, bag: dict) -> dict:
        """TF-IDF weights of unit length; terms that no example has are left out."""
        w = {t: (1 + math.log(n)) * self.idf[t] for t, n in bag.items() if t in self.idf}
        norm = math.sqrt(math.fsum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()} if norm else {}

    def nearest(self, bag: dict, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k greatest cosines above zero, by cosine, then number."""
        query = [(w, *self._posted(t)) for t, w in self.unit(bag).items()]
        bound = np.zeros(self.n_blocks)
        for w, blocks, greatest, _ in query:
            bound[blocks] += w * greatest
        order = (-bound).argsort(kind="stable").tolist()
        rows, cosines, found, least, last = [], [], 0, -1.0, -1
        for b in order:
            # no example of a block has a greater cosine than its bound: below the k-th best cosine none counts, at it
            # none of a greater number does
            if bound[b] == 0.0 or bound[b] < least:
                break
            if bound[b] == least and b > last:
                continue
            self.visited += 1
            score = np.zeros(self.block)
            for w, _, _, inside in query:
                if b in inside:
                    at, weights = inside[b]
                    score[at] += w * weights
            some = score.nonzero()[0]
            rows.append(some + b * self.block)
            cosines.append(score[some])
            found += len(some)
            if found >= k:
                every = np.concatenate(cosines)
                least = np.partition(every, found - k)[found - k]
                last = int(np.concatenate(rows)[every == least].max()) // self.block
        self.skipped += np.count_nonzero(bound) - len(rows)
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0)
        rows, cosines = np.concatenate(rows), np.concatenate(cosines)
        best = np.lexsort((rows, -cosines))[:k]
        return rows[best], np.minimum(cosines[best], 1.0)


def learners(labels: DataFrame, label_col: str = "toxic") -> DataFrame:
    """Labelled rows that may teach: those whose id's checksum is not held out."""
    rest = F.crc32(F.col("doc_id").cast("string")) % 3
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1) & (rest != 1))
            .groupBy(F.col("doc_id").cast("long").alias("l_id"))
            .agg(F.max(F.col(label_col).cast("int")).alias("label")))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def examples_of(docs: DataFrame, labels: DataFrame, max_examples: int, max_bytes: int) -> DataFrame:
    """At most ``max_examples`` distinct (text, label) of about ``max_bytes`` in all: text, label, example_id, fold."""
    chosen = learners(labels).orderBy(F.xxhash64("l_id"), "l_id").limit(max_examples)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # at most max_examples ids
    taught = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
    distinct = (taught.groupBy("text", "label").agg(F.min("doc_id").alias("example_id"))
                .withColumn("h", F.xxhash64("text", "label")))
    # the window holds at most max_examples rows of two numbers
    drawn = (distinct.select("h", F.octet_length("text").cast("long").alias("bytes")).orderBy("h").limit(max_examples)
             .withColumn("before", F.sum("bytes").over(Window.orderBy("h").rowsBetween(Window.unboundedPreceding, -1)))
             .where(F.coalesce(F.col("before"), F.lit(0)) < max_bytes).select("h").distinct())
    return distinct.join(F.broadcast(drawn), "h", "left_semi").select(
        "text", "label", "example_id", F.pmod(F.col("h"), F.lit(FOLDS)).cast("int").alias("fold"))


def _counted(batches):
    """Passages of labelled texts: texts and toxic texts by fold, and the texts' ids, summed before the shuffle."""
    for b in batches:
        y, ids, fold = (b.column(c).to_numpy() for c in ("label", "example_id", "fold"))
        texts = b.column("text").to_pylist()
        for i, j in by_bytes(texts, TOGETHER):
            text, word, _, words = counted_words(texts[i:j])
            text = text + i
            n = len(words)
            counts = []
            for f in range(FOLDS):
                some = fold[text] == f
                counts.append(np.bincount(word[some], minlength=n).astype(np.int64))
                counts.append(np.bincount(word[some], y[text[some]], minlength=n).astype(np.int64))
            # a toxic text's smallest id, or else a harmless one's
            order = np.lexsort((ids[text], 1 - y[text], word))
            first = text[order[np.searchsorted(word[order], np.arange(n))]]
            yield pa.RecordBatch.from_arrays([words, *map(pa.array, counts), pa.array((1 - y[first]).astype(np.int64)), pa.array(ids[first])],
                                             names=["passage", *_COUNTS, "harmless", "example_id"])


_COUNTS = [f"{c}{f}" for f in range(FOLDS) for c in "ny"]
_VOTES = ["vote", *[f"vote{f}" for f in range(FOLDS)]]


def _searched(n_all: int, prior: float, k: int):
    """Every word and word beginning of a shard searched in the shard's index: votes in all and without each fold.

    No example but the word itself has its whole term.  So its nearest are itself and those of its longest beginning,
    their cosines times the length of the word's vector without that term: one search serves all words of a beginning.
    """
    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("passage")
        words = table.column("passage").to_pylist()
        ids = table.column("example_id").to_numpy()
        counts = np.stack([table.column(c).to_numpy() for c in _COUNTS], axis=1).astype(np.float64)
        index = BlockMaxIndex([dict.fromkeys(terms_of(w), 1) for w in words], n_all)
        alike: dict[str, list[int]] = {}
        for j, w in enumerate(words):
            terms = terms_of(w)
            alike.setdefault(terms[-1] if len(terms) > 1 else "", []).append(j)
        beginnings = sorted({t for w in words for t in terms_of(w)[1:]})
        sums = np.empty((len(words) + len(beginnings), counts.shape[1]))
        near = np.arange(len(sums))
        cosine = np.ones(len(sums))
        alone = alike.get("", [])
        sums[alone] = counts[alone]
        for at, b in enumerate(beginnings, len(words)):
            rows, cos = index.nearest(dict.fromkeys(terms_of(b), 1), k)
            sums[at] = NEAR / (NEAR + 1 - cos) @ counts[rows]
            near[at], cosine[at] = rows[0], cos[0]
            some = np.array(alike.get(b, []), np.int64)
            if len(some):
                unit = index.unit(dict.fromkeys(terms_of(words[some[0]]), 1))
                weight = NEAR / (NEAR + 1 - cos * math.sqrt(math.fsum(x * x for t, x in unit.items() if t.endswith("*"))))
                sums[some] = weight[:k - 1] @ counts[rows[:k - 1]] + counts[some]
                # words among the nearest themselves
                own = np.isin(rows, some).nonzero()[0]
                others = np.where(own[:, None] == np.arange(len(rows)), 0.0, weight)
                sums[rows[own]] = others @ counts[rows] + counts[rows[own]]
        n, y = sums[:, 0::2], sums[:, 1::2]
        votes = [(y.sum(axis=1) + SMOOTH * prior) / (n.sum(axis=1) + SMOOTH)]
        for f in range(FOLDS):
            rest = np.arange(FOLDS) != f
            votes.append((y[:, rest].sum(axis=1) + SMOOTH * prior) / (n[:, rest].sum(axis=1) + SMOOTH))
        return pa.table([pa.array(words + beginnings), *[pa.array(v) for v in votes], pa.array(ids[near]),
                         table.column("passage").combine_chunks().take(pa.array(near)), pa.array(cosine)],
                        names=["entry", *_VOTES, "example_id", "example", "cosine"])
    return search


class Passages:
    """Votes by word and word beginning, in falling order of the vote; bounded by the examples."""

    def __init__(self, table: pa.Table, prior: float):
        votes = np.stack([table.column(c).to_numpy() for c in _VOTES], axis=1) if table.num_rows else np.zeros((0, 1 + FOLDS))
        votes = np.clip(votes, 1e-6, 1 - 1e-6)
        order = np.lexsort((np.array(table.column("entry").to_pylist(), dtype=object), -votes[:, 0])) if len(votes) else []
        table = table.take(pa.array(order, pa.int64()))
        self.entries = table.column("entry").combine_chunks()
        self.odds = np.log(votes / (1 - votes))[order] if len(votes) else votes
        self.odds = (self.odds - math.log(prior / (1 - prior))).astype(np.float32)
        self.near = [table.column(c).combine_chunks() for c in ("example_id", "example", "cosine")]
        self.beginnings = pc.ends_with(self.entries, "*").to_numpy(zero_copy_only=False).nonzero()[0]
        self.numbers = None

    def number(self, word: str) -> int:
        """The entry of a word: its own, or that of its longest known beginning; -1 without one."""
        if self.numbers is None:
            self.numbers = {e: j for j, e in enumerate(self.entries.to_pylist())}
        at = self.numbers.get(word)
        if at is None:
            for n in reversed(BEGINNINGS):
                if len(word) >= n:
                    at = self.numbers.get(word[:n] + "*")
                    if at is not None:
                        return at
            return -1
        return at

    def numbers_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words' own entries, and these or else those of their longest known beginnings; -1 without one."""
        own = _places(words, self.entries)
        number = own.copy()
        starred = self.entries.take(pa.array(self.beginnings))
        lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        for b in reversed(BEGINNINGS):
            rest = ((number < 0) & (lengths >= b)).nonzero()[0]
            cut = pc.utf8_slice_codeunits(words.take(pa.array(rest)), 0, b)
            coded = pc.binary_join_element_wise(cut, "*", "").dictionary_encode()
            at = _places(coded.dictionary, starred)
            at = np.where(at >= 0, self.beginnings[at] if len(self.beginnings) else -1, -1)
            number[rest] = at[coded.indices.to_numpy(zero_copy_only=False)] if len(rest) else -1
        return own, number

    def of(self, text: str | None) -> dict[str, int]:
        """The text's passages that resemble an example, and their entries."""
        words = passages(text)
        known = remembered(self, words, MEMORY)
        for w in words.difference(known):
            known[w] = self.number(w)
        return {w: known[w] for w in words if known[w] >= 0}

    def evidence(self, text: str | None, fold: int | None = None) -> tuple[float, list[tuple[int, str]]] | None:
        """Summed log odds of the strongest passages, and these; None without any.  ``fold``: leave out its counts."""
        found = self.of(text)
        if not found:
            return None
        if fold is None:
            best = heapq.nsmallest(STRONGEST, ((j, w) for w, j in found.items()))
            return float(sum(self.odds[j, 0] for j, _ in best)), best
        odds = self.odds[np.fromiter(found.values(), np.int64, len(found)), 1 + fold]
        return float(np.sort(odds)[-STRONGEST:].sum()), []


def _places(values: pa.Array, among: pa.Array) -> np.ndarray:
    """Distinct values' places in a longer array; -1 where it lacks one.  The table of hashes is the shorter one's."""
    at = pc.index_in(among, value_set=values)
    places = np.full(len(values), -1, np.int64)
    some = pc.is_valid(at).to_numpy(zero_copy_only=False).nonzero()[0]
    places[at.take(pa.array(some)).to_numpy(zero_copy_only=False)] = some
    return places


def calibrate(votes: list[tuple[float, float]], prior: float, groups: int = 100) -> tuple[list[float], list[float]]:
    """Monotone map from evidence to probability: groups of like evidence, pooled until their rates rise."""
    if not votes:
        return [0.0, 1.0], [prior, prior]
    votes = sorted(votes)
    size = max(1, -(-len(votes) // groups))
    pools: list[list[float]] = []  # sum of evidence, of labels, number
    for at in range(0, len(votes), size):
        part = votes[at:at + size]
        pools.append([sum(v for v, _ in part), sum(y for _, y in part), float(len(part))])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    # one example's worth of the overall rate in each pool, so that no probability is 0 or 1
    return [v / n for v, _, n in pools], [(y + prior) / (n + 1) for _, y, n in pools]


def _drawn(docs: DataFrame, labels: DataFrame, max_examples: int, max_bytes: int) -> tuple[DataFrame, int, float]:
    """The examples, stored; how many; their smoothed toxic rate."""
    arrow_limits(docs.sparkSession, BATCH)
    examples = examples_of(docs, labels, max_examples, max_bytes).withColumn("key", F.monotonically_increasing_id())
    examples = stored(examples, "toxicity-examples")
    total = examples.agg(F.count("*"), F.sum("label")).first()
    return examples, total[0], ((total[1] or 0) + 0.5) / (total[0] + 1)


def _known_passages(examples: DataFrame, prior: float, k: int) -> Passages:
    """Every passage of the examples and its votes: bounded by the examples."""
    counted = (examples.mapInArrow(_counted, "passage string, " + ", ".join(f"{c} long" for c in _COUNTS)
                                   + ", harmless long, example_id long")
               .groupBy("passage").agg(*[F.sum(c).alias(c) for c in _COUNTS],
                                       F.min(F.struct("harmless", "example_id"))["example_id"].alias("example_id")))
    counted = stored(counted, "toxicity-passages")
    shard = F.pmod(F.xxhash64(F.substring("passage", 1, BEGINNINGS[0])), F.lit(SHARDS))
    entries = (counted.withColumn("shard", shard).repartition(SHARDS, "shard").groupBy("shard").applyInArrow(
        _searched(counted.count(), prior, k),
        "entry string, " + ", ".join(f"{v} double" for v in _VOTES) + ", example_id long, example string, cosine double"))
    return Passages(entries.toArrow(), prior)


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, max_bytes: int = MAX_BYTES,
        k: int = NEIGHBOURS) -> tuple:
    """Learn passages from the labelled documents; (passages, knots, bare rate), the first shared with all tasks."""
    examples, _, prior = _drawn(docs, labels, max_examples, max_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(_known_passages(examples, prior, k))

    def votes(batches):
        for x in batches:
            out = [(shared.value.evidence(t, f), y) for t, f, y in zip(*(x.column(c).to_pylist() for c in ("text", "fold", "label")))]
            yield pa.RecordBatch.from_arrays([pa.array([e[0] if e else None for e, _ in out], pa.float64()),
                                              pa.array([float(y) for _, y in out], pa.float64())], names=["vote", "label"])

    # at most max_examples pairs
    cast = examples.mapInArrow(votes, "vote double, label double").toArrow().to_pydict()
    bare = [y for v, y in zip(cast["vote"], cast["label"]) if v is None]
    knots = calibrate([(v, y) for v, y in zip(cast["vote"], cast["label"]) if v is not None], prior)
    return shared, knots, (sum(bare) + prior) / (len(bare) + 1)


# ---------------------------------------------------------------- whole texts

def counted_words(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(text, word, count) of the texts' distinct words, by text; words are numbers in the last, the distinct words."""
    chunks, sizes = [], []
    for i, j in by_bytes([t or "" for t in texts], 1 << 18):
        words = [_WORD.findall((t or "").lower()) for t in texts[i:j]]
        sizes.extend(map(len, words))
        chunks.append(pa.array(list(chain.from_iterable(words)), pa.string()))
    coded = pa.concat_arrays(chunks).dictionary_encode() if chunks else pa.array([], pa.string()).dictionary_encode()
    most = max(1, len(coded.dictionary))
    key, count = np.unique(np.repeat(np.arange(len(texts)), sizes) * most + coded.indices.to_numpy(), return_counts=True)
    return key // most, key % most, count, coded.dictionary


def _bags(batches):
    for b in batches:
        keys, texts = b.column("key").to_numpy(), b.column("text").to_pylist()
        for i, j in by_bytes(texts, TOGETHER):
            text, word, count, words = counted_words(texts[i:j])
            yield pa.RecordBatch.from_arrays([pa.array(keys[i:j][text]), words.take(pa.array(word)), pa.array(count.astype(np.int32))],
                                             names=["key", "term", "n"])


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    offsets = (starts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _posted(keys: np.ndarray):
    """A shard's terms, each with its postings: the examples' numbers (places in ``keys``) and counts."""
    def post(table: pa.Table) -> pa.Table:
        coded = table.column("term").combine_chunks().dictionary_encode()
        term = coded.indices.to_numpy()
        row = np.searchsorted(keys, table.column("key").to_numpy())
        order = np.lexsort((row, term))
        starts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(coded.dictionary)))])
        count = table.column("n").to_numpy()[order]
        return pa.table([coded.dictionary, _binary(row[order].astype(np.uint32), starts), _binary(count.astype(np.uint32), starts)],
                        names=["term", "rows", "counts"])
    return post


def _text_index(examples: DataFrame, keys: np.ndarray, entries: pa.Array) -> TextIndex:
    """The examples' block-max index; its terms are numbered as ``entries``."""
    terms = examples.select("key", "text").mapInArrow(_bags, "key long, term string, n int")
    shard = F.pmod(F.xxhash64("term"), F.lit(SHARDS))
    posted = (terms.withColumn("shard", shard).groupBy("shard")
              .applyInArrow(_posted(keys), "term string, rows binary, counts binary").toArrow())
    at = pc.index_in(entries, value_set=posted.column("term").combine_chunks()).fill_null(-1).to_numpy()
    parts = []
    for name in ("rows", "counts"):
        size, flat = _flat(posted.column(name), np.uint32)
        # half the bytes where no text has a word more often
        kind = np.uint16 if name == "counts" and flat.max(initial=0) < 1 << 16 else np.uint32
        first = np.concatenate([[0], np.cumsum(size)])
        sizes = np.where(at >= 0, size[at] if len(size) else 0, 0).astype(np.int64)
        out, to = np.empty(int(sizes.sum()), kind), 0
        for i in range(0, len(at), 20_000):
            some = slice(i, i + 20_000)
            values = flat[spans(np.where(at[some] >= 0, first[at[some]], 0), sizes[some])]
            out[to:to + len(values)] = values
            to += len(values)
        parts.append(out)
    del posted, flat
    return TextIndex(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), *parts, len(keys))


def _flat(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of a binary column's values, and all values one after the other, as numbers."""
    sizes, values = [np.zeros(0, np.int64)], [np.zeros(0, kind)]
    for c in column.chunks:
        if len(c):
            offsets = np.frombuffer(c.buffers()[1], np.int32)[c.offset:c.offset + len(c) + 1].astype(np.int64) // kind().itemsize
            sizes.append(np.diff(offsets))
            values.append(np.frombuffer(c.buffers()[2], kind, offsets[-1])[offsets[0]:])
    return np.concatenate(sizes), np.concatenate(values)


class Texts:
    """Known passages, and the index of whole examples with their labels, folds and ids."""

    def __init__(self, known: Passages, index: TextIndex, label: np.ndarray, fold: np.ndarray, ids: np.ndarray, prior: float, k: int):
        self.known, self.index, self.label, self.fold, self.ids = known, index, label, fold, ids
        self.prior, self.k = prior, k

    def evidence(self, texts: list, folds: np.ndarray | None = None) -> tuple:
        """By text: passages' log odds (NaN without any), neighbours' log odds (likewise), the pairs (text, entry, word)
        of the strongest passages, and (text, example, cosine) of the neighbours.  ``folds``: leave out what they taught."""
        text, word, count, words = counted_words(texts)
        n = len(texts)
        term, number = self.known.numbers_of(words)
        some = (number[word] >= 0).nonzero()[0]
        t, w = text[some], word[some]
        entry = number[w]
        odds = self.known.odds[entry, 0 if folds is None else 1 + folds[t]].astype(np.float64)
        order = np.lexsort((entry if folds is None else -odds, t))
        place = np.empty(len(t), np.int64)
        place[order] = np.arange(len(t)) - np.searchsorted(t, t[order])
        top = place < STRONGEST
        passage = np.where(np.bincount(t, minlength=n) > 0, np.bincount(t[top], odds[top], minlength=n), np.nan)
        own = (term[word] >= 0).nonzero()[0]
        near = self.index.nearest(text[own], term[word[own]], count[own], n, self.k, None if folds is None else (folds, self.fold))
        weight = NEAR / (NEAR + 1 - near[2])
        of_y, of_n = (np.bincount(near[0], x, minlength=n) for x in (weight * self.label[near[1]], weight))
        vote = np.clip((of_y + SMOOTH * self.prior) / (of_n + SMOOTH), 1e-6, 1 - 1e-6)
        whole = np.where(of_n > 0, np.log(vote / (1 - vote)) - math.log(self.prior / (1 - self.prior)), np.nan)
        pairs = []
        if folds is None:
            # equally strong passages by their words
            last = np.full(n, -1, np.int64)
            np.maximum.at(last, t[top], entry[top])
            held = (entry <= last[t]).nonzero()[0]
            by_text = sorted(zip(t[held].tolist(), entry[held].tolist(), words.take(pa.array(w[held])).to_pylist()))
            taken = Counter()
            for p in by_text:
                taken[p[0]] += 1
                if taken[p[0]] <= STRONGEST:
                    pairs.append(p)
        return passage, whole, pairs, near


def factor(passage: np.ndarray, whole: np.ndarray, label: np.ndarray, rounds: int = 50) -> float:
    """What whole texts' log odds count beside passages', ``LEAST`` to 1: logistic regression by damped Newton steps."""
    x = np.stack([np.nan_to_num(passage), np.nan_to_num(whole), np.ones(len(label))], axis=1)
    ridge = np.array([1.0, 1.0, 0.0]) + 1e-6

    def loss(at):
        z = x @ at
        return float(np.logaddexp(0, z).sum() - z @ label + 0.5 * (ridge * at * at).sum())

    at = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (label - p) - ridge * at)
        size = 1.0
        while size > 1e-6 and loss(at + size * step) > loss(at):
            size /= 2
        at = at + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return min(1.0, max(LEAST, float(at[1]) / float(at[0]))) if at[0] > 0 else 1.0


def fit_texts(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, max_bytes: int = MAX_BYTES,
              k: int = NEIGHBOURS) -> tuple:
    """Learn whole texts and passages from the labelled documents: (texts, factor, knots, bare rate), the first shared."""
    examples, _, prior = _drawn(docs, labels, max_examples, max_bytes)
    known = _known_passages(examples, prior, k)
    # at most max_examples rows of numbers
    listed = examples.select("key", "label", "fold", "example_id").toArrow().sort_by("key")
    keys, label, fold, ids = (listed.column(c).to_numpy() for c in ("key", "label", "fold", "example_id"))
    index = _text_index(examples, keys, known.entries)
    shared = docs.sparkSession.sparkContext.broadcast(Texts(known, index, label, fold, ids, prior, k))

    def votes(batches):
        for x in batches:
            texts, folds, y = x.column("text").to_pylist(), x.column("fold").to_numpy(), x.column("label").to_numpy()
            for i, j in by_bytes(texts, TOGETHER):
                passage, whole, _, _ = shared.value.evidence(texts[i:j], folds[i:j])
                yield pa.RecordBatch.from_arrays([pa.array(passage), pa.array(whole), pa.array(y[i:j].astype(np.float64))],
                                                 names=["passage", "whole", "label"])

    # at most max_examples rows of three numbers
    cast = examples.mapInArrow(votes, "passage double, whole double, label double").toArrow()
    passage, whole, label = (cast.column(c).to_numpy() for c in ("passage", "whole", "label"))
    times = factor(passage, whole, label)
    bare = np.isnan(passage) & np.isnan(whole)
    total = np.nan_to_num(passage) + times * np.nan_to_num(whole)
    knots = calibrate(list(zip(total[~bare].tolist(), label[~bare].tolist())), prior)
    return shared, times, knots, (float(label[bare].sum()) + prior) / (int(bare.sum()) + 1)


def text_scorer(model):
    """A column function: text -> struct of score, evidence (its strongest passages) and neighbours (nearest whole texts)."""
    shared, times, knots, bare = model
    kind = ("score double, evidence array<struct<passage: string, log_odds: double, example_id: long, example: string, cosine: double>>, "
            "neighbours array<struct<example_id: long, cosine: double>>")

    def lists(text: np.ndarray, n: int, columns: list, names: list[str]) -> pa.Array:
        offsets = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, names=names))

    def judged(known: Texts, texts: list) -> pa.Array:
        passage, whole, pairs, near = known.evidence(texts)
        score = np.interp(np.nan_to_num(passage) + times * np.nan_to_num(whole), *knots)
        score = np.where(np.isnan(passage) & np.isnan(whole), bare, score)
        entry = np.array([e for _, e, _ in pairs], np.int64)
        ids, example, cosine = (c.take(pa.array(entry)) for c in known.known.near)
        evidence = lists(np.array([t for t, _, _ in pairs], np.int64), len(texts),
                         [pa.array([w for _, _, w in pairs], pa.string()), pa.array(known.known.odds[entry, 0].astype(np.float64)),
                          ids, example, cosine], ["passage", "log_odds", "example_id", "example", "cosine"])
        neighbours = lists(near[0], len(texts), [pa.array(known.ids[near[1]]), pa.array(near[2])], ["example_id", "cosine"])
        return pa.StructArray.from_arrays([pa.array(score), evidence, neighbours], names=["score", "evidence", "neighbours"])

    @F.arrow_udf(kind)
    def judge(texts: pa.Array) -> pa.Array:
        coded = pc.fill_null(texts, "").dictionary_encode()
        once = coded.dictionary.to_pylist()
        if not once:
            return judged(shared.value, [])
        return pa.concat_arrays([judged(shared.value, once[i:j]) for i, j in by_bytes(once, TOGETHER)]).take(coded.indices)

    return judge


def with_text_score(docs: DataFrame, model: tuple, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """``docs`` and ``out_col`` (score, evidence, neighbours); no shuffle."""
    arrow_limits(docs.sparkSession, BATCH)
    return docs.withColumn(out_col, text_scorer(model)(F.col(f"`{text_col}`")))


# ---------------------------------------------------------------- passages alone

def scorer(spark, model):
    """A column function: text -> struct of score and evidence (its strongest passages, each with its nearest example)."""
    shared, knots, bare = model
    kind = "score double, evidence array<struct<passage: string, log_odds: double, example_id: long, example: string, cosine: double>>"

    @F.pandas_udf(kind)
    def judge(texts: pd.Series) -> pd.DataFrame:
        known = shared.value
        once = {}
        for text in texts:
            if text not in once:
                found = known.evidence(text)
                if found is None:
                    once[text] = (bare, [])
                else:
                    once[text] = (float(np.interp(found[0], *knots)),
                                  [(w, float(known.odds[j, 0]), *(c[j].as_py() for c in known.near)) for j, w in found[1]])
        rows = [once[t] for t in texts]
        return pd.DataFrame({"score": [s for s, _ in rows], "evidence": [e for _, e in rows]})

    return judge


def with_score(docs: DataFrame, model: tuple, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """``docs`` and ``out_col`` (score, evidence); no shuffle."""
    arrow_limits(docs.sparkSession)
    return docs.withColumn(out_col, scorer(docs.sparkSession, model)(F.col(f"`{text_col}`")))
