"""Repeated passages by sparse suffix arrays.

Suffixes are kept at content-selected positions only: those whose ``gram``-word
hash is the least of some window of neighbouring ones, so documents that share
a passage of ``min_words`` words keep suffixes at the same places in it.
Suffixes whose first ``gram`` words occur once cannot match and stop there.
The others are brought together by the hash of those words and sorted by all
of them.  A run of suffixes that begin alike and has more than ``run_rows``
members is cut by document into that many parts, so that no task holds more of
it, and no keys are sampled on the driver.

Each suffix is compared with its neighbours from other documents, in the order
of the words to the right and, among suffixes that begin alike, in the order of
the words to the left; matches are extended left and right word by word.  Where
its best left and right extensions come from different neighbours, so that they
may not belong to one passage, a suffix is compared by every window of
``min_words`` words around it with all that begin alike.

A suffix brings ``min_words - 1`` words on either side.  Longer passages follow
because the next suffix of a passage is nearer than that: a document's matched
spans are joined.  Members of a run that was cut may match best in a part they
never met: the windows of ``min_words`` words around each of them whose least
gram it is are grouped by their words, and those that two documents have are spans too.  The
least gram of a window is the same in every document, and always kept, so each
window is grouped once for a document.

Words are runs of other than ASCII white space, A-Z lower-cased.  Cases: null
text has no words; repeats inside one document alone are no passage; rows that
repeat both id and text are one document; a null id is carried through; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapvault.llm.common import arrow_limits, stored, text_hash, utf8

MIN_WORDS = 50
GRAM = 16
RUN_ROWS = 4096  # members of a run compared in one task
_MUL = np.uint64(0x9E3779B97F4A7C15)
SELECTED = "doc_id long, text_hash long, hashes array<long>, places array<int>"
CONTEXT = "hash long, part int, parts int, doc_id long, text_hash long, places array<int>, left binary, right binary"
FOUND = ("doc_id long, text_hash long, places array<int>, before int, after int, match_id long, "
         "left binary, right binary")
HELD = "window binary, a long, b long, first long, last long"
OPEN = "window binary, doc_id long, text_hash long, starts array<int>"


def gram_hashes(words: list[bytes], gram: int) -> np.ndarray:
    """A hash of every run of ``gram`` words, mixed so that its order has nothing to do with the words."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(0, len(h) - gram + 1)
    out = np.zeros(n, np.uint64)
    for k in range(gram):
        out = out * _MUL + h[k:k + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """Minimum or maximum over every window, by windows that double."""
    done = 1
    while 2 * done <= width:
        x = least(x[:len(x) - done], x[done:])
        done *= 2
    rest = width - done
    return least(x[:len(x) - rest], x[rest:]) if rest else x


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the least hash of some window (all of equal ones)."""
    if len(grams) < window:
        return np.flatnonzero(grams == grams.min()) if len(grams) else np.zeros(0, np.int64)
    least = _sliding(grams, window, np.minimum)
    pad = np.zeros(window - 1, np.uint64)
    # no window around a position has a larger minimum than the position's own hash
    return np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), window, np.maximum) == grams)


def _select(min_words: int, gram: int):
    window = min_words - gram - 1  # grams of any min_words words hold more than one window

    def run(batches):
        for b in batches:
            hashes, places = [], []
            for body in b.column("body").to_pylist():
                words = body.lower().split()
                at = np.zeros(0, np.int64)
                if len(words) >= min_words:
                    grams = gram_hashes(words, gram)
                    at = minimisers(grams, window)
                    hashes.append(grams[at].view(np.int64))
                else:
                    hashes.append(at)
                places.append(at.astype(np.int32))
            keep = np.flatnonzero([len(p) > 0 for p in places])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(keep)), b.column("text_hash").take(pa.array(keep)),
                 pa.array([hashes[k] for k in keep], pa.list_(pa.int64())),
                 pa.array([places[k] for k in keep], pa.list_(pa.int32()))],
                names=["doc_id", "text_hash", "hashes", "places"])

    return run


def _contexts(min_words: int, gram: int):
    """Words around each suffix; suffixes of a document with equal surroundings are one row."""

    def run(batches):
        for b in batches:
            rows, size = [], 0
            place, parts = (x.to_numpy() for x in b.column("places").values.flatten())
            ends = b.column("places").offsets.to_pylist()
            for doc, text, body, first, end in zip(*(b.column(k).to_pylist() for k in ("doc_id", "text_hash", "body")), ends, ends[1:]):
                words = b" ".join(body.lower().split())
                # where each word starts, and one would after the last
                starts = np.concatenate([[0], np.flatnonzero(np.frombuffer(words, np.uint8) == 32) + 1, [len(words) + 1]])
                at, k = np.unique(place[first:end], return_index=True)
                cuts = (starts[np.clip(at + d, 0, len(starts) - 1)].tolist() for d in (1 - min_words, 0, gram, min_words))
                alike: dict = {}
                me = xxhash.xxh64_intdigest(f"{doc}/{text}")
                for p, n, before, here, begun, after in zip(at.tolist(), parts[first:end][k].tolist(), *cuts):
                    left, right = words[before:max(before, here - 1)], words[here:after - 1]
                    row = alike.get((left, right))
                    if row is None:
                        h = xxhash.xxh64_intdigest(words[here:begun - 1]) - 2**63
                        alike[left, right] = (h, me % n, n, doc, text, [p], left, right)
                        size += len(left) + len(right)
                    else:
                        row[5].append(p)
                rows.extend(alike.values())
                if size > 4 << 20:
                    yield _batch(rows)
                    rows, size = [], 0
            yield _batch(rows)

    return run


def _batch(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 8
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=[x.split()[0] for x in CONTEXT.split(", ")])


def shared_words(a: bytes, b: bytes) -> int:
    """Whole words that both begin with."""
    if a == b:
        return a.count(b" ") + 1 if a else 0
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "little") ^ int.from_bytes(b[:n], "little")
    if differ:  # its lowest bit lies in the first byte that differs
        n = ((differ & -differ).bit_length() - 1) // 8
    if not n:
        return 0
    return a.count(b" ", 0, n) + ((n == len(a) or a[n] == 32) and (n == len(b) or b[n] == 32))


def _neighbours(order: list[int], who: list) -> list[tuple[int, int]]:
    """Pairs that stand next to each other in ``order`` but for members of the same document."""
    pairs, last_other = [], None
    for before, now in zip(order, order[1:]):
        if who[before] != who[now]:
            pairs.append((before, now))
            last_other = before
        elif last_other is not None and who[last_other] != who[now]:
            pairs.append((last_other, now))
    first_other = None
    for after, now in zip(order[:0:-1], order[-2::-1]):
        if who[after] != who[now]:
            first_other = after
        elif first_other is not None and who[first_other] != who[now]:
            pairs.append((now, first_other))
    return pairs


def _around(left: bytes, right: bytes, min_words: int) -> list[tuple[int, bytes]]:
    """Every window of ``min_words`` words around a suffix: how many of them are to the left, and their hash."""
    before = left.count(b" ") + 1 if left else 0
    text = left + b" " + right if left else right
    starts = [0, *accumulate(len(w) + 1 for w in text.split(b" "))]
    most = min(before, min_words - 1)
    return [(k, xxhash.xxh128_digest(text[starts[before - k]:starts[before - k + min_words] - 1]))
            for k in range(max(0, min_words - (len(starts) - 1 - before)), most + 1)]


def match_run(who: list, left: list[bytes], right: list[bytes], min_words: int) -> list[tuple[int, int, int | None]]:
    """(words before, words after, smallest matching id) for each suffix of a run; (0, 0, None) without a match.

    ``who``: (doc_id, text_hash) of suffixes that begin alike, in the order of
    ``right``, then ``left``.
    """
    n = len(who)
    before, after, match = [0] * n, [0] * n, [None] * n
    best_before, best_after = [0] * n, [0] * n
    back = [x[::-1] for x in left]
    settled = set()

    def settle(i, j):
        """A pair's match; what it adds is the same whenever and however often it is met."""
        pair = min(i, j) * n + max(i, j)
        if pair in settled:
            return
        settled.add(pair)
        extend_l, extend_r = shared_words(back[i], back[j]), shared_words(right[i], right[j])
        for x, y in ((i, j), (j, i)):
            if extend_l > best_before[x]:
                best_before[x] = extend_l
            if extend_r > best_after[x]:
                best_after[x] = extend_r
            if extend_l + extend_r >= min_words:
                before[x], after[x] = max(before[x], extend_l), max(after[x], extend_r)
                other = who[y][0]
                match[x] = other if match[x] is None else match[x] if other is None else min(match[x], other)

    if n == 2:
        if who[0] != who[1]:
            settle(0, 1)
    elif len(set(who)) > 1:
        for order in (list(range(n)), sorted(range(n), key=back.__getitem__)):
            for i, j in _neighbours(order, who):
                settle(i, j)
        if any((x > y or z > w) and x + z >= min_words for x, y, z, w in zip(best_before, before, best_after, after)):
            seen: dict = {}
            keys: list = []
            for i in range(n):
                if not i or right[i] != right[i - 1] or left[i] != left[i - 1]:  # copies stand next to each other
                    keys = _around(left[i], right[i], min_words)
                for key in keys:
                    met = seen.setdefault(key, [])
                    for j in met:
                        if who[j] != who[i]:
                            settle(i, j)
                            break
                    if len(met) < 2 and all(who[j] != who[i] for j in met):
                        met.append(i)  # two documents are enough to find another one
    return list(zip(before, after, match))


def _match(min_words: int):
    names = [x.split()[0] for x in FOUND.split(", ")]

    def matched(runs: pa.RecordBatch):
        """Whole runs' matches; all members with their words where a run has other parts."""
        hashes, parts = runs.column("hash").to_numpy(), runs.column("part").to_numpy()
        starts = np.flatnonzero((hashes[1:] != hashes[:-1]) | (parts[1:] != parts[:-1])) + 1
        cut = (runs.column("parts").to_numpy() > 1).tolist()
        who = list(zip(*(runs.column(k).to_pylist() for k in ("doc_id", "text_hash"))))
        left, right = runs.column("left").to_pylist(), runs.column("right").to_pylist()
        rows, found = [], []
        for first, end in pairwise([0, *starts.tolist(), len(who)]):
            # rows that repeat id and text stand next to each other
            run = [i for i in range(first, end) if i == first or who[i] != who[i - 1] or right[i] != right[i - 1] or left[i] != left[i - 1]]
            for i, m in zip(run, match_run(*([x[i] for i in run] for x in (who, left, right)), min_words)):
                if cut[i] or m[1]:
                    rows.append(i)
                    found.append(m)
        for k in range(0, len(rows), 5000):
            at = pa.array(rows[k:k + 5000], pa.int64())
            before, after, match = zip(*found[k:k + 5000])
            words = [pa.array([x[i] if cut[i] else None for i in rows[k:k + 5000]], pa.binary()) for x in (left, right)]
            yield pa.RecordBatch.from_arrays(
                [*(runs.column(c).take(at) for c in ("doc_id", "text_hash", "places")), pa.array(before, pa.int32()),
                 pa.array(after, pa.int32()), pa.array(match, pa.int64()), *words], names=names)

    def run(batches):
        held, at = [], None  # the rows so far of a run that may go on
        for b in batches:
            if not b.num_rows:
                continue
            hashes, parts = b.column("hash").to_numpy(), b.column("part").to_numpy()
            if held and (hashes[0], parts[0]) != at:
                yield from matched(pa.concat_batches(held))
                held = []
            last = b.num_rows - int(np.count_nonzero((hashes == hashes[-1]) & (parts == parts[-1])))  # where its last run starts
            if last:
                yield from matched(pa.concat_batches([*held, b.slice(0, last)]))
                held = []
            held.append(b.slice(last))
            at = hashes[-1], parts[-1]
        if held:
            yield from matched(pa.concat_batches(held))

    return run


def own_windows(left: list[bytes], right: list[bytes], min_words: int, gram: int) -> range:
    """Starts, in ``left + right``, of the windows whose least gram (the first of equal ones) is the suffix's own.

    A window of ``min_words`` words holds more grams than the selection looks
    at, so its least gram is a kept suffix in every document that has the
    window: each window has one suffix that answers for it.
    """
    words, p = left + right, len(left)
    grams = gram_hashes(words, gram)
    held = min_words - gram + 1  # grams of a window
    if p >= len(grams):
        return range(0)
    before, after = np.flatnonzero(grams[:p] <= grams[p]), np.flatnonzero(grams[p + 1:] < grams[p])
    first = max(0, p - held + 1, int(before[-1]) + 1 if len(before) else 0)
    last = min(p, len(words) - min_words, p + 1 + int(after[0]) - held if len(after) else p)
    return range(first, last + 1)


def _held_windows(min_words: int, gram: int):
    """Windows of ``min_words`` words around the suffixes, as hashes, with the least and largest document of each.

    Summed up batch by batch before the shuffle: members of a run stand next to each other.
    """
    kinds = [pa.binary(), *[pa.int64()] * 4]

    def batch(held: dict):
        cols = zip(*((w, *v) for w, v in held.items())) if held else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["window", "a", "b", "first", "last"])

    def run(batches):
        for b in batches:
            held: dict = {}
            around, windows = None, set()
            for who, doc, left, right in zip(*(b.column(k).to_pylist() for k in ("who", "doc_id", "left", "right"))):
                if (left, right) != around:  # copies stand next to each other
                    around = left, right
                    x, y = left.split(), right.split()
                    words = x + y
                    windows = {xxhash.xxh128_digest(b" ".join(words[k:k + min_words]))
                               for k in own_windows(x, y, min_words, gram)}
                for h in windows:
                    seen = held.get(h)
                    if seen is None:
                        held[h] = [who, who, doc, doc]
                    else:
                        seen[0], seen[1] = min(seen[0], who), max(seen[1], who)
                        if doc is not None:
                            seen[2], seen[3] = (doc, doc) if seen[2] is None else (min(seen[2], doc), max(seen[3], doc))
                if len(held) > 100_000:
                    yield batch(held)
                    held = {}
            yield batch(held)

    return run


def _open_windows(min_words: int, gram: int):
    """Every window of a suffix that its matches so far don't cover, as a hash, with its first words."""
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def batch(rows):
        cols = zip(*rows) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["window", "doc_id", "text_hash", "starts"])

    def run(batches):
        for b in batches:
            rows, size = [], 0
            for doc, text, places, before, after, left, right in zip(*(
                    b.column(k).to_pylist() for k in ("doc_id", "text_hash", "places", "before", "after", "left", "right"))):
                x, y = left.split(), right.split()
                words = x + y
                found: dict = {}
                if before == len(x) and after == len(y):
                    continue
                for k in own_windows(x, y, min_words, gram):
                    if not (len(x) - before <= k and k + min_words <= len(x) + after):
                        found.setdefault(xxhash.xxh128_digest(b" ".join(words[k:k + min_words])), []).append(k - len(x))
                for h, ks in found.items():
                    rows.append((h, doc, text, [p + k for p in places for k in ks]))
                    size += 1 + len(places) * len(ks)
                if size > 50_000:
                    yield batch(rows)
                    rows, size = [], 0
            yield batch(rows)

    return run


def across_parts(found: DataFrame, min_words: int, gram: int) -> DataFrame:
    """Further spans of the runs that were cut into parts.

    Windows that two documents have are counted over all members, those of one
    batch once, each by the suffix that answers for it; only those that no
    match covers yet look themselves up.
    """
    members = found.where("right is not null")
    shared = (members.select(F.xxhash64("doc_id", "text_hash").alias("who"), "doc_id", "left", "right")
              .mapInArrow(_held_windows(min_words, gram), HELD).groupBy("window")
              .agg(F.min("a").alias("a"), F.max("b").alias("b"), F.min("first").alias("match_id"), F.max("last").alias("last_id"))
              .where("a <> b").select(F.col("window").alias("s_window"), "match_id", "last_id"))
    met = members.mapInArrow(_open_windows(min_words, gram), OPEN).join(shared, F.col("window") == F.col("s_window"))
    # a document that has the smallest id itself names the largest; copies of one id name that id
    other = F.when(F.col("doc_id").eqNullSafe(F.col("match_id")), F.col("last_id")).otherwise(F.col("match_id"))
    return met.select("doc_id", "text_hash", other.alias("match_id"), F.explode("starts").alias("s")).select(
        "doc_id", "text_hash", "match_id", "s", (F.col("s") + min_words).alias("e"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                      gram: int = GRAM, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per passage that a document shares with another: id, start_word, end_word, n_words, match_id."""
    if gram < 2 or min_words < 2 * gram + 2:
        raise ValueError("min_words must be at least 2 * gram + 2")
    arrow_limits(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_hash(f"`{text_col}`").alias("text_hash"),
                       utf8(f"`{text_col}`").alias("body"))
    chosen = stored(rows.mapInArrow(_select(min_words, gram), SELECTED), "suffixes")
    each = chosen.select("doc_id", "text_hash", F.explode(F.arrays_zip("hashes", "places")).alias("s"))
    each = each.select("doc_id", "text_hash", F.col("s.hashes").alias("h"), F.col("s.places").alias("place"))
    # only beginnings that two documents have can match
    who = F.xxhash64("doc_id", "text_hash")
    twice = stored(each.groupBy("h").agg(F.min(who).alias("a"), F.max(who).alias("b"), F.count("*").alias("n")).where("a <> b")
                   .select(F.col("h").alias("t_h"), F.ceil(F.col("n") / run_rows).cast("int").alias("parts")), "shared-beginnings", free=True)  # so that Spark can split a hot one in the join
    places = (each.join(twice, F.col("h") == F.col("t_h"))
              # a document's positions: no more than its words
              .groupBy(F.col("doc_id").alias("p_id"), F.col("text_hash").alias("p_h"))
              .agg(F.collect_list(F.struct("place", "parts")).alias("places")))
    around = stored(rows.join(places, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("text_hash") == F.col("p_h")))
                    .select("doc_id", "text_hash", "body", "places").mapInArrow(_contexts(min_words, gram), CONTEXT),
                    "suffix-contexts", codec="zstd", free=True)  # surroundings of neighbouring suffixes overlap
    found = stored(around.repartition("hash", "part")
                   .sortWithinPartitions("hash", "part", "right", "left", "doc_id", "text_hash")
                   .mapInArrow(_match(min_words), FOUND), "suffix-matches", codec="zstd", free=True)
    matched = found.where("after > 0")
    spans = matched.select("doc_id", "text_hash", "match_id", F.explode("places").alias("p"), "before", "after").select(
        "doc_id", "text_hash", "match_id", (F.col("p") - F.col("before")).alias("s"), (F.col("p") + F.col("after")).alias("e"))
    spans = spans.unionByName(across_parts(found, min_words, gram))
    inside = Window.partitionBy("doc_id", "text_hash").orderBy("s", "e")
    reach = F.max("e").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    joined = (spans.withColumn("new", F.when(F.col("s") <= reach, 0).otherwise(1))
              .withColumn("n", F.sum("new").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    return (joined.groupBy("doc_id", "text_hash", "n")
            .agg(F.min("s").alias("start_word"), F.max("e").alias("end_word"), F.min("match_id").alias("match_id"))
            .select(F.col("doc_id").alias(id_col), "start_word", "end_word",
                    (F.col("end_word") - F.col("start_word")).alias("n_words"), "match_id", "text_hash"))
