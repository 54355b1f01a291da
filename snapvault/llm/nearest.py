"""Exact TF-IDF cosine of whole texts by a block-max inverted index, many texts at a time.

An example is a whole text: the counts of its words, weighed by plain TF-IDF and
scaled to unit length.  Examples are put in an order that keeps texts with the
same commonest word together, and cut into blocks.  Terms that a sixteenth of the
examples have are frequent: their postings lie in rows as long as the examples,
with the greatest weight in each block.  The others' are lists, which are few and
short beside them and weigh most; they are read whole (block-max MaxScore).

A block's bound for a text is the sum of its weights times the frequent terms'
maxima there, and the greatest sum that the lists give an example of the block.
Blocks lie in strips.  Each text's strip of the greatest bound is scored first; then,
by strip, the blocks whose bound reaches the k-th best cosine so far, for the texts
that need one there.  The others are skipped: no example in them can be among the
nearest.

Cosines are found in single precision and those that may be among the k best are
worked out again in double, so the neighbours are exact for the stored (single
precision) weights.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64
STRIP = 16             # blocks scored at once
TOGETHER = 128         # texts that visit blocks together
FREQUENT = 16          # one in so many examples has the term
EXACT = 4096           # cosines worked out at once
PART = 100_000         # postings derived at once
SHORT = 128            # lists below this length are read together
SLACK = 1e-5           # more than single precision errs in a cosine


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of many ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class TextIndex:
    """Postings by term number: ``starts`` (terms + 1), ``rows`` and ``counts``; ``n`` examples.

    ``order`` gives the caller's number of an example.  What the search needs
    besides is derived when it is first used, and not part of a pickle.
    """

    def __init__(self, starts: np.ndarray, rows: np.ndarray, counts: np.ndarray, n: int, block: int = BLOCK):
        self.n, self.block, self.starts = n, block, starts
        self.n_blocks = -(-n // block)
        df = np.diff(starts)
        self.idf = np.log((1 + n) / (1 + df)) + 1
        # an example's commonest word, and how many words it has
        frequent = (df >= max(2, n / FREQUENT)).nonzero()[0]
        at = spans(starts[frequent], df[frequent])
        term = np.repeat(np.arange(len(frequent), dtype=np.int32), df[frequent])
        by_count = np.lexsort((-term, counts[at]))
        best = np.full(n, -1, np.int32)
        best[rows[at[by_count]]] = term[by_count]
        place_of = _chained(best, rows[at], term, len(frequent))
        words = np.bincount(rows, minlength=n) if len(rows) else np.zeros(n, np.int64)
        self.order = np.lexsort((words, place_of)).astype(np.int32)
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        self.rows = np.empty(len(rows), np.uint16 if n <= 1 << 16 else np.uint32)
        self.counts = np.empty(len(rows), counts.dtype)
        square = np.zeros(n)
        for i, j, term in self._parts():
            part = slice(starts[i], starts[j])
            to = place[rows[part]]
            sort = np.argsort((term - i) * n + to, kind="stable")
            self.rows[part], self.counts[part] = to[sort], counts[part][sort]
            tf_idf = (1 + np.log(self.counts[part])) * self.idf[term]
            square += np.bincount(self.rows[part], tf_idf * tf_idf, minlength=n)
        self.norm = np.where(square > 0, np.sqrt(square), 1.0)
        self.visited = self.skipped = 0
        self.ready = self.loaded = False

    def _parts(self):
        """(first term, end, each posting's term) of runs of terms with some 100,000 postings: bounds what is derived at once."""
        i, last = 0, len(self.starts) - 1
        while i < last:
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + PART, "right")) - 1)
            yield i, j, np.repeat(np.arange(i, j), np.diff(self.starts[i:j + 1]))
            i = j

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")} | {"ready": False}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, loaded=True)

    def _prepare(self) -> None:
        df = np.diff(self.starts)
        frequent = (df >= max(2, self.n / FREQUENT)).nonzero()[0]
        self._row_of = np.full(len(df), -1, np.int32)
        self._row_of[frequent] = np.arange(len(frequent))
        width = self.n_blocks * self.block
        dense = np.zeros((len(frequent), width), np.float32)
        # the other terms' lists: a posting is its place (lower half) and its weight's bits
        size = np.where(self._row_of >= 0, 0, df)
        self._first = np.concatenate([[0], np.cumsum(size)])
        self._list = np.empty(self._first[-1], np.int64)
        for i, j, term in self._parts():
            part = slice(self.starts[i], self.starts[j])
            at = self.rows[part]
            weight = ((1 + np.log(self.counts[part])) * self.idf[term] / self.norm[at]).astype(np.float32)
            some = self._row_of[term] >= 0
            dense[self._row_of[term[some]], at[some]] = weight[some]
            self._list[self._first[i]:self._first[j]] = weight[~some].view(np.int32).astype(np.int64) << 32 | at[~some]
        self._dense = dense.reshape(len(frequent), self.n_blocks, self.block)
        self._dense_max = self._dense.max(axis=2)
        if self.loaded:  # a task's copy only searches
            self.rows = self.counts = None
        self.ready = True

    def unit(self, text: np.ndarray, term: np.ndarray, count: np.ndarray, n_texts: int):
        """(text, term, weight) of the terms that examples have, of unit length by text; sorted by text as given."""
        known = (self.starts[term + 1] > self.starts[term]).nonzero()[0]
        text, term = text[known], term[known]
        w = (1 + np.log(count[known])) * self.idf[term]
        norm = np.sqrt(np.bincount(text, w * w, minlength=n_texts))
        return text, term, w / norm[text]

    def nearest(self, text: np.ndarray, term: np.ndarray, count: np.ndarray, n_texts: int, k: int,
                left_out: tuple[np.ndarray, np.ndarray] | None = None):
        """(text, example, cosine) of each text's k greatest cosines above zero, by text, cosine, place.

        ``text`` is sorted.  ``left_out``: a number for each text and one for each
        example; examples of a text's own number are none of its neighbours.
        """
        if not self.ready:
            self._prepare()
        text, term, weight = self.unit(text, term, count, n_texts)
        at = np.searchsorted(text, np.arange(n_texts + 1))
        if left_out is not None:
            of_text, of_place = left_out[0], left_out[1][self.order]
        out = []
        # texts whose frequent terms' greatest bounds lie in the same stretch visit like blocks
        stretch = np.zeros(n_texts if self.n_blocks else 0, np.int64)
        for i in range(0, len(stretch), 4 * TOGETHER):
            j = min(n_texts, i + 4 * TOGETHER)
            part = slice(at[i], at[j])
            m, used, _ = self._matrix(text[part] - i, term[part], weight[part], j - i)
            bound = m.astype(np.float32) @ self._dense_max[used]
            stretch[i:j] = np.add.reduceat(bound, np.arange(0, self.n_blocks, STRIP), axis=1).argmax(axis=1)
        by_block = np.argsort(stretch, kind="stable")
        for i in range(0, len(by_block), TOGETHER):
            group = np.sort(by_block[i:i + TOGETHER])
            entries = spans(at[group], at[group + 1] - at[group])
            q = np.repeat(np.arange(len(group)), at[group + 1] - at[group])
            own = None if left_out is None else (of_text[group], of_place)
            g, place, cosine = self._visit(q, term[entries], weight[entries], len(group), k, own)
            out.append((group[g], self.order[place], place, cosine))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        text, example, place, cosine = (np.concatenate(x) for x in zip(*out))
        by_text = np.lexsort((place, -cosine, text))
        return text[by_text], example[by_text], np.minimum(cosine[by_text], 1.0)

    def _matrix(self, q, term, weight, n: int):
        """Weights of the frequent terms as a matrix, the terms' rows, and which entries are other terms'."""
        row = self._row_of[term]
        some = row >= 0
        used = np.unique(row[some])
        m = np.zeros((n, len(used)))
        m[q[some], np.searchsorted(used, row[some])] = weight[some]
        return m, used, ~some

    def _listed(self, q, term, weight, n: int) -> np.ndarray:
        """Sums by text and place over the terms' lists."""
        out = np.zeros((n, self.n_blocks * self.block))
        start, size = self._first[term], self._first[term + 1] - self._first[term]
        short = size < SHORT
        some, start, end = start[short], start[~short], (start + size)[~short]
        together, times = self._list[spans(some, size[short])], np.repeat(weight[short], size[short])
        texts = np.arange(n + 1)
        first = np.concatenate([[0], np.cumsum(size[short])])[np.searchsorted(q[short], texts)]
        of, weight = np.searchsorted(q[~short], texts), weight[~short]
        for j in range(n):
            part, rest = slice(of[j], of[j + 1]), slice(first[j], first[j + 1])
            lists = [self._list[x:y] for x, y in zip(start[part].tolist(), end[part].tolist())]
            postings = np.concatenate([*lists, together[rest]])
            w = np.concatenate([np.repeat(weight[part], end[part] - start[part]), times[rest]])
            w *= (postings >> 32).astype(np.int32).view(np.float32)
            out[j] = np.bincount(postings & 0xFFFFFFFF, w, minlength=out.shape[1])
        return out

    def _visit(self, q, term, weight, n: int, k: int, own):
        m, used, rest = self._matrix(q, term, weight, n)
        single = m.astype(np.float32)
        lists = self._listed(q[rest], term[rest], weight[rest], n)
        bound = single @ self._dense_max[used] + lists.reshape(n, self.n_blocks, self.block).max(axis=2)
        flat = self._dense.reshape(len(self._dense), self.n_blocks * self.block)
        strips = np.arange(0, self.n_blocks, STRIP)
        greatest = np.maximum.reduceat(bound, strips, axis=1)
        start = greatest.argmax(axis=1)
        best = np.zeros((n, k), np.float32)  # the k best cosines so far
        found = []

        def score(strip: int, texts: np.ndarray) -> None:
            """Some texts' cosines in the blocks of a strip that one of them needs."""
            least = np.maximum(best[texts].min(axis=1) - SLACK, SLACK / 1000)
            near = bound[texts, strip * STRIP:(strip + 1) * STRIP] >= least[:, None]
            texts, near, least = texts[near.any(axis=1)], near.any(axis=0), least[near.any(axis=1)]
            self.visited += int(near.sum())
            self.skipped += len(near) - int(near.sum())
            if not len(texts):
                return
            blocks = near.nonzero()[0] + strip * STRIP
            places = (blocks[:, None] * self.block + np.arange(self.block)).ravel()
            cosine = single[texts] @ self._dense[used[:, None], blocks].reshape(len(used), len(places))
            cosine += lists[texts[:, None], places]
            if own is not None:
                cosine[own[1][np.minimum(places, self.n - 1)][None, :] == own[0][texts][:, None]] = 0
            best[texts] = np.partition(np.concatenate([best[texts], cosine], axis=1), len(places), axis=1)[:, len(places):]
            least = np.maximum(best[texts].min(axis=1) - SLACK, SLACK / 1000)
            g, c = (cosine >= least[:, None]).nonzero()
            found.append((texts[g], places[c], cosine[g, c]))

        for strip in np.unique(start):
            score(strip, (start == strip).nonzero()[0])
        for strip in np.argsort(-greatest.sum(axis=0), kind="stable"):
            score(strip, (start != strip).nonzero()[0])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        g, place, cosine = (np.concatenate(x) for x in zip(*found))
        some = cosine >= np.maximum(best.min(axis=1) - SLACK, SLACK / 1000)[g]
        g, place = g[some], place[some]
        cosine = lists[g, place]
        for i in range(0, len(g), EXACT):
            part = slice(i, i + EXACT)
            cosine[part] += np.einsum("ct,tc->c", m[g[part]], flat[used[:, None], place[part]])
        order = np.lexsort((place, -cosine, g))
        g, place, cosine = g[order], place[order], cosine[order]
        kept = np.arange(len(g)) - np.searchsorted(g, g) < k
        return g[kept], place[kept], cosine[kept]


def _chained(best: np.ndarray, rows: np.ndarray, term: np.ndarray, n_terms: int) -> np.ndarray:
    """Each example's place by its commonest word, where words of examples with like words follow each other."""
    words, cluster = np.unique(best, return_inverse=True)
    width = max(1, n_terms)
    mean = np.bincount(cluster[rows] * width + term, minlength=len(words) * width).reshape(len(words), width)
    mean = mean / np.maximum(np.sqrt((mean * mean).sum(axis=1, keepdims=True)), 1e-9)
    like = mean @ mean.T
    left, place, at = np.ones(len(words), bool), np.empty(len(words), np.int64), 0
    for j in range(len(words)):
        left[at], place[at] = False, j
        at = int(np.where(left, like[at], -1).argmax())
    return place[cluster]
