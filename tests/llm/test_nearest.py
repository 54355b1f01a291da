"""Whole texts against whole labelled texts: exact neighbours, skipped blocks, and their votes in every score."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from snapvault.llm import toxicity
from snapvault.llm.nearest import TextIndex
from snapvault.llm.toxicity import fit_texts, with_text_score


def _texts(rng, n, words=60):
    tongues = [["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(words)] for letters in ("abcde", "fghij", "klmno")]
    return [" ".join(rng.choice(t)[: rng.randint(2, 6)] for _ in range(rng.randint(1, 60))) for t in (rng.choice(tongues) for _ in range(n))]


def _brute(examples, queries):
    """Cosines of all pairs, plain TF-IDF over all words."""
    bags = [toxicity.Counter(toxicity._WORD.findall(t.lower())) for t in examples]
    df = toxicity.Counter(w for b in bags for w in b)
    idf = {w: np.log((1 + len(bags)) / (1 + c)) + 1 for w, c in df.items()}

    def unit(bag):
        v = {w: (1 + np.log(c)) * idf[w] for w, c in bag.items() if w in idf}
        norm = sum(x * x for x in v.values()) ** 0.5
        return {w: x / norm for w, x in v.items()}
    units = [unit(b) for b in bags]
    return np.array([[sum(x * u.get(w, 0) for w, x in unit(toxicity.Counter(toxicity._WORD.findall(q.lower()))).items()) for u in units]
                     for q in queries])


def test_whole_text_search_is_exact_and_skips_blocks():
    rng = random.Random(4)
    examples, queries = _texts(rng, 500), _texts(rng, 150) + ["", "unknown zzz"]
    text, word, count, words = toxicity.counted_words(examples)
    order = np.lexsort((text, word))
    starts = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words)))])
    index = TextIndex(starts, text[order], count[order], len(examples), block=8)
    q, w, c, known = toxicity.counted_words(queries)
    number = {x: i for i, x in enumerate(words.to_pylist())}
    term = np.array([number.get(x, -1) for x in known.to_pylist()])[w]
    got = index.nearest(q[term >= 0], term[term >= 0], c[term >= 0], len(queries), 10)
    every = _brute(examples, queries)
    for j in range(len(queries)):
        want = np.sort(every[j][every[j] > 1e-9])[::-1][:10]
        cosines, rows = got[2][got[0] == j], got[1][got[0] == j]
        assert len(cosines) == len(want) and np.allclose(cosines, want, atol=1e-6)
        assert np.allclose(every[j][rows], cosines, atol=1e-6) and len(set(rows.tolist())) == len(rows)
    assert index.skipped > 0
    # examples of a text's own number are left out
    fold = np.arange(len(examples)) % 5
    mine = np.arange(len(queries)) % 5
    got = index.nearest(q[term >= 0], term[term >= 0], c[term >= 0], len(queries), 10, (mine, fold))
    assert not (fold[got[1]] == mine[got[0]]).any()
    for j in range(len(queries)):
        left = every[j][(fold != mine[j]) & (every[j] > 1e-9)]
        assert np.allclose(got[2][got[0] == j], np.sort(left)[::-1][:10], atol=1e-6)


def test_scores_hold_votes_of_the_nearest_whole_texts(spark):
    rng = random.Random(6)
    texts = _texts(rng, 150)
    rows = [(i, t, int("b" in t.split()[0])) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    shared, times, knots, bare = model = fit_texts(docs, docs.where("doc_id < 100").select("doc_id", "toxic"))
    assert times >= toxicity.LEAST
    got = {r["doc_id"]: r["t"] for r in with_text_score(docs, model).select("doc_id", F.col("toxicity").alias("t")).collect()}

    taught = {}
    for i, t, y in rows:
        if i < 100 and zlib.crc32(str(i).encode()) % 3 != 1:
            taught.setdefault((t, y), i)
    examples = [t for t, _ in taught]
    label, ids = np.array([y for _, y in taught]), np.array(list(taught.values()))
    prior = (label.sum() + 0.5) / (len(taught) + 1)
    every = _brute(examples, texts)
    for i, t, _ in rows:
        cosine = every[i]
        best = sorted(cosine[cosine > 1e-9], reverse=True)[: toxicity.NEIGHBOURS]
        near = got[i]["neighbours"]
        assert np.allclose([n["cosine"] for n in near], best, atol=1e-6)
        at = [int((ids == n["example_id"]).nonzero()[0][0]) for n in near]
        weight = np.array([toxicity.NEAR / (toxicity.NEAR + 1 - n["cosine"]) for n in near])
        vote = (weight @ label[at] + toxicity.SMOOTH * prior) / (weight.sum() + toxicity.SMOOTH) if near else prior
        whole = np.log(vote / (1 - vote)) - np.log(prior / (1 - prior))
        found = shared.value.known.evidence(t)
        want = float(np.interp((found[0] if found else 0.0) + times * whole, *knots)) if found or near else bare
        assert abs(got[i]["score"] - want) < 1e-6, i
        assert [(e["passage"]) for e in got[i]["evidence"]] == [w for _, w in (found[1] if found else [])]


def test_one_search_serves_all_words_of_a_beginning(monkeypatch):
    rng = random.Random(8)
    stems = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    words = sorted({s + e for s in stems for e in ("", "d", "er", "ing", "ings")})
    counts = {c: [rng.randint(0, 3) + (c[0] == "n") * 3 for _ in words] for c in toxicity._COUNTS}
    table = pa.table({"passage": words, **counts, "example_id": list(range(len(words)))})
    searched, nearest = [], toxicity.BlockMaxIndex.nearest
    monkeypatch.setattr(toxicity.BlockMaxIndex, "nearest", lambda self, bag, k: searched.append(bag) or nearest(self, bag, k))
    for k in (1, 4, 15):
        searched.clear()
        got = {r["entry"]: r for r in toxicity._searched(len(words), 0.1, k)(table).to_pylist()}
        beginnings = {t for w in words for t in toxicity.terms_of(w)[1:]}
        assert set(got) == set(words) | beginnings and len(searched) == len(beginnings) < len(words)
        # against a search for each entry
        index = toxicity.BlockMaxIndex([dict.fromkeys(toxicity.terms_of(w), 1) for w in words], len(words))
        n, y = (np.array([counts[f"{c}{f}"] for f in range(toxicity.FOLDS)], float).T for c in "ny")
        for e, r in got.items():
            rows, cosine = nearest(index, dict.fromkeys(toxicity.terms_of(e), 1), k)
            weight = toxicity.NEAR / (toxicity.NEAR + 1 - cosine)
            for f in (None, *range(toxicity.FOLDS)):
                rest = [x for x in range(toxicity.FOLDS) if x != f]
                want = ((weight @ y[rows][:, rest]).sum() + 0.1 * toxicity.SMOOTH) / ((weight @ n[rows][:, rest]).sum() + toxicity.SMOOTH)
                assert abs(r["vote" if f is None else f"vote{f}"] - want) < 1e-12, (k, e, f)
            assert r["example"] == words[rows[0]] and r["example_id"] == rows[0] and abs(r["cosine"] - cosine[0]) < 1e-12


def test_a_text_skips_the_strips_that_only_others_need(monkeypatch):
    """Texts of several tongues, searched together: no text is scored in the blocks of the other tongues."""
    rng = random.Random(9)
    tongues = [[f"{letter}{j}" for j in range(40)] for letter in "xyz"]
    examples = [" ".join(rng.choice(tongues[i % 3]) for _ in range(30)) for i in range(1200)]
    queries = [" ".join(rng.choice(tongues[i % 3]) for _ in range(30)) for i in range(60)]
    text, word, count, words = toxicity.counted_words(examples)
    order = np.lexsort((text, word))
    starts = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words)))])
    index = TextIndex(starts, text[order], count[order], len(examples), block=4)
    number = {x: i for i, x in enumerate(words.to_pylist())}
    q, w, c, known = toxicity.counted_words(queries)
    term = np.array([number[x] for x in known.to_pylist()])[w]
    scored, partition = [], np.partition
    monkeypatch.setattr(np, "partition", lambda a, *x, **y: scored.append(a.shape) or partition(a, *x, **y))
    got = index.nearest(q, term, c, len(queries), 10)
    monkeypatch.undo()
    every = _brute(examples, queries)
    for j in range(len(queries)):
        assert np.allclose(got[2][got[0] == j], np.sort(every[j])[::-1][:10], atol=1e-6)
    pairs = sum(n * (width - 10 * (width > 10)) for n, width in scored)
    assert pairs < 0.6 * len(queries) * len(examples)


def test_words_take_their_own_entry_or_their_longest_known_beginning():
    entries = ["abcde", "abcde*", "abc*", "ab", "xyz", "xyz*", "éàü*"]
    votes = {v: [0.5] * len(entries) for v in toxicity._VOTES}
    known = toxicity.Passages(pa.table({"entry": entries, **votes, "example_id": list(range(7)), "example": entries, "cosine": [1.0] * 7}), 0.1)
    words = ["abcde", "abcdef", "abcd", "abx", "ab", "xyz", "xyzzy", "éàüéà", "q", "abcdefg"]
    own, number = known.numbers_of(pa.array(words))
    place = {e: j for j, e in enumerate(known.entries.to_pylist())}
    assert own.tolist() == [place.get(w, -1) for w in words]
    assert number.tolist() == [known.number(w) for w in words]
    own, number = known.numbers_of(pa.array([], pa.string()))
    assert len(own) == len(number) == 0


def test_texts_without_a_frequent_word_find_their_neighbours():
    examples = [f"a{i} b{i // 2}" for i in range(40)]
    text, word, count, words = toxicity.counted_words(examples)
    order = np.lexsort((text, word))
    starts = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words)))])
    number = {x: i for i, x in enumerate(words.to_pylist())}
    for n in (40, 3):
        index = TextIndex(starts, text[order], count[order], len(examples), block=8)
        queries = [f"b{j}" for j in range(n // 2)] + [""]
        term = np.array([number[q] for q in queries[:-1]])
        got = index.nearest(np.arange(n // 2), term, np.ones(n // 2, int), len(queries), 5)
        every = _brute(examples, queries)
        for j in range(len(queries)):
            assert np.allclose(got[2][got[0] == j], np.sort(every[j][every[j] > 1e-9])[::-1][:5], atol=1e-6)


def test_a_word_counts_as_often_as_a_text_has_it(spark):
    """A million times the same word: the text's own cosine is 1, and the others' are as brute force has them."""
    rng = random.Random(10)
    words = [f"w{j}" for j in range(500)]
    texts = [" ".join(["na"] * times + rng.sample(words, 400)) for times in (1_000_000, 1, 70_000, 9)] + _texts(rng, 20)
    free = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(free[j], t, j % 2) for j, t in enumerate(texts)] + [(1000 + j, t, None) for j, t in enumerate(texts[:4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit_texts(docs, docs.where("doc_id < 1000").select("doc_id", "toxic"))
    got = {r["doc_id"]: r["n"] for r in with_text_score(docs.where("doc_id >= 1000"), model).select("doc_id", F.col("toxicity.neighbours").alias("n")).collect()}
    every = _brute(texts, texts[:4])
    for j in range(4):
        near = got[1000 + j]
        assert near[0]["example_id"] == free[j] and abs(near[0]["cosine"] - 1) < 1e-6
        assert np.allclose([n["cosine"] for n in near[:4]], np.sort(every[j])[::-1][:4], atol=1e-6)
