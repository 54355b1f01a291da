"""Segmentations, targets, cleaned texts and pipeline stages against plain versions."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from snapvault.llm import mixing, quality, simhash, toxicity, unigram


def _best(m, words, longest, body):
    """Greatest score of any segmentation of the whole text, by plain dynamic programming."""
    text = b" " + body
    at = [0.0] + [float("-inf")] * len(text)
    for i in range(len(text)):
        if text[i] & 0xC0 == 0x80:
            continue
        end = i + 1
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end += 1
        if text[i:end] not in words:
            at[end] = max(at[end], at[i] + m.unknown)
        for j in range(i + 1, min(len(text), i + longest) + 1):
            if text[i:j] in words:
                at[j] = max(at[j], at[i] + words[text[i:j]])
    return at[-1]


def _score(m, ids):
    byte, total, held = {int(k): v for v, k in enumerate(m.byte_id)}, 0.0, b""
    for k in ids:
        if k not in byte:
            assert not held
            total += float(m.score[k])
            continue
        held += bytes([byte[k]])
        try:
            held.decode()
        except UnicodeDecodeError:
            continue
        total, held = total + m.unknown, b""
    assert not held
    return total


def test_segmentations_are_the_best_of_all():
    local = random.Random(3)
    m = unigram.UnigramModel(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    byte = set(m.byte_id.tolist())
    words = {raw: float(s) for k, (raw, s) in enumerate(zip(m.raw, m.score)) if raw and k not in byte}
    longest = max(map(len, words))
    some = [w.decode() for w in local.sample(sorted(words), 300)]
    texts = ["".join(local.choice(some + list(" abthe▁é🎉\n")) for _ in range(local.randint(1, 12))) for _ in range(150)]
    texts += ["  two  spaces ", "antidisestablishmentarianism " * 3, "▁", "日本語のテキスト", "a\x00b"]
    for text, ids in zip(texts, unigram.Encoder(m).encode([t.encode() for t in texts])):
        got = [int.from_bytes(ids[k:k + 4], "little") for k in range(0, len(ids), 4)]
        assert m.decode(got) == text
        assert _score(m, got) == pytest.approx(_best(m, words, longest, text.encode()), abs=1e-6), text


def test_targets_are_those_of_repeated_sharing(spark):
    local = random.Random(5)
    for n in (1, 2, 5, 9):
        size = {f"s{k}": local.choice([0, 1, 10, 300, 5000]) for k in range(n - 1)} | {None: local.randint(0, 900)}
        order = sorted((s for s in size if s is not None)) + [None]
        weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
        want, left, open_ = {}, 1.5 * sum(size.values()), set(order)
        while open_:
            level = left / sum(weight[s] for s in open_)
            full = {s for s in open_ if level * weight[s] >= 2 * size[s]}
            if not full:
                want |= {s: level * weight[s] for s in open_}
                break
            want |= {s: 2.0 * size[s] for s in full}
            left -= sum(2 * size[s] for s in full)
            open_ -= full
        rows = spark.createDataFrame([(s, size[s]) for s in order], "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
        assert got.keys() == want.keys()
        assert all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want), (got, want)


def test_cleaned_text_is_the_text_without_failed_lines(spark):
    body = "A sentence with words.\nHome | About | Contact | Login\n\nBuy now!! cheap!!\n### $$$ ###\nAll rights reserved 2020\nThe end."
    rows = spark.createDataFrame([(1, body), (2, None), (3, ""), (4, "alpha beta gamma delta | epsilon zeta eta theta"),
                                  (5, "Home · About · Contact"), (6, "Home / About / Contact / Login"),
                                  (7, "one / or two of the words that were said here · twice")], "doc_id long, text string")
    got = {r["doc_id"]: r["c"] for r in rows.select("doc_id", quality.cleaned_text(F.col("text")).alias("c")).collect()}
    assert got == {1: "A sentence with words.\n\nThe end.", 2: None, 3: "", 4: "alpha beta gamma delta | epsilon zeta eta theta",
                   5: "", 6: "", 7: "one / or two of the words that were said here · twice"}
    judged = {r["doc_id"]: r for r in quality.judge_quality(rows).collect()}
    for k, text in got.items():
        before, after = (rows.where(F.col("doc_id") == k).first()["text"] or ""), text or ""
        assert len(before.split()) - len(after.split()) == judged[k]["n_lost_words"]


def test_stages_keep_the_rows_they_should(spark, tmp_path):
    local = random.Random(11)
    word = [f"w{k}" for k in range(400)]
    texts = [" ".join(local.choice(word) for _ in range(60)) for _ in range(30)]
    texts += [t.upper() for t in texts[:5]] + [texts[7]] * 4
    texts += [t + " tail" for t in texts[10:14]] + ["", None]
    docs = spark.createDataFrame([(k, t, "en", "s" if k % 3 else None) for k, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string")
    lower = [(t or "").lower() for t in texts]
    kept = pipeline.drop_copies(spark, docs, "")
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == sorted({t: k for k, t in enumerate(lower)}.values())

    prints = {k: simhash.fingerprint(lower[k].encode(), 4) for k in ids}
    parent = {k: k for k in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (int(prints[a]) ^ int(prints[b])).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    near = pipeline.drop_near_copies(spark, kept, "")
    got = sorted(r["doc_id"] for r in near.collect())
    assert got == [k for k in ids if find(k) == k]

    mix = {r["doc_id"]: r["copies"] for r in mixing.cube_mix(near).collect()}
    mixed = [r["doc_id"] for r in pipeline.mix_sources(spark, near, "").collect()]
    assert {k: mixed.count(k) for k in mix} == mix


def test_pipeline_drops_what_only_whole_texts_tell(spark, tmp_path):
    """Each word is in one toxic and one harmless pattern, so words alone tell nothing; the nearest whole texts do."""
    local = random.Random(13)
    word = [f"{local.choice('bdfgkm')}{local.choice('aeiou')}{k}" for k in range(60)]
    halves = [local.sample(word, 30), local.sample(word, 30)]
    patterns = [(h, y) for y, half in enumerate(halves) for h in (half, [w for w in word if w not in half])]
    texts = [(" ".join(local.sample(patterns[k % 4][0], 25)), patterns[k % 4][1]) for k in range(360)]
    rows = [(k, t, y) for k, (t, y) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    labels = docs.where("doc_id < 300").selectExpr("doc_id", "y AS toxic")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    new = docs.where("doc_id >= 300")

    got = sorted(r["doc_id"] for r in pipeline.drop_toxic(spark, docs, str(tmp_path)).where("doc_id >= 300").collect())
    assert got == [k for k, _, y in rows if k >= 300 and not y]
    # the former stage, passages alone
    alone = toxicity.with_score(new, toxicity.fit(docs, labels)).where(F.col("toxicity.score") < toxicity.THRESHOLD)
    assert sorted(r["doc_id"] for r in alone.collect()) != got
