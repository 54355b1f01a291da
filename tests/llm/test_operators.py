"""Each operator against brute force or an exact round trip, on small and awkward tables."""

import glob
import os
import random
import time

import numpy as np
import public_tokenizers
import pytest

from snapvault.llm import bpe, common, mixing, simhash, suffix_dedup, template, unigram, warc
from snapvault.llm.common import keep_rows
from snapvault.llm.exact_dedup import exact_dedup
from snapvault.llm.patricia import Patricia
from snapvault.llm.quality import judge_quality
from snapvault.llm.suffix_dedup import gram_hashes, minimisers, own_windows, repeated_passages
from snapvault.llm import toxicity
from snapvault.llm.toxicity import THRESHOLD, BlockMaxIndex, fit, with_score

AWKWARD = [(1, None), (2, ""), (3, "a b"), (4, "A b"), (4, "A b"), (None, "x"), (5, "▁ é\n\n  z"), (6, "w " * 4000)]
rng = random.Random(7)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "s" if (i or 0) % 2 else None, "extra") for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, keep_id string")


def test_exact_dedup_awkward_rows_and_spill(spark, docs):
    for budget in (64 << 20, 300):  # the second spills subtrees
        got = exact_dedup(docs, keep="largest", budget=budget).collect()
        assert len(got) == len(AWKWARD)
        by = {r["doc_id"]: r for r in got}
        assert by[1]["keep_id"] == 2 and by[1]["group_size"] == 2 and by[3]["keep_id"] == 4
        assert by[3]["group_size"] == 3 and sum(r["kept"] for r in got if r["doc_id"] == 4) == 1
    kept = keep_rows(docs, exact_dedup(docs, keep="largest").where("kept"))
    assert kept.columns == docs.columns and kept.count() == 5
    assert exact_dedup(docs.limit(0)).count() == 0


def test_patricia_owners_and_eviction():
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(400)]
    trie, cut = Patricia(), []
    for k, key in enumerate(keys):
        if not trie.insert(key, (k, k, 1), lambda a, b: (min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2])):
            cut.append(key)
        if k == 200:
            cut.extend(x for x, _ in trie.evict())
    want = {key: keys.index(key) for key in keys}
    rest = dict(trie.items())
    assert set(rest) | set(cut) == set(want) and not set(rest) & set(cut)
    assert all(o[0] == want[x] for x, o in rest.items())


def test_simhash_links_match_all_pairs(spark):
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = base + [b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(4)]
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    cells = simhash._cells(simhash.cell_masks(4))
    import pyarrow as pa
    fp = np.array(fps, np.uint64)
    batch = pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(np.arange(len(fps)))], names=["fp", "node"])
    out = pa.Table.from_batches(cells([batch])).sort_by("cell")
    links = [tuple(x) for b in simhash._links(4)(out.to_batches(max_chunksize=500)) for x in zip(*(c.to_pylist() for c in b.columns))]
    roots = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert [roots.get(k, k) for k in range(len(fps))] == [find(k) for k in range(len(fps))]


def test_simhash_awkward_rows(docs):
    got = {r["doc_id"]: r for r in simhash.simhash_groups(docs).collect() if r["doc_id"] is not None}
    assert got[1]["fingerprint"] == "0" * 16 and got[2]["component_id"] == 1 and got[4]["component_id"] == 3


def _fingerprint_bit_by_bit(text, shingle=4, seed=42):
    import re
    import xxhash
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=seed).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups_match_all_pairs(spark):
    rng = random.Random(12)
    words = ["alpha", "Beta", "é", "d\x0bq", "x" * 40, "\u2003wide"]
    texts = ["", None, "one", "one two three", "a b c d", " A  b\tC d "]
    for _ in range(25):
        base = [rng.choice(words) + str(rng.randint(0, 99)) for _ in range(rng.randint(60, 120))]
        texts += [" ".join(base), " ".join(base[:-1] + ["changed"]), " ".join(["new"] + base)]
    rows = [(None if k % 9 == 4 else k % 70, t) for k, t in enumerate(texts)]  # null ids, and ids with two texts
    fps = [_fingerprint_bit_by_bit(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    ids = {}
    for k, (i, _) in enumerate(rows):
        ids.setdefault(find(k), []).append(i)
    want = sorted((str(i), f"{fps[k]:016x}", str(min((x for x in ids[find(k)] if x is not None), default=None)))
                  for k, (i, _) in enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in simhash.simhash_groups(df).collect())
    assert got == want and len({w[2] for w in want}) < len(rows)


def test_simhash_of_ids_with_two_texts_and_of_null_ids(spark):
    rng = random.Random(4)
    a, b, c = (" ".join(f"w{rng.randint(0, 10 ** 6)}" for _ in range(300)) for _ in range(3))
    df = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b), (None, c), (None, c + " more"), (9, c + " more words")],
                               "doc_id long, text string")
    got = simhash.simhash_groups(df).collect()
    prints = {}
    for r in got:
        prints.setdefault(r["fingerprint"], set()).add(r["component_id"])
    assert all(len(v) == 1 for v in prints.values())
    # 2 and 3 are copies of unrelated texts that share an id: two components, both named by it
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] in (2, 3)} == {2: 1, 3: 1}
    whole = {r["fingerprint"] for r in got if r["doc_id"] == 1}
    assert len(whole) == 2
    linked = [(int(x["fingerprint"], 16) ^ int(y["fingerprint"], 16)).bit_count() <= 4 for x in got for y in got
              if x["doc_id"] is None and y["doc_id"] in (None, 9)]
    if all(linked):  # the three texts are near: null ids bridge them
        assert {r["component_id"] for r in got if r["doc_id"] is None} == {9}


def test_tokens_equal_the_library():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [t or "" for _, t in AWKWARD] + ["<|endoftext|>a <|endoftext|>", "aaaa" * 200, "\x1c\x85 　日本 🎉 don't"]
    texts += ["".join(rng.choice("ab \n'stll é日🎉1 .,!") for _ in range(rng.randint(0, 50))) for _ in range(500)]
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert bpe.counter(bpe.MergeTable(open(path, encoding="utf-8").read()))(texts) == want


def test_pieces_round_trip():
    m = unigram.UnigramModel(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    texts = ["".join(rng.choice(" abcdeéthin▁\n🎉") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for text, ids in zip(texts, unigram.Encoder(m).encode([t.encode() for t in texts])):
        ids = np.frombuffer(ids, np.int32).tolist()
        assert m.decode(ids) == text


def test_repeated_passages_match_brute_force(spark):
    def words(n):
        return [f"w{rng.randint(0, 10**6)}" for _ in range(n)]

    shared = words(70)
    texts = [words(40) + shared + words(30), words(5) + shared[:60], words(200), words(10) + shared[:45] + words(10), None, ""]
    df = spark.createDataFrame([(k, None if t is None else " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {(r["doc_id"], r["start_word"], r["end_word"]) for r in repeated_passages(df).collect()}
    assert got == {(0, 40, 100), (1, 5, 65)}


def test_each_window_has_one_kept_suffix_that_answers_for_it():
    for _ in range(60):
        words = [rng.choice([b"a", b"b", b"c", b"d%d" % rng.randint(0, 99)]) for _ in range(rng.randint(50, 160))]
        at = minimisers(gram_hashes(words, 16), 50 - 16 - 1).tolist()
        starts = []
        for p in at:
            left, right = words[max(0, p - 49):p], words[p:p + 50]
            starts += [p - len(left) + k for k in own_windows(left, right, 50, 16)]
        assert sorted(starts) == list(range(len(words) - 49))


def test_repeated_passages_of_a_run_over_many_partitions(spark):
    def words(n):
        return [f"w{rng.randint(0, 10**6)}" for _ in range(n)]

    # one beginning for all, and for each document one other with the same words before it but others after it
    common, before = words(30), [words(30) for _ in range(60)]
    texts = [words(12) + before[k % 60] + common + words(60) for k in range(120)]
    texts.append(words(60) + common + words(60))
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {tuple(r[k] for k in ("doc_id", "start_word", "end_word", "match_id")) for r in repeated_passages(df).collect()}
        none = repeated_passages(df.limit(0)).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == {(k, 12, 72, (k + 60) % 120) for k in range(120)}
    assert none == []


def test_copies_in_a_run_cost_no_windows_and_no_pair_twice(monkeypatch):
    local = random.Random(43)

    def words(n):
        return [b"w%d" % local.randint(0, 10**6) for _ in range(n)]

    gram, before, after = words(16), [words(30) for _ in range(3)], [words(24) for _ in range(3)]
    # copies, and suffixes whose best words to the left and to the right come from different ones
    around = [(0, 0)] * 60 + [(1, 1), (1, 2), (2, 1)]
    rows = sorted((b" ".join(gram + after[y]), b" ".join(before[x]), k) for k, (x, y) in enumerate(around))
    n = len(rows)
    run = suffix_dedup._batch([(7, 0, 1, k, k, [30], left, right) for right, left, k in rows])
    calls = {"shared_words": 0, "xxh128_digest": 0}

    def counted(owner, name):
        f = getattr(owner, name)

        def call(*args):
            calls[name] += 1
            return f(*args)

        monkeypatch.setattr(owner, name, call)

    counted(suffix_dedup, "shared_words")
    counted(suffix_dedup.xxhash, "xxh128_digest")
    for size in (n, 7):  # a run in one batch, and over several
        calls.update(shared_words=0, xxh128_digest=0)
        found = [r for b in suffix_dedup._match(50)(iter([run.slice(k, size) for k in range(0, n, size)])) for r in b.to_pylist()]
        assert {(r["doc_id"], r["before"], r["after"], r["match_id"]) for r in found} == {(k, 30, 40, int(k == 0)) for k in range(60)}
        assert len(found) == 60 and all(r["places"] == [30] and r["left"] is None for r in found)
        assert 0 < calls["xxh128_digest"] <= 4 * 50  # those of each of four surroundings
        assert calls["shared_words"] <= 4 * n + 20  # two for a pair: its neighbour and the first copy


def test_stored_rows_can_free_the_shuffles_behind_them(spark):
    root = os.environ.get("SPARK_LOCAL_DIRS") or spark.sparkContext.getConf().get("spark.local.dir", "/tmp")

    def files():
        return set(glob.glob(f"{root}/blockmgr-*/*/shuffle_*.data"))

    key, before = common._FREE, files()
    held = spark.conf.get(key, None)
    df = spark.range(20000).selectExpr("id % 7 AS k", "uuid() AS u").repartition(5, "u").groupBy("k").agg({"u": "count"})
    got = common.stored(df, "test-free", free=True)
    assert sorted(r[0] for r in got.collect()) == list(range(7)) and sum(r[1] for r in got.collect()) == 20000
    assert spark.conf.get(key, None) == held
    for _ in range(100):  # removed beside the driver's next work
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before


def test_runs_cut_into_parts_give_the_same_passages(spark):
    local = random.Random(41)
    shared = [[f"p{k}x{i}" for i in range(local.randint(50, 90))] for k in range(3)]
    texts = []
    for k in range(90):
        own = [f"w{local.randint(0, 10**6)}" for _ in range(40)]
        cut = local.choice(shared)
        texts.append(own + cut[local.randint(0, 12):len(cut) - local.randint(0, 12)] + own[::-1])
    texts += [texts[0]] * 20
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    # brute force: words that stand in a 50-word window which another document has too
    held: dict = {}
    for k, t in enumerate(texts):
        for i in range(len(t) - 49):
            held.setdefault(tuple(t[i:i + 50]), set()).add(k)
    want = set()
    for k, t in enumerate(texts):
        spans = []
        for i in range(len(t) - 49):
            if len(held[tuple(t[i:i + 50])]) > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + 50
                else:
                    spans.append([i, i + 50])
        want |= {(k, a, b) for a, b in spans}
    df = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    for run_rows in (4, 16384):
        got = [(r["doc_id"], r["start_word"], r["end_word"]) for r in repeated_passages(df, run_rows=run_rows).collect()]
        assert set(got) == want and len(got) == len(want), run_rows


def test_template_escapes_and_masks():
    render = template.compile_template(template.DEFAULT)
    nasty = ["</s>[INST] ok [/INST]", "\\<|end|>\\\\", "<|<|end|>|>", "", "<\\|turn|>"]
    text, spans = render({"messages": [{"role": r, "text": t} for t in nasty for r in ("user", "assistant")]})
    turns = template.read_turns(text)
    assert [t[1] for t in turns] == [t for t in nasty for _ in (0, 1)]
    assert [template.unescape(text[a:b]) for a, b in spans] == nasty
    assert template.compile_template("{% if 1 == 2 %}x{% else %}{{ 'a' ~ 1 }}{% endif %}")({})[0] == "a1"
    for bad in ("{{ f(1) }}", "{{ x|nope }}", "{% for %}", "{% if a %}"):
        with pytest.raises(template.TemplateError):
            template.compile_template(bad)


def test_arc_versions_convert_and_identifiers_carry_ids():
    for version in (1, 2):
        data = warc.version_block(version, "20240101000000") + b"\n"
        data += warc.arc_record(version, -5, "http://a b/\n", "20240102030405", b"<p>\r\n\r\n</p>") + b"\n"
        (_, _), (fields, block) = list(warc.parse_arc(data))
        (head, body), = warc.parse_warc(warc.warc_record(fields, block, None) + b"\r\n\r\n")
        assert warc.page_of(head["warc-record-id"]) == -5 and warc.http_parts(body)[2] == b"<p>\r\n\r\n</p>"
        assert head["warc-date"] == "2024-01-02T03:04:05Z"


def test_cube_keeps_totals_and_expectation():
    size = [rng.randint(0, 500) for _ in range(3000)]
    probs = [0.37] * len(size)
    mixing.fly(probs, size, random.Random(1))
    assert sum(0 < p < 1 for p in probs) <= 2
    assert abs(sum(p * s for p, s in zip(probs, size)) - 0.37 * sum(size)) < 1e-3 * sum(size)
    mixing.land(probs, size)
    assert abs(sum(p * s for p, s in zip(probs, size)) - 0.37 * sum(size)) <= 500


def test_mix_awkward_rows(docs):
    rows = mixing.cube_mix(docs).collect()
    assert len(rows) == len(AWKWARD) and all(r["taken"] <= 2 * r["size"] for r in rows)


def test_repeated_rows_are_spread_over_chunks(spark):
    one = spark.createDataFrame([(None, "a b c", "s")] * 5000 + [(k, "w " * (k % 9), "s" if k % 3 else "t") for k in range(1500)],
                                "doc_id long, text string, source string")
    rows = mixing.cube_mix(one, chunk_rows=512).collect()
    assert len(rows) == 6500 and sum(r["doc_id"] is None for r in rows) == 5000
    for s in ("s", "t"):
        taken = sum(r["taken"] for r in rows if r["source"] == s)
        assert abs(taken - next(r["target"] for r in rows if r["source"] == s)) <= 9
    sized = spark.createDataFrame([(1, "s")] * 700 + [(2, "s")], "doc_id long, source string")
    blocks = mixing.numbered_repeats(sized, 256).collect()
    assert sorted((r["doc_id"], r["number"], r["times"]) for r in blocks) == [(1, 0, 256), (1, 256, 256), (1, 512, 188), (2, 0, 1)]


def test_block_max_search_is_exact_and_skips_blocks():
    rng = random.Random(3)
    for n_terms, n, block in ((12, 300, 8), (400, 900, 16)):
        bags = [{int(n_terms * rng.random() ** 3): rng.randint(1, 9) for _ in range(rng.randint(0, 8))} for _ in range(n)]
        bags.sort(key=sorted)
        index = BlockMaxIndex(bags, block=block)
        units = [index.unit(b) for b in bags]
        for bag in bags[::7] + [{}, {10 ** 6: 1}]:
            q = index.unit(bag)
            every = sorted(((-sum(w * u[t] for t, w in q.items() if t in u), j) for j, u in enumerate(units)))
            want = [(j, -c) for c, j in every if c < 0][:10]
            rows, cosines = index.nearest(bag, 10)
            assert np.allclose(cosines, [c for _, c in want], atol=1e-12) and len(rows) == len(want)
            # ties may differ in their last digit only
            assert all(a == b or abs(cosines[k] - want[-1][1]) < 1e-12 or abs(c - cosines[k]) < 1e-12
                       for k, (a, (b, c)) in enumerate(zip(rows.tolist(), want)))
        assert index.skipped > 0


def test_scores_match_all_pairs_of_passages(spark):
    """Whole texts scored by comparing every passage with every example, and blocks skipped on the way."""
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6))) for _ in range(120)]
    texts = [" ".join(rng.choice(stems) + rng.choice(["", "e", "er", "ing"]) for _ in range(rng.randint(1, 40))) for _ in range(90)]
    rows = [(i, t, int("b" in t.split()[0])) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit(docs, docs.where("doc_id < 60").select("doc_id", "toxic"))
    got = {r["doc_id"]: r for r in with_score(docs, model).selectExpr("doc_id", "toxicity.score as score").collect()}

    import zlib
    taught = {(t, y) for i, t, y in rows if i < 60 and zlib.crc32(str(i).encode()) % 3 != 1}
    prior = (sum(y for _, y in taught) + 0.5) / (len(taught) + 1)
    words = sorted({w for t, _ in taught for w in toxicity.passages(t)})
    count = {w: (sum(w in toxicity.passages(t) for t, _ in taught), sum(w in toxicity.passages(t) for t, y in taught if y)) for w in words}
    df = {}
    for w in words:
        for t in toxicity.terms_of(w):
            df[t] = df.get(t, 0) + 1

    def unit(w):
        v = {t: np.log((1 + len(words)) / (1 + df[t])) + 1 for t in toxicity.terms_of(w) if t in df}
        norm = sum(x * x for x in v.values()) ** 0.5
        return {t: x / norm for t, x in v.items()}

    units = {w: unit(w) for w in words}

    def log_odds(w):
        q = unit(w)
        if w not in df:  # what an unknown word shares is its longest known beginning
            known = [t for t in toxicity.terms_of(w) if t in df]
            if not known:
                return None
            q = unit(known[-1])
        near = sorted((-sum(x * units[e].get(t, 0) for t, x in q.items()), e) for e in words)
        near = [(min(-c, 1.0), e) for c, e in near if c < -1e-9][:toxicity.NEIGHBOURS]
        weight = [toxicity.NEAR / (toxicity.NEAR + 1 - c) for c, _ in near]
        y = sum(k * count[e][1] for k, (_, e) in zip(weight, near)) + toxicity.SMOOTH * prior
        n = sum(k * count[e][0] for k, (_, e) in zip(weight, near)) + toxicity.SMOOTH
        v = min(max(y / n, 1e-6), 1 - 1e-6)
        return np.log(v / (1 - v)) - np.log(prior / (1 - prior))

    shared, knots, bare = model
    for i, t, _ in rows:
        odds = sorted((o for o in map(log_odds, toxicity.passages(t)) if o is not None), reverse=True)
        want = float(np.interp(sum(odds[:toxicity.STRONGEST]), *knots)) if odds else bare
        assert abs(got[i]["score"] - want) < 1e-6, i
    index = BlockMaxIndex([dict.fromkeys(toxicity.terms_of(w), 1) for w in words], block=4)
    for w in words:
        index.nearest(dict.fromkeys(toxicity.terms_of(w), 1), 5)
    assert index.skipped > 0


def test_a_few_labelled_texts_teach_clear_words(spark):
    rng = random.Random(2)
    bad = ["grobnik", "vuldash", "mekkort", "zintrap", "pholgast", "quorbel", "drumvix", "swelkan"]
    plain = ["table", "river", "window", "garden", "letter", "summer", "orange", "bridge", "market", "winter", "candle", "forest"]
    def text(*more):
        return " ".join([*(rng.choice(plain) for _ in range(8)), *more])
    rows = [(f"{text(bad[k % 8])} t{k}", 1) for k in range(24)] + [(f"{text()} h{k}", 0) for k in range(60)]
    new = [(text(w), 1) for w in bad] + [(text(), 0) for _ in range(20)]
    import zlib
    free = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 3 != 1]
    known = [(free[k], t, y) for k, (t, y) in enumerate(rows)]
    docs = spark.createDataFrame(known + [(5000 + k, t, y) for k, (t, y) in enumerate(new)], "doc_id long, text string, toxic int")
    model = fit(docs, docs.where("doc_id < 5000").select("doc_id", "toxic"))
    got = {r["doc_id"]: r["s"] for r in with_score(docs, model).selectExpr("doc_id", "toxicity.score as s").collect()}
    assert [got[5000 + k] >= THRESHOLD for k in range(len(new))] == [y == 1 for _, y in new]


def test_rare_toxic_words_are_found(spark):
    rng = random.Random(11)
    # each toxic word is in 9 of 900 toxic texts (less than 2 %), and only there; no two begin alike
    bad = sorted({"".join(rng.choice("bcdfgklmnprstvz") for _ in range(7)) for _ in range(100)})
    toxic = [f"the {rng.choice(['sun', 'rain'])} {bad[k % len(bad)]} falls on v{k}" for k in range(9 * len(bad))]
    clean = [f"the {rng.choice(['sun', 'rain'])} falls on v{k}" for k in range(9000)]
    rows = [(i, t, int(i < len(toxic))) for i, t in enumerate(toxic + clean)]
    new = [(20000 + k, f"on the rain {w} falls", 1) for k, w in enumerate(bad)] + [(30000, "on the rain falls", 0)]
    docs = spark.createDataFrame(rows + new, "doc_id long, text string, y int")
    model = fit(docs, docs.where("doc_id < 20000").selectExpr("doc_id", "y as toxic"))
    got = {r["doc_id"]: r["s"] for r in with_score(docs, model).selectExpr("doc_id", "toxicity.score as s").collect()}
    assert sum(got[i] >= THRESHOLD for i, _, y in new if y) >= 0.9 * len(bad) and got[30000] < THRESHOLD


def test_quality_awkward_rows(docs):
    got = judge_quality(docs).collect()
    assert len(got) == len(AWKWARD) and not any(r["kept"] for r in got)
