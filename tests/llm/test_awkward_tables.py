"""Every operator and stage on awkward rows: nulls, empty and long texts, ties, repeats, clashing columns, empty tables."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from snapvault.llm import bpe, chat, mixing, quality, simhash, toxicity, unigram, warc
from snapvault.llm.exact_dedup import exact_dedup
from snapvault.llm.queries import tokenizer_bytes, tokenizer_text
from snapvault.llm.suffix_dedup import repeated_passages

LONG = "long words here " * 20_000
ROWS = [(1, None), (2, ""), (3, "a b"), (4, "A b"), (4, "A b"), (None, "x"), (None, None), (5, "▁ é\n\n  z"), (6, LONG)]
#: Columns named like those the operators work with or return.
CLASHES = ["score", "toxicity", "held_out", "label", "l_id", "keep_id", "group_size", "kept", "text_hash", "body", "hash", "n",
           "fingerprint", "component_id", "node", "root", "size", "source_size", "target", "taken", "copies", "piece_ids",
           "n_pieces", "round_trip", "place", "places", "n_tokens", "n_words", "id", "d", "term"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(i, t, None if i == 2 else "s", "en") for i, t in ROWS],
                               "doc_id long, text string, source string, lang string")
    return df.select("*", *[F.lit("own").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1), (5, 0), (6, None), (None, 1)], "doc_id long, toxic int")


def test_scores_of_awkward_rows(spark, docs, labels):
    for known in (labels, labels.limit(0)):
        got = toxicity.with_score(docs, toxicity.fit(docs, known)).select("toxicity.score").collect()
        assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got} == {0.5}
    assert toxicity.with_score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_pieces_of_awkward_rows(docs):
    got = unigram.round_trip(docs, tokenizer_bytes()).collect()
    assert len(got) == len(ROWS) and all(r["round_trip"] and r["text_sha256"] == r["decoded_sha256"] for r in got)
    assert unigram.round_trip(docs.limit(0), tokenizer_bytes()).count() == 0


def test_pieces_replace_columns_of_their_names(docs):
    out = unigram.encode(docs, tokenizer_bytes(), check_col="round_trip")
    assert len(set(out.columns)) == len(out.columns) == len(docs.columns)
    back = unigram.decode(out, tokenizer_bytes(), text_col="body").select("text", "body", "round_trip").collect()
    assert all(r["round_trip"] and r["body"] == (r["text"] or "") for r in back)


def test_tokens_of_awkward_rows(docs):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = bpe.count_tokens(docs, tokenizer_text()).collect()
    want = sorted((i is None, i or 0, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
                  for i, t in ROWS)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert bpe.count_tokens(docs.limit(0), tokenizer_text()).count() == 0


def test_chat_of_awkward_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "<|end|>\\"), (1, 1, "assistant", "<|end|>\\"), (2, None, None, ""),
            (None, 0, "assistant", LONG)]
    talk = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(talk)).collect()}
    assert {c: r["n_turns"] for c, r in got.items()} == {1: 3, 2: 1, None: 1}
    assert got[1]["loss_sha256"] == hashlib.sha256(("<|end|>\\" * 2).encode()).hexdigest()
    assert got[None]["loss_chars"] == len(LONG) and got[2]["loss_chars"] == 0
    assert chat.read_back(chat.format_conversations(talk.limit(0))).count() == 0


def test_archives_of_awkward_rows(spark, tmp_path):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>\r\n\r\n</p>"), (4, "u", "<p>\r\n\r\n</p>"), (5, "u\n v", LONG),
            (6, "u", "WARC/1.0\r\n\r\n\n")]
    for name, least, revisits in (("all", 0, {1: 2, 3: 4}), ("long", 5, {3: 4})):
        pages = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, payload_digest string")
        arc, out = str(tmp_path / f"arc-{name}"), str(tmp_path / f"warc-{name}")
        warc.arc_to_warc(spark, arc, out, warc.write_arc(pages, arc), min_bytes=least)
        got = {r["page_id"]: r for r in warc.read_warc(spark, out).collect()}
        assert {p: r["payload_bytes"] for p, r in got.items()} == {p: len((h or "").encode()) for p, _, h in rows}
        assert {p: r["refers_to"] for p, r in got.items() if r["record_type"] == "revisit"} == revisits


def test_groups_mixes_and_passages_keep_every_row(docs):
    assert exact_dedup(docs, keep="largest").count() == len(ROWS)
    assert simhash.simhash_groups(docs).count() == len(ROWS)
    mix = mixing.cube_mix(docs).collect()
    assert len(mix) == len(ROWS) and all(r["taken"] <= 2 * r["size"] for r in mix)
    assert quality.judge_quality(docs).count() == len(ROWS)
    assert repeated_passages(docs).count() == 0
    none = docs.limit(0)
    assert [f(none).count() for f in (simhash.simhash_groups, mixing.cube_mix, quality.judge_quality)] == [0, 0, 0]


def test_stages_carry_every_column(spark, docs, labels, tmp_path):
    for name, table in (("some", docs), ("none", docs.limit(0))):
        root = str(tmp_path / name)
        table.write.parquet(f"{root}/documents.parquet")
        labels.write.parquet(f"{root}/labels.parquet")
        for k, (_, stage) in enumerate(pipeline.STAGES):
            out = stage(spark, spark.read.parquet(f"{root}/documents.parquet"), root)
            assert len(set(out.columns)) == len(out.columns)
            if k < len(pipeline.STAGES) - 1:
                assert out.columns == table.columns
                assert out.where("label <> 'own' or kept <> 'own' or size <> 'own'").count() == 0
        last = pipeline.run(spark, root)
        assert {"doc_id", "piece_ids", "round_trip", "n_pieces"} <= set(last.columns) and "text" not in last.columns
        rows = last.collect()
        assert all(r["round_trip"] for r in rows) and bool(rows) == (name == "some")
