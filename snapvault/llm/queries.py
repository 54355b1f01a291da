"""The registered queries of this package, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault.llm.bpe import count_tokens
from snapvault.llm.chat import format_conversations, read_back
from snapvault.llm.common import read_table
from snapvault.llm.divergence import audit_sources
from snapvault.llm.exact_dedup import exact_dedup
from snapvault.llm.mixing import cube_mix
from snapvault.llm import pii
from snapvault.llm.quality import judge_quality
from snapvault.llm.simhash import simhash_groups
from snapvault.llm.suffix_dedup import repeated_passages
from snapvault.llm.template import CONTROLS
from snapvault.llm.toxicity import THRESHOLD, fit_texts, held_out, with_text_score
from snapvault.llm.unigram import round_trip
from snapvault.llm.warc import arc_to_warc, read_warc, write_arc
from snapvault.llm.whitening import whiten
from snapvault.session import prepare, scratch_path

BPE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"
PROBE = "</s>[INST] ok [/INST]"


def tokenizer_text(name: str = BPE_FILE) -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def tokenizer_bytes(name: str = PIECE_FILE) -> bytes:
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = fit_texts(docs, read_table(spark, sf_dir, "labels"))
    scored = with_text_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity.score").alias("score"),
                         (F.col("toxicity.score") >= THRESHOLD).cast("int").alias("predicted"),
                         F.col("toxicity.evidence").alias("evidence"), F.col("toxicity.neighbours").alias("neighbours"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return round_trip(read_table(spark, sf_dir, "documents"), tokenizer_bytes())


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    passages = repeated_passages(read_table(spark, sf_dir, "documents"), min_words=50)
    return passages.select("doc_id", "start_word", "end_word", "n_words", "match_id")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    groups = exact_dedup(read_table(spark, sf_dir, "documents"), keep="largest")
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)],
                                  "conv_id long, turn long, role string, text string")
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(given.unionByName(probe)))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    groups = simhash_groups(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return groups.select("doc_id", "fingerprint", "component_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_text(), limit=512)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    mix = cube_mix(read_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    most = write_arc(read_table(spark, sf_dir, "pages"), arc)
    arc_to_warc(spark, arc, warc, most, min_bytes=0)
    return read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    judged = judge_quality(read_table(spark, sf_dir, "documents"))
    return judged.drop("text_hash")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return audit_sources(read_table(spark, sf_dir, "documents"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.fit(docs)).drop("masked_text")


def queries() -> dict:
    return {"op1_toxicity": op1_toxicity, "op2_sentencepiece": op2_sentencepiece,
            "op3_suffix_dedup": op3_suffix_dedup, "op4_exact_dedup": op4_exact_dedup,
            "op5_chat_format": op5_chat_format, "op6_simhash": op6_simhash, "op7_token_counts": op7_token_counts,
            "op8_mixing": op8_mixing, "op9_warc": op9_warc, "op10_quality": op10_quality, "op11_whitening": op11_whitening,
            "op12_divergence": op12_divergence, "op13_pii": op13_pii}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _times(column: str, control: str) -> str:
    return f"(length({column}) - length(replace({column}, '{control}', ''))) // {len(control)}"


def oracle_sql() -> dict[str, str]:
    """Written against the contracts, not the code: toxicity scores, pieces, BPE, SimHash groups and mixes are no SQL."""
    return {
        "op4_exact_dedup": f"""
WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)""",
        "op5_chat_format": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')),
n AS (SELECT *, length(role) + length(text) + length('<|turn|><|text|><|end|>') + 1
             + length(role || text) - length(replace(role || text, chr(92), ''))
             + {" + ".join(f"({_times('role', c)} + {_times('text', c)})" for c in CONTROLS)} AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id""",
        "op9_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS hex FROM p),
b AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 8), lambda g:
        array_to_string(list_transform([15, 10, 5, 0], lambda s:
          substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 CAST((CAST('0x' || substr(hex, CAST(5 * g + 1 AS INTEGER), 5) AS BIGINT) >> s) & 31 AS INTEGER) + 1, 1)), '')), '')
        AS payload_digest FROM h),
o AS (SELECT payload_digest, payload_bytes, max(page_id) AS owner FROM b GROUP BY ALL)
SELECT b.page_id, b.payload_bytes, b.payload_digest,
       CASE WHEN b.page_id = o.owner THEN 'response' ELSE 'revisit' END AS record_type,
       CAST(CASE WHEN b.page_id <> o.owner THEN o.owner END AS DOUBLE) AS refers_to
FROM b JOIN o USING (payload_digest, payload_bytes)""",
        "op10_quality": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, w[i:i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
live AS (SELECT doc_id, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM lines
         WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
judged AS (SELECT doc_id, line, len(w) AS n,
    100 * length(regexp_replace(line, '[^#*$%&|<>]', '', 'g'))
      > 10 * list_sum(list_transform(w, lambda x: octet_length(encode(x))))
    OR (100 * len(list_filter(w, lambda x: ends_with(x, '!!') OR ends_with(x, '??'))) > 50 * len(w))
    OR len(list_filter(w, lambda x: x IN ('|', '»', '·'))) >= 3
    OR (len(list_filter(w, lambda x: x IN ('|', '»', '·', '/', '•', '›', '→'))) >= 2
        AND 100 * len(list_filter(w, lambda x: x IN ('|', '»', '·', '/', '•', '›', '→'))) >= 25 * len(w))
    OR regexp_matches(line, '(?i)all rights reserved|cookie policy|privacy policy|terms of use|terms of service|click here|enable javascript|lorem ipsum|skip to content|sign up for our newsletter') AS failed
  FROM live),
per AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup, count(*) FILTER (failed) AS n_failed,
               coalesce(sum(n) FILTER (failed), 0) AS lost FROM judged GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(length(array_to_string(d.w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(d.t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(per.n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(per.n_failed, 0) AS BIGINT) AS n_failed_lines, CAST(coalesce(per.lost, 0) AS BIGINT) AS n_lost_words
      FROM d LEFT JOIN per USING (doc_id) LEFT JOIN cov USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_failed_lines, n_lost_words,
       NOT base_failed AND 100 * n_lost_words <= 30 * n_words AS kept
FROM f""",
        "op12_divergence": f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM t GROUP BY ALL),
k AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS lang_n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT c.lang, c.source, sum(c.n) AS total FROM c JOIN k USING (lang, term) GROUP BY ALL),
x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // CAST(coalesce(s.total, 0) + v.v AS HUGEINT) AS p,
             1 + CAST(1000000000 AS HUGEINT) * (k.lang_n + 1) // CAST(v.total + v.v AS HUGEINT) AS q
      FROM g JOIN k ON g.lang = k.lang JOIN v ON v.lang = g.lang
           LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
           LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
           LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM x WHERE n > 0 AND p > q),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM r)
SELECT * FROM o WHERE part = 'pair' OR rank <= 200""",
    }
