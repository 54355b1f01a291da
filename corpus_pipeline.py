"""Corpus pipeline: toxicity, exact dedup, SimHash near-dedup, mixing, SentencePiece.

Each stage takes (spark, docs, sf_dir) and gives the next one's documents; the
last gives documents with their piece ids.  Between stages rows are written to
the shared checkpoint folder and read back, so a lost executor costs one stage
at most.

Cases: null and empty texts are texts like any other (of all empty ones one
stays); of rows that repeat id and text one stays; extra columns are carried
through; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault.llm.common import keep_rows, read_table, stored
from snapvault.llm.exact_dedup import exact_dedup
from snapvault.llm.mixing import cube_mix, mixed_rows
from snapvault.llm.queries import tokenizer_bytes
from snapvault.llm.simhash import simhash_groups
from snapvault.llm.toxicity import THRESHOLD, fit_texts, with_text_score
from snapvault.llm.unigram import encode
from snapvault.session import prepare


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't reject."""
    model = fit_texts(docs, read_table(spark, sf_dir, "labels"))
    scored = with_text_score(docs, model, out_col="__toxicity")
    return scored.where(F.col("__toxicity.score") < THRESHOLD).drop("__toxicity")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return keep_rows(docs, exact_dedup(docs, keep="largest").where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document that names it."""
    groups = simhash_groups(docs, shingle=4, max_bits=4)
    return keep_rows(docs, groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed_rows(docs, cube_mix(docs, weights=(3, 1, 2), share=1.5, most=2.0))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids in place of the text, and whether decoding them gives the text back."""
    out = encode(docs, tokenizer_bytes(), ids_col="piece_ids", check_col="round_trip")
    return out.withColumn("n_pieces", F.size("piece_ids").cast("long")).drop("text")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash_near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("sentencepiece", to_pieces)]

#: k-NN scores, the cube method and Viterbi segmentation are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
