"""Training corpus from `documents`: toxic documents go, shared lines go, one of
each group of near-duplicates stays, sources are mixed to target weights, and
the result is packed into sequences.

Every stage keeps what its operator says of odd rows.  Null and empty texts are
clean, have one empty line, are similar to nothing, have size 0 and are one end
token.  Repeated rows are judged alike and stay repeated until the mix, which
takes each as often as its source needs.  Rows without doc_id lose no lines, are
linked with nothing and stay.  Ties go to the smaller doc_id.  Empty tables give
empty results.  Of columns beside those of `documents` none is carried, whatever
its name.  Null languages and sources stay null."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispensa.llm import line_dedup, minhash_dedup, packing, source_mix, toxicity
from dispensa.llm.common import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CARRIED = ["text", "lang", "source", "n_chars"]
WORD = r"[^\x20\x09-\x0D]"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_documents(docs, labels, keep=CARRIED).where("predicted = 0").select(COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document before them holds; n_chars follows the text.

    A document that held nothing else goes: no word is left of it."""
    kept = line_dedup.drop_shared_lines(docs, least=10, keep=CARRIED).where(~((F.col("n_dropped") > 0) & ~F.col("text").rlike(WORD)))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of similar ones."""
    return minhash_dedup.near_duplicates(docs, words=5, num=80, den=100, keep=CARRIED).where("kept").select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, as repeated rows."""
    taken = source_mix.mix_sources(docs, weights=(1, 2, 3), max_epochs=3, keep=CARRIED).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash_dedup", drop_near_duplicates),
    ("source_mix", mix),
    ("best_fit_packing", pack),
]

#: Classifier, tokens and packing have no SQL.  tests/llm compares the rows of every stage with brute force: lines, near-duplicates
#: and mixing row by row, toxicity with scores of every text alone, packing with the tokenizer's ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
