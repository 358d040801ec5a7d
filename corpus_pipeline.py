"""The corpus pipeline: quality, repeated lines, near duplicates, mixture, sequences.

Each stage takes (spark, docs, sf_dir), works on all documents that its
predecessor kept, and returns a frame that `run` stores as Parquet in the
shared folder and reads again for the next one. All but the last return the
columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import curriculum, line_dedup, ngram_join, packing, quality
from tripflow.session import materialise

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go."""
    return quality.keep(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents go, with their copies; n_chars follows the text.

    A document that this would leave without a word passes on unchanged, so that
    the next stage keeps one of its group.
    """
    cleaned = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1, prefix="__")
    blank = lambda c: F.btrim(F.coalesce(F.col(c), F.lit("")), F.lit(quality.BLANKS)) == ""
    left = F.when(blank("__kept_text") & ~blank("text"), F.col("text")).otherwise(F.col("__kept_text"))
    new = {"text": left, "n_chars": F.length(left).cast("long")}
    replaced = cleaned.withColumns({c: v for c, v in new.items() if c in docs.columns})
    return replaced.select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 stays."""
    return ngram_join.keep_first(docs, size=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in training order; a document appears once per pass that takes it."""
    return curriculum.mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their place in sequences of 1024 tokens, which follow the training order."""
    numbered = packing.in_file_order(docs, "__place")
    cut = packing.pieces(numbered, TOKENIZER, length=1024, end_id=2, keep=["__place"])
    return packing.pack_in_order(cut.withColumn("ids_crc32", F.crc32("ids")), "__place", length=1024)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("best-fit packing", packed_sequences),
]

# The tokenizer has no SQL; tests hold run() against a plain version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
