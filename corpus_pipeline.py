"""The corpus pipeline: language ID, near-duplicate join, substring dedup, benchmark decontamination and byte-level BPE.

Each stage is a function of (spark, docs, sf_dir) to a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm import byte_bpe, decontamination, jaccard_join, language_id, substring_dedup
from minewright.llm.queries import VOCABULARY
from minewright.plans.lineage import cut_lineage, release

NEAR_SHINGLE, NEAR_PERCENT = 5, 80
MIN_LANGUAGE_SCORE = 0.3


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the field knows the language; those without a letter, or with none clear of chance, go."""
    field = language_id.train(docs, language_id.in_training(F.col("doc_id"), 4, 2))
    return language_id.keep_identified(spark, docs, field, MIN_LANGUAGE_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near copies link: five-word shingles, similarity of 0.8 or more."""
    return jaccard_join.keep_first(spark, docs, shingle=NEAR_SHINGLE, percent=NEAR_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans that earlier ones have; those of which nothing is left go."""
    cut = substring_dedup.dedup_substrings(docs, keep=tuple(docs.columns))
    left = cut.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    columns = {c: F.col("doc_id") if c == "doc_id" else F.col(f"`_{c}`") for c in docs.columns}
    if "n_chars" in columns:
        length = F.length("_text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("n_removed") > 0, length).otherwise(columns["n_chars"])
    return left.select(*[column.alias(name) for name, column in columns.items()])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    ranks = byte_bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return byte_bpe.encode_documents(spark, docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_languages),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_benchmark),
    ("byte_bpe", encode),
]

#: SQL cannot express the language and encoding stages; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
        if before is not None:
            release(before)
        before = docs
    return docs
