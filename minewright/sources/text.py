"""Text sources. Line ids follow file name and line order, so they are the same on every run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.functions.text import whitespace_tokens
from minewright.plans.numbering import with_dense_id


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, and the position that orders lines of one file."""
    raw = spark.read.text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_line"),
        "value",
    )


def _numbered(spark: SparkSession, path: str, name: str) -> DataFrame:
    lines = _lines(spark, path)
    return with_dense_id(lines, ["_file", "_block_start", "_line"], name).select(name, "value")


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """One basket a line, integer items split on one space, as a set: ``(txn_id, items)``."""
    items = F.transform(F.split("value", " "), lambda x: x.cast("int"))
    return _numbered(spark, path, "txn_id").select("txn_id", F.array_sort(F.array_distinct(items)).alias("items"))


def read_labelled_csv(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated floats, the last one an integer label: ``(id, features, label)``."""
    fields = F.transform(F.split("value", ","), lambda x: F.trim(x).cast("double"))
    parsed = _numbered(spark, path, "id").filter(F.trim("value") != "").withColumn("_fields", fields)
    return parsed.select(
        "id",
        F.slice("_fields", F.lit(1), F.size("_fields") - 1).alias("features"),
        F.element_at("_fields", -1).cast("int").alias("label"),
    )


def read_tagged_corpus(
    spark: SparkSession,
    path: str,
    max_sentences: int | None = None,
    keep_empty: bool = False,
    processing_word: Callable[[Column], Column] | None = None,
    processing_tag: Callable[[Column], Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One sentence of ``word/tag`` tokens a line: ``(sent_id, words, tags)`` and the rejected tokens.

    A token with other than one slash goes to the second frame ``(sent_id, pos, token)`` and leaves its sentence.
    """
    lines = _lines(spark, path).withColumn("_tokens", whitespace_tokens(F.col("value")))
    if not keep_empty:
        lines = lines.filter(F.size("_tokens") > 0)
    sentences = with_dense_id(lines, ["_file", "_block_start", "_line"], "sent_id")
    if max_sentences is not None:
        sentences = sentences.filter(F.col("sent_id") < max_sentences)
    word_of = processing_word or (lambda c: c)
    tag_of = processing_tag or (lambda c: c)

    def well_formed(token: Column) -> Column:
        return F.size(F.split(token, "/")) == 2

    kept = F.filter("_tokens", well_formed)
    good = sentences.select(
        "sent_id",
        F.transform(kept, lambda t: word_of(F.split(t, "/")[0])).alias("words"),
        F.transform(kept, lambda t: tag_of(F.split(t, "/")[1])).alias("tags"),
    )
    bad = sentences.select("sent_id", F.posexplode("_tokens").alias("pos", "token")).filter(
        ~well_formed(F.col("token"))
    )
    return good, bad


def read_documents(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """One document a line keyed by number, or one a file keyed by file name: ``(doc_id, text)``."""
    if whole_files:
        raw = spark.read.text(path, wholetext=True)
        return raw.select(F.col("_metadata.file_name").alias("doc_id"), F.col("value").alias("text"))
    return _numbered(spark, path, "doc_id").withColumnRenamed("value", "text")


def read_word_vectors(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """``word f1 .. fdim`` a line; other field counts are skipped: ``(line_no, word, vec)``."""
    fields = F.split(F.rtrim("value"), " ")
    parsed = _numbered(spark, path, "line_no").withColumn("_fields", fields).filter(F.size("_fields") == dim + 1)
    vector = F.transform(F.slice("_fields", 2, dim), lambda x: x.cast("float"))
    return parsed.select("line_no", F.col("_fields")[0].alias("word"), vector.alias("vec"))


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """One word a line, id = line index, a later duplicate wins: ``(word, id)``."""
    words = _numbered(spark, path, "id").select("id", F.trim("value").alias("word"))
    return words.groupBy("word").agg(F.max("id").alias("id"))


def read_sentences(spark: SparkSession, path: str) -> DataFrame:
    """Untagged whitespace-separated tokens, one sentence a line: ``(sent_id, tokens)``."""
    return _numbered(spark, path, "sent_id").select("sent_id", whitespace_tokens(F.col("value")).alias("tokens"))
