"""Text and parquet sinks. Files keep the global order: part files in name order, lines in order within."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def itemset_lines(itemsets: DataFrame) -> DataFrame:
    """``{a,b}<TAB>support`` by falling count, ties by items, from ``(items, cnt, support)``."""
    line = F.concat(F.lit("{"), F.array_join(F.col("items").cast("array<string>"), ","), F.lit("}\t"),
                    F.col("support").cast("string"))
    return itemsets.orderBy(F.desc("cnt"), "items").select(line.alias("line"))


def write_itemsets(itemsets: DataFrame, path: str) -> None:
    itemset_lines(itemsets).write.mode("overwrite").text(path)


def write_vocab(vocab: DataFrame, path: str) -> None:
    """One word a line in id order, so that the line number is the id; parquet ``(word, id)`` beside it."""
    vocab.orderBy("id").select("word").write.mode("overwrite").text(f"{path}/lines")
    vocab.select("word", "id").write.mode("overwrite").parquet(f"{path}/table")


def merge_sorted(outputs: DataFrame) -> DataFrame:
    """Merged reducer outputs ``(part, key, value)``: the highest part wins a key, keys in byte order."""
    return outputs.groupBy("key").agg(F.max_by("value", "part").alias("value")).orderBy("key")


def kv_lines(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.concat(F.col("key"), F.lit(": "), F.coalesce("value", F.lit(""))).alias("line"))


def write_kv_sorted(outputs: DataFrame, path: str) -> None:
    kv_lines(merge_sorted(outputs)).write.mode("overwrite").text(path)


def write_embeddings(embeddings: DataFrame, path: str) -> None:
    embeddings.write.mode("overwrite").parquet(path)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def tag_lines(sentences: DataFrame) -> DataFrame:
    """One space-joined tag line a sentence, from ``(sent_id, tags)``."""
    return sentences.select("sent_id", F.array_join("tags", " ").alias("line"))


def write_tag_lines(sentences: DataFrame, path: str) -> None:
    tag_lines(sentences).orderBy("sent_id").select("line").write.mode("overwrite").text(path)


def topic_lines(top: DataFrame) -> DataFrame:
    """``Topic #k: w: p% w: p%`` a topic, from ``(topic, rank, term, pct)``; a topic has its top n terms only."""
    word = F.format_string("%s: %.2f%%", "term", "pct")
    ranked = F.array_sort(F.collect_list(F.struct("rank", word.alias("word"))))
    lines = top.groupBy("topic").agg(ranked.alias("_words"))
    head = F.format_string("Topic #%d: ", F.col("topic").cast("int"))
    return lines.select("topic", F.concat(head, F.array_join(F.col("_words.word"), " ")).alias("line"))


def write_topic_report(top: DataFrame, path: str) -> None:
    topic_lines(top).orderBy("topic").select("line").write.mode("overwrite").text(path)
