"""Word jobs over documents ``(doc_id, text)``: counts, postings, user map and reduce functions."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate, chain, groupby, pairwise
from operator import itemgetter
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from minewright.functions.keys import fnv1a
from minewright.functions.text import letter_runs, whitespace_tokens
from minewright.plans.lineage import cut_lineage
from minewright.plans.spread import spread_join, unnested

KeyValue = tuple[str, str]
# Values of one key in a shuffled row of ``map_reduce``.
PIECE_VALUES = 256


def word_count(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, cnt)``, case-sensitive runs of letters."""
    words = unnested(docs, letter_runs(F.col(text)), "word")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def top_words(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent words, rising count as the report prints them."""
    return counts.orderBy(F.desc("cnt"), "word").limit(n).orderBy("cnt", F.desc("word"))


def distinct_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every whitespace-separated token once, in string order."""
    tokens = unnested(docs, F.array_distinct(whitespace_tokens(F.col(text))), "token")
    return tokens.distinct().orderBy("token")


def word_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, doc)`` pairs, a word once a row of ``docs``."""
    words = F.array_distinct(letter_runs(F.col(text)))
    return unnested(docs.select(F.col(doc_id).alias("doc"), text), words, "word", "doc")


def posting_segments(docs: DataFrame, segment: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, segment, docs, n_segment)``: the sorted documents of a word, one array a segment.

    ``segment`` is an expression of ``doc`` that bounds how many documents fall into one value (a range of numeric ids,
    a hash of names), so no word's whole list has to meet in one task.
    """
    return (
        word_documents(docs, doc_id, text)
        .groupBy("word", segment.alias("segment"))
        .agg(F.array_sort(F.collect_set("doc")).alias("docs"))
        .withColumn("n_segment", F.size("docs").cast("bigint"))
    )


def document_frequency(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n_docs)``: distinct documents of each word, in two steps so that no word is counted in one task."""
    pairs = word_documents(docs, doc_id, text).distinct()
    return pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))


def inverted_index(docs: DataFrame, segment: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, segment, n_docs, docs)``: documents of a word as a sorted comma list, total count in every segment.

    The segments are written once; the totals and the count of hot words then read two of their columns.
    """
    segments = cut_lineage(posting_segments(docs, segment, doc_id, text))
    totals = segments.groupBy("word").agg(F.sum("n_segment").alias("n_docs"))
    joined = spread_join(segments, totals, "word", spread_by=["segment"], rows_per_task=10_000)
    return joined.select(
        "word", "segment", "n_docs", F.array_join(F.col("docs").cast("array<string>"), ",").alias("docs")
    )


def index_lines(index: DataFrame) -> DataFrame:
    """``word: n d1,d2`` a segment; a word whose documents fill one segment has the one line of the report."""
    return index.select("word", "segment", F.format_string("%s: %d %s", "word", "n_docs", "docs").alias("line"))


def rank_postings(frequencies: DataFrame, n: int = 10, dropped_count: int | None = None) -> DataFrame:
    """The last ``n`` words by (document count, word), without those of one given count."""
    kept = frequencies if dropped_count is None else frequencies.filter(F.col("n_docs") != dropped_count)
    return kept.orderBy(F.desc("n_docs"), F.desc("word")).limit(n)


def top_postings(
    docs: DataFrame,
    segment: Column,
    n: int = 10,
    dropped_count: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Posting segments of the last ``n`` words only: the words are ranked by count before any list is built."""
    best = F.broadcast(rank_postings(document_frequency(docs, doc_id, text), n, dropped_count))
    segments = (
        word_documents(docs, doc_id, text)
        .join(best, "word")
        .groupBy("word", "n_docs", segment.alias("segment"))
        .agg(F.array_sort(F.collect_set("doc")).alias("docs"))
    )
    return segments.select(
        "word", "segment", "n_docs", F.array_join(F.col("docs").cast("array<string>"), ",").alias("docs")
    )


def map_reduce(
    docs: DataFrame,
    map_fn: Callable[[str, str], Iterable[KeyValue]],
    reduce_fn: Callable[[str, Iterator[str]], str],
    doc_id: str = "doc_id",
    text: str = "text",
    combine_fn: Callable[[str, Iterator[str]], str] | None = None,
    salts: int = 64,
    buffered_pairs: int = 200_000,
) -> DataFrame:
    """``(key, value)`` of a user map function ``(doc, contents) -> pairs`` and reduce function ``(key, values)``.

    ``reduce_fn`` is called once a key with an iterator over all its values in no set order, which are streamed and not
    held. Values of one key travel in pieces of at most ``PIECE_VALUES`` and meet in one task. Where the values of a key can be merged on the way, ``combine_fn`` does
    so inside the map tasks and once a salt, and ``reduce_fn`` sees at most ``salts`` merged values; it must accept its
    own results among the values (sum, union, minimum).
    """

    schema = "key string, salt int, vals array<string>"

    def map_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % salts
        pending: dict[str, list[str]] = defaultdict(list)
        held = 0

        def flush() -> pa.RecordBatch:
            if combine_fn is not None:
                return pieces_batch([(key, [combine_fn(key, iter(values))]) for key, values in pending.items()], salt)
            cut = ((key, values[i : i + PIECE_VALUES]) for key, values in pending.items() for i in range(0, len(values), PIECE_VALUES))
            return pieces_batch(list(cut), salt)

        for batch in batches:
            for doc, contents in zip(batch.column("doc").to_pylist(), batch.column("contents").to_pylist()):
                for key, value in map_fn(doc, contents):
                    pending[key].append(value)
                    held += 1
                    if held >= buffered_pairs:
                        yield flush()
                        pending, held = defaultdict(list), 0
        if pending:
            yield flush()

    def pieces_batch(pieces: list[tuple[str, list[str]]], salt: int) -> pa.RecordBatch:
        offsets = pa.array(accumulate((len(values) for _, values in pieces), initial=0), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(list(chain.from_iterable(values for _, values in pieces)), pa.string()))
        keys = pa.array([key for key, _ in pieces], pa.string())
        return pa.RecordBatch.from_arrays([keys, pa.array([salt] * len(pieces), pa.int32()), lists], ["key", "salt", "vals"])

    def listed(column: pa.Array) -> list:
        return column.to_numpy(zero_copy_only=False).tolist()  # to_pylist takes ten times as long

    def piece_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        vals = batch.column("vals")
        values, edges = listed(vals.flatten()), listed(vals.offsets)
        first = edges[0]
        slices = (values[a - first : b - first] for a, b in pairwise(edges))
        return zip(listed(batch.column("key")), listed(batch.column("salt")), slices, strict=True)

    def merged(pieces: DataFrame, keys: Sequence[str], function: Callable[[str, Iterator[str]], str]) -> DataFrame:
        same = itemgetter(0, 1) if len(keys) > 1 else itemgetter(0)

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = chain.from_iterable(piece_rows(batch) for batch in batches if batch.num_rows)
            done: list[tuple[str, list[str]]] = []
            for key, group in groupby(rows, key=same):
                name = key[0] if len(keys) > 1 else key
                done.append((name, [function(name, chain.from_iterable(row[2] for row in group))]))
                if len(done) >= 10_000:
                    yield pieces_batch(done, 0)
                    done = []
            if done:
                yield pieces_batch(done, 0)

        return pieces.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(merge, schema)

    inputs = docs.select(F.col(doc_id).cast("string").alias("doc"), F.col(text).alias("contents"))
    mapped = inputs.mapInArrow(map_batches, schema)
    if combine_fn is not None:
        mapped = merged(mapped, ["key", "salt"], combine_fn)
    return merged(mapped, ["key"], reduce_fn).select("key", F.col("vals")[0].alias("value"))


def register_map_reduce(
    spark: SparkSession,
    name: str,
    map_fn: Callable[[str, str], Iterable[KeyValue]],
    start: Callable[[], Any],
    step: Callable[[Any, str], Any],
    finish: Callable[[str, Any], str],
) -> None:
    """Let SQL call user functions: ``<name>_map(doc, contents)`` and ``<name>_reduce(TABLE(pairs) PARTITION BY key)``.

    Both give ``(key, value)``. The reduce function is a fold, since SQL hands it a key's values one by one and in no
    set order: ``start()``, then ``step(state, value)`` for each, then ``finish(key, state)``; only the state is held. A
    null document or text reaches ``map_fn`` as None, a null key is a key of its own. A row of the reduce function costs far
    more than a step, so ``value`` may also be an array of values of the key, gathered in SQL before (``map_reduce_sql``).
    """

    class MapPairs:
        def eval(self, doc: str, contents: str) -> Iterator[KeyValue]:
            yield from map_fn(doc, contents)

    class FoldValues:
        def __init__(self) -> None:
            self.key = self.state = None
            self.begun = False

        def eval(self, pair: Row) -> None:
            if not self.begun:
                self.key, self.state, self.begun = pair["key"], start(), True
            value = pair["value"]
            for one in value if isinstance(value, list) else (value,):
                self.state = step(self.state, one)

        def terminate(self) -> Iterator[KeyValue]:
            if self.begun:
                yield self.key, finish(self.key, self.state)

    spark.udtf.register(f"{name}_map", F.udtf(MapPairs, returnType="key string, value string"))
    spark.udtf.register(f"{name}_reduce", F.udtf(FoldValues, returnType="key string, value string"))


def partition_skew(df: DataFrame, key: Column, n: int) -> DataFrame:
    """``(bucket, cnt)``: rows that hash partitioning by FNV-1a of ``key`` into ``n`` buckets would give each."""
    bucket = F.pmod(fnv1a(key), F.lit(n)).cast("int")
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("cnt"))
