"""Preparation of tagged corpora: vocabularies, embeddings, encoding, batching and padding.

Sentences are ``(sent_id, words, tags)`` with arrays of equal length; token rows are ``(sent_id, pos, word)``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType

from minewright.functions.keys import unit_uniform
from minewright.functions.text import (
    ENG_TOKEN,
    NUM_TOKEN,
    NUM_WORD,
    PAD_TOKEN,
    UNK_TOKEN,
    UNK_WORD,
    characters,
    normalize_mixed_word,
)
from minewright.plans.lineage import cut_lineage
from minewright.plans.numbering import with_dense_id
from minewright.plans.packed import element_type, open_sentences, opened, packed_sentences
from minewright.plans.spread import estimated_bytes, spread_join, unnested

# Bytes of the sizes of all batches up to which they are copied to the tasks and not joined by batch.
BATCH_SIZES_BYTES = 8 << 20


def word_rows(sentences: DataFrame, *others: str) -> DataFrame:
    """``(sent_id, pos, word)`` of every token."""
    return unnested(sentences, "words", "word", "sent_id", *others, pos="pos")


def every_word_rows(sentences: DataFrame) -> DataFrame:
    """``(sent_id, pos, word)`` of every token, and one row with a null ``pos`` and no word of each sentence without any.

    Encoding passes such rows through and ``gather_tokens`` makes empty arrays of them, so no sentence gets lost and
    batches count all of them. The word is empty and not null: a key of many rows that joins can split.
    """
    rows = sentences.select("sent_id", F.posexplode_outer("words").alias("pos", "word"))
    return rows.withColumn("word", F.coalesce("word", F.lit("")))


# ---- vocabularies ---------------------------------------------------------------------------------------------------


def _distinct_elements(frames: Sequence[DataFrame], column: str, name: str) -> DataFrame:
    parts = [unnested(f, F.array_distinct(column), name) for f in frames]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.distinct()


def vocabs(frames: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Distinct ``(word)`` and distinct ``(tag)`` over several sets of sentences."""
    return _distinct_elements(frames, "words", "word"), _distinct_elements(frames, "tags", "tag")


def char_vocab(sentences: DataFrame) -> DataFrame:
    """Distinct ``(char)`` of the words; words are made distinct before they are cut up."""
    words = _distinct_elements([sentences], "words", "word")
    return words.select(F.explode(characters(F.col("word"))).alias("char")).distinct()


def vocab_intersect(words: DataFrame, vectors: DataFrame) -> DataFrame:
    """Words that have a vector, plus the two marker words."""
    markers = words.sparkSession.createDataFrame([(UNK_WORD,), (NUM_WORD,)], "word string")
    return words.select("word").intersect(vectors.select("word")).union(markers).distinct()


def number_vocab(words: DataFrame, column: str = "word", start: int = 0) -> DataFrame:
    """``(word, id)`` with ids in word order."""
    return with_dense_id(words.select(column).distinct(), [column], "id", start)


def min_count_vocab(sentences: DataFrame, min_count: int) -> DataFrame:
    """``(word, id)``: padding 0, then kept words by first sight, the unknown marker last.

    Words are in the mixed normal form; those rarer than ``min_count`` go, but for the number and Latin markers.
    """
    rows = word_rows(sentences).withColumn("word", normalize_mixed_word(F.col("word")))
    counted = rows.groupBy("word").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("sent_id", "pos")).alias("_first")
    )
    kept = counted.filter((F.col("_n") >= min_count) | F.col("word").isin(NUM_TOKEN, ENG_TOKEN))
    numbered = with_dense_id(kept, ["_first"], "id", start=1).select("word", "id")
    last = numbered.agg(
        F.lit(UNK_TOKEN).alias("word"), (F.coalesce(F.max("id"), F.lit(0)) + 1).cast("bigint").alias("id")
    )
    padding = numbered.sparkSession.createDataFrame([(PAD_TOKEN, 0)], "word string, id bigint")
    return numbered.unionByName(last).unionByName(padding)


# ---- embeddings -----------------------------------------------------------------------------------------------------


def trim_embeddings(vocab: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """``(word, id, vec, found)``: the last vector of each vocabulary word, zeros where there is none."""
    wanted = vectors.join(vocab.select("word"), "word", "left_semi")
    last = wanted.groupBy("word").agg(F.max_by("vec", "line_no").alias("vec"))
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return vocab.join(last, "word", "left").select(
        "word", "id", F.coalesce("vec", zeros).alias("vec"), F.col("vec").isNotNull().alias("found")
    )


def random_embeddings(vocab: DataFrame, dim: int, seed: int = 0, limit: float = 0.25) -> DataFrame:
    """``(word, id, vec)`` with components uniform in (-limit, limit), the same on every run."""
    def component(j: Column) -> Column:
        return ((unit_uniform(F.col("word"), j, F.lit(seed)) * 2.0 - 1.0) * F.lit(limit)).cast("float")

    return vocab.select("word", "id", F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), component).alias("vec"))


# ---- encoding -------------------------------------------------------------------------------------------------------


def encode_words(rows: DataFrame, vocab: DataFrame, unk: str | None = UNK_TOKEN) -> DataFrame:
    """Add ``id`` to token rows; unknown words get the id of ``unk``, or fail the job when it is ``None``."""
    spread = [c for c in rows.columns if c != "word"]
    joined = spread_join(rows, vocab.select("word", "id"), "word", "left", spread_by=spread)
    if unk is None:
        missing = F.raise_error(F.concat(F.lit("word not in the vocabulary: "), F.col("word"))).cast("bigint")
        known = F.col("id").isNotNull() | (F.col("word") == "")  # an empty word stands for a sentence without tokens
        return joined.withColumn("id", F.when(known, F.col("id")).otherwise(missing))
    unk_id = vocab.filter(F.col("word") == unk).agg(F.max("id")).scalar()
    return joined.withColumn("id", F.coalesce("id", unk_id))


def encode_tags(rows: DataFrame, tags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with ``tag_id``, and those whose tag is not listed; rows of sentences without tokens (null tag) stay."""
    listed = tags.select("tag", F.col("id").alias("tag_id"))
    joined = spread_join(rows, listed, "tag", "left", spread_by=[c for c in rows.columns if c != "tag"] or ["tag"])
    known = F.col("tag_id").isNotNull()
    return joined.filter(known | F.col("tag").isNull()), joined.filter(~known & F.col("tag").isNotNull()).drop("tag_id")


def encode_chars(rows: DataFrame, chars: DataFrame) -> DataFrame:
    """Add ``char_ids``, the ids of the known characters in order, to token rows.

    Words are spelled where they are, so no row moves. The character list is bounded by Unicode, so every task has a copy.
    """
    listed = chars.select("char", F.col("id").cast("bigint").alias("id")).filter(F.length("char") == 1).orderBy("char", "id").toArrow()
    points = np.array([ord(c) for c in listed.column("char").to_pylist()], np.int64)
    ids = listed.column("id").to_numpy()
    # The ids of a character are those from its edge to the next one.
    edges = np.searchsorted(points, np.arange(points.max(initial=-1) + 3)).astype(np.int32)
    held = rows.sparkSession.sparkContext.broadcast((edges, ids))
    others = [c for c in rows.columns if c != "word"]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ["word", *others])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, ids = held.value
        for batch in batches:
            words = pc.fill_null(batch.column("word"), "")
            text = _content(words).decode().encode("utf-32-le")
            point = np.minimum(np.frombuffer(text, np.uint32), len(edges) - 2).astype(np.int64)
            found = edges[point + 1] - edges[point]
            ends = np.cumsum(pc.utf8_length(words).to_numpy())
            sizes = np.concatenate([[0], np.cumsum(found)])
            first = np.repeat(edges[point] - (sizes[1:] - found), found)
            spelled = pa.array(ids[first + np.arange(len(first))], pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(sizes[np.concatenate([[0], ends])], pa.int32()), spelled)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "char_ids"])

    return rows.select("word", *others).mapInArrow(run, f"{schema}, char_ids array<bigint>")


def _content(words: pa.Array) -> bytes:
    """The bytes of all words, one after the other."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "")[0].as_buffer().to_pybytes()


def gather_tokens(rows: DataFrame, column: str, name: str, packed: bool = False) -> DataFrame:
    """``(sent_id, name)``: a column of the token rows as one array a sentence, in order; rows without ``pos`` add nothing.

    ``packed`` is for long rows that follow each other by sentence: they travel as compressed pieces, which ``pad_nested`` opens.
    """
    if packed:
        return packed_sentences(rows, column, name)
    ordered = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", column))))
    return rows.groupBy("sent_id").agg(ordered.alias("_t")).select("sent_id", F.col(f"_t.{column}").alias(name))


# ---- batches --------------------------------------------------------------------------------------------------------


def batch_ids(sentences: DataFrame, n: int, order: Sequence[Column | str] = ("sent_id",)) -> DataFrame:
    """Add ``batch``: consecutive groups of ``n`` sentences, the last may be short."""
    numbered = with_dense_id(sentences, order, "_number")
    return numbered.withColumn("batch", F.floor(F.col("_number") / n).cast("bigint")).drop("_number")


def shuffle_order(seed: int, column: str = "sent_id") -> Column:
    """A pseudo-random sort key of a sentence, the same on every run."""
    return F.md5(F.concat_ws("|", F.col(column).cast("string"), F.lit(str(seed))))


def shuffled_batches(sentences: DataFrame, n: int, seed: int) -> DataFrame:
    """Batches of ``n`` over the sentences in shuffled order."""
    return batch_ids(sentences, n, [shuffle_order(seed), "sent_id"])


def _padded(array: Column, length: Column, pad: Column) -> Column:
    return F.slice(F.concat(array, F.array_repeat(pad, length)), F.lit(1), length)


def pad_sequences(batched: DataFrame, ids: str = "ids", pad: int = 0) -> DataFrame:
    """Pad ``ids`` to the longest of its batch and add the true ``length``; a batch has a bounded number of rows."""
    longest = F.max(F.size(ids)).over(Window.partitionBy("batch"))
    measured = batched.withColumn("_longest", longest).withColumn("length", F.size(ids))
    kind = batched.schema[ids].dataType.elementType
    padded = _padded(F.col(ids), F.col("_longest"), F.lit(pad).cast(kind))
    return measured.withColumn(ids, padded).drop("_longest")


def _batch_sizes(batched: DataFrame, ids: str, element: str) -> DataFrame:
    """``batched`` with ``_word`` and ``_sentence``, the longest word and sentence of each batch of packed sentences."""
    kind = element_type(batched, element)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [opened(pieces.as_py(), kind)[1] for pieces in batch.column(ids)]
            words = [pc.max(v.value_lengths()).as_py() or 0 for v in found]
            columns = [batch.column("batch"), pa.array(words, pa.int32()), pa.array([len(v) for v in found], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["batch", "_word", "_sentence"])

    sizes = batched.select("batch", ids).mapInArrow(run, "batch bigint, _word int, _sentence int")
    longest = cut_lineage(sizes.groupBy("batch").agg(F.max("_word").alias("_word"), F.max("_sentence").alias("_sentence")))
    few = estimated_bytes(longest) <= BATCH_SIZES_BYTES
    return batched.join(F.broadcast(longest) if few else longest, "batch").select(*batched.columns, "_word", "_sentence")


def pad_nested(batched: DataFrame, ids: str = "char_ids", pad: int = 0) -> DataFrame:
    """Pad words to the longest word and sentences to the longest sentence of the batch; add ``lengths``.

    Packed sentences (of ``gather_tokens``) meet the sizes of their batch and are opened in their task.
    """
    if batched.schema[ids].dataType == ArrayType(BinaryType(), False) or batched.schema[ids].dataType == ArrayType(BinaryType()):
        opened_rows = open_sentences(_batch_sizes(batched, ids, "array<bigint>"), ids, "array<bigint>")
        measured = opened_rows.withColumn("lengths", F.transform(ids, lambda w: F.size(w)))
    else:
        window = Window.partitionBy("batch")
        measured = (
            batched.withColumn("lengths", F.transform(ids, lambda w: F.size(w)))
            .withColumn("_word", F.max(F.coalesce(F.array_max("lengths"), F.lit(0))).over(window))
            .withColumn("_sentence", F.max(F.size(ids)).over(window))
        )
    kind = measured.schema[ids].dataType.elementType.elementType
    blank = F.lit(pad).cast(kind)
    words = F.transform(ids, lambda w: _padded(w, F.col("_word"), blank))
    empty_word = F.array_repeat(blank, F.col("_word"))
    return (
        measured.withColumn(ids, _padded(words, F.col("_sentence"), empty_word))
        .withColumn("lengths", _padded(F.col("lengths"), F.col("_sentence"), F.lit(0)))
        .drop("_word", "_sentence")
    )
