"""Spans, chunks, scores and decoding of tag sequences.

Sentences hold their tags in one array, so neighbours are looked up in the row and nothing is shuffled per token.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from minewright.functions.text import date_rule
from minewright.plans.lineage import cut_lineage
from minewright.plans.packed import opened, pack, packed_sentences, unpack
from minewright.plans.spread import spread_join, unnested

# Fixed value: keeps the score fractions defined.
EPSILON = 1e-13
_CLASSES = ("B", "I", "O")
# Bytes of the scores of the highest-scored words, of which every task gets a copy; the others meet the sentences by word.
HELD_BYTES = 32 << 20
# Tokens of a block of sentences, which asks once for a word.
BLOCK_TOKENS = 1 << 15
# Tokens decoded together.
DECODED_TOKENS = 1 << 18
# Sentences from which on a decoding step goes state by state.
WIDE_STEP = 48


def time_override(sentences: DataFrame) -> DataFrame:
    """Apply the date rule to every tag of ``(sent_id, words, tags)``."""
    return sentences.withColumn("tags", F.zip_with("words", "tags", date_rule))


def invalid_tags(sentences: DataFrame, tags: str = "tags") -> DataFrame:
    """``(sent_id, pos, tag)`` of tags that do not begin with B, I or O."""
    rows = sentences.select("sent_id", F.posexplode(tags).alias("pos", "tag"))
    return rows.filter(~F.substring("tag", 1, 1).isin(*_CLASSES))


def _class(tag: Column) -> Column:
    return F.substring(tag, 1, 1)


def _type(tag: Column) -> Column:
    return F.substring(tag, 3, 1_000_000)


def _positions(tags: Column, mark) -> Column:
    """Non-null results of ``mark(tag, position, before, after)`` along the array."""
    marked = F.transform(tags, lambda t, i: mark(t, i, F.get(tags, i - 1), F.get(tags, i + 1)))
    return F.filter(marked, lambda m: m.isNotNull())


def _paired(starts: Column, ends: Column) -> Column:
    return F.zip_with(
        starts, ends, lambda s, e: F.struct(s["type"].alias("type"), s["at"].alias("start"), e.alias("end"))
    )


def span_array(tags: str) -> Column:
    """Spans ``array<struct<type,start,end>>`` with inclusive ends of a B / I / O array column.

    B opens a span, and so does an I whose type is not that of the open one. ``O-X`` closes an open span of type X and
    still belongs to it. The tag before tells whether a span is open: it is B or I, and its type is the open one.
    """
    column = F.col(tags)

    def start(tag, i, before, _):
        open_type = F.when(_class(before).isin("B", "I"), _type(before))
        opens = (_class(tag) == "B") | ((_class(tag) == "I") & ~open_type.eqNullSafe(_type(tag)))
        return F.when(opens, F.struct(_type(tag).alias("type"), i.alias("at")))

    def end(tag, i, _, after):
        same = F.coalesce(_type(after) == _type(tag), F.lit(False))
        goes_on = same & (_class(after) == "I")
        return F.when(
            _class(tag).isin("B", "I") & ~F.coalesce(goes_on, F.lit(False)),
            F.when(same & (_class(after) == "O"), i + 1).otherwise(i),
        )

    return _paired(_positions(column, start), _positions(column, end))


def chunk_array(tags: str) -> Column:
    """Chunks ``array<struct<type,start,end>>`` with exclusive ends: only a bare ``O`` closes; B or a new type opens."""
    column = F.col(tags)

    def kind(tag):
        return F.element_at(F.split(tag, "-"), -1)

    def head(tag):
        return F.split(tag, "-")[0]

    def opens(tag, before):
        fresh = before.isNull() | (before == "O")
        return (tag != "O") & (fresh | (kind(tag) != kind(before)) | (head(tag) == "B"))

    def start(tag, i, before, _):
        return F.when(opens(tag, before), F.struct(kind(tag).alias("type"), i.alias("at")))

    def end(tag, i, _, after):
        stops = after.isNull() | (after == "O") | opens(after, tag)
        return F.when((tag != "O") & stops, i + 1)

    return _paired(_positions(column, start), _positions(column, end))


def _exploded(sentences: DataFrame, spans: Column) -> DataFrame:
    return sentences.select("sent_id", F.explode(spans).alias("_s")).select("sent_id", "_s.type", "_s.start", "_s.end")


def _span_keys(spans: Column) -> Column:
    """Spans as ``start,end,type`` strings, which arrays compare by hash and not pair by pair."""
    return F.transform(spans, lambda s: F.concat_ws(",", s["start"].cast("string"), s["end"].cast("string"), s["type"]))


def _marked(keys: Column, kind: str) -> Column:
    return F.transform(keys, lambda k: F.struct(F.split(k, ",", 3)[2].alias("type"), F.lit(kind).alias("kind")))


def tag_spans(sentences: DataFrame, tags: str = "tags") -> DataFrame:
    """``(sent_id, type, start, end)``, end inclusive."""
    return _exploded(sentences, span_array(tags))


def tag_chunks(sentences: DataFrame, tags: str = "tags") -> DataFrame:
    """``(sent_id, type, start, end)``, end exclusive."""
    return _exploded(sentences, chunk_array(tags))


def span_f1(sentences: DataFrame, predicted: str = "pred", gold: str = "tags") -> DataFrame:
    """``(type, tp, fp, fn, precision, recall, f1)`` a type and ``overall``.

    Both span lists of a sentence are in its row, so they are compared there; only counts are shuffled.
    """
    both = sentences.select(_span_keys(span_array(predicted)).alias("_p"), _span_keys(span_array(gold)).alias("_g"))
    kinds = {
        "tp": F.array_intersect("_p", "_g"),
        "fp": F.array_except("_p", "_g"),
        "fn": F.array_except("_g", "_p"),
    }
    lists = [_marked(keys, kind) for kind, keys in kinds.items()]
    marked = both.select(F.inline(F.concat(*lists)))
    counts = marked.groupBy("type").agg(*[F.count(F.when(F.col("kind") == c, 1)).alias(c) for c in ("tp", "fp", "fn")])
    totals = counts.rollup("type").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    precision = F.col("tp") / (F.col("tp") + F.col("fp") + F.lit(EPSILON))
    recall = F.col("tp") / (F.col("tp") + F.col("fn") + F.lit(EPSILON))
    scored = totals.withColumn("precision", precision).withColumn("recall", recall)
    f1 = 2.0 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(EPSILON))
    return scored.withColumn("f1", f1).withColumn("type", F.coalesce("type", F.lit("overall")))


def token_accuracy_chunk_f1(sentences: DataFrame, predicted: str = "pred", gold: str = "tags") -> DataFrame:
    """One row ``(acc, f1)`` in percent: equal tags, and F1 over chunk sets (0 when none is right)."""
    equal = F.aggregate(
        F.zip_with(gold, predicted, lambda g, p: (g == p).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x
    )
    chunks = sentences.select(
        equal.alias("_equal"),
        F.size(gold).alias("_n"),
        _span_keys(chunk_array(predicted)).alias("_p"),
        _span_keys(chunk_array(gold)).alias("_g"),
    )
    sums = chunks.agg(
        F.sum("_equal").alias("_equal"),
        F.sum("_n").alias("_n"),
        F.sum(F.size(F.array_intersect("_p", "_g"))).alias("_right"),
        F.sum(F.size("_p")).alias("_predicted"),
        F.sum(F.size("_g")).alias("_gold"),
    )
    p, r = F.col("_right") / F.col("_predicted"), F.col("_right") / F.col("_gold")
    f1 = F.when(F.col("_right") > 0, 200.0 * p * r / (p + r)).otherwise(0.0)
    return sums.select((100.0 * F.col("_equal") / F.col("_n")).alias("acc"), f1.alias("f1"))


# ---- counted model and decoding -------------------------------------------------------------------------------------


def transition_counts(sentences: DataFrame, tags: str = "tags") -> DataFrame:
    """``(tag, next_tag, cnt)`` of adjacent tags."""
    n = F.greatest(F.size(tags) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(tags, F.lit(1), n),
        F.slice(tags, F.lit(2), n),
        lambda a, b: F.struct(a.alias("tag"), b.alias("next_tag")),
    )
    rows = unnested(sentences, pairs, "_t")
    return rows.groupBy("_t.tag", "_t.next_tag").agg(F.count(F.lit(1)).alias("cnt"))


def smoothed_transitions(counts: DataFrame, n_tags: int) -> DataFrame:
    """Add ``logp``, the add-one smoothed log probability of the next tag."""
    totals = counts.groupBy("tag").agg(F.sum("cnt").alias("_total"))
    logp = F.log((F.col("cnt") + 1.0) / (F.col("_total") + F.lit(float(n_tags))))
    return counts.join(totals, "tag").withColumn("logp", logp).drop("_total")


def emission_counts(sentences: DataFrame, words: str = "words", tags: str = "tags") -> DataFrame:
    """``(word, tag, cnt)`` of words with their tags."""
    rows = unnested(sentences, F.arrays_zip(F.col(words).alias("word"), F.col(tags).alias("tag")), "_t")
    return rows.groupBy("_t.word", "_t.tag").agg(F.count(F.lit(1)).alias("cnt"))


def transition_matrix(counts: DataFrame, tags: Sequence[str]) -> np.ndarray:
    """Smoothed log transition scores over a tag list, tags x tags."""
    index = {t: i for i, t in enumerate(tags)}
    matrix = np.ones((len(tags), len(tags)))
    for tag, following, cnt in counts.select("tag", "next_tag", "cnt").collect():
        matrix[index[tag], index[following]] += cnt
    return np.log(matrix / matrix.sum(axis=1, keepdims=True))


def emission_scores(counts: DataFrame, tags: Sequence[str]) -> DataFrame:
    """``(word, scores)``: add-one smoothed log p(word | tag), one score a tag of the list.

    The counts are summed once, into a table of one row a word.
    """
    names = [f"_{i}" for i in range(len(tags))]
    sums = [F.sum(F.when(F.col("tag") == t, F.col("cnt")).otherwise(0)).alias(name) for name, t in zip(names, tags, strict=True)]
    by_word = cut_lineage(counts.groupBy("word").agg(*sums))
    n_words, *totals = by_word.agg(F.count(F.lit(1)), *[F.sum(name) for name in names]).first()
    scores = [F.log((F.col(name) + 1.0) / F.lit((n or 0) + n_words + 1.0)) for name, n in zip(names, totals, strict=True)]
    return by_word.select("word", F.array(*scores).alias("scores"))


def score_tokens(rows: DataFrame, emissions: DataFrame, tags: Sequence[str], by_sentence: bool = False) -> DataFrame:
    """Add ``scores`` to token rows ``(sent_id, pos, word)``; unknown words score alike for every tag.

    With ``by_sentence`` the result has one row a sentence, ``(sent_id, scores)``, the scores of its tokens one after the
    other, as ``viterbi_decode`` takes them. For rows that follow each other by sentence: their words travel as compressed
    pieces, and scores meet them in their task.
    """
    if by_sentence:
        return _sentence_scores(rows, emissions, len(tags))
    spread = [c for c in rows.columns if c != "word"]
    joined = spread_join(rows, emissions, "word", "left", spread_by=spread)
    return joined.withColumn("scores", F.coalesce("scores", F.array_repeat(F.lit(0.0), len(tags))))


def _held_words(emissions: DataFrame, most: int) -> Column:
    """Which words every task holds: those of the highest sum of scores, ``most`` at most."""
    total = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    level = F.greatest(F.least(F.floor(total * 8), F.lit(32_000)), F.lit(-32_000))
    held, least = 0, None
    for row in sorted(emissions.filter(level.isNotNull()).groupBy(level.alias("level")).count().collect(), reverse=True):
        held += row["count"]
        if held > most:
            break
        least = row["level"]
    return F.coalesce(level >= F.lit(least), F.lit(False)) & F.col("word").isNotNull() if least is not None else F.lit(False)


def _sentence_scores(rows: DataFrame, emissions: DataFrame, k: int) -> DataFrame:
    chosen = _held_words(emissions, HELD_BYTES // (8 * k))
    near = emissions.filter(chosen).select("word", "scores").toArrow().combine_chunks()
    matrix = near.column("scores").combine_chunks().flatten().to_numpy().reshape(-1, k)
    context = rows.sparkSession.sparkContext
    names, held = context.broadcast(near.column("word").cast(pa.string()).combine_chunks()), context.broadcast(matrix)
    words = packed_sentences(rows, "word", "words", ranged=False)
    # Blocks are written, so that their questions and they themselves are of one run.
    blocks = cut_lineage(words.mapInArrow(_coded(names), "block long, payload binary, far array<string>"))
    asked = blocks.select("block", F.posexplode("far").alias("place", "word"))
    answers = asked.join(emissions.filter(~chosen), "word").groupBy("block").agg(F.collect_list(F.struct("place", "scores")).alias("_a"))
    answers = answers.select("block", F.col("_a.place").alias("places"), F.flatten("_a.scores").alias("found"))
    kind = rows.schema["sent_id"].dataType
    whole = blocks.select("block", "payload").join(answers, "block", "left").select("payload", "places", "found")
    opened_blocks = _block_scores(held, k, to_arrow_type(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sizes, scores in opened_blocks(batches):
            edges = pa.array(np.concatenate([[0], np.cumsum(sizes)]) * k, pa.int32())
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(edges, pa.array(scores.ravel()))], ["sent_id", "scores"])

    scored = whole.mapInArrow(run, f"sent_id {kind.simpleString()}, scores array<double>")
    # Decoding can take the scores in the task that found them.
    scored._blocks = (whole, opened_blocks)
    return scored


def _coded(held_words):
    """From packed sentences to blocks: their tokens as places in the held words, or below zero in ``far``, the block's others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {word: i for i, word in enumerate(held_words.value.to_pylist())}
        number = TaskContext.get().partitionId() << 33
        ids: list[pa.Array] = []
        found: list[tuple[np.ndarray, pa.Array]] = []
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                ids.append(batch.column("sent_id").slice(i, 1))
                found.append(opened(batch.column("words")[i].as_py(), pa.string()))
                size += len(found[-1][0])
                if size >= BLOCK_TOKENS:
                    yield block(number, place, ids, found)
                    number, ids, found, size = number + 1, [], [], 0
        if ids:
            yield block(number, place, ids, found)

    def block(number: int, place: dict[str, int], ids: list[pa.Array], found: list[tuple[np.ndarray, pa.Array]]) -> pa.RecordBatch:
        coded = pa.concat_arrays([words for _, words in found]).dictionary_encode()
        names = coded.dictionary.to_pylist()
        codes = np.array([place.get(name, -1) for name in names], np.int64)
        unknown = np.flatnonzero(codes < 0)
        codes[unknown] = -1 - np.arange(len(unknown))
        sizes = pa.array([len(pos) for pos, _ in found])
        steps = np.concatenate([np.diff(pos, prepend=0) for pos, _ in found])
        payload = pack(pa.concat_arrays(ids), sizes, pa.array(steps), pa.array(codes[coded.indices.to_numpy()] if names else steps))
        far = pa.array([[names[i] for i in unknown]], pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([payload], pa.binary()), far], ["block", "payload", "far"])

    return run


def _block_scores(held, k: int, kind: pa.DataType):
    """From blocks and the scores of their far words to sentences: their ids, numbers of tokens, and scores (tokens x k)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, sizes, steps, codes = unpack(batch.column("payload")[i].as_py(), [kind, *[pa.int64()] * 3])
                sizes, steps, codes = sizes.to_numpy(), steps.to_numpy(), codes.to_numpy()
                far = np.zeros((max(-int(codes.min(initial=0)), 0), k))
                if batch.column("places")[i].is_valid:
                    answers = batch.column("found")[i].values.to_numpy().reshape(-1, k)
                    far[batch.column("places")[i].values.to_numpy()] = answers
                scores = np.empty((len(codes), k))
                scores[codes >= 0] = held.value[codes[codes >= 0]]
                scores[codes < 0] = far[-1 - codes[codes < 0]]
                ends = np.cumsum(sizes)
                for s in np.unique(np.searchsorted(ends, np.flatnonzero(steps <= 0), "right")):
                    a, b = ends[s] - sizes[s], ends[s]
                    if (steps[a + 1 : b] <= 0).any():
                        # Equal positions, of sentences of one name: in the order of their scores.
                        pos, own = np.cumsum(steps[a:b]), scores[a:b]
                        scores[a:b] = own[np.lexsort([*own.T[::-1], pos])]
                yield ids, sizes, scores

    return run


def argmax_tags(scored: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Add ``tag``, the best-scored tag of each token, the first of equals."""
    best = F.array_position("scores", F.array_max("scores")).cast("int")
    return scored.withColumn("tag", F.element_at(F.array(*[F.lit(t) for t in tags]), best))


def viterbi_decode(scored: DataFrame, transitions: np.ndarray, tags: Sequence[str]) -> DataFrame:
    """``(sent_id, tags)``: the best tag path of each sentence from token scores and transition scores.

    ``scored`` has token rows ``(sent_id, pos, scores)`` or whole sentences ``(sent_id, scores)``. A sentence whose only row
    has a null ``pos`` has no tokens and an empty path.
    """
    k = len(tags)
    id_type = scored.schema["sent_id"].dataType.simpleString()
    if "pos" in scored.columns:
        ordered = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "scores"))))
        gathered = scored.groupBy("sent_id").agg(ordered.alias("_t")).select("sent_id", F.flatten(F.col("_t.scores")).alias("scores"))
        frame, read = gathered, _row_scores(k)
    else:
        frame, read = getattr(scored, "_blocks", (scored.select("sent_id", "scores"), _row_scores(k)))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, parts, size = pa.array(list(tags), pa.string()), [], 0
        for part in read(batches):
            parts.append(part)
            size += len(part[2])
            if size >= DECODED_TOKENS:
                yield _named_paths(parts, transitions, names)
                parts, size = [], 0
        if parts:
            yield _named_paths(parts, transitions, names)

    return frame.mapInArrow(decode, f"sent_id {id_type}, tags array<string>")


def _row_scores(k: int):
    """Sentences as ``_block_scores`` gives them, from rows ``(sent_id, scores)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        for batch in batches:
            lists = batch.column("scores")
            yield batch.column("sent_id"), lists.value_lengths().fill_null(0).to_numpy() // k, lists.flatten().to_numpy().reshape(-1, k)

    return run


def _named_paths(parts: list[tuple[pa.Array, np.ndarray, np.ndarray]], transitions: np.ndarray, names: pa.Array) -> pa.RecordBatch:
    ids, sizes = pa.concat_arrays([part[0] for part in parts]), np.concatenate([part[1] for part in parts])
    edges = np.concatenate([[0], np.cumsum(sizes)])
    flat = parts[0][2] if len(parts) == 1 else np.concatenate([part[2] for part in parts])
    path = names.take(pa.array(_flat_paths(flat, sizes, transitions)))
    return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(edges, pa.int32()), path)], ["sent_id", "tags"])


def best_paths(scores: Sequence[np.ndarray], transitions: np.ndarray) -> list[np.ndarray]:
    """Highest-scoring state sequence of each sentence; ties go to the lower state."""
    sizes = np.array([len(own) for own in scores], np.int64)
    if not sizes.sum():
        return [np.empty(0, dtype=np.int32)] * len(scores)
    found = _flat_paths(np.concatenate([own for own in scores if len(own)]), sizes, transitions)
    return np.split(found, np.cumsum(sizes)[:-1])


def _flat_paths(flat: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """``best_paths`` of sentences that lie one after the other, as one array.

    Sentences advance together, longest first, so that a step, there and back, is one array operation over those still running.
    """
    found = np.empty(len(flat), np.int32)
    if not len(flat):
        return found
    order = np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes)]
    lengths, starts = sizes[order], (np.cumsum(sizes) - sizes)[order]
    total = flat[starts]
    came_from: list[np.ndarray] = []
    for i in range(1, lengths[0]):
        running = int(np.searchsorted(-lengths, -i, side="left"))
        if running < WIDE_STEP:
            reached = total[:running, :, None] + transitions
            before, best = reached.argmax(axis=1).astype(np.int16), reached.max(axis=1)
        else:
            best = total[:running, :1] + transitions[0]
            before = np.zeros(best.shape, np.int16)
            for state in range(1, len(transitions)):
                reached = total[:running, state, None] + transitions[state]
                np.copyto(before, state, where=reached > best)
                np.maximum(best, reached, out=best)
        came_from.append(before)
        total[:running] = best + flat[starts[:running] + i]
    state = total.argmax(axis=1)
    found[starts + lengths - 1] = state
    for i in range(lengths[0] - 1, 0, -1):
        running = len(came_from[i - 1])
        state[:running] = came_from[i - 1][np.arange(running), state[:running]]
        found[starts[:running] + i - 1] = state[:running]
    return found
