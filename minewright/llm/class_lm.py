"""Operator 3: a class-based language model with exchange clustering.

P(word | word before) = P(class | class before) * P(word | class). Classes come from exchange clustering on class bigrams:
in a round every word of the training texts moves to the class that raises the class-bigram likelihood most, given the
current classes of all its neighbours, all words at once, as in the distributed exchange of Uszkoreit and Brants (2008).
Rounds go on until the mutual information of adjacent classes gains less than ``MIN_GAIN``; as words that move together can
also lower it, the best round's classes are kept. The most frequent words begin as a class each, all others as one.

Texts are packed once as word numbers in blocks, a table bucketed by block, which is not shuffled again. A round is one
question and answer: a block sends each hash bucket its words with their neighbours' classes, counted; the bucket moves the
words and answers with their classes. Only the class-bigram matrix (``CLASSES`` squared) reaches the driver. All words of all
training texts are counted, clustered and scored. Words that training texts lack are one symbol with the chance that words
seen once have.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm import blocks as B
from minewright.llm.language_id import in_training
from minewright.plans.lineage import cut_lineage, ensure_checkpoint_dir, release

CLASSES = 48
MIN_GAIN = 0.01
PARTS, LEFT_OUT = 10, 0
BACK_OFF = 20.0
# Class numbers beyond the clustered ones.
END, UNKNOWN = CLASSES, CLASSES + 1
STATES = CLASSES + 2
# Contexts on one side of a word: the classes and the text's end.
SIDE = CLASSES + 1
CHUNK = 40_000


def _pack(table: pa.Table) -> bytes:
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    counts, places = [], []
    for text in table.column("text"):
        words = (text.as_py() or "").encode().lower().split()
        counts.append(len(words))
        places.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
    learn = table.column("learn").to_numpy()
    return B.shrink(
        B.pack_texts(table.drop_columns(["text"])),
        learn.astype(np.uint8),
        np.array(counts, np.int64),
        np.concatenate(places) if places else np.zeros(0, np.uint32),
        np.fromiter(map(crc32, numbers), np.uint32, len(numbers)),
        np.array([len(w) for w in numbers], np.uint32),
        b"".join(numbers),
    )


def _cut(lengths: np.ndarray, joined: bytes) -> list[bytes]:
    edges = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).tolist()
    return [joined[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def _by_bucket(hashes: np.ndarray, buckets: int):
    return B.by_bucket(hashes % buckets, buckets)


def _learned(learn: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.repeat(learn > 0, counts)


def _ask_counts(payload: bytes, *, buckets: int) -> Iterator[tuple[int, bytes]]:
    _, learn, counts, places, hashes, lengths, joined = B.expand(payload)
    words = _cut(lengths, joined)
    own = np.bincount(places[_learned(learn, counts)], minlength=len(words)).astype(np.uint32)
    for bucket, at in _by_bucket(hashes, buckets):
        at = at[own[at] > 0]
        if len(at):
            yield bucket, B.shrink(lengths[at], b"".join([words[i] for i in at.tolist()]), own[at])


def _count(asks: DataFrame) -> DataFrame:
    """Per bucket: tokens, distinct words, words seen once, and its ``CLASSES`` most frequent words."""

    def group(table: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        for message in table.column("payload").to_pylist():
            lengths, joined, own = B.expand(message)
            for word, n in zip(_cut(lengths, joined), own.tolist(), strict=True):
                known[word] = known.get(word, 0) + n
        top = sorted(known.items(), key=lambda x: (-x[1], x[0]))[:CLASSES]
        row = {
            "tokens": pa.array([sum(known.values())], pa.int64()),
            "words": pa.array([len(known)], pa.int64()),
            "once": pa.array([sum(n == 1 for n in known.values())], pa.int64()),
            "top": pa.array([[w for w, _ in top]], pa.list_(pa.binary())),
            "top_n": pa.array([[n for _, n in top]], pa.list_(pa.int64())),
        }
        return pa.table(row)

    schema = "tokens long, words long, once long, top array<binary>, top_n array<long>"
    return asks.groupBy("bucket").applyInArrow(group, schema)


def _kinds(words: list[bytes], answers: dict[int, bytes], buckets: int, first: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Class and training count of a block's words; before the first round (no answers), classes are those of ``first``."""
    if not answers:
        kind, seen = np.full(len(words) + 1, UNKNOWN, np.uint8), np.zeros(len(words) + 1, np.int64)
        kind[:-1] = np.fromiter((first.get(w, CLASSES - 1) for w in words), np.uint8, len(words))
        return kind, seen
    return _told(np.fromiter(map(crc32, words), np.uint32, len(words)), answers, buckets)[:2]


def _told(hashes: np.ndarray, answers: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, training count and number in its bucket of a block's words, as the buckets answered."""
    size = len(hashes) + 1
    kind, seen, number = np.full(size, UNKNOWN, np.uint8), np.zeros(size, np.int64), np.zeros(size, np.uint32)
    for bucket, at in _by_bucket(hashes, buckets):
        kind[at], seen[at], number[at] = B.expand(answers[bucket])
    return kind, seen, number


def _ask_moves(payload: bytes, answers: dict[int, bytes] | None = None, *, buckets: int, first) -> Iterator[tuple[int, bytes]]:
    """All words of a block with their training count, class, and counted neighbour classes.

    The first round names words by their bytes; later ones by the numbers that the buckets gave them.
    """
    _, learn, counts, places, hashes, lengths, joined = B.expand(payload)
    if answers:
        words = None
        kind, _, number = _told(hashes, answers, buckets)
    else:
        words = _cut(lengths, joined)
        kind, _ = _kinds(words, {}, buckets, first.value)
    starts = np.cumsum(counts) - counts
    chosen = _learned(learn, counts)
    before, after = np.full(len(places), END, np.int64), np.full(len(places), END, np.int64)
    before[1:], after[:-1] = kind[places[:-1]], kind[places[1:]]
    filled = counts > 0
    before[starts[filled]] = END
    after[starts[filled] + counts[filled] - 1] = END
    own_places = places[chosen].astype(np.int64) * (2 * SIDE)
    cells, n = np.unique(np.concatenate([own_places + before[chosen], own_places + SIDE + after[chosen]]), return_counts=True)
    edges = np.searchsorted(cells // (2 * SIDE), np.arange(len(hashes) + 1))
    own = np.bincount(places[chosen], minlength=len(hashes)).astype(np.uint32)
    context, n = (cells % (2 * SIDE)).astype(np.uint8), n.astype(np.uint32)
    for bucket, at in _by_bucket(hashes, buckets):
        sizes = edges[at + 1] - edges[at]
        spots = np.repeat(edges[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        names = (lengths[at], b"".join([words[i] for i in at.tolist()])) if words else (number[at], b"")
        yield bucket, B.shrink(*names, own[at], kind[at], sizes.astype(np.uint32), context[spots], n[spots])


def _neighbour_sums(asks: DataFrame) -> np.ndarray:
    """Tokens by (class, class of the word before) and, behind them, (class, class of the word after)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(CLASSES * 2 * SIDE)
        for batch in batches:
            for payload in batch.column("payload"):
                *_, kind, sizes, context, n = B.expand(payload.as_py())
                sums += np.bincount(np.repeat(kind.astype(np.int64), sizes) * (2 * SIDE) + context, n, minlength=sums.size)
        yield pa.RecordBatch.from_pydict({"class": pa.array([0], pa.int32()), "sums": pa.array([sums.tobytes()], pa.binary())})

    rows = _summed(asks.select("payload").mapInArrow(scan, "class int, sums binary"))
    return rows.get(0, np.zeros(CLASSES * 2 * SIDE)).reshape(CLASSES, 2 * SIDE)


def mutual_information(sums: np.ndarray) -> float:
    """Of adjacent classes, in nats: the class-bigram likelihood a token, but for a constant."""
    pairs = sums[:, :SIDE] / max(1.0, sums[:, :SIDE].sum())
    apart = pairs.sum(1, keepdims=True) * pairs.sum(0, keepdims=True)
    some = pairs > 0
    return float((pairs[some] * np.log(pairs[some] / apart[some])).sum())


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def best_classes(own: np.ndarray, kind: np.ndarray, sizes: np.ndarray, context: np.ndarray, n: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The class of each word under which class bigrams are likeliest, the word taken out of its own first; ties stay.

    ``sizes`` cells (``context``, ``n``) a word. Where a word is its own neighbour, that neighbour keeps its class.
    """
    totals = sums[:, :SIDE].sum(1)
    add, drop = _xlogx(sums + 1) - _xlogx(sums), _xlogx(sums) - _xlogx(np.maximum(sums - 1, 0))
    add, out = np.ascontiguousarray(add.T), kind.astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(edges, edges[low] + CHUNK, "right")) - 1)
        part = slice(int(edges[low]), int(edges[high]))
        some = low + np.flatnonzero(sizes[low:high])
        if len(some):
            cell, times = context[part].astype(np.int64), n[part].astype(float)
            home = np.repeat(out[low:high], sizes[low:high])
            gain = add[cell]
            gain[np.arange(len(cell)), home] = drop[home, cell]
            many = np.flatnonzero(times > 1)
            base = sums[:, cell[many]].T.copy()
            base[np.arange(len(many)), home[many]] -= times[many]
            gain[many] = _xlogx(np.maximum(base, 0) + times[many, None]) - _xlogx(np.maximum(base, 0))
            worth = np.add.reduceat(gain, edges[some] - part.start)
            rest, size, at = np.tile(totals, (len(some), 1)), own[some].astype(float), np.arange(len(some))
            rest[at, out[some]] -= size
            worth -= 2 * (_xlogx(np.maximum(rest, 0) + size[:, None]) - _xlogx(np.maximum(rest, 0)))
            worth[at, out[some]] += 1e-9 * size + 1e-9
            out[some] = worth.argmax(1)
        low = high
    return out


def _move(asks: DataFrame, sums) -> DataFrame:
    """Answers to the blocks, for each word: class after the move (``UNKNOWN`` without training tokens), training count, number."""

    def group(table: pa.Table) -> pa.Table:
        known: defaultdict[bytes, int] = defaultdict(count().__next__)
        places, messages, size = [], [], 0
        for message in table.column("payload"):
            names, joined, *counted = B.expand(message.as_py())
            if joined:
                names = np.fromiter(map(known.__getitem__, _cut(names, joined)), np.uint32, len(names))
            places.append(names)
            messages.append(counted)
            size = max(size, int(names.max()) + 1)
        total, kind, grid = np.zeros(size, np.int64), np.zeros(size, np.uint8), np.zeros(size * 2 * SIDE, np.uint32)
        for place, (own, now, sizes, context, n) in zip(places, messages, strict=True):
            total[place] += own
            kind[place] = now
            grid[np.repeat(place.astype(np.int64), sizes) * (2 * SIDE) + context] += n
        del messages
        unique = np.flatnonzero(grid)
        summed = grid[unique].astype(np.int64)
        sizes = np.bincount(unique // (2 * SIDE), minlength=size)
        found = np.where(total > 0, best_classes(total, np.minimum(kind, CLASSES - 1), sizes, unique % (2 * SIDE), summed, sums.value), UNKNOWN)
        out = [B.shrink(found[place].astype(np.uint8), total[place], place) for place in places]
        return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), "payload": pa.array(out, pa.binary())})

    return asks.groupBy("bucket").applyInArrow(group, B.ASK_SCHEMA)


def _bucketed(blocks: DataFrame, count: int) -> tuple[DataFrame, str]:
    """The blocks as a table bucketed by block in the checkpoint folder, so that joins on it leave it in place."""
    spark, name = blocks.sparkSession, f"class_lm_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark)}/table-{name}"
    blocks.write.bucketBy(count, "block").option("path", path).format("parquet").saveAsTable(name)
    written = spark.table(name)
    written._table_path, written._block_partitions = path, count
    return written, name


def cluster(spark: SparkSession, blocks: DataFrame, buckets: int, top: list[bytes]) -> tuple[DataFrame | None, np.ndarray, list[float]]:
    """Exchange rounds: (answers of the best round, its neighbour sums, mutual information before each round and at the end)."""
    first = spark.sparkContext.broadcast({w: i for i, w in enumerate(top)})
    question = partial(_ask_moves, buckets=buckets, first=first)
    history: list[float] = []
    best, best_sums, answers = None, None, None
    while True:
        asks = cut_lineage(B.ask(blocks if answers is None else B.with_answers(blocks, answers), question))
        sums = _neighbour_sums(asks)
        history.append(mutual_information(sums))
        last = max(history[:-1], default=0.0)
        # The classes before the first round are the seeds, which no answer holds yet.
        better = len(history) <= 2 or history[-1] > last
        if better:
            if best is not None:
                release(best)
            best, best_sums = answers, sums
        elif answers is not None:
            release(answers)
        if len(history) > 2 and history[-1] - last < MIN_GAIN * last or len(history) == 2 and not history[-1]:
            release(asks)
            return best, best_sums, history
        answers = cut_lineage(_move(asks, spark.sparkContext.broadcast(sums)))
        release(asks)


def _summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sums by class of the tasks' vectors; only one vector a class reaches the driver."""

    def group(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x) for x in table.column("sums").to_pylist())
        return pa.table({"class": table.column("class").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    return {r["class"]: np.frombuffer(r["sums"]) for r in parts.groupBy("class").applyInArrow(group, "class int, sums binary").collect()}


def _annotate(payload: bytes, answers: dict[int, bytes], *, buckets: int, totals, tokens: int, words: int, ends: int):
    rest, learn, counts, places, hashes, *_ = B.expand(payload)
    kind, seen, _ = _told(hashes, answers, buckets)
    floor = np.log10(tokens + 0.1 * (words + 1))
    base = np.log10(seen + 0.1) - floor
    emit = np.where(seen > 0, np.log10(np.maximum(seen, 1)) - np.log10(np.maximum(totals[np.minimum(kind, CLASSES - 1)], 1)), 0.0)
    edges = np.concatenate([[0], np.cumsum(counts)])

    def per_text(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values[places])])
        return sums[edges[1:]] - sums[edges[:-1]]

    classes = kind[places].tobytes()
    cuts = edges.tolist()
    table = B.unpack_texts(rest)
    yield from pa.table(
        {
            "doc_id": table.column("doc_id"),
            "learn": pa.array(learn > 0),
            "n_tokens": pa.array(counts + 1, pa.int64()),
            "n_known": pa.array(per_text((seen > 0).astype(np.int64)) + (ends > 0), pa.int64()),
            "base_score": pa.array(per_text(base) + np.log10(ends + 0.1) - floor, pa.float64()),
            "emitted": pa.array(per_text(emit), pa.float64()),
            "classes": pa.array([classes[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
        }
    ).combine_chunks().to_batches(max_chunksize=2000)


def _moves(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Class pairs (before * STATES + class) of all texts, end to end, and the bounds of the texts."""
    texts = column.to_pylist()
    closing = bytes([END])
    flat = np.frombuffer(closing + b"".join([t + closing for t in texts]), np.uint8).astype(np.int64)
    return flat[:-1] * STATES + flat[1:], np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])


def _transitions(annotated: DataFrame) -> np.ndarray:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(STATES * STATES)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_moves(batch.column("classes"))[0], minlength=STATES * STATES)
        yield pa.RecordBatch.from_pydict({"class": pa.array([0], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    rows = _summed(annotated.filter("learn").select("classes").mapInArrow(scan, "class int, sums binary"))
    return rows.get(0, np.zeros(STATES * STATES)).reshape(STATES, STATES)


def transition_scores(moves: np.ndarray, unknown: float) -> np.ndarray:
    """log10 P(class | class before), smoothed by the class frequencies; ``unknown``: the chance of a new word."""
    overall = moves.sum(0)
    overall[UNKNOWN] = 0
    overall = (overall + 1e-3) / (overall + 1e-3).sum()
    chance = (moves + BACK_OFF * overall) / (moves.sum(1, keepdims=True) + BACK_OFF)
    chance[:, UNKNOWN] = 0
    chance *= (1 - unknown) / chance.sum(1, keepdims=True)
    chance[:, UNKNOWN] = unknown
    return np.log10(chance)


def score_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row.

    Tokens are the words of the A-Z lower-cased text, split at ASCII white space, and one end. Texts whose id's crc32 is 0
    modulo 10 are held out; so are rows with a null ``doc_id``. Null texts are empty: the end is their only token. Repeated
    rows count as often as they occur. An empty table gives an empty result; without training texts every word is unknown.
    Other columns are ignored.
    """
    rows = docs.select("doc_id", "text", in_training(F.col("doc_id"), PARTS, LEFT_OUT).alias("learn"))
    buckets = B.partitions_for(docs, B.SCAN_BYTES_PER_BUCKET)
    blocks, name = _bucketed(B.make_blocks(rows, _pack, spread=False), B.partitions_for(docs))
    counted = cut_lineage(_count(B.ask(blocks, partial(_ask_counts, buckets=buckets))))
    sums = counted.agg(F.sum("tokens"), F.sum("words"), F.sum("once")).first()
    n_words, n_distinct, n_once = (int(x or 0) for x in sums)
    ends = rows.filter("learn").count()
    tokens, distinct = n_words + ends, n_distinct + (ends > 0)
    most = counted.select(F.explode(F.arrays_zip("top", "top_n")).alias("t")).select("t.top", "t.top_n")
    top = [bytes(r["top"]) for r in most.orderBy(F.desc("top_n"), "top").limit(CLASSES - 1).collect()]
    release(counted)
    answers, sums, _ = cluster(spark, blocks, buckets, top)
    totals = sums[:, :SIDE].sum(1)
    model = {"buckets": buckets, "totals": totals, "tokens": tokens, "words": distinct, "ends": ends}
    schema = "learn boolean, n_tokens long, n_known long, base_score double, emitted double, classes binary"
    kind = docs.schema["doc_id"].dataType.simpleString()
    annotated = cut_lineage(
        B.finish(B.with_answers(blocks, answers), partial(_annotate, **model), f"doc_id {kind}, {schema}")
    )
    release(answers)
    release(blocks)
    spark.sql(f"DROP TABLE {name}")
    unknown = min(0.5, max(1e-7, n_once / tokens)) if tokens else 0.5
    log_moves = spark.sparkContext.broadcast(transition_scores(_transitions(annotated), unknown).ravel())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moves, edges = _moves(batch.column("classes"))
            sums = np.concatenate([[0], np.cumsum(log_moves.value[moves])])
            score = sums[edges[1:]] - sums[edges[:-1]] + batch.column("emitted").to_numpy()
            size = batch.column("n_tokens").to_numpy()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": pa.array(~batch.column("learn").to_numpy(zero_copy_only=False)),
                    "n_tokens": batch.column("n_tokens"),
                    "n_known": batch.column("n_known"),
                    "train_tokens": pa.array(np.full(len(size), tokens), pa.int64()),
                    "base_score": batch.column("base_score"),
                    "score": pa.array(score, pa.float64()),
                    "perplexity": pa.array(10 ** np.minimum(-score / size, 300), pa.float64()),
                }
            )

    out = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return annotated.mapInArrow(scan, f"doc_id {kind}, {out}")
