"""Operator 4: benchmark items inside documents, by MinHash containment search over size partitions.

A MinHash sketch of a long document says little about a short item, because their Jaccard similarity is small whatever
the containment. So sizes are partitioned (Zhu et al. 2016): items of ``2^c`` to ``2^(c+1) - 1`` shingles meet windows of
``3 * 2^c`` shingles that start at every ``2^c``-th; an item copied in one place lies in one window, with a similarity of
at least 0.25 when 0.8 of it is there. One of ``HASHES`` minima must agree to make a candidate (a miss there has a chance
of 0.75^32 = 0.0001, of 0.67^32 = 0.000003 for a whole item). Candidates are verified exactly: distinct shingles of the
item found anywhere in the document over distinct shingles of the item.

Only the sketches and shingles of items travel, as a broadcast of a shard of bounded size; documents are read in place,
once a shard, and are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm import blocks as B
from minewright.llm.wordhash import inside, mix, ngrams, shingle_sets, words_of

SHINGLE = 5
CONTAINMENT = 0.8
HASHES = 32
SHARD_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
_FILTER_BITS = 20

_FACTORS = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SLOTS = mix(np.arange(1, HASHES + 1, dtype=np.uint64))


@dataclass
class Index:
    """Sketches of a shard of items by size partition, and the items' shingles."""

    item_ids: list
    shingles: list[np.ndarray]
    values: dict[int, np.ndarray]
    owners: dict[int, np.ndarray]
    filters: dict[int, np.ndarray]


def build_index(item_ids: list, texts: list[str | None], shingle: int = SHINGLE) -> Index:
    sets, bounds = shingle_sets(words_of(pa.array(texts, pa.string())), shingle)
    shingles = [sets[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    rows: dict[int, list[tuple[np.ndarray, int]]] = {}
    for i, own in enumerate(shingles):
        if len(own):
            least = np.array([(own * f).min() for f in _FACTORS], np.uint64)
            rows.setdefault(int(len(own)).bit_length() - 1, []).append((mix(least ^ _SLOTS), i))
    index = Index(item_ids, shingles, {}, {}, {})
    for level, entries in rows.items():
        values = np.concatenate([v for v, _ in entries])
        owners = np.repeat([i for _, i in entries], HASHES)
        order = np.argsort(values, kind="stable")
        index.values[level], index.owners[level] = values[order], owners[order]
        marks = np.zeros(1 << _FILTER_BITS, bool)
        marks[values & np.uint64((1 << _FILTER_BITS) - 1)] = True
        index.filters[level] = marks
    return index


def _block_starts(counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks of ``width`` entries, no block running over a text's end; and blocks a text."""
    blocks = -(-counts // width)
    first = np.cumsum(counts) - counts
    within = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return np.repeat(first, blocks) + within * width, blocks


def candidates(grams: np.ndarray, counts: np.ndarray, index: Index) -> set[tuple[int, int]]:
    """(text, item) pairs with an equal minimum in some window; ``counts`` are the shingle positions of each text."""
    found: set[tuple[int, int]] = set()
    levels = sorted(index.values)
    if not len(grams) or not levels:
        return found
    starts, blocks = _block_starts(counts, 1 << levels[0])
    minima = [np.minimum.reduceat(grams * f, starts) for f in _FACTORS]
    for level in range(levels[0], levels[-1] + 1):
        if level > levels[0]:
            starts, blocks = _block_starts(blocks, 2)
            minima = [np.minimum.reduceat(m, starts) for m in minima]
        if level not in index.values:
            continue
        text = np.repeat(np.arange(len(blocks)), blocks)
        one = np.flatnonzero(text[1:] == text[:-1])
        two = np.flatnonzero(text[2:] == text[:-2])
        for slot, least in zip(_SLOTS, minima, strict=True):
            window = least.copy()
            window[one] = np.minimum(window[one], least[one + 1])
            window[two] = np.minimum(window[two], least[two + 2])
            window = mix(window ^ slot)
            at = np.flatnonzero(index.filters[level][window & np.uint64((1 << _FILTER_BITS) - 1)])
            if len(at):
                low = np.searchsorted(index.values[level], window[at], "left")
                high = np.searchsorted(index.values[level], window[at], "right")
                for t, a, b in zip(text[at].tolist(), low.tolist(), high.tolist(), strict=True):
                    found.update((t, int(i)) for i in index.owners[level][a:b])
    return found


def matches(texts: pa.Array, index: Index, shingle: int, containment: float) -> list[tuple[int, int, int]]:
    """(row, item number, shared shingles) of every pair at or above the containment."""
    words = words_of(texts)
    grams = ngrams(words.hashes, shingle)
    ok = inside(words.bounds, shingle, len(grams))
    counts = np.maximum(np.diff(words.bounds) - shingle + 1, 0)
    sets, bounds = None, None
    short = np.flatnonzero((np.diff(words.bounds) > 0) & (counts == 0))
    if len(short):
        sets, bounds = shingle_sets(words, shingle)
        order = np.argsort(np.concatenate([np.repeat(np.arange(len(counts)), counts), short]), kind="stable")
        grams = np.concatenate([grams[ok], sets[bounds[short]]])[order]
        counts = counts.copy()
        counts[short] = 1
    else:
        grams = grams[ok]
    pairs = candidates(grams, counts, index)
    out = []
    if pairs:
        edges = np.concatenate([[0], np.cumsum(counts)])
        for row, item in sorted(pairs):
            own = index.shingles[item]
            shared = int(np.isin(own, grams[edges[row] : edges[row + 1]]).sum())
            if shared >= containment * len(own) - 1e-9:
                out.append((row, item, shared))
    return out


def _shards(spark: SparkSession, benchmark: DataFrame, shingle: int) -> Iterator:
    """Broadcast indexes of shards of the benchmark; a shard has about ``SHARD_BYTES`` of text."""
    size = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = -(-int(size) // SHARD_BYTES) or 1
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for i in range(count):
        rows = benchmark.filter(F.col("text").isNotNull() & (shard == i)).select("item_id", "text").collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        yield spark.sparkContext.broadcast(build_index([r["item_id"] for r in rows], [r["text"] for r in rows], shingle))


def find_leaks(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, shingle: int = SHINGLE, containment: float = CONTAINMENT
) -> DataFrame:
    """Pairs of a document and a benchmark item of which it holds at least ``containment``.

    Returns (doc_id, item_id, n_shared, n_item, containment), one row for each document row and item row. Shingles are
    ``shingle`` consecutive words, unchanged; an item or document with fewer words is one shingle, without words (null or
    empty text) it matches nothing. Null ids are carried as they are. Empty tables give an empty result; other columns are
    ignored.
    """
    kinds = [t.schema[c].dataType.simpleString() for t, c in ((docs, "doc_id"), (benchmark, "item_id"))]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_shared long, n_item long, containment double"
    item_type = pa.int64() if kinds[1] == "bigint" else pa.string() if kinds[1] == "string" else pa.int32()
    out = None
    for index in _shards(spark, benchmark, shingle):

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for table in B.gathered(batches, "text", SLICE_BYTES):
                items = index.value
                hits = matches(table.column("text"), items, shingle, containment)
                if hits:
                    sizes = [len(items.shingles[i]) for _, i, _ in hits]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": table.column("doc_id").take(pa.array([r for r, _, _ in hits])).combine_chunks(),
                            "item_id": pa.array([items.item_ids[i] for _, i, _ in hits], item_type),
                            "n_shared": pa.array([n for _, _, n in hits], pa.int64()),
                            "n_item": pa.array(sizes, pa.int64()),
                            "containment": pa.array([h[2] / n for h, n in zip(hits, sizes, strict=True)], pa.float64()),
                        }
                    )

        found = docs.select("doc_id", "text").mapInArrow(scan, schema)
        out = found if out is None else out.union(found)
    return out


def drop_leaks(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, shingle: int = SHINGLE, containment: float = CONTAINMENT
) -> DataFrame:
    """Documents that hold no benchmark item (as ``find_leaks`` says), with all their columns."""
    for index in _shards(spark, benchmark, shingle):

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for table in B.gathered(batches, "text", SLICE_BYTES):
                keep = np.ones(table.num_rows, bool)
                keep[[row for row, _, _ in matches(table.column("text"), index.value, shingle, containment)]] = False
                yield from table.filter(pa.array(keep)).combine_chunks().to_batches()

        docs = docs.mapInArrow(scan, docs.schema)
    return docs
