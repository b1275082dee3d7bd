"""Operator 7: removal of word spans that an earlier document already has.

The dealt method broadcasts suffix automata of reference shards and streams every document past every shard. Here every
document is a reference, so the automata grow with the input and each would meet all documents: an unbounded broadcast and
quadratic work. What a matching statistic of at least ``window`` words says is kept, "this window starts in an earlier
document", and found by routing: equal windows have the same rarest (smallest-hash) inner word n-gram, their anchor.

1. Each block asks which of its anchors other documents share (six bytes an anchor, one bit back).
2. Windows on shared anchors, once a block with their smallest document, ask whether any document before that one has
   them (one bit back).
3. Covered words go, maximal spans at a time.

A passage that a third of all documents share gives one message entry a block. Window hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from minewright.llm import blocks as B
from minewright.llm.wordhash import Words, inside, ngrams, text_of_position, words_of

WINDOW = 13
ANCHOR = 7
OUT_ROWS = 500
# Half of what others take: word and n-gram arrays of a whole block are held beside the texts.
BLOCK_BYTES = 4 << 20
_MASK = np.uint64((1 << 48) - 1)


def _windows(words: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that begin a window of one text, and the window's anchor."""
    grams = ngrams(words.hashes, anchor)
    count = max(0, len(words.hashes) - window + 1)
    least = grams[:count].copy()
    for step in range(1, window - anchor + 1):
        np.minimum(least, grams[step : step + count], out=least)
    spots = np.flatnonzero(inside(words.bounds, window, count))
    return spots, least[spots] & _MASK


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("doc_id").combine_chunks()
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ids.is_valid().to_numpy(zero_copy_only=False)


def _anchors(words: Words, known: np.ndarray, ids: np.ndarray, window: int, anchor: int):
    """Windows of documents with an id: position, document id, anchor number; and the distinct anchors with a flag."""
    spots, marks = _windows(words, window, anchor)
    texts = text_of_position(words.bounds, spots)
    named = known[texts]
    spots, marks, docs = spots[named], marks[named], ids[texts[named]]
    values, number = np.unique(marks, return_inverse=True)
    low = np.full(len(values), np.iinfo(np.int64).max)
    high = np.full(len(values), np.iinfo(np.int64).min)
    np.minimum.at(low, number, docs)
    np.maximum.at(high, number, docs)
    return spots, docs, number, values, low < high


def _ask_anchors(payload: bytes, *, buckets: int, window: int, anchor: int) -> Iterator[tuple[int, bytes]]:
    table = B.unpack_texts(payload)
    ids, known = _ids(table)
    *_, values, several = _anchors(words_of(table.column("text")), known, ids, window, anchor)
    for bucket, at in B.by_bucket(values % np.uint64(buckets), buckets):
        six = np.ascontiguousarray(values[at].view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
        yield bucket, six + np.packbits(several[at]).tobytes() + len(at).to_bytes(4, "little")


def _read_anchors(message: bytes) -> tuple[np.ndarray, np.ndarray]:
    count = int.from_bytes(message[-4:], "little")
    wide = np.zeros((count, 8), np.uint8)
    wide[:, :6] = np.frombuffer(message, np.uint8, 6 * count).reshape(-1, 6)
    return wide.view(np.uint64).reshape(-1), np.unpackbits(np.frombuffer(message[6 * count : -4], np.uint8), count=count) > 0


def _reply_anchors(messages: list[bytes]) -> list[bytes]:
    read = [_read_anchors(m) for m in messages]
    values, number, counts = np.unique(np.concatenate([v for v, _ in read]), return_inverse=True, return_counts=True)
    shared = counts > 1
    shared[number[np.concatenate([s for _, s in read])]] = True
    hits = np.split(shared[number], np.cumsum([len(v) for v, _ in read])[:-1])
    return [np.packbits(h).tobytes() for h in hits]


def _flags(values: np.ndarray, answers: dict[int, bytes], buckets: int) -> np.ndarray:
    flags = np.zeros(len(values), bool)
    for bucket, at in B.by_bucket(values % np.uint64(buckets), buckets):
        if bucket in answers:
            flags[at] = np.unpackbits(np.frombuffer(answers[bucket], np.uint8), count=len(at)) > 0
    return flags


def _shared_windows(table: pa.Table, words: Words, answers: dict[int, bytes], buckets: int, window: int, anchor: int):
    """Windows on shared anchors: position, document, number of the distinct window; those windows and first documents."""
    ids, known = _ids(table)
    spots, docs, number, values, _ = _anchors(words, known, ids, window, anchor)
    open_ = _flags(values, answers, buckets)[number]
    spots, docs = spots[open_], docs[open_]
    texts, which = np.unique(ngrams(words.hashes, window)[spots], return_inverse=True)
    first = np.full(len(texts), np.iinfo(np.int64).max)
    np.minimum.at(first, which, docs)
    return spots, docs, which, texts, first


def _ask_windows(payload: bytes, anchors: dict[int, bytes], *, buckets: int, window: int, anchor: int):
    table = B.unpack_texts(payload)
    *_, texts, first = _shared_windows(table, words_of(table.column("text")), anchors, buckets, window, anchor)
    for bucket, at in B.by_bucket(texts % np.uint64(buckets), buckets):
        yield bucket, B.shrink(texts[at], first[at])


def _reply_windows(messages: list[bytes]) -> list[bytes]:
    read = [B.expand(m) for m in messages]
    values, number = np.unique(np.concatenate([v for v, _ in read]), return_inverse=True)
    docs = np.concatenate([d for _, d in read])
    first = np.full(len(values), np.iinfo(np.int64).max)
    np.minimum.at(first, number, docs)
    earlier = np.split(first[number] < docs, np.cumsum([len(v) for v, _ in read])[:-1])
    return [np.packbits(e).tobytes() for e in earlier]


def _cut(payload: bytes, anchors: dict[int, bytes], windows: dict[int, bytes], *, buckets, window, anchor, keep_text):
    table = B.unpack_texts(payload)
    words = words_of(table.column("text"))
    spots, docs, which, texts, first = _shared_windows(table, words, anchors, buckets, window, anchor)
    dup = (docs > first[which]) | _flags(texts, windows, buckets)[which]
    edges = np.zeros(len(words.hashes) + 1, np.int64)
    edges[: len(words.hashes)] = np.bincount(spots[dup], minlength=len(words.hashes))[: len(words.hashes)]
    edges[window:] -= edges[: len(edges) - window].copy() if len(edges) > window else 0
    gone = np.cumsum(edges)[:-1] > 0
    del edges, spots, docs, which, texts, first, dup
    bounds = words.bounds.tolist()
    # Rows leave in parts: word positions of one text at a time, and never all rebuilt texts of the block.
    for first_row in range(0, table.num_rows, OUT_ROWS):
        part = table.slice(first_row, OUT_ROWS)
        to = first_row + part.num_rows
        kept, removed = [], []
        for low, high in itertools.pairwise(bounds[first_row : to + 1]):
            left = np.flatnonzero(~gone[low:high]) + low
            removed.append(high - low - len(left))
            if keep_text and not removed[-1]:
                kept.append(None)
                continue
            base = int(words.starts[low]) if high > low else 0
            raw = words.data[base : int(words.ends[high - 1])].tobytes() if high > low else b""
            starts, ends = (words.starts[left] - base).tolist(), (words.ends[left] - base).tolist()
            kept.append(b" ".join([raw[i:j] for i, j in zip(starts, ends, strict=True)]))
        columns = {
            "doc_id": part.column("doc_id").cast(pa.int64()),
            "n_words": pa.array(np.diff(words.bounds[first_row : to + 1]), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
        }
        if keep_text:
            for name in table.column_names:
                if name not in ("doc_id", "text"):
                    columns["_" + name] = part.column(name)
            was = part.column("text").to_pylist()
            columns["_text"] = pa.array([w if k is None else k.decode() for w, k in zip(was, kept, strict=True)], pa.string())
        else:
            columns["kept_sha256"] = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
        yield from pa.table(columns).combine_chunks().to_batches()


def dedup_substrings(
    docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, keep: tuple[str, ...] | None = None
) -> DataFrame:
    """Remove every word covered by a ``window``-word sequence that also starts in a document of smaller ``doc_id``.

    ``doc_id`` is a whole number. Returns (doc_id, n_words, n_removed, kept_sha256); with ``keep``, the names of further columns, the cut text as
    ``_text`` and the columns with a leading underscore in place of the digest. A text that loses nothing stays as it is
    there; otherwise its kept words are joined by one space.

    Null texts have no words. A row with a null ``doc_id`` is before or after nothing: it keeps its words and takes none
    from others. Rows of one ``doc_id`` do not remove each other's words. Windows do not run from one row to the next;
    texts shorter than ``window`` keep everything; an empty table gives an empty result. Other columns are ignored.
    """
    if not 0 < anchor <= window:
        raise ValueError("the anchor must fit the window")
    rows = docs.select("doc_id", "text", *(c for c in keep or () if c not in ("doc_id", "text")))
    buckets = B.partitions_for(docs, B.SCAN_BYTES_PER_BUCKET)
    how = {"buckets": buckets, "window": window, "anchor": anchor}
    blocks = B.make_blocks(rows, B.pack_texts, limit=BLOCK_BYTES)
    shared = B.answer(B.ask(blocks, partial(_ask_anchors, **how)), _reply_anchors)
    marked = B.with_answers(blocks, shared, "anchors")
    earlier = B.answer(B.ask(marked, partial(_ask_windows, **how)), _reply_windows)
    done = B.with_answers(marked, earlier, "windows")
    schema = "doc_id long, n_words long, n_removed long, "
    if keep is None:
        schema += "kept_sha256 string"
    else:
        schema += ", ".join(f"`_{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("doc_id", "text"))
        schema += ", `_text` string" if len(rows.columns) > 2 else "`_text` string"
    return B.finish(done, partial(_cut, **how, keep_text=keep is not None), schema)
