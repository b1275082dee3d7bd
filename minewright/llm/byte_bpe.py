"""Operator 2: byte-level BPE by a shuffle of distinct words.

Texts are cut into pre-tokens once; each block keeps its documents as positions of block-wide word numbers. The distinct
words of all blocks meet in hash buckets, where each is encoded once, and the ids return to the blocks, which put them
back by position. Decoding reads the bytes of every id from the token table. The token table is bounded by the vocabulary.

Vocabulary files and their patterns are parameters; see ``load_ranks``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache, partial
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from minewright.llm import blocks as B

# Words longer than this merge by a heap, so that time stays near linear in the word.
_SHORT = 48


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file: base64 token, space, rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=4)
def _compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the whole word if it is a token, else merges in rank order, leftmost first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > _SHORT:
        return _encode_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best, at = None, 0
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    end = len(word)
    after, before, size = list(range(1, end + 1)), list(range(-1, end - 1)), [1] * end
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < end:
            rank = ranks.get(word[i : j + size[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, j + size[j]))

    for i in range(end):
        offer(i)
    while heap:
        _, i, to = heapq.heappop(heap)
        j = after[i]
        if not size[i] or j >= end or j + size[j] != to:
            continue
        size[i] += size[j]
        size[j] = 0
        after[i] = after[j]
        if after[i] < end:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < end:
        out.append(ranks[word[i : i + size[i]]])
        i = after[i]
    return out


def _pretokenize(table: pa.Table, pattern: str) -> bytes:
    find = _compiled(pattern).findall
    numbers: dict[str, int] = {}
    counts, places = [], []
    for text in table.column("text").to_pylist():
        words = find(text) if text else []
        counts.append(len(words))
        places.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.uint32))
    words = [w.encode() for w in numbers]
    rest = table.drop_columns(["text"])
    return B.shrink(
        B.pack_texts(rest),
        np.array(counts, np.int64),
        np.concatenate(places) if places else np.zeros(0, np.uint32),
        np.array([len(w) for w in words], np.uint32),
        b"".join(words),
    )


def _cut(lengths: np.ndarray, joined: bytes) -> list[bytes]:
    edges = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).tolist()
    return [joined[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def _by_bucket(words: list[bytes], buckets: int):
    return B.by_bucket(np.fromiter((crc32(w) for w in words), np.int64, len(words)) % buckets, buckets)


def _ask(payload: bytes, *, buckets: int) -> Iterator[tuple[int, bytes]]:
    *_, lengths, joined = B.expand(payload)
    words = _cut(lengths, joined)
    for bucket, at in _by_bucket(words, buckets):
        asked = sorted(at.tolist(), key=words.__getitem__)
        yield bucket, B.shrink(lengths[asked], b"".join([words[i] for i in asked]))


def _reply(messages: list[bytes], *, ranks) -> list[bytes]:
    known: dict[bytes, list[int]] = {}
    table, out = ranks.value, []
    for message in messages:
        ids, counts = [], []
        for word in _cut(*B.expand(message)):
            got = known.get(word)
            if got is None:
                got = known[word] = encode_word(word, table)
            ids += got
            counts.append(len(got))
        out.append(B.shrink(np.array(counts, np.uint32), np.array(ids, np.uint32)))
    return out


@lru_cache(maxsize=1)
def _token_bytes(ranks) -> dict[int, bytes]:
    return {i: token for token, i in ranks.value.items()}


def _reassemble(payload: bytes, answers: dict[int, bytes], *, buckets: int, ranks, keep_ids: bool):
    rest, counts, places, lengths, joined = B.expand(payload)
    words = _cut(lengths, joined)
    ids: list = [None] * len(words)
    for bucket, at in _by_bucket(words, buckets):
        sizes, flat = B.expand(answers[bucket])
        edges = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).tolist()
        flat = flat.tolist()
        for i, low, high in zip(sorted(at.tolist(), key=words.__getitem__), edges, edges[1:], strict=False):
            ids[i] = flat[low:high]
    token = _token_bytes(ranks)
    sizes = np.array([len(x) for x in ids], np.int64)
    texts = [",".join(map(str, x)) for x in ids]
    decoded = [b"".join([token[i] for i in x]) for x in ids]
    edges = np.concatenate([[0], np.cumsum(counts)]).tolist()
    columns: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
    flat_ids = []
    for low, high in zip(edges, edges[1:], strict=False):
        at = places[low:high]
        columns["n_tokens"].append(int(sizes[at].sum()))
        at = at.tolist()
        columns["ids_sha256"].append(hashlib.sha256(",".join([texts[i] for i in at]).encode()).hexdigest())
        columns["decoded_sha256"].append(hashlib.sha256(b"".join([decoded[i] for i in at])).hexdigest())
        if keep_ids:
            flat_ids.append([x for i in at for x in ids[i]])
    table = B.unpack_texts(rest)
    arrays = {n: table.column(n) for n in table.column_names}
    arrays |= {
        "n_tokens": pa.array(columns["n_tokens"], pa.int64()),
        "ids_sha256": pa.array(columns["ids_sha256"], pa.string()),
        "decoded_sha256": pa.array(columns["decoded_sha256"], pa.string()),
    }
    if keep_ids:
        arrays["ids"] = pa.array(flat_ids, pa.list_(pa.int32()))
    yield from pa.table(arrays).combine_chunks().to_batches(max_chunksize=2000)


def encode_documents(
    spark: SparkSession, docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, keep_ids: bool = False
) -> DataFrame:
    """Encode every text and decode the ids again.

    Returns (doc_id, n_tokens, ids_sha256, decoded_sha256), with ``keep_ids`` also the ids themselves. Every match of
    ``pattern`` is encoded by itself and there are no special tokens. A null text is empty: no tokens and the digests of
    nothing. Repeated rows and rows with a null ``doc_id`` are encoded like others, one result row each; an empty table
    gives an empty result. Other columns are ignored.
    """
    shared = spark.sparkContext.broadcast(ranks)
    buckets = B.partitions_for(docs, B.SCAN_BYTES_PER_BUCKET)
    blocks = B.make_blocks(docs.select("doc_id", "text"), partial(_pretokenize, pattern=pattern))
    answers = B.answer(B.ask(blocks, partial(_ask, buckets=buckets)), partial(_reply, ranks=shared))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    done = B.with_answers(blocks, answers)
    return B.finish(done, partial(_reassemble, buckets=buckets, ranks=shared, keep_ids=keep_ids), schema)
