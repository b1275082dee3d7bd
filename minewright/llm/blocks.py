"""Question-and-answer shuffles between blocks of documents and hash buckets of what occurs in them.

Texts travel once, as compressed blocks of about ``BLOCK_BYTES``; a block is one row. A block asks each bucket about the
distinct values (words, n-gram hashes) that fall into it, with one packed message, so that a value which every document
has still gives one entry a block. The bucket, which sees all blocks' messages, answers every message in its order. Both
sides are plain DataFrames: ``asks`` is grouped by bucket, and answers are gathered by block and joined to it. Rows of a
block or bucket are bounded by the block size and the number of buckets, which follows the input's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.plans.spread import estimated_bytes


BLOCK_BYTES = 8 << 20
SCAN_BYTES_PER_PARTITION = 8 << 20
SCAN_BYTES_PER_BUCKET = 16 << 20
MAX_PARTITIONS = 100_000
# Catalyst gives inputs that it knows nothing of (local rows, RDDs, unread caches) sizes near 2^63.
UNKNOWN_BYTES = 1 << 62

BLOCK_SCHEMA = "block long, payload binary"
ASK_SCHEMA = "bucket int, block long, payload binary"


def scanned_bytes(docs: DataFrame) -> int:
    """Bytes that the frame reads: what Catalyst knows of its sources, or its text bytes, counted once, if it does not.

    Sources are added up, because the estimate of a whole plan multiplies at joins; it counts where it is the smaller, as
    it leaves out columns that are not read.
    """
    leaves = docs._jdf.queryExecution().optimizedPlan().collectLeaves()
    known = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if known < UNKNOWN_BYTES:
        return min(known, estimated_bytes(docs))
    counted = getattr(docs, "_text_bytes", None)
    if counted is None:
        texts = [F.octet_length(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() in ("string", "binary")]
        sizes = [F.coalesce(F.sum(t), F.lit(0)) for t in texts]
        counted = sum(docs.agg(*[n.alias(f"_{i}") for i, n in enumerate(sizes)]).first()) if sizes else 0
        docs._text_bytes = counted
    return counted


def partitions_for(docs: DataFrame, scan_bytes: int = SCAN_BYTES_PER_PARTITION) -> int:
    """Shuffle partitions for an input: those of the session, or more when the scan is large."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(MAX_PARTITIONS, max(least, scanned_bytes(docs) // scan_bytes)))


def shrink(*arrays: np.ndarray | bytes) -> bytes:
    """Several arrays or byte strings as one compressed byte string; integers go plane by plane."""
    parts, head = [], [len(arrays)]
    for a in arrays:
        if isinstance(a, np.ndarray):
            raw = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if a.size else b""
            head += [ord(a.dtype.char), len(raw)]
        else:
            raw = a
            head += [0, len(raw)]
        parts.append(raw)
    return zstandard.ZstdCompressor(level=3).compress(np.array(head, np.int64).tobytes() + b"".join(parts))


def expand(payload: bytes) -> list:
    """The arrays and byte strings of ``shrink``."""
    raw = zstandard.ZstdDecompressor().decompress(payload)
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * count, 8).reshape(-1, 2)
    at, out = 8 + 16 * count, []
    for kind, size in head.tolist():
        part = raw[at : at + size]
        at += size
        if kind:
            dtype = np.dtype(chr(kind))
            planes = np.frombuffer(part, np.uint8).reshape(dtype.itemsize, -1)
            out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(-1))
        else:
            out.append(part)
    return out


def byte_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of ``column`` each; a longer text is a slice of its own."""
    sizes = pc.binary_length(batch.column(column).cast(pa.large_string())).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Consecutive rows of a task as tables of about ``limit`` bytes of text."""
    kept, held = [], 0
    for batch in batches:
        for part in byte_slices(batch, column, limit):
            size = part.column(column).nbytes
            if held and held + size > limit:
                yield pa.Table.from_batches(kept)
                kept, held = [], 0
            kept.append(part)
            held += size
    if kept:
        yield pa.Table.from_batches(kept)


def make_blocks(
    docs: DataFrame, pack: Callable[[pa.Table], bytes], column: str = "text", spread: bool = True, limit: int = BLOCK_BYTES
) -> DataFrame:
    """Documents as blocks: (block, payload of ``pack``) of about ``limit`` bytes, hashed by block unless ``spread`` is off.

    Block ids name the scan's partition and the place in it, so a task that runs again makes the same blocks.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for i, table in enumerate(gathered(batches, column, limit)):
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([first + i], pa.int64()), "payload": pa.array([pack(table)], pa.binary())}
            )

    blocks = docs.mapInArrow(packed, BLOCK_SCHEMA)
    if not spread:
        return blocks
    count = partitions_for(docs)
    spread_blocks = blocks.repartition(count, "block")
    spread_blocks._block_partitions = count
    return spread_blocks


def pack_texts(table: pa.Table) -> bytes:
    """All columns of the rows as one compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())


def unpack_texts(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(payload)).read_all().combine_chunks()


def ask(blocks: DataFrame, questions: Callable[..., Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Messages of the blocks: ``questions(payload, *answers)`` gives (bucket, message) pairs."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                asked = list(questions(row["payload"], *_answers(row)))
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([b for b, _ in asked], pa.int32()),
                        "block": pa.array([row["block"]] * len(asked), pa.int64()),
                        "payload": pa.array([m for _, m in asked], pa.binary()),
                    }
                )

    return blocks.mapInArrow(emit, ASK_SCHEMA)


def answer(asks: DataFrame, reply: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """Answers to the messages of each bucket, in the messages' form: ``reply`` maps a bucket's messages one to one."""

    def group(table: pa.Table) -> pa.Table:
        out = reply(table.column("payload").to_pylist())
        return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), "payload": pa.array(out, pa.binary())})

    return asks.groupBy("bucket").applyInArrow(group, ASK_SCHEMA)


def with_answers(blocks: DataFrame, answers: DataFrame, name: str = "answers") -> DataFrame:
    """Blocks beside their answers, a map from bucket to message; a block holds at most one answer a bucket."""
    # As many partitions as the blocks have, so that the join leaves them where they are and their exchange is reused.
    count = getattr(blocks, "_block_partitions", None)
    near = answers.repartition(count, "block") if count else answers
    mine = near.groupBy("block").agg(F.collect_list(F.struct("bucket", "payload")).alias(name))
    joined = blocks.join(mine, "block", "left")
    joined._block_partitions = count
    return joined


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _answers(row: dict) -> list[dict[int, bytes]]:
    return [{a["bucket"]: a["payload"] for a in row[k] or ()} for k in row if k not in ("block", "payload")]


def finish(answered: DataFrame, rows_of: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Result rows of each block: ``rows_of(payload, *answers)``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                yield from rows_of(row["payload"], *_answers(row))

    return answered.mapInArrow(emit, schema)


def by_bucket(buckets: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of the entries of each bucket that has any, in their order."""
    order = np.argsort(buckets, kind="stable")
    edges = np.searchsorted(buckets[order], np.arange(count + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        yield b, order[edges[b] : edges[b + 1]]
