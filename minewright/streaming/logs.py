"""Log operators on streams: request de-duplication, ping sessions, liveness, and a folded key/value table."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from minewright.operators.logs import APPEND, DEAD_PINGS, PING_MILLIS, PUT
from minewright.plans.lineage import cut_lineage, release
from minewright.plans.spread import spread_join

# Sequence numbers within which a request is retried and a row may be late; micro-batches between two merges.
RETRY_SPAN = 10_000_000
MERGE_EVERY = 8


def read_log_stream(spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int = 64) -> DataFrame:
    """Parquet pieces of a log, as they arrive, a bounded number a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_dedup(log: DataFrame, delay: str, ts: str = "ts", request: tuple[str, ...] = ("client", "req")) -> DataFrame:
    """Each request once; a request's retries must come within ``delay`` of it, after which its state is dropped."""
    timed = log.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.dropDuplicatesWithinWatermark(list(request))


def stream_sessions(pings: DataFrame, gap: str, delay: str) -> DataFrame:
    """``(server, start, end, n)`` of closed runs of pings; end is the last ping, as in the batch form."""
    timed = pings.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    windows = timed.groupBy("server", F.session_window("ts", gap).alias("_w")).agg(
        F.min("ts").alias("start"), F.max("ts").alias("end"), F.count(F.lit(1)).alias("n")
    )
    return windows.select("server", "start", "end", "n")


def stream_liveness(
    pings: DataFrame, delay: str, interval_millis: int = PING_MILLIS, dead_pings: int = DEAD_PINGS
) -> DataFrame:
    """``(server, last_ping, dead_from, back_at)`` as it becomes known, by timers on event time.

    A server is reported dead (null ``back_at``) when the watermark passes ``dead_from``, without waiting for another
    ping, and the period again, with ``back_at``, once it pings. The latest row of each (server, last_ping) is
    ``ping_gaps`` as of the watermark. State is a server's last ping and those newer than the watermark; pings
    without a server or a time are ignored.
    """
    limit = interval_millis * dead_pings * 1000
    timed = pings.select("server", F.col("ts").cast("timestamp").alias("ts")).dropna().withWatermark("ts", delay)
    kind = timed.schema["server"].dataType.simpleString()

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, reported, waiting = state.get if state.exists else (None, False, [])
        waiting = sorted([*waiting, *(int(micros) for batch in batches for micros in batch["_micros"])])
        now = state.getCurrentWatermarkMs() * 1000
        ready = bisect_right(waiting, now)
        periods = []
        for ping in waiting[:ready]:
            if last is not None and ping - last > limit:
                periods.append((key[0], last, last + limit, ping))
            reported = reported and last == ping
            last = ping
        waiting = waiting[ready:]
        if last is not None and not reported and now > last + limit:
            periods.append((key[0], last, last + limit, None))
            reported = True
        state.update((last, reported, waiting))
        timers = [*waiting[:1], *([last + limit + 1] if last is not None and not reported else [])]
        if timers:
            state.setTimeoutTimestamp(max(-(-min(timers) // 1000), now // 1000 + 1))
        if periods:
            out = pd.DataFrame(periods, columns=["server", "last_ping", "dead_from", "back_at"])
            yield out.astype({"back_at": "Int64"})

    found = (
        timed.withColumn("_micros", F.unix_micros("ts"))
        .groupBy("server")
        .applyInPandasWithState(
            watch,
            f"server {kind}, last_ping long, dead_from long, back_at long",
            "last long, reported boolean, waiting array<long>",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )
    return found.select("server", *[F.timestamp_micros(c).alias(c) for c in ("last_ping", "dead_from", "back_at")])


def stream_fold(
    log: DataFrame,
    table: str,
    checkpoint: str,
    request: Sequence[str] = (),
    span: int = RETRY_SPAN,
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Keep a compacted log under ``table``; ``read_folded`` and the batch fold of it give the keys' values.

    Every micro-batch adds a piece under its number (``fold_batch``), and every ``merge_every`` batches the pieces are
    merged into one base. No key's value is held in operator state.
    """
    return (
        log.writeStream.foreachBatch(lambda batch, number: fold_batch(batch, number, table, request, span, merge_every))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def fold_batch(
    batch: DataFrame,
    number: int,
    table: str,
    request: Sequence[str] = (),
    span: int = RETRY_SPAN,
    merge_every: int = MERGE_EVERY,
) -> None:
    """Add micro-batch ``number`` to the compacted log under ``table``.

    Without ``request``, writes that a later Put replaces are dropped at once: sequence numbers decide the order, so late
    rows fall into place. With it, only the first row of a request counts. A retry has a sequence number at most
    ``span`` above the first's, and a row comes at most ``span`` behind the highest seen; so a Put replaces what is
    before it only once it lies that far back, and a request's number is remembered for twice the span after its row
    is gone. The table is then bounded by the keys' live writes and that many numbers.

    A batch that is run again overwrites its own piece; one that is already merged is skipped.
    """
    spark = batch.sparkSession
    bases = _written(spark, f"{table}/base")
    if bases and bases[-1] >= number:
        return
    writes = batch.filter(F.col("op").isin(PUT, APPEND)).select(*request, "seq", "key", "op", "value")
    fresh = writes.withColumn("live", F.lit(True))
    fresh = _firsts(fresh, request) if request else _after_puts(fresh)
    fresh.write.mode("overwrite").parquet(f"{table}/piece/{number}")
    if (number + 1) % merge_every:
        return
    rows, pieces = _rows(spark, table, bases)
    if request:
        merged = cut_lineage(_firsts(rows, request))
        high = F.lit(merged.agg(F.max("seq")).first()[0]).cast("bigint")
        left = _after_puts(merged, high - span, keep_dead=True)
        left = left.filter(F.col("live") | (F.col("seq") >= high - 2 * span))
    else:
        merged, left = rows, _after_puts(rows)
    left.write.mode("overwrite").parquet(f"{table}/base/{number}")
    release(merged)
    for old in [*(f"base/{n}" for n in bases), *(f"piece/{n}" for n in pieces)]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{old}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_folded(spark: SparkSession, table: str, request: Sequence[str] = ()) -> DataFrame:
    """The compacted log ``(seq, key, op, value)``, ready for the batch fold."""
    rows, _ = _rows(spark, table, _written(spark, f"{table}/base"))
    return (_firsts(rows, request) if request else rows).filter("live").select("seq", "key", "op", "value")


def _written(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete tables in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    tables = [status.getPath() for status in files.listStatus(path)]
    done = [t for t in tables if files.exists(spark._jvm.org.apache.hadoop.fs.Path(t, "_SUCCESS"))]
    return sorted(int(t.getName()) for t in done)


def _rows(spark: SparkSession, table: str, bases: list[int]) -> tuple[DataFrame, list[int]]:
    """The latest base with the pieces after it, and all pieces there are."""
    pieces = _written(spark, f"{table}/piece")
    later = [n for n in pieces if not bases or n > bases[-1]]
    paths = [*(f"{table}/base/{n}" for n in bases[-1:]), *(f"{table}/piece/{n}" for n in later)]
    return spark.read.parquet(*paths), pieces


def _firsts(rows: DataFrame, request: Sequence[str]) -> DataFrame:
    """The row of least ``seq`` of every request; a live row before the remembered number of the same row."""
    others = [c for c in rows.columns if c not in request]
    first = rows.groupBy(*request).agg(F.min_by(F.struct(*others), F.struct("seq", ~F.col("live"))).alias("_first"))
    return first.select(*request, *[F.col(f"_first.{c}").alias(c) for c in others])


def _after_puts(rows: DataFrame, until: Column | None = None, keep_dead: bool = False) -> DataFrame:
    """Rows from each key's last Put (up to ``until``) on; the others go, or stay as mere numbers."""
    counted = (F.col("op") == PUT) & F.col("live")
    puts = rows.filter(counted if until is None else counted & (F.col("seq") <= until))
    puts = puts.groupBy("key").agg(F.max("seq").alias("_put"))
    joined = spread_join(rows, puts, "key", "left", spread_by=["seq"])
    live = F.col("live") & (F.col("_put").isNull() | (F.col("seq") >= F.col("_put")))
    if not keep_dead:
        return joined.filter(live).select(*rows.columns)
    emptied = {c: F.when(live, F.col(c)).alias(c) for c in ("key", "op", "value")}
    return joined.select(*[emptied.get(c, live.alias("live") if c == "live" else F.col(c)) for c in rows.columns])
