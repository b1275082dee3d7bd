"""Replay, look-up, de-duplication and audit of keyed operation logs.

A log is ``(seq, client, req, key, op, value)`` with ``seq`` a unique integer order and ``op`` one of Put, Append, Get.
All per-key work is cut into blocks of ``width`` consecutive sequence numbers, so that one busy key is shared by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.plans.ordered import (
    sequence_block,
    time_block,
    with_last_seen,
    with_next,
    with_previous,
    with_running_sum,
)
from minewright.plans.lineage import cut_lineage
from minewright.plans.spread import spread_join

# Operation names, the error of a missing key, the ping interval and the number of missed pings that count as dead.
PUT, APPEND, GET = "Put", "Append", "Get"
OK, NO_KEY = "OK", "ErrNoKey"
LOCK, UNLOCK = "Lock", "Unlock"
PING_MILLIS = 100
DEAD_PINGS = 5

BLOCK_WIDTH = 1_000_000
PIECE_BYTES = 4 * 1024 * 1024
BLOCK_SECONDS = 86_400


# ---- key/value state ------------------------------------------------------------------------------------------------


def fold_log(log: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """``(key, piece, value)``: what each key holds after all operations, in pieces to be read in order.

    A Put replaces, an Append adds to the end; what lies before a key's last Put is dropped before anything is
    collected. The value of a key is the concatenation of its pieces; a piece spans ``width`` sequence numbers.
    """
    writes = log.filter(F.col("op").isin(PUT, APPEND)).select("seq", "key", "op", "value")
    puts = writes.filter(F.col("op") == PUT).groupBy("key").agg(F.max("seq").alias("_put"))
    live = spread_join(writes, puts, "key", "left", spread_by=["seq"]).filter(
        F.col("_put").isNull() | (F.col("seq") >= F.col("_put"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("seq", "value")))
    pieces = live.groupBy("key", sequence_block("seq", width).alias("piece")).agg(ordered.alias("_v"))
    return pieces.select("key", "piece", F.array_join(F.col("_v.value"), "").alias("value"))


def get_as_of(log: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """``(seq, key, put_seq, put_value, n_appends, err)`` of every Get: the last Put before it and the Appends since.

    The text read is the Put's value and those Appends; it is named by sequence numbers and not spelled out, since
    spelling it out for each Get grows with the square of a busy key's operations. A key never written gives
    ``ErrNoKey`` and an empty value.
    """
    block = sequence_block("seq", width)
    appended = F.when(F.col("op") == APPEND, 1).otherwise(0).cast("bigint")
    counted = with_running_sum(log.select("seq", "key", "op", "value"), ["key"], ["seq"], block, appended, "_appends")
    put = F.when(F.col("op") == PUT, F.struct("seq", "value", "_appends"))
    seen = with_last_seen(counted, ["key"], ["seq"], block, put, "_put").filter(F.col("op") == GET)
    since = F.col("_appends") - F.coalesce(F.col("_put._appends"), F.lit(0))
    known = F.col("_put").isNotNull() | (since > 0)
    return seen.select(
        "seq",
        "key",
        F.col("_put.seq").alias("put_seq"),
        F.coalesce(F.col("_put.value"), F.lit("")).alias("put_value"),
        since.alias("n_appends"),
        F.when(known, F.lit(OK)).otherwise(F.lit(NO_KEY)).alias("err"),
    )


def read_values(
    log: DataFrame, reads: DataFrame, piece_bytes: int = PIECE_BYTES, width: int = BLOCK_WIDTH
) -> DataFrame:
    """``(seq, key, piece, value, err)``: the text that each Get of ``reads`` (a column ``seq``) saw, in pieces.

    The writes of a key since a Put are cut into pieces by running length (bytes, and one more a write), written down
    once, and a read meets the pieces up to its own place. A piece holds at most ``piece_bytes`` and one write, so a
    long value is never in one row; the pieces of a read, in order, are its text. The output is as long as the texts
    asked for; numbers at which no write begins are left out. A read before any write gives one empty piece and ``ErrNoKey``; a ``seq`` that is no Get gives nothing,
    one named twice counts once. Null keys are a key of their own; a null value is empty.
    """
    wanted = reads.select("seq").distinct()
    asked = log.filter(F.col("op") == GET).select("seq", F.struct("key").alias("_k")).join(wanted, "seq", "left_semi")
    writes = log.filter(F.col("op").isin(PUT, APPEND)).select(
        "seq", F.struct("key").alias("_k"), "op", F.coalesce("value", F.lit("")).alias("value")
    )
    writes = spread_join(writes, asked.select("_k").distinct(), "_k", "left_semi", spread_by=["seq"])
    size = F.coalesce(F.octet_length("value") + 1, F.lit(0)).cast("bigint")
    rows = writes.unionByName(asked, allowMissingColumns=True)
    block = sequence_block("seq", width)
    summed = with_running_sum(rows, ["_k"], ["seq"], block, size, "_end").withColumn("_start", F.col("_end") - size)
    put = F.when(F.col("op") == PUT, F.col("_start"))
    since = with_last_seen(summed, ["_k"], ["seq"], block, put, "_from").withColumn("_from", F.coalesce("_from", F.lit(0)))
    placed = cut_lineage(since.withColumn("_at", F.col("_start") - F.col("_from")).drop("_start", "_end"))
    piece = F.floor(F.col("_at") / F.lit(piece_bytes)).cast("bigint").alias("piece")
    pieces = (
        placed.filter(F.col("op").isNotNull())
        .groupBy("_k", "_from", piece)
        .agg(F.array_sort(F.collect_list(F.struct("seq", "value"))).alias("_writes"))
    )
    last = F.floor(F.greatest(F.col("_at") - 1, F.lit(0)) / F.lit(piece_bytes)).cast("bigint")
    spans = placed.filter(F.col("op").isNull()).select(
        "seq", "_k", "_from", "_at", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece")
    )
    met = spread_join(spans, pieces, ["_k", "_from", "piece"], "left", spread_by=["seq"])
    met = met.withColumn("_seen", F.filter("_writes", lambda w: w["seq"] < F.col("seq")))
    # A write longer than what is left of its piece reaches into numbers at which no write begins: no rows for these.
    met = met.filter((F.size("_seen") > 0) | (F.col("_at") == 0))
    return met.select(
        "seq",
        F.col("_k.key").alias("key"),
        "piece",
        F.coalesce(F.array_join(F.transform("_seen", lambda w: w["value"]), ""), F.lit("")).alias("value"),
        F.when(F.col("_at") > 0, F.lit(OK)).otherwise(F.lit(NO_KEY)).alias("err"),
    )


def dedup_requests(log: DataFrame, request: Sequence[str] = ("client", "req"), order: str = "seq") -> DataFrame:
    """The first row of every request; repeats are dropped on the map side already."""
    others = [c for c in log.columns if c not in request]
    first = log.groupBy(*request).agg(F.min_by(F.struct(*others), order).alias("_first"))
    return first.select(*[F.col(c) if c in request else F.col(f"_first.{c}").alias(c) for c in log.columns])


def check_appends(sent: DataFrame, stored: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """``(client, n_sent, n_missing, n_duplicated, n_disordered)`` of ``(client, req)`` against ``(client, req, pos)``.

    A request must be stored once, and its first position must come after that of the client's last stored request
    before it.
    """
    found = stored.groupBy("client", "req").agg(F.min("pos").alias("_pos"), F.count(F.lit(1)).alias("_n"))
    joined = sent.select("client", "req").distinct().join(found, ["client", "req"], "left")
    placed = joined.filter(F.col("_pos").isNotNull())
    ordered = with_previous(placed, ["client"], ["req"], sequence_block("req", width), {"_before": "_pos"})
    ordered = ordered.unionByName(joined.filter(F.col("_pos").isNull()), allowMissingColumns=True)
    return ordered.groupBy("client").agg(
        F.count(F.lit(1)).alias("n_sent"),
        F.count(F.when(F.col("_pos").isNull(), 1)).alias("n_missing"),
        F.count(F.when(F.col("_n") > 1, 1)).alias("n_duplicated"),
        F.count(F.when(F.col("_pos") <= F.col("_before"), 1)).alias("n_disordered"),
    )


# ---- locks ----------------------------------------------------------------------------------------------------------


def lock_history(log: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """Add ``granted`` to ``(seq, name, op)``: Lock when free, Unlock when held.

    After a Lock the lock is held and after an Unlock it is free, whatever it was before, so the operation before decides.
    """
    before = with_previous(log, ["name"], ["seq"], sequence_block("seq", width), {"_before": "op"})
    held = F.coalesce(F.col("_before") == LOCK, F.lit(False))
    granted = F.when(F.col("op") == LOCK, ~held).otherwise(held)
    return before.withColumn("granted", granted).drop("_before")


def lock_intervals(log: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """``(name, locked_at, unlocked_at)`` of every granted Lock; an open one has no end."""
    granted = lock_history(log, width).filter("granted").select("seq", "name", "op")
    paired = with_next(granted, ["name"], ["seq"], sequence_block("seq", width), {"_next": "seq"})
    return paired.filter(F.col("op") == LOCK).select(
        "name", F.col("seq").alias("locked_at"), F.col("_next").alias("unlocked_at")
    )


# ---- liveness -------------------------------------------------------------------------------------------------------


def ping_gaps(
    pings: DataFrame,
    interval_millis: int = PING_MILLIS,
    dead_pings: int = DEAD_PINGS,
    block_seconds: int = BLOCK_SECONDS,
    as_of: Column | None = None,
) -> DataFrame:
    """``(server, last_ping, dead_from, back_at)``: times in which a server missed ``dead_pings`` pings in a row.

    A server that is still down at ``as_of`` (by default the latest ``ts`` of all pings) has no ``back_at``.
    """
    limit = interval_millis * dead_pings * 1000
    pings = pings.select("server", "ts")
    now = pings.agg(F.max("ts")).scalar() if as_of is None else as_of
    returned = _with_last_ping(pings, block_seconds)
    last = pings.groupBy("server").agg(F.max("ts").alias("_before"))
    still = last.withColumn("ts", F.lit(None).cast(pings.schema["ts"].dataType)).withColumn("_until", now)
    both = returned.select("server", "_before", "ts", F.col("ts").alias("_until")).unionByName(still)
    gap = F.unix_micros(F.col("_until").cast("timestamp")) - F.unix_micros(F.col("_before").cast("timestamp"))
    return both.filter(gap > limit).select(
        "server",
        F.col("_before").alias("last_ping"),
        (F.col("_before") + F.make_dt_interval(secs=F.lit(limit / 1_000_000))).alias("dead_from"),
        F.col("ts").alias("back_at"),
    )


def _with_last_ping(pings: DataFrame, block_seconds: int) -> DataFrame:
    return with_previous(pings, ["server"], ["ts"], time_block("ts", block_seconds), {"_before": "ts"})


def sessions(pings: DataFrame, gap_seconds: float, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """``(server, start, end, n)``: runs of pings that are at most ``gap_seconds`` apart."""
    before = _with_last_ping(pings.select("server", "ts"), block_seconds)
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("_before").cast("timestamp"))
    opens = F.when(F.col("_before").isNull() | (gap > int(gap_seconds * 1_000_000)), 1).otherwise(0)
    block = time_block("ts", block_seconds)
    numbered = with_running_sum(before, ["server"], ["ts"], block, opens.cast("bigint"), "_session")
    return numbered.groupBy("server", "_session").agg(
        F.min("ts").alias("start"), F.max("ts").alias("end"), F.count(F.lit(1)).alias("n")
    ).drop("_session")


# ---- shards ---------------------------------------------------------------------------------------------------------


def shard_load(df: DataFrame, shard: Column) -> DataFrame:
    """``(shard, cnt)``: rows a shard."""
    return df.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("cnt"))


def config_as_of(configs: DataFrame, num: int = -1) -> DataFrame:
    """``(shard, gid)`` of configuration ``num`` of ``(num, shard, gid)``; -1, or a number not yet reached, is the latest."""
    known = configs if num < 0 else configs.filter(F.col("num") <= num)
    return known.groupBy("shard").agg(F.max_by("gid", "num").alias("gid"))


def shard_balance_audit(config: DataFrame, groups: DataFrame) -> DataFrame:
    """One row ``(n_invalid, min_shards, max_shards, balanced)`` of ``(shard, gid)`` against ``(gid)``.

    Shards must be on known groups, and counts a group (0 for a group without shards) may differ by one.
    """
    invalid = config.join(groups, "gid", "left_anti").agg(F.count(F.lit(1)).alias("n_invalid"))
    held = config.groupBy("gid").agg(F.count(F.lit(1)).alias("_n"))
    spread = groups.select("gid").distinct().join(held, "gid", "left").agg(
        F.min(F.coalesce("_n", F.lit(0))).alias("min_shards"), F.max(F.coalesce("_n", F.lit(0))).alias("max_shards")
    )
    audited = spread.withColumn("n_invalid", invalid.scalar())
    balanced = (F.col("n_invalid") == 0) & (F.col("max_shards") - F.col("min_shards") <= 1)
    return audited.select("n_invalid", "min_shards", "max_shards", balanced.alias("balanced"))
