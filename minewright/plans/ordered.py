"""Ordered per-key computations that never put a whole key into one task.

A key's rows are cut into blocks along the order. Inside a block an ordinary window does the work; what must cross
from block to block is one summary row per (key, block), which a second, far smaller window carries forward. The block
expression must not decrease along the order, so that blocks of one key follow each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "_block"


def _with_carry(
    df: DataFrame, keys: Sequence[str], block: Column, tail: Column, carry: Column, descending: bool = False
) -> DataFrame:
    """Attach ``_carry``: ``carry`` evaluated over the tails of the blocks before (or after) a row's block."""
    blocked = df.withColumn(BLOCK, block)
    order = F.col(BLOCK).desc() if descending else F.col(BLOCK)
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    tails = blocked.groupBy(*keys, BLOCK).agg(tail.alias("_tail"))
    carried = tails.select(*keys, BLOCK, carry.over(before).alias("_carry"))
    names = [*keys, BLOCK]
    right = carried.select(*[F.col(c).alias(f"_right_{c}") for c in names], "_carry")
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in names]
    return blocked.join(right, same).drop(*[f"_right_{c}" for c in names])


def _in_block(keys: Sequence[str], order: Sequence[Column | str]) -> Window:
    return Window.partitionBy(*keys, BLOCK).orderBy(*order)


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, columns: dict[str, str]
) -> DataFrame:
    """Add, for every ``new: column`` pair, the column's value in the preceding row of the same key."""
    row = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    carried = _with_carry(df, keys, block, F.max_by(row, F.struct(*order)), F.last("_tail"))
    previous = F.coalesce(F.lag(row).over(_in_block(keys, order)), F.col("_carry"))
    out = carried.withColumn("_previous", previous)
    return out.select(*df.columns, *[F.col("_previous")[n].alias(n) for n in columns])


def with_next(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, columns: dict[str, str]
) -> DataFrame:
    """Add, for every ``new: column`` pair, the column's value in the following row of the same key."""
    row = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    carried = _with_carry(df, keys, block, F.min_by(row, F.struct(*order)), F.last("_tail"), descending=True)
    following = F.coalesce(F.lead(row).over(_in_block(keys, order)), F.col("_carry"))
    out = carried.withColumn("_next", following)
    return out.select(*df.columns, *[F.col("_next")[n].alias(n) for n in columns])


def with_last_seen(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, value: Column, name: str
) -> DataFrame:
    """Add the latest non-null ``value`` at or before each row of the same key."""
    position = F.when(F.col("_value").isNotNull(), F.struct(*order))
    carried = _with_carry(
        df.withColumn("_value", value),
        keys,
        block,
        F.max_by("_value", position),
        F.last("_tail", ignorenulls=True),
    )
    window = _in_block(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.coalesce(F.last("_value", ignorenulls=True).over(window), F.col("_carry"))
    return carried.withColumn(name, seen).select(*df.columns, name)


def with_running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, value: Column, name: str
) -> DataFrame:
    """Add the running sum of ``value`` up to and including each row of the same key."""
    carried = _with_carry(df.withColumn("_value", value), keys, block, F.sum("_value"), F.sum("_tail"))
    window = _in_block(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("_value").over(window) + F.coalesce(F.col("_carry"), F.lit(0))
    return carried.withColumn(name, total).select(*df.columns, name)


def sequence_block(column: str, width: int) -> Column:
    """Block of an integer sequence: at most ``width`` distinct values a block."""
    return F.floor(F.col(column) / F.lit(width)).cast("bigint")


def time_block(column: str, seconds: int) -> Column:
    """Block of a timestamp: ``seconds`` of time a block."""
    return F.floor(F.unix_micros(F.col(column).cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("bigint")
