"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single task may take before the key is split. The list of split keys holds at most
# (rows / ROWS_PER_TASK) entries, which is what makes it safe to broadcast.
ROWS_PER_TASK = 4_000_000
# Scanned bytes a core below which spreading the rows costs less than idle cores.
SMALL_SCAN_BYTES = 16 * 1024 * 1024
# Scanned bytes of one task above which they are spread, however large the scan: twice what Spark gives a task unless a row
# group is larger.
LARGE_TASK_BYTES = 16 * SMALL_SCAN_BYTES


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame, without running it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except ValueError:  # more digits than Python converts
        return sys.maxsize


def fits_broadcast(df: DataFrame) -> bool:
    """True when Catalyst's estimate is below the session's broadcast threshold."""
    setting = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    if setting.startswith("-"):
        return False
    limit = int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting))
    return estimated_bytes(df) <= limit


def widen(df: DataFrame, key: str, large_task_bytes: int | None = None) -> DataFrame:
    """Hash a scan too small to occupy every core over all cores; larger inputs are left as they are split.

    Meant for costly row-wise work (tokenising, decoding): a row group is one task, whatever its size. With
    ``large_task_bytes`` a larger input is spread too if one task scans more; the rows of the tasks are counted without
    reading a column.
    """
    cores, scanned = df.sparkSession.sparkContext.defaultParallelism, estimated_bytes(df)
    if scanned >= cores * SMALL_SCAN_BYTES:
        if large_task_bytes is None:
            return df
        counts = df.groupBy(F.spark_partition_id().alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
        most, total = counts.agg(F.max("_n"), F.sum("_n")).first()
        if not total or scanned * most / total <= large_task_bytes:
            return df
    return df.repartition(max(cores, -(-scanned // SMALL_SCAN_BYTES)), key)


def unnested(df: DataFrame, array: Column | str, name: str, *others: str, pos: str | None = None) -> DataFrame:
    """``(others..., pos, name)``: one row an element of ``array``.

    The explode is an outer one and the rows of empty arrays go after it. For an inner one Catalyst infers a filter on the
    array's size and pushes it through ``widen`` to the scan, where the array is computed a second time, in one task a row
    group.
    """
    place = pos or "_pos"
    rows = df.select(*others, F.posexplode_outer(array).alias(place, name)).filter(F.col(place).isNotNull())
    return rows if pos else rows.drop(place)


def hot_keys(df: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and the number of parts each should be split into."""
    return (
        df.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_task)
        .select(*on, F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias("_parts"))
    )


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str] | str,
    how: str = "inner",
    *,
    spread_by: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``big`` to ``small`` on equal keys; hot keys of ``big`` are salted, their ``small`` rows copied.

    ``spread_by`` names columns of ``big`` that tell rows of one key apart; the salt is their hash, so a task that
    is run again assigns the same salts. Every row of the plain join appears exactly once. When Catalyst already
    knows that ``small`` is under the broadcast threshold the plain join is returned: it has no shuffle of ``big``.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"unsupported join type {how}")
    if fits_broadcast(small):
        return big.join(small, on, how)
    hot = F.broadcast(hot_keys(big, on, rows_per_task))
    salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_parts")).cast("int"), F.lit(0))
    left = big.join(hot, on, "left").withColumn("_salt", salt).drop("_parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    right = small.join(hot, on, "left").withColumn("_salt", copies).drop("_parts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
