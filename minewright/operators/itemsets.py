"""Frequent itemsets, level by level.

Baskets are ``(txn_id, items)`` with ``items`` a sorted array without repeats. Levels are ``(items, cnt, support)``.
The number of frequent items is at most (mean basket size / min_supp), whatever the number of baskets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.plans.lineage import cut_lineage
from minewright.plans.spread import spread_join, widen

# Candidates that may be broadcast to the basket scan; larger sets are joined by shuffle with hot items salted.
BROADCAST_CANDIDATES = 500_000
# Candidates that are counted by bit sets in the basket scan: a task compares each with all its baskets, 64 at a time.
BITSET_CANDIDATES = 20_000
# Candidates whose bit sets are combined at a time.
BITSET_ROWS = 512
# Frequent items that may be written into the plan as a list; with more, baskets keep their infrequent items, which
# then meet no candidate.
LITERAL_ITEMS = 5_000


def baskets_from_rows(rows: DataFrame, txn: str, item: str) -> DataFrame:
    """Baskets from ``(txn, item)`` rows; repeats are dropped on the map side by the set aggregate."""
    return rows.groupBy(F.col(txn).alias("txn_id")).agg(F.array_sort(F.collect_set(item)).alias("items"))


def item_counts(baskets: DataFrame) -> DataFrame:
    """``(item, cnt)``: number of baskets with each item."""
    return baskets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("cnt"))


def basket_summary(baskets: DataFrame) -> DataFrame:
    """One row ``(n_baskets, max_item)``."""
    return baskets.agg(F.count(F.lit(1)).alias("n_baskets"), F.max(F.array_max("items")).alias("max_item"))


def min_support_filter(counts: DataFrame, n_baskets: int | Column, min_supp: float = 0.8) -> DataFrame:
    """Rows with ``cnt >= min_supp * n_baskets`` and their support."""
    n = n_baskets if isinstance(n_baskets, Column) else F.lit(n_baskets)
    return counts.filter(F.col("cnt") >= F.lit(float(min_supp)) * n).withColumn("support", F.col("cnt") / n)


def frequent_items(baskets: DataFrame, min_supp: float = 0.8, n_baskets: int | None = None) -> DataFrame:
    """Level 1: ``(items, cnt, support)`` with one item an array."""
    n = baskets.count() if n_baskets is None else n_baskets
    return min_support_filter(item_counts(baskets), n, min_supp).select(
        F.array("item").alias("items"), "cnt", "support"
    )


def candidate_itemsets(level: DataFrame, size: int) -> DataFrame:
    """``(prefix, last)`` of every ``size``-set whose subsets of ``size - 1`` items are all in ``level``.

    Two sets of the level join when they agree on all but their last item, so each candidate comes up once. The
    remaining subsets are looked up in the level by semi-joins.
    """
    shared = F.slice("items", 1, size - 2)
    left = level.select(shared.alias("_shared"), F.col("items").alias("prefix"))
    right = level.select(shared.alias("_shared"), F.element_at("items", -1).alias("last"))
    pairs = left.join(right, "_shared").filter(F.element_at("prefix", -1) < F.col("last")).drop("_shared")
    known = level.select(F.col("items").alias("_subset"))
    for position in range(1, size - 1):
        kept = F.concat(F.slice("prefix", 1, position - 1), F.slice("prefix", position + 1, size - 1 - position),
                        F.array("last"))
        pairs = pairs.withColumn("_subset", kept).join(known, "_subset", "left_semi").drop("_subset")
    return pairs


def candidate_sets(level: DataFrame, size: int) -> DataFrame:
    """The candidates as ``(items)``."""
    return candidate_itemsets(level, size).select(F.concat("prefix", F.array("last")).alias("items"))


def count_candidates(baskets: DataFrame, candidates: DataFrame, broadcast: bool = False) -> DataFrame:
    """``(items, cnt)``: number of baskets holding each candidate ``(prefix, last)``.

    Candidates of one prefix form a class. A basket meets the classes of its own items only, keeps those whose prefix
    it holds, and adds one to each extension it holds; the counts are combined before the shuffle.
    """
    classes = (
        candidates.groupBy("prefix")
        .agg(F.collect_list("last").alias("_extensions"))
        .withColumn("_first", F.col("prefix")[0])
    )
    firsts = baskets.filter(F.size("items") > 1).select("txn_id", "items", F.explode("items").alias("_first"))
    if broadcast:
        met = firsts.join(F.broadcast(classes), "_first")
    else:
        met = spread_join(firsts, classes, "_first", spread_by=["txn_id"])
    held = met.filter(F.expr("forall(prefix, p -> array_contains(items, p))"))
    found = held.select("prefix", F.explode(F.array_intersect("_extensions", "items")).alias("last"))
    return (
        found.groupBy("prefix", "last")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.concat("prefix", F.array("last")).alias("items"), "cnt")
    )


def count_by_bitsets(baskets: DataFrame, candidates: DataFrame, size: int) -> DataFrame:
    """The counts of ``count_candidates`` for a bounded number of candidates, without a row for a basket and candidate.

    A task turns a batch of baskets to one bit set an item, and a candidate's count is the number of bits that the sets of
    its items share. It hands over one row a candidate.
    """
    sets = candidates.select(F.concat("prefix", F.array("last")).alias("items")).toArrow().column("items").combine_chunks()
    names = sets.flatten().unique()
    codes = pc.index_in(sets.flatten(), names).to_numpy().reshape(-1, size)
    shared = baskets.sparkSession.sparkContext.broadcast((sets, names, codes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, names, codes = shared.value
        counts = np.zeros(len(codes), np.int64)
        for batch in batches:
            lists = batch.column("items")
            found = pc.index_in(lists.flatten().cast(names.type), names)
            known = found.is_valid().to_numpy(zero_copy_only=False)
            basket = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
            held = np.zeros((len(names), -(-len(lists) // 64) * 64), bool)
            held[found.drop_null().to_numpy(), basket[known]] = True
            bits = np.packbits(held, axis=1).view(np.uint64)
            for start in range(0, len(codes), BITSET_ROWS):
                part = codes[start : start + BITSET_ROWS]
                common = bits[part[:, 0]]
                for column in part.T[1:]:
                    common &= bits[column]
                counts[start : start + BITSET_ROWS] += np.bitwise_count(common).sum(1, dtype=np.int64)
        at = np.flatnonzero(counts)
        if len(at):
            yield pa.RecordBatch.from_pydict({"items": sets.take(pa.array(at)), "cnt": pa.array(counts[at])})

    kind = baskets.schema["items"].dataType.simpleString()
    counted = baskets.select("items").mapInArrow(count, f"items {kind}, cnt bigint")
    return counted.groupBy("items").agg(F.sum("cnt").alias("cnt"))


def frequent_level(baskets: DataFrame, size: int, min_supp: float = 0.8) -> DataFrame:
    """The frequent sets of exactly ``size`` items."""
    for level_size, level in _levels(baskets, min_supp, size):
        if level_size == size:
            return level
    return level.limit(0)


def _levels(baskets: DataFrame, min_supp: float, max_size: int | None = None):
    """Yield ``(size, level)`` for every non-empty level; baskets and levels are written once each."""
    baskets = widen(cut_lineage(baskets), "txn_id")
    n = baskets.count()
    level = cut_lineage(frequent_items(baskets, min_supp, n))
    n_items = n_level = level.count()
    kept = level.select(F.col("items")[0].alias("item"))
    size = 1
    while n_level:
        yield size, level
        size += 1
        if max_size is not None and size > max_size:
            return
        if size == 2:
            baskets = _restrict(baskets, kept, n_items)
        candidates = cut_lineage(candidate_itemsets(level, size))
        if candidates.count() <= BITSET_CANDIDATES:
            counted = count_by_bitsets(baskets, candidates, size)
        else:
            counted = count_candidates(baskets, candidates, broadcast=n_level * n_items <= BROADCAST_CANDIDATES)
        level = cut_lineage(min_support_filter(counted, n, min_supp))
        n_level = level.count()


def _restrict(baskets: DataFrame, kept: DataFrame, n_items: int) -> DataFrame:
    """Drop infrequent items from the baskets while the list of frequent ones is short enough to be a literal."""
    if n_items > LITERAL_ITEMS:
        return baskets
    frequent = [row["item"] for row in kept.collect()]
    return baskets.select("txn_id", F.filter("items", lambda x: x.isin(*frequent)).alias("items"))


def maximal_level_itemsets(baskets: DataFrame, min_supp: float = 0.8) -> DataFrame:
    """The last non-empty level, by falling count."""
    level = None
    for _, level in _levels(baskets, min_supp):
        pass
    if level is None:
        return frequent_items(baskets, min_supp)
    return level.orderBy(F.desc("cnt"), "items")


def levelwise_itemsets(baskets: DataFrame, min_supp: float = 0.8) -> DataFrame:
    """All levels together."""
    result = None
    for _, level in _levels(baskets, min_supp):
        result = level if result is None else result.unionByName(level)
    return frequent_items(baskets, min_supp) if result is None else result


def all_frequent_itemsets(baskets: DataFrame, min_supp: float = 0.8) -> DataFrame:
    """All levels by parallel FP-growth, which shards the baskets by item; same support rule."""
    n = baskets.count()
    model = FPGrowth(itemsCol="items", minSupport=min_supp).fit(baskets)
    counts = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("cnt"))
    return min_support_filter(counts, n, min_supp)
