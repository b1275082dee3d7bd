"""Itemset queries: brands a customer bought (dense baskets) and part types in an order (sparse baskets)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.catalog.registry import query, table
from minewright.operators import itemsets as ops
from minewright.plans.spread import spread_join
from minewright.sinks import itemset_lines

DENSE_SUPPORT = 0.5
SPARSE_SUPPORT = 0.2


def dense_baskets(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    named = spread_join(lines, parts, "l_partkey", spread_by=["l_orderkey", "l_linenumber"])
    sold = spread_join(named, orders, "l_orderkey", spread_by=["l_linenumber"])
    return ops.baskets_from_rows(sold, "o_custkey", "p_brand")


def sparse_baskets(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    sold = spread_join(lines, parts, "l_partkey", spread_by=["l_orderkey", "l_linenumber"])
    return ops.baskets_from_rows(sold, "l_orderkey", "p_type")


_DENSE = """b AS (
  SELECT DISTINCT o_custkey AS txn, p_brand AS item
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
_SPARSE = """b AS (
  SELECT DISTINCT l_orderkey AS txn, p_type AS item FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _with_levels(baskets: str, support: float, depth: int) -> str:
    """WITH clause giving ``f1 .. f<depth>``, the frequent sets of each size by joining a basket to itself."""
    parts = [baskets, "n AS (SELECT count(DISTINCT txn) AS n FROM b)"]
    for size in range(1, depth + 1):
        names = ", ".join(f"x{i}.item AS i{i}" for i in range(1, size + 1))
        keys = ", ".join(f"x{i}.item" for i in range(1, size + 1))
        joins = "".join(
            f" JOIN b x{i} ON x{i}.txn = x1.txn AND x{i}.item > x{i - 1}.item" for i in range(2, size + 1)
        )
        parts.append(
            f"f{size} AS (SELECT {names}, count(*) AS cnt FROM b x1{joins} GROUP BY {keys}"
            f" HAVING count(*) >= {support} * (SELECT n FROM n))"
        )
    return "WITH " + ",\n".join(parts)


def _rows(size: int) -> str:
    items = " || ',' || ".join(f"i{i}" for i in range(1, size + 1))
    return f"SELECT {items} AS items, cnt, round(cnt / (SELECT n FROM n), 6) AS support, {size} AS size FROM f{size}"


def _last_level(depth: int) -> str:
    union = " UNION ALL ".join(_rows(size) for size in range(1, depth + 1))
    return f", u AS ({union}) SELECT items, cnt, support FROM u WHERE size = (SELECT max(size) FROM u)"


def _flat(level: DataFrame) -> DataFrame:
    return level.select(F.array_join("items", ",").alias("items"), "cnt", F.round("support", 6).alias("support"))


@query("WITH " + _DENSE + " SELECT item, count(*) AS cnt FROM b GROUP BY item")
def item_counts(spark, sf):
    return ops.item_counts(dense_baskets(spark, sf))


@query("WITH " + _DENSE + " SELECT count(DISTINCT txn) AS n_baskets, max(item) AS max_item FROM b")
def basket_summary(spark, sf):
    return ops.basket_summary(dense_baskets(spark, sf))


@query(_with_levels(_DENSE, DENSE_SUPPORT, 1) + " SELECT items, cnt, support FROM (" + _rows(1) + ")")
def frequent_items(spark, sf):
    return _flat(ops.frequent_level(dense_baskets(spark, sf), 1, DENSE_SUPPORT))


@query(_with_levels(_DENSE, DENSE_SUPPORT, 1) + " SELECT a.i1 || ',' || c.i1 AS items FROM f1 a JOIN f1 c ON a.i1 < c.i1")
def candidate_pairs(spark, sf):
    level = ops.frequent_level(dense_baskets(spark, sf), 1, DENSE_SUPPORT)
    return ops.candidate_sets(level, 2).select(F.array_join("items", ",").alias("items"))


@query(
    _with_levels(_DENSE, DENSE_SUPPORT, 2)
    + """
SELECT a.i1 || ',' || a.i2 || ',' || c.i2 AS items
FROM f2 a JOIN f2 c ON a.i1 = c.i1 AND a.i2 < c.i2 JOIN f2 d ON d.i1 = a.i2 AND d.i2 = c.i2"""
)
def candidate_triples(spark, sf):
    level = ops.frequent_level(dense_baskets(spark, sf), 2, DENSE_SUPPORT)
    return ops.candidate_sets(level, 3).select(F.array_join("items", ",").alias("items"))


@query(_with_levels(_DENSE, DENSE_SUPPORT, 2) + " SELECT items, cnt, support FROM (" + _rows(2) + ")")
def frequent_pairs(spark, sf):
    return _flat(ops.frequent_level(dense_baskets(spark, sf), 2, DENSE_SUPPORT))


@query(_with_levels(_DENSE, DENSE_SUPPORT, 3) + " SELECT items, cnt, support FROM (" + _rows(3) + ")")
def frequent_triples(spark, sf):
    return _flat(ops.frequent_level(dense_baskets(spark, sf), 3, DENSE_SUPPORT))


@query(_with_levels(_SPARSE, SPARSE_SUPPORT, 4) + _last_level(4))
def apriori_sparse(spark, sf):
    return _flat(ops.maximal_level_itemsets(sparse_baskets(spark, sf), SPARSE_SUPPORT))


@query(_with_levels(_DENSE, DENSE_SUPPORT, 5) + _last_level(5))
def apriori_dense(spark, sf):
    return _flat(ops.maximal_level_itemsets(dense_baskets(spark, sf), DENSE_SUPPORT))


@query(
    _with_levels(_SPARSE, SPARSE_SUPPORT, 4)
    + " SELECT items, cnt, support FROM ("
    + " UNION ALL ".join(_rows(size) for size in range(1, 5))
    + ")"
)
def fpgrowth_all(spark, sf):
    return _flat(ops.all_frequent_itemsets(sparse_baskets(spark, sf), SPARSE_SUPPORT))


@query(
    _with_levels(_SPARSE, SPARSE_SUPPORT, 4)
    + _last_level(4).replace("SELECT items, cnt, support FROM u", "SELECT '{' || items || '}' AS itemset, support FROM u")
)
def itemset_report(spark, sf):
    lines = itemset_lines(ops.maximal_level_itemsets(sparse_baskets(spark, sf), SPARSE_SUPPORT))
    fields = F.split("line", "\t")
    return lines.select(fields[0].alias("itemset"), F.round(fields[1].cast("double"), 6).alias("support"))
