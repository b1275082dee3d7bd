import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from minewright.plans.lineage import ensure_checkpoint_dir
from minewright.plans.numbering import with_dense_id
from minewright.plans.ordered import sequence_block, with_last_seen, with_next, with_previous, with_running_sum
from minewright.plans.spread import hot_keys, spread_join
from minewright.operators.corpus import word_rows
from minewright.operators.topics import token_rows
from minewright.plans import spread
from minewright.plans.spread import unnested


@pytest.fixture(scope="module")
def log(spark):
    """One key holds most rows; sequence numbers have gaps, so some blocks of a key are empty."""
    rng = random.Random(1)
    data = [
        (seq, "hot" if rng.random() < 0.6 else rng.choice("abc"), rng.choice([None, 1, 2, 3]))
        for seq in sorted(rng.sample(range(1000), 300))
    ]
    return spark.createDataFrame(data, "seq bigint, key string, v int").repartition(5), data


def by_key(data):
    grouped = defaultdict(list)
    for row in data:
        grouped[row[1]].append(row)
    return grouped


@pytest.mark.parametrize("width", [7, 100, 10_000])
def test_previous_and_next_cross_blocks(log, width):
    df, data = log
    block = sequence_block("seq", width)
    got = with_previous(df, ["key"], ["seq"], block, {"p": "seq", "pv": "v"})
    got = with_next(got, ["key"], ["seq"], block, {"n": "seq"})
    wanted = []
    for group in by_key(data).values():
        for i, (seq, _, _) in enumerate(group):
            before = group[i - 1] if i else (None, None, None)
            after = group[i + 1][0] if i + 1 < len(group) else None
            wanted.append((seq, before[0], before[2], after))
    assert sorted(wanted) == rows(got, "seq", "p", "pv", "n")


@pytest.mark.parametrize("width", [7, 10_000])
def test_last_seen_and_running_sum_cross_blocks(log, width):
    df, data = log
    block = sequence_block("seq", width)
    got = with_last_seen(df, ["key"], ["seq"], block, F.col("v"), "seen")
    got = with_running_sum(got, ["key"], ["seq"], block, F.coalesce("v", F.lit(0)), "total")
    wanted = []
    for group in by_key(data).values():
        seen, total = None, 0
        for seq, _, v in group:
            seen, total = (seen if v is None else v), total + (v or 0)
            wanted.append((seq, seen, total))
    assert sorted(wanted) == rows(got, "seq", "seen", "total")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, no_broadcast, log, how):
    df, _ = log
    lookup = spark.createDataFrame([("hot", 1), ("a", 2), ("a", 3), ("z", 4)], "key string, w int")
    plain = df.join(lookup, "key", how)
    salted = spread_join(df, lookup, "key", how, spread_by=["seq"], rows_per_task=20)
    assert salted.columns == plain.columns
    assert rows(salted.na.fill(-1), *plain.columns) == rows(plain.na.fill(-1), *plain.columns)
    assert {r["key"]: r["_parts"] for r in hot_keys(df, ["key"], 20).collect()}["hot"] > 5


@pytest.mark.parametrize("partitions", [1, 6])
def test_dense_ids_follow_the_order(spark, partitions):
    df = spark.range(0, 5000, 7).repartition(partitions)
    got = with_dense_id(df, [F.desc("id")], "n", start=1).orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, len(got) + 1))
    assert [r["id"] for r in got] == sorted((r["id"] for r in got), reverse=True)


def test_checkpoint_dir_is_kept(spark):
    first = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == first


def test_unnested_array_is_not_computed_below_the_exchange(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, ""), (3, None), (4, "c")], "doc_id bigint, text string")
    wide = docs.repartition(3, "doc_id").withColumn("tokens", F.transform(F.split("text", " "), F.upper))
    rows_of = unnested(wide, "tokens", "term", "doc_id", pos="pos")
    assert sorted(map(tuple, rows_of.collect())) == [(1, 0, "A"), (1, 1, "B"), (2, 0, ""), (4, 0, "C")]
    plan = rows_of._jdf.queryExecution().optimizedPlan().toString()
    assert "upper" not in plan[plan.index("RepartitionByExpression") :].lower()
    assert token_rows(wide).columns == ["doc_id", "pos", "term"] and word_rows(wide.select(F.col("doc_id").alias("sent_id"), F.col("tokens").alias("words"))).count() == 4


def test_large_scan_of_one_row_group_is_spread(spark, tmp_path, monkeypatch):
    spark.range(4000).coalesce(1).write.parquet(f"{tmp_path}/one")
    monkeypatch.setattr(spread, "SMALL_SCAN_BYTES", 1000)
    read = spark.read.parquet(f"{tmp_path}/one")
    assert spread.estimated_bytes(read) >= 4 * 1000
    spread_rows = spread.widen(read, "id", 4000).groupBy(F.spark_partition_id()).count().collect()
    assert len(spread_rows) > 4 and sum(r["count"] for r in spread_rows) == 4000
