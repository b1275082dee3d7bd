import random
from itertools import combinations

import pytest
from conftest import rows

from minewright.operators import itemsets as ops
from minewright.sinks import itemset_lines


def brute(baskets, support):
    n, items = len(baskets), sorted({i for b in baskets for i in b})
    levels = []
    for size in range(1, len(items) + 1):
        level = {}
        for combo in combinations(items, size):
            cnt = sum(set(combo) <= b for b in baskets)
            if cnt >= support * n:
                level[combo] = cnt
        if not level:
            break
        levels.append(level)
    return levels


@pytest.fixture(scope="module")
def random_baskets(spark):
    rng = random.Random(3)
    sets = [{i for i in range(9) if rng.random() < 0.2 + 0.07 * i} for _ in range(120)]
    data = [(t, item) for t, s in enumerate(sets) for item in s for _ in range(rng.choice([1, 2]))]
    kept = [s for s in sets if s]
    frame = spark.createDataFrame(data, "t bigint, item int")
    return ops.baskets_from_rows(frame, "t", "item"), kept


@pytest.mark.parametrize("support", [0.15, 0.3, 0.6])
def test_levels_match_enumeration(random_baskets, support):
    baskets, sets = random_baskets
    levels = brute(sets, support)
    everything = {k: v for level in levels for k, v in level.items()}
    got = {tuple(r["items"]): r["cnt"] for r in ops.levelwise_itemsets(baskets, support).collect()}
    assert got == everything
    top = {tuple(r["items"]): r["cnt"] for r in ops.maximal_level_itemsets(baskets, support).collect()}
    assert top == levels[-1]
    fp = {tuple(r["items"]): r["cnt"] for r in ops.all_frequent_itemsets(baskets, support).collect()}
    assert fp == everything


def test_counting_without_broadcast_and_with_hot_items(spark, no_broadcast, random_baskets, monkeypatch):
    baskets, sets = random_baskets
    monkeypatch.setattr(ops, "BROADCAST_CANDIDATES", 0)
    monkeypatch.setattr(ops, "LITERAL_ITEMS", 0)
    got = {tuple(r["items"]): r["cnt"] for r in ops.frequent_level(baskets, 3, 0.15).collect()}
    assert got == brute(sets, 0.15)[2]


def test_bit_sets_count_as_the_join_does(spark, random_baskets, monkeypatch):
    baskets, sets = random_baskets
    monkeypatch.setattr(ops, "BITSET_ROWS", 5)
    for size in (2, 3):
        candidates = ops.candidate_itemsets(ops.frequent_level(baskets, size - 1, 0.15), size).cache()
        counted = [rows(c, "items", "cnt") for c in (ops.count_by_bitsets(baskets.repartition(3), candidates, size), ops.count_candidates(baskets, candidates))]
        assert counted[0] == counted[1] and len(counted[0]) > 5
    monkeypatch.setattr(ops, "BITSET_CANDIDATES", 0)
    for limit in (0, 500_000):
        monkeypatch.setattr(ops, "BROADCAST_CANDIDATES", limit)
        got = {tuple(r["items"]): r["cnt"] for r in ops.frequent_level(baskets, 3, 0.15).collect()}
        assert got == brute(sets, 0.15)[2]


def test_repeated_item_counts_once_a_basket(spark):
    baskets = ops.baskets_from_rows(spark.createDataFrame([(0, 1), (0, 1), (0, 2), (1, 1)], "t int, i int"), "t", "i")
    assert rows(ops.item_counts(baskets), "item", "cnt") == [(1, 2), (2, 1)]


def test_support_is_inclusive_and_empty_result_keeps_the_schema(spark):
    baskets = spark.createDataFrame([(0, [1, 2]), (1, [1]), (2, [3])], "txn_id bigint, items array<int>")
    assert rows(ops.frequent_items(baskets, 2 / 3), "items", "cnt") == [([1], 2)]
    assert ops.maximal_level_itemsets(baskets, 0.9).collect() == []
    lines = itemset_lines(ops.maximal_level_itemsets(baskets, 1 / 3))
    assert [r["line"].split("\t")[0] for r in lines.collect()] == ["{1,2}"]
