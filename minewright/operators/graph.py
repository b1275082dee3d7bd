"""Neighbour graphs: undirected edges ``(src, dst, w)`` held in both directions, components, shortest paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.operators.vectors import NeighbourIndex, knn, knn_indexed
from minewright.plans.lineage import cut_lineage, release
from minewright.plans.spread import ROWS_PER_TASK, spread_join


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, each once, with its smallest weight."""
    swapped = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    both = edges.select("src", "dst", "w").unionByName(swapped).filter(F.col("src") != F.col("dst"))
    return both.groupBy("src", "dst").agg(F.min("w").alias("w"))


def ranked_edges(
    vectors: DataFrame, k: int, index: NeighbourIndex | None = None, probes: int = 8, **options
) -> DataFrame:
    """``(src, dst, w, rank)``: each vector's ``k`` nearest others with their Euclidean distance.

    With an ``index`` of the vectors the neighbours are those that it finds.
    """
    if index is None:
        near = knn(vectors, vectors, k, exclude_self=True, **options)
    else:
        near = knn_indexed(vectors, index, k, probes, exclude_self=True, **options)
    return near.select(
        F.col("query_id").alias("src"), F.col("base_id").alias("dst"), F.sqrt("dist2").alias("w"), "rank"
    )


def knn_graph(vectors: DataFrame, k: int, **options) -> DataFrame:
    """Undirected graph in which each vector is linked to its ``k`` nearest others."""
    return undirected(ranked_edges(vectors, k, **options))


def components(
    nodes: DataFrame, edges: DataFrame, max_rounds: int = 100, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``(id, component)`` with the smallest id of each connected component.

    Every round takes the smallest label among the neighbours and then the label of that label, so that labels travel
    twice as far each time. Hub nodes and the giant component's label are hot keys of these joins and are salted.
    """
    labels = previous = cut_lineage(nodes.select("id", F.col("id").alias("component")))
    edges = cut_lineage(edges.select("src", "dst"))
    for _ in range(max_rounds):
        of_source = labels.select(F.col("id").alias("src"), F.col("component").alias("_seen"))
        offers = (
            spread_join(edges, of_source, "src", spread_by=["dst"], rows_per_task=rows_per_task)
            .groupBy(F.col("dst").alias("id"))
            .agg(F.min("_seen").alias("_seen"))
        )
        lowered = labels.join(offers, "id", "left").select(
            "id", F.col("component").alias("_old"), F.least("component", F.coalesce("_seen", "component")).alias("_via")
        )
        lookup = lowered.select(F.col("id").alias("_via"), F.col("_via").alias("_further"))
        jumped = spread_join(lowered, lookup, "_via", spread_by=["id"], rows_per_task=rows_per_task)
        state = cut_lineage(jumped.select("id", F.least("_via", "_further").alias("component"), "_old"))
        release(previous)
        labels, previous = state.select("id", "component"), state
        if state.filter(F.col("component") != F.col("_old")).isEmpty():
            release(edges)
            return labels
    raise RuntimeError(f"labels still change after {max_rounds} rounds")


def is_connected(nodes: DataFrame, edges: DataFrame) -> tuple[bool, int]:
    """Whether one component holds every node, and how many nodes lie outside the one of the smallest id."""
    labels = components(nodes, edges)
    first = labels.agg(F.min("component").alias("_m")).scalar()
    unreached = labels.filter(F.col("component") != first).count()
    return unreached == 0, unreached


def bottleneck_rank(nodes: DataFrame, ranked: DataFrame, start: int) -> int | None:
    """The smallest ``k >= start`` for which the edges of ``rank <= k`` connect all nodes; None if none does.

    It is the largest rank in a spanning tree of least ranks (Boruvka): every part of the graph takes its link of the least
    rank, parts that links join become one, and links inside a part go. The number of parts at least halves each round.
    """
    labels = components(nodes, undirected(ranked.filter(F.col("rank") <= start)))
    parts = cut_lineage(labels.select(F.col("component").alias("id")).distinct())
    of_source = labels.select(F.col("id").alias("src"), F.col("component").alias("a"))
    of_target = labels.select(F.col("id").alias("dst"), F.col("component").alias("b"))
    named = spread_join(ranked.filter(F.col("rank") > start), of_source, "src", spread_by=["dst"])
    links = cut_lineage(_least_links(spread_join(named, of_target, "dst", spread_by=["src"])))
    k, count = start, parts.count()
    while count > 1:
        best = cut_lineage(links.groupBy("a").agg(F.min(F.struct("rank", "b")).alias("_l")).select("a", "_l.rank", "_l.b"))
        found = best.agg(F.count(F.lit(1)), F.max("rank")).first()
        if found[0] < count:
            return None
        k = max(k, found[1])
        joined = undirected(best.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.lit(1.0).alias("w")))
        merged = components(parts, joined)
        to_a = merged.select(F.col("id").alias("a"), F.col("component").alias("_a"))
        to_b = merged.select(F.col("id").alias("b"), F.col("component").alias("_b"))
        moved = spread_join(spread_join(links, to_a, "a", spread_by=["b"]), to_b, "b", spread_by=["a"])
        before = (links, parts, best)
        links = cut_lineage(_least_links(moved.select(F.col("_a").alias("a"), F.col("_b").alias("b"), "rank")))
        parts = cut_lineage(merged.select(F.col("component").alias("id")).distinct())
        for table in before:
            release(table)
        count = parts.count()
    release(links)
    release(parts)
    return k


def _least_links(rows: DataFrame) -> DataFrame:
    """The least rank between every two parts, in both directions."""
    there = rows.filter(F.col("a") != F.col("b")).select("a", "b", "rank")
    back = there.select(F.col("b").alias("a"), F.col("a").alias("b"), "rank")
    return there.unionByName(back).groupBy("a", "b").agg(F.min("rank").alias("rank"))


def smallest_connecting_k(vectors: DataFrame, start: int = 4, **options) -> tuple[int, DataFrame]:
    """The first ``k >= start`` whose neighbour graph is connected, and that graph.

    Neighbours are ranked up to a ceiling, which doubles while no ``k`` below it suffices.
    """
    vectors = cut_lineage(vectors)
    n, ceiling = vectors.count(), 2 * start
    while start < n:
        ceiling = min(ceiling, n - 1)
        ranked = cut_lineage(ranked_edges(vectors, ceiling, **options))
        k = bottleneck_rank(vectors, ranked, start)
        if k is not None:
            edges = cut_lineage(undirected(ranked.filter(F.col("rank") <= k)))
            release(ranked)
            return k, edges
        release(ranked)
        if ceiling == n - 1:
            break
        ceiling *= 2
    raise ValueError(f"k must stay below the number of vectors ({n})")


def shortest_paths(
    edges: DataFrame, sources: DataFrame, max_rounds: int = 10_000, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``(source, id, dist)`` from every source ``(source)`` to each node it reaches.

    Rounds of relaxation from the nodes whose distance has just improved; with many nodes give few sources (landmarks),
    as the result has a row for each pair.
    """
    edges = cut_lineage(edges.select(F.col("src").alias("id"), F.col("dst").alias("_next"), "w"))
    best = cut_lineage(
        sources.select("source", F.col("source").alias("id"), F.lit(0.0).alias("dist"), F.lit(True).alias("_fresh"))
    )
    for _ in range(max_rounds):
        fresh = best.filter("_fresh").select("source", "id", "dist")
        reached = spread_join(edges, fresh, "id", spread_by=["_next"], rows_per_task=rows_per_task).select(
            "source", F.col("_next").alias("id"), (F.col("dist") + F.col("w")).alias("dist"), F.lit(True).alias("_new")
        )
        known = best.select("source", "id", "dist", F.lit(False).alias("_new"))
        merged = known.unionByName(reached).groupBy("source", "id").agg(
            F.min("dist").alias("dist"), F.min(F.when(~F.col("_new"), F.col("dist"))).alias("_before")
        )
        improved = F.col("_before").isNull() | (F.col("dist") < F.col("_before"))
        previous, best = best, cut_lineage(merged.select("source", "id", "dist", improved.alias("_fresh")))
        release(previous)
        if best.filter("_fresh").isEmpty():
            release(edges)
            return best.select("source", "id", "dist")
    raise RuntimeError(f"distances still improve after {max_rounds} rounds")


def hop_counts(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """``(source, id, hops)``: shortest paths with every edge of length 1."""
    paths = shortest_paths(edges.withColumn("w", F.lit(1.0)), sources)
    return paths.select("source", "id", F.col("dist").cast("int").alias("hops"))
