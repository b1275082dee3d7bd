import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from minewright.operators import graph, manifold
from minewright.operators import vectors as ops


def frame(spark, points, labels=None):
    labels = labels if labels is not None else [0] * len(points)
    data = [(i, [float(x) for x in p], int(y)) for i, (p, y) in enumerate(zip(points, labels))]
    return spark.createDataFrame(data, "id bigint, features array<double>, label int")


def exact(q, b, k, exclude_self):
    found = []
    for i, x in enumerate(q):
        d2 = ((b - x) ** 2).sum(1)
        order = [j for j in sorted(range(len(b)), key=lambda j: (d2[j], j)) if not (exclude_self and i == j)]
        found += [(i, j, r + 1) for r, j in enumerate(order[:k])]
    return sorted(found)


@pytest.fixture(scope="module")
def crowded():
    """A third of the points are copies of one, the rest lie in a few groups."""
    rng = np.random.default_rng(5)
    groups = rng.normal(size=(6, 4)) * 5
    points = groups[rng.integers(0, 6, 240)] + rng.normal(size=(240, 4)) * 0.3
    points[::3] = points[0]
    return points


@pytest.mark.parametrize("block_rows,max_cells", [(10_000, 8), (16, 8), (7, 1024)])
@pytest.mark.parametrize("exclude_self", [True, False])
def test_knn_is_exact(spark, crowded, block_rows, max_cells, exclude_self):
    vectors = frame(spark, crowded)
    got = ops.knn(vectors, vectors, 4, exclude_self, block_rows, max_cells)
    assert rows(got, "query_id", "base_id", "rank") == exact(crowded, crowded, 4, exclude_self)


def test_blocks_moved_by_exact_search_grow_with_the_input(spark):
    rng = np.random.default_rng(8)
    moved = {}
    for n in (400, 1600):
        vectors = frame(spark, rng.normal(size=(n, 8)))
        blocks = ops._pack_batches(vectors, 8).withColumn("cell", F.lit(0))
        moved[n] = ops._grid(vectors, blocks, n, n, 8).count()
    assert moved[1600] <= 5 * moved[400]


def test_index_search_that_holds_the_queries_is_exact(spark, crowded, monkeypatch):
    vectors = frame(spark, crowded)
    index = ops.build_index(vectors, most=4, block_rows=2)
    cells = len(index.tree.pivots)
    assert cells > 40  # so that copying the queries for each cell would move more than the blocks
    monkeypatch.setattr(ops, "block_pairs", None)
    for exclude_self in (True, False):
        got = ops.knn_indexed(vectors, index, 4, cells, exclude_self, block_rows=16)
        assert rows(got, "query_id", "base_id", "rank") == exact(crowded, crowded, 4, exclude_self)
    few = index.tree.nearest(crowded, 3, 4)
    meets = index.tree.probing(crowded, 3)
    assert all(meets(c).tolist() == np.flatnonzero((few == c).any(1)).tolist() for c in range(cells))


def test_knn_with_fewer_base_rows_than_k(spark):
    points = np.arange(6.0).reshape(3, 2)
    got = ops.knn(frame(spark, points), frame(spark, points), 9)
    assert got.count() == 9


def test_index_with_all_probes_is_exact(spark, crowded):
    vectors = frame(spark, crowded)
    index = ops.build_index(vectors, most=4, block_rows=16)
    for exclude_self in (True, False):
        got = ops.knn_indexed(vectors, index, 4, len(index.tree.pivots), exclude_self, block_rows=16)
        assert rows(got, "query_id", "base_id", "rank") == exact(crowded, crowded, 4, exclude_self)
    with pytest.raises(ValueError):
        ops.knn_indexed(vectors, index, 5)


def test_index_drops_only_copies_that_cannot_be_near(spark, crowded):
    index = ops.build_index(frame(spark, crowded), most=4, block_rows=16)
    held = index.blocks.select(F.explode("ids").alias("id")).count()
    assert held == len(crowded) - (len(crowded) // 3 - 5)


def test_index_recall_is_tuned_and_block_pairs_are_linear(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 8)) * 3
    points = centres[rng.integers(0, 40, 3200)] + rng.normal(size=(3200, 8)) * 0.5
    pairs = {}
    for n in (800, 3200):
        vectors = frame(spark, points[:n]).cache()
        index = ops.build_index(vectors, most=5, block_rows=32)
        probes = ops.tune_probes(vectors, vectors, index, 5, 0.9, exclude_self=True, sample_rows=60)
        seen = ops.index_recall(vectors, vectors, index, 5, probes, exclude_self=True, sample_rows=120).first()
        assert seen["queries"] == 120 and seen["recall"] >= 0.85
        pairs[n] = ops.block_pairs(vectors, index, 4, 32).count()
        blocks = index.blocks.count()
        assert pairs[n] <= 4 * blocks * 4
        ops.release_index(index)
    assert pairs[3200] <= 6 * pairs[800]


def test_index_of_nothing(spark, crowded):
    empty = frame(spark, crowded).limit(0)
    assert ops.knn_indexed(frame(spark, crowded[:3]), ops.build_index(empty, 3), 2).count() == 0
    assert ops.knn_indexed(empty, ops.build_index(frame(spark, crowded), 3), 2).count() == 0


def test_graph_and_vote_through_an_index(spark, crowded):
    vectors = frame(spark, crowded, np.arange(len(crowded)) % 2)
    index = ops.build_index(vectors, most=6, block_rows=16)
    every = len(index.tree.pivots)
    assert rows(graph.ranked_edges(vectors, 3, index, every), "src", "dst", "rank") == rows(graph.ranked_edges(vectors, 3), "src", "dst", "rank")
    assert rows(ops.knn_classify(vectors, vectors, 5, index, every), "id", "predicted") == rows(ops.knn_classify(vectors, vectors, 5), "id", "predicted")


def test_tie_goes_to_smaller_id_and_vote_to_first_seen(spark):
    train = frame(spark, [[1.0], [-1.0], [3.0], [-3.0]], [7, 8, 8, 7])
    query = frame(spark, [[0.0]])
    assert rows(ops.knn(query, train, 1), "base_id") == [(0,)]
    assert rows(ops.knn_classify(query, train, 4), "predicted") == [(7,)]


def test_projections_match_numpy(spark, crowded):
    vectors = frame(spark, crowded)
    pca = ops.pca_fit(vectors, 3)
    values, components = np.linalg.eigh(np.cov(crowded.T))
    assert np.allclose(pca.values, values[::-1][:3])
    assert np.allclose(np.abs(pca.components @ components[:, ::-1][:, :3]), np.eye(3), atol=1e-6)
    got = np.array([r["features"] for r in pca.transform(vectors).orderBy("id").collect()])
    assert np.allclose(got, (crowded - crowded.mean(0)) @ pca.components.T)
    svd = ops.svd_fit(vectors, 2)
    assert np.allclose(svd.values, np.linalg.svd(crowded, compute_uv=False)[:2])
    assert np.allclose(np.array([r["features"] for r in ops.center(vectors).collect()]).mean(0), 0)


def test_reduce_then_1nn_on_separated_classes(spark):
    rng = np.random.default_rng(0)
    labels = np.arange(60) % 3
    points = np.eye(3)[labels] * 10 + rng.normal(size=(60, 3)) * 0.1
    vectors = frame(spark, points, labels)
    train, test = vectors.filter("id % 5 <> 0"), vectors.filter("id % 5 = 0")
    for method in ("pca", "svd"):
        assert ops.reduce_then_1nn(train, test, method, 2).collect()[0]["accuracy"] == 1.0


def edges_of(spark, pairs):
    return graph.undirected(spark.createDataFrame(pairs, "src bigint, dst bigint, w double"))


def test_components_with_a_hub_and_a_chain(spark, no_broadcast):
    chain = [(i, i + 1, 1.0) for i in range(20, 60)]
    hub = [(0, i, 1.0) for i in range(1, 20)]
    nodes = spark.range(62).select("id")
    got = dict(rows(graph.components(nodes, edges_of(spark, chain + hub), rows_per_task=5), "id", "component"))
    assert [got[0], got[19], got[20], got[60], got[61]] == [0, 0, 20, 20, 61]
    assert graph.is_connected(nodes, edges_of(spark, chain + hub)) == (False, 42)


def test_shortest_paths_match_floyd_warshall(spark, no_broadcast):
    rng = np.random.default_rng(2)
    n = 25
    d = np.full((n, n), np.inf)
    np.fill_diagonal(d, 0)
    pairs = [(int(a), int(b), float(w)) for a, b, w in zip(rng.integers(0, n, 50), rng.integers(0, n, 50), rng.random(50)) if a != b]
    for a, b, w in pairs:
        d[a, b] = d[b, a] = min(d[a, b], w)
    for k in range(n):
        d = np.minimum(d, d[:, [k]] + d[[k], :])
    sources = spark.createDataFrame([(0,), (3,)], "source bigint")
    got = graph.shortest_paths(edges_of(spark, pairs), sources, rows_per_task=6).collect()
    assert len(got) == np.isfinite(d[[0, 3]]).sum()
    assert all(abs(d[r["source"], r["id"]] - r["dist"]) < 1e-12 for r in got)


def test_k_is_raised_until_connected(spark):
    points = [[0.0], [0.1], [10.0], [10.1]]
    k, edges = graph.smallest_connecting_k(frame(spark, points), 1)
    assert k == 2 and graph.is_connected(frame(spark, points), edges)[0]
    with pytest.raises(ValueError):
        graph.smallest_connecting_k(frame(spark, points), 4)


def test_isomap_equals_classical_scaling_when_all_are_landmarks(spark):
    rng = np.random.default_rng(4)
    points = np.column_stack([np.linspace(0, 3, 30), rng.random(30) * 0.2])
    vectors = frame(spark, points)
    k, embedded = manifold.isomap(vectors, 2, 3, landmarks=30)
    got = np.array([r["features"] for r in embedded.orderBy("id").collect()])
    _, edges = graph.smallest_connecting_k(vectors, k)
    paths = graph.shortest_paths(edges, vectors.select(F.col("id").alias("source"))).collect()
    d2 = np.zeros((30, 30))
    for r in paths:
        d2[r["source"], r["id"]] = r["dist"] ** 2
    centred = -0.5 * (d2 - d2.mean(0) - d2.mean(1)[:, None] + d2.mean())
    values, axes = np.linalg.eigh(centred)
    wanted = axes[:, ::-1][:, :2] * np.sqrt(np.maximum(values[::-1][:2], 0))
    assert np.allclose(np.abs(got), np.abs(wanted), atol=1e-6)


def test_double_center_of_a_rectangle(spark):
    rng = np.random.default_rng(1)
    d = rng.random((5, 3))
    long = spark.createDataFrame([(i, j, float(d[i, j])) for i in range(5) for j in range(3)], "i int, j int, dist double")
    d2 = d**2
    wanted = -0.5 * (d2 - d2.mean(1)[:, None] - d2.mean(0)[None, :] + d2.mean())
    assert all(abs(wanted[r["i"], r["j"]] - r["b"]) < 1e-12 for r in ops.double_center(long).collect())


def test_bottleneck_rank_equals_trying_every_k(spark):
    draw = np.random.default_rng(3)
    for case in (2,):
        n = int(draw.integers(20, 40))
        groups = draw.normal(size=(3, 2)) * (1 + 3 * case)
        points = groups[draw.integers(0, 3, n)] + draw.normal(size=(n, 2))
        near = [(i, j, r) for i, j, r in exact(points, points, n - 1, True)]

        def connected(k, near=near):
            root = {i: i for i, _, _ in near}

            def find(i):
                while root[i] != i:
                    i = root[i]
                return i

            for i, j, r in near:
                if r <= k:
                    root[find(i)] = find(j)
            return len({find(i) for i in root}) == 1

        wanted = next(k for k in range(1, n) if connected(k))
        ranked = graph.ranked_edges(frame(spark, points), n - 1).cache()
        assert graph.bottleneck_rank(frame(spark, points), ranked, 1) == wanted
        if wanted > 1:
            assert graph.bottleneck_rank(frame(spark, points), ranked.filter(F.col("rank") < wanted), 1) is None
