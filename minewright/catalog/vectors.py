"""Vector, graph and manifold queries over the embeddings. Every fifth vector is the test part of the split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.catalog.registry import query, table
from minewright.operators import graph, manifold
from minewright.operators import vectors as ops

K = 5
COMPONENTS = 10
LANDMARKS = 50
GRAPH_K = 3


def all_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return ops.vectors_from(table(spark, sf, "embeddings"), "vec_id", "embedding", "label")


def split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Training and test vectors."""
    vectors, fold = all_vectors(spark, sf), F.pmod("id", F.lit(5))
    return vectors.filter(fold != 0), vectors.filter(fold == 0)


def class_centres(vectors: DataFrame) -> DataFrame:
    """``(landmark, features)``: the mean vector of every label."""
    means = (
        vectors.select("label", F.posexplode("features").alias("dim", "x"))
        .groupBy("label", "dim")
        .agg(F.avg("x").alias("x"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("dim", "x")))
    return means.groupBy(F.col("label").alias("landmark")).agg(ordered.alias("_p")).select(
        "landmark", F.col("_p.x").alias("features")
    )


_V = "v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS f, label FROM embeddings)"
_CENTRES = """
x AS (SELECT id, label, unnest(f) AS x, generate_subscripts(f, 1) AS d FROM v),
m AS (SELECT label, d, avg(x) AS x FROM x GROUP BY ALL),
c AS (SELECT label AS landmark, list(x ORDER BY d) AS f FROM m GROUP BY label),
dist AS (SELECT v.id, landmark, list_distance(v.f, c.f) AS dist FROM v CROSS JOIN c)"""


@query(f"WITH {_V},{_CENTRES} SELECT id, landmark, round(dist, 6) AS dist FROM dist")
def pairwise_distance(spark, sf):
    vectors = all_vectors(spark, sf)
    return ops.landmark_distances(vectors, class_centres(vectors)).withColumn("dist", F.round("dist", 6))


@query(f"""
WITH {_V},{_CENTRES},
s AS (SELECT id AS i, landmark AS j, dist * dist AS d2 FROM dist)
SELECT i, j, round(-0.5 * (d2 - avg(d2) OVER (PARTITION BY i) - avg(d2) OVER (PARTITION BY j) + avg(d2) OVER ()), 6) AS b
FROM s
""")
def double_center(spark, sf):
    vectors = all_vectors(spark, sf)
    distances = ops.landmark_distances(vectors, class_centres(vectors))
    return ops.double_center(distances, "id", "landmark").select(
        F.col("id").alias("i"), F.col("landmark").alias("j"), F.round("b", 6).alias("b")
    )


_NEAR = """near AS (
  SELECT a.id AS query_id, b.id AS base_id, list_distance(a.f, b.f) AS d,
    row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.f, b.f), b.id) AS rank
  FROM v a JOIN v b ON a.id <> b.id)"""


@query(f"""
WITH {_V}, {_NEAR} SELECT query_id, base_id, round(d, 6) AS dist, rank FROM near WHERE rank <= {K}
""")
def knn_topk(spark, sf):
    vectors = all_vectors(spark, sf)
    near = ops.knn(vectors, vectors, K, exclude_self=True)
    return near.select("query_id", "base_id", F.round(F.sqrt("dist2"), 6).alias("dist"), "rank")


SMALL_BLOCK = 64
RECALL = 0.9


@query(f"""
WITH {_V}, {_NEAR} SELECT query_id, base_id, round(d, 6) AS dist, rank FROM near WHERE rank <= {K}
""")
def knn_topk_blocks(spark, sf):
    """The same neighbours with blocks so small that cells, block pairs and their ranking all take part."""
    vectors = all_vectors(spark, sf)
    near = ops.knn(vectors, vectors, K, exclude_self=True, block_rows=SMALL_BLOCK)
    return near.select("query_id", "base_id", F.round(F.sqrt("dist2"), 6).alias("dist"), "rank")


@query()
def knn_indexed(spark, sf):
    """Neighbours through the index, with as many probes as the sampled recall asks for."""
    vectors = all_vectors(spark, sf)
    index = ops.build_index(vectors, K, SMALL_BLOCK)
    probes = ops.tune_probes(vectors, vectors, index, K, RECALL, exclude_self=True)
    near = ops.knn_indexed(vectors, index, K, probes, exclude_self=True)
    return near.select("query_id", "base_id", F.round(F.sqrt("dist2"), 6).alias("dist"), "rank")


@query(f"""
WITH {_V}, {_NEAR} SELECT count(DISTINCT query_id) AS queries, count(*) AS neighbours, true AS enough FROM near WHERE rank <= {K}
""")
def knn_index_recall(spark, sf):
    """Whether the index finds its share of all true neighbours, over all queries and not a sample."""
    vectors = all_vectors(spark, sf)
    true = ops.knn(vectors, vectors, K, exclude_self=True).select("query_id", "base_id")
    got = knn_indexed(spark, sf).select("query_id", "base_id", F.lit(1).alias("hit"))
    found = true.join(got, ["query_id", "base_id"], "left")
    share = F.avg(F.coalesce("hit", F.lit(0)))
    # The probes were chosen on a sample of queries, so the whole may fall short by the sample's error.
    return found.agg(
        F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("neighbours"), (share >= RECALL - 0.03).alias("enough")
    )


_PREDICT = f"""
near AS (
  SELECT a.id, b.label, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.f, b.f), b.id) AS rank
  FROM v a JOIN v b ON a.id % 5 = 0 AND b.id % 5 <> 0),
votes AS (SELECT id, label, count(*) AS n, min(rank) AS r FROM near WHERE rank <= {K} GROUP BY ALL),
pred AS (SELECT id, label AS predicted FROM votes QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, r) = 1)"""


@query(f"WITH {_V},{_PREDICT} SELECT id, predicted FROM pred")
def knn_predict(spark, sf):
    train, test = split(spark, sf)
    return ops.knn_classify(test, train, K)


@query(f"WITH {_V},{_PREDICT} SELECT round(avg((predicted = label)::INT), 6) AS accuracy FROM pred JOIN v USING (id)")
def knn_accuracy(spark, sf):
    train, test = split(spark, sf)
    return ops.accuracy(ops.knn_classify(test, train, K), test).select(F.round("accuracy", 6).alias("accuracy"))


_X = "x AS (SELECT id, unnest(f) AS x, generate_subscripts(f, 1) - 1 AS d FROM v)"


@query(f"WITH {_V}, {_X} SELECT d AS dim, round(avg(x), 9) AS mean FROM x GROUP BY d")
def dim_means(spark, sf):
    return ops.column_means(all_vectors(spark, sf)).withColumn("mean", F.round("mean", 9))


@query(f"""
WITH {_V}, {_X}
SELECT a.d AS i, b.d AS j, round(covar_samp(a.x, b.x), 9) AS cov FROM x a JOIN x b ON a.id = b.id AND a.d <= b.d
GROUP BY ALL
""")
def covariance(spark, sf):
    return ops.covariance(all_vectors(spark, sf)).withColumn("cov", F.round("cov", 9))


@query(f"""
WITH {_V}, {_X}
SELECT a.d AS i, b.d AS j, round(sum(a.x * b.x), 6) AS s FROM x a JOIN x b ON a.id = b.id AND a.d <= b.d GROUP BY ALL
""")
def gram_matrix(spark, sf):
    return ops.gram_matrix(all_vectors(spark, sf)).withColumn("s", F.round("s", 6))


def _values(spark: SparkSession, projection: ops.Projection) -> DataFrame:
    rows = [(i, float(v)) for i, v in enumerate(projection.values)]
    return spark.createDataFrame(rows, "component int, value double")


@query()
def pca_variance(spark, sf):
    return _values(spark, ops.pca_fit(all_vectors(spark, sf), COMPONENTS))


@query()
def svd_values(spark, sf):
    return _values(spark, ops.svd_fit(all_vectors(spark, sf), COMPONENTS))


@query()
def pca_project(spark, sf):
    vectors = all_vectors(spark, sf)
    return ops.pca_fit(vectors, COMPONENTS).transform(vectors)


@query()
def svd_project(spark, sf):
    vectors = all_vectors(spark, sf)
    return ops.svd_fit(vectors, COMPONENTS).transform(vectors)


@query()
def pca_1nn(spark, sf):
    return ops.reduce_then_1nn(*split(spark, sf), "pca", COMPONENTS)


@query()
def svd_1nn(spark, sf):
    return ops.reduce_then_1nn(*split(spark, sf), "svd", COMPONENTS)


# ---- graph ----------------------------------------------------------------------------------------------------------

_EDGES = f"""
half AS (SELECT query_id AS src, base_id AS dst, d AS w FROM near WHERE rank <= {GRAPH_K}),
e AS (SELECT DISTINCT src, dst, w FROM (SELECT src, dst, w FROM half UNION ALL SELECT dst, src, w FROM half))"""


@query(f"WITH {_V}, {_NEAR},{_EDGES} SELECT src, dst, round(w, 6) AS w FROM e")
def knn_graph(spark, sf):
    return graph.knn_graph(all_vectors(spark, sf), GRAPH_K).withColumn("w", F.round("w", 6))


def _graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    vectors = all_vectors(spark, sf)
    return vectors, graph.knn_graph(vectors, GRAPH_K)


@query(f"""
WITH RECURSIVE {_V}, {_NEAR},{_EDGES},
reach(id, seen) AS (SELECT id, id FROM v UNION SELECT e.dst, reach.seen FROM reach JOIN e ON e.src = reach.id)
SELECT id, min(seen) AS component FROM reach GROUP BY id
""")
def graph_components(spark, sf):
    vectors, edges = _graph(spark, sf)
    return graph.components(vectors, edges)


@query(f"""
WITH RECURSIVE {_V}, {_NEAR},{_EDGES},
walk(id, hops) AS (
  SELECT min(id), 0 FROM v UNION SELECT e.dst, walk.hops + 1 FROM walk JOIN e ON e.src = walk.id WHERE walk.hops < 60)
SELECT (SELECT min(id) FROM v) AS source, id, min(hops) AS hops FROM walk GROUP BY id
""")
def sssp_hops(spark, sf):
    vectors, edges = _graph(spark, sf)
    return graph.hop_counts(edges, vectors.agg(F.min("id").alias("source")))


@query()
def geodesic(spark, sf):
    vectors, edges = _graph(spark, sf)
    paths = graph.shortest_paths(edges, manifold.pick_landmarks(vectors, LANDMARKS))
    return paths.withColumn("dist", F.round("dist", 6))


@query(f"""
WITH RECURSIVE {_V}, {_NEAR},
e AS MATERIALIZED (SELECT query_id AS a, base_id AS b, rank FROM near WHERE rank <= 20
      UNION ALL SELECT base_id, query_id, rank FROM near WHERE rank <= 20),
reach(k, id) AS (SELECT unnest(range(2, 21)), (SELECT min(id) FROM v)
      UNION SELECT k, b FROM reach JOIN e ON a = id AND rank <= k),
n AS (SELECT k, count(*) AS n FROM reach GROUP BY k)
SELECT min(k)::INT AS k FROM n WHERE n = (SELECT count(*) FROM v)
""")
def min_connecting_k(spark, sf):
    k, _ = graph.smallest_connecting_k(all_vectors(spark, sf), 2)
    return spark.createDataFrame([(k,)], "k int")


@query()
def isomap_embed(spark, sf):
    return manifold.isomap(all_vectors(spark, sf), COMPONENTS, 4, LANDMARKS)[1]


@query()
def isomap_1nn(spark, sf):
    train, test = split(spark, sf)
    return manifold.isomap_then_1nn(train, test, COMPONENTS, 4, landmarks=LANDMARKS)
