"""Isomap with landmark points, so that no table is the square of the number of vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.functions.vectors import constant_vector, dot
from minewright.operators.graph import shortest_paths, smallest_connecting_k
from minewright.operators.vectors import accuracy, knn_classify, top_eigen

# Upper bound on landmarks: their m x m distances are decomposed on the driver.
MAX_LANDMARKS = 2000


def pick_landmarks(vectors: DataFrame, m: int) -> DataFrame:
    """``(source)``: the ``m`` ids with the smallest hashes."""
    if m > MAX_LANDMARKS:
        raise ValueError(f"at most {MAX_LANDMARKS} landmarks")
    return vectors.select(F.col("id").alias("source")).orderBy(F.xxhash64("source"), "source").limit(m)


def landmark_mds(distances: DataFrame, n: int) -> DataFrame:
    """``(id, features)`` in ``n`` dimensions from ``(source, id, dist)``, the distances to the landmarks.

    The landmark block is double-centred and decomposed on the driver (classical scaling, negative eigenvalues set to
    zero); every point is then placed by a linear map of its squared distances, which returns the classical
    coordinates for the landmarks themselves.
    """
    landmarks = distances.select(F.col("source").alias("id")).distinct()
    block = distances.join(F.broadcast(landmarks), "id", "left_semi").toPandas()
    names = np.sort(block["source"].unique())
    matrix = block.pivot(index="source", columns="id", values="dist").loc[names, names].to_numpy() ** 2
    row_means = matrix.mean(axis=1)
    centred = -0.5 * (matrix - row_means[:, None] - matrix.mean(axis=0)[None, :] + matrix.mean())
    values, vectors = top_eigen(centred, min(n, len(names)))
    values = np.maximum(values, 0.0)
    inverse = np.divide(1.0, np.sqrt(values), out=np.zeros_like(values), where=values > 1e-12)
    weights = vectors * inverse

    squared = F.struct("source", (F.col("dist") * F.col("dist")).alias("d2"))
    points = distances.groupBy("id").agg(F.array_sort(F.collect_list(squared)).alias("_d"))
    moved = F.zip_with(F.col("_d.d2"), constant_vector(row_means), lambda x, m: (m - x) * F.lit(0.5))
    points = points.select("id", moved.alias("_moved"))
    axes = [dot(F.col("_moved"), constant_vector(column)) for column in weights.T]
    return points.select("id", F.array(*axes).alias("features"))


def isomap(vectors: DataFrame, n: int, k: int, landmarks: int = 200, **options) -> tuple[int, DataFrame]:
    """The ``k`` that connects the neighbour graph and ``(id, features)`` in ``n`` dimensions."""
    k, edges = smallest_connecting_k(vectors, k, **options)
    distances = shortest_paths(edges, pick_landmarks(vectors, landmarks))
    return k, landmark_mds(distances, n)


def isomap_then_1nn(train: DataFrame, test: DataFrame, n: int, k: int, **options) -> DataFrame:
    """Embed training and test vectors together, classify by the nearest one: one row ``(accuracy)``."""
    columns = ["id", "features"]
    _, embedded = isomap(train.select(columns).unionByName(test.select(columns)), n, k, **options)
    labelled = embedded.join(train.select("id", "label"), "id")
    asked = embedded.join(test.select("id"), "id", "left_semi")
    return accuracy(knn_classify(asked, labelled, 1), test)
