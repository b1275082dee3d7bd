"""Vector tables ``(id, features, ...)``: distances, exact neighbours, linear projections.

Vectors have a fixed, small number of dimensions d; anything that goes through the driver is at most d x d numbers or
one row a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from minewright.functions.vectors import as_doubles, constant_vector, distance, dot
from minewright.plans.lineage import cut_lineage, release

# Rows of one packed block; a block of 64 doubles a row is then about 1 MB.
BLOCK_ROWS = 2048
# Upper bound on the number of cells the space is cut into, hence on the cell table that reaches the driver.
MAX_CELLS = 1024
# Queries that a task holds while base blocks pass: 64 MB at 64 dimensions, and at most 2 KB each for the cells they probe.
HELD_ROWS = 131_072
# Queries compared with a block at a time, and pairs whose exact differences are taken at a time.
QUERY_ROWS = 1024
PAIRS_AT_ONCE = 65_536


def vectors_from(df: DataFrame, vec_id: str, vector: str, *others: str) -> DataFrame:
    """``(id, features, others...)`` with features as doubles."""
    return df.select(F.col(vec_id).alias("id"), as_doubles(F.col(vector)).alias("features"), *others)


# ---- distances ------------------------------------------------------------------------------------------------------


def landmark_distances(vectors: DataFrame, landmarks: DataFrame) -> DataFrame:
    """``(id, landmark, dist)``: Euclidean distance of every vector to each of a few landmark vectors.

    The landmarks ``(landmark, features)`` must be few (they are packed into one broadcast row). This takes the place of
    the full distance matrix, whose size is the square of the number of vectors.
    """
    packed = landmarks.agg(
        F.array_sort(F.collect_list(F.struct(F.col("landmark"), as_doubles(F.col("features")).alias("point")))).alias(
            "_landmarks"
        )
    )
    each = vectors.select("id", "features", F.explode(packed.scalar()).alias("_l"))
    return each.select(
        "id",
        F.col("_l.landmark").alias("landmark"),
        distance(F.col("features"), F.col("_l.point")).alias("dist"),
    )


def double_center(distances: DataFrame, row: str = "i", column: str = "j", dist: str = "dist") -> DataFrame:
    """``(row, column, b)`` with b = -1/2 (d^2 - row mean - column mean + grand mean) of a long-form matrix.

    Means are combined before the shuffle; columns are few (landmarks), rows may be many.
    """
    squared = distances.select(row, column, (F.col(dist) * F.col(dist)).alias("_d2"))
    rows = squared.groupBy(row).agg(F.avg("_d2").alias("_row"))
    columns = squared.groupBy(column).agg(F.avg("_d2").alias("_column"))
    grand = squared.agg(F.avg("_d2")).scalar()
    joined = squared.join(rows, row).join(columns, column)
    return joined.select(
        row, column, (F.lit(-0.5) * (F.col("_d2") - F.col("_row") - F.col("_column") + grand)).alias("b")
    )


# ---- exact nearest neighbours ---------------------------------------------------------------------------------------


def _pick_pivots(base: DataFrame, cells: int) -> np.ndarray:
    """``cells`` base vectors with the smallest hashes of their ids: the same ones on every run."""
    chosen = base.orderBy(F.xxhash64("id"), "id").limit(cells).select("features").collect()
    return np.array([row["features"] for row in chosen], dtype=np.float64)


def _squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gram = a @ b.T
    return np.maximum((a * a).sum(1)[:, None] - 2.0 * gram + (b * b).sum(1)[None, :], 0.0)


def _stack(column: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in column])


def _assign(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot's number ``cell`` and the distance to it, ``radius``."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d2 = _squared_distances(_stack(batch["features"]), pivots)
                cell = d2.argmin(1)
                yield batch.assign(cell=cell.astype("int32"), radius=np.sqrt(d2[np.arange(len(d2)), cell]))

    id_type = vectors.schema["id"].dataType.simpleString()
    return vectors.select("id", "features").mapInPandas(
        assign, f"id {id_type}, features array<double>, cell int, radius double"
    )


def _points(column: pa.ListArray, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _names(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _pack_batches(vectors: DataFrame, block_rows: int) -> DataFrame:
    """Blocks ``(ids, points, number)`` of neighbouring rows, without a shuffle; points are laid end to end."""
    id_type = vectors.schema["id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                part = batch.slice(start, block_rows)
                ids, points = part.column("id"), part.column("features").flatten()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays([0, len(ids)], ids),
                        pa.ListArray.from_arrays([0, len(points)], points),
                        pa.array([number], pa.int64()),
                    ],
                    ["ids", "points", "number"],
                )
                number += 1

    return vectors.select("id", "features").mapInArrow(pack, f"ids array<{id_type}>, points array<double>, number bigint")


def _without_spare_copies(base: DataFrame, most: int) -> DataFrame:
    """Of vectors equal in all dimensions only the ``most`` smallest ids, which is all that ``most`` neighbours can need."""
    copies = Window.partitionBy("features").orderBy("id")
    ranked = base.select("id", "features", F.row_number().over(copies).alias("_copy"))
    return ranked.filter(F.col("_copy") <= most).select("id", "features")


def knn(
    query: DataFrame,
    base: DataFrame,
    k: int,
    exclude_self: bool = False,
    block_rows: int = BLOCK_ROWS,
    max_cells: int = MAX_CELLS,
) -> DataFrame:
    """``(query_id, base_id, dist2, rank)``: the exact ``k`` nearest base vectors, ties by smaller id.

    Tasks form a grid: each holds a share of the queries and lets the blocks of a share of the base pass, keeping ``k``
    rows a query. Vectors travel once a row or column of the grid, which has a set number of tasks until a share of the
    queries outgrows ``HELD_ROWS``, and ``k`` rows a query and base share are ranked. Both sides are ordered by cells
    around pivots, and a block that the triangle inequality rules out for a group of queries is not compared.
    """
    query, base = query.select("id", "features"), base.select("id", "features")
    base = cut_lineage(_without_spare_copies(base, k + int(exclude_self)))
    n_base, n_query = base.count(), query.count()
    schema = _found_schema(query, base.schema["id"].dataType)
    if n_base == 0 or n_query == 0:
        return query.sparkSession.createDataFrame([], schema + ", rank int")
    cells = max(1, min(max_cells, -(-n_base // block_rows)))
    if cells > 1:
        pivots = _pick_pivots(base, cells)
        query, base = (_assign(v, pivots).sortWithinPartitions("cell", "id") for v in (query, base))
    blocks = _pack_batches(base, block_rows).withColumn("cell", F.lit(0))
    return _ranked(_grid(query, blocks, n_query, n_base, block_rows).mapInArrow(_hold_and_meet(k, exclude_self), schema), k)


def _found_schema(query: DataFrame, base_id: DataType) -> str:
    return f"query_id {query.schema['id'].dataType.simpleString()}, base_id {base_id.simpleString()}, dist2 double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("dist2", "base_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _grid_sides(spark: SparkSession, n_query: int, n_base: int, block_rows: int) -> tuple[int, int]:
    """Number of shares that queries and base are cut into."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    side = min(max(1, round(tasks**0.5)), -(-n_query // block_rows))
    query_shares = max(side, -(-n_query // HELD_ROWS))
    return query_shares, max(1, min(-(-tasks // query_shares), -(-n_base // block_rows)))


def _grid(query: DataFrame, blocks: DataFrame, n_query: int, n_base: int, block_rows: int) -> DataFrame:
    """``(task, asked, ids, points, cell)``: a task's query blocks (``ids`` null), then its base blocks."""
    query_shares, base_shares = _grid_sides(query.sparkSession, n_query, n_base, block_rows)
    across = F.explode(F.sequence(F.lit(0), F.lit(base_shares - 1)))
    down = F.explode(F.sequence(F.lit(0), F.lit(query_shares - 1)))
    asking = _pack_batches(query, block_rows).select(
        (F.pmod("number", F.lit(query_shares)) * base_shares).cast("int").alias("_row"), across.alias("_column"), "ids", "points"
    )
    held = asking.select((F.col("_row") + F.col("_column")).alias("task"), F.col("ids").alias("asked"), "points")
    offered = blocks.select(
        F.pmod("number", F.lit(base_shares)).cast("int").alias("_column"), down.alias("_row"), "ids", "points", "cell"
    )
    passing = offered.select((F.col("_row") * base_shares + F.col("_column")).alias("task"), "ids", "points", "cell")
    rows = held.unionByName(passing, allowMissingColumns=True)
    dealt = rows.repartitionById(query_shares * base_shares, "task")
    return dealt.sortWithinPartitions("task", F.col("ids").isNotNull()).select("task", "asked", "ids", "points", "cell")


class _Nearest:
    """The ``k`` nearest of some queries among the base blocks met so far; near ties are settled with exact differences."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, k: int, exclude_self: bool) -> None:
        self.ids, self.points, self.k, self.exclude_self = ids, points, k, exclude_self
        self.norms = (points * points).sum(1)
        self.turned = np.hstack([-2.0 * points, np.ones((len(points), 1))])
        self.dist = np.full((len(points), k), np.inf)
        self.found = None
        starts = range(0, len(points), QUERY_ROWS)
        self.centres = np.vstack([points[s : s + QUERY_ROWS].mean(0) for s in starts])
        self.radii = np.array([self._reach(points[s : s + QUERY_ROWS], c) for s, c in zip(starts, self.centres)])

    @staticmethod
    def _reach(points: np.ndarray, centre: np.ndarray) -> float:
        return float(np.sqrt(((points - centre) ** 2).sum(1).max()))

    def meet(self, base_ids: np.ndarray, base: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Compare a block with the queries at ``rows``, in rising order, or with all that it can be near to."""
        if self.found is None:
            self.found = np.full(self.dist.shape, base_ids[0], dtype=base_ids.dtype)
        norms = (base * base).sum(1)
        turned, largest = np.hstack([base, norms[:, None]]).T, norms.max()
        if rows is not None:
            for start in range(0, len(rows), QUERY_ROWS):
                part = rows[start : start + QUERY_ROWS]
                self._compare(part, self.turned[part] @ turned, base_ids, base, largest)
            return
        centre = base.mean(0)
        gaps = np.sqrt(((self.centres - centre) ** 2).sum(1)) - self.radii - self._reach(base, centre)
        for number, gap in enumerate(gaps):
            part = slice(number * QUERY_ROWS, (number + 1) * QUERY_ROWS)
            slack = 1e-7 * (1.0 + self.norms[part].max() + largest)
            if gap <= 0 or gap * gap <= self.dist[part, -1].max() + slack:
                at = np.arange(part.start, min(part.stop, len(self.ids)))
                self._compare(at, self.turned[part] @ turned, base_ids, base, largest)

    def _compare(self, at: np.ndarray, part: np.ndarray, base_ids: np.ndarray, base: np.ndarray, largest: float) -> None:
        """``part`` is the squared distance without the query's norm."""
        limit = self.dist[at, -1] - self.norms[at]
        unset = ~np.isfinite(limit)
        if part.shape[1] > self.k + 1 and unset.any():
            limit[unset] = np.partition(part[unset], self.k, axis=1)[:, self.k]
        limit += 1e-9 * (1.0 + self.norms[at] + largest)
        rows, columns = np.nonzero(part <= limit[:, None])
        for start in range(0, len(rows), PAIRS_AT_ONCE):
            q, c = at[rows[start : start + PAIRS_AT_ONCE]], columns[start : start + PAIRS_AT_ONCE]
            if self.exclude_self:
                other = self.ids[q] != base_ids[c]
                q, c = q[other], c[other]
            exact = ((self.points[q] - base[c]) ** 2).sum(1)
            near = exact <= self.dist[q, -1]
            if near.any():
                self._merge(q[near], base_ids[c[near]], exact[near])

    def _merge(self, q: np.ndarray, base_ids: np.ndarray, exact: np.ndarray) -> None:
        touched = np.unique(q)
        rows = np.concatenate([np.repeat(touched, self.k), q])
        dist = np.concatenate([self.dist[touched].ravel(), exact])
        ids = np.concatenate([self.found[touched].ravel(), base_ids])
        order = np.lexsort((ids, dist, rows))
        rows, dist, ids = rows[order], dist[order], ids[order]
        first = np.searchsorted(rows, touched)
        best = (first[:, None] + np.arange(self.k)).ravel()
        self.dist[touched], self.found[touched] = dist[best].reshape(-1, self.k), ids[best].reshape(-1, self.k)

    def results(self, query_type: pa.DataType, base_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(self.ids) if self.found is not None else 0, 10_000):
            rows, ranks = np.nonzero(np.isfinite(self.dist[start : start + 10_000]))
            rows = rows + start
            columns = [pa.array(self.ids[rows], query_type), pa.array(self.found[rows, ranks], base_type)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(self.dist[rows, ranks])], ["query_id", "base_id", "dist2"])


def _hold_and_meet(k: int, exclude_self: bool, probing: Callable[[np.ndarray], Callable[[int], np.ndarray]] | None = None):
    """Hold the queries of a grid task while its base blocks pass; ``probing`` tells which queries a cell concerns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, asked, points, nearest, probes, types = None, [], [], None, None, None
        for batch in batches:
            types = (batch.schema.field("asked").type.value_type, batch.schema.field("ids").type.value_type)
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                if row.column("task")[0].as_py() != task:
                    if nearest is not None:
                        yield from nearest.results(*types)
                    task, asked, points, nearest, probes = row.column("task")[0].as_py(), [], [], None, None
                base = row.column("ids")[0].is_valid
                names = _names(row.column("ids" if base else "asked").flatten())
                block = _points(row.column("points"), len(names))
                if not base:
                    asked.append(names)
                    points.append(block.copy())
                elif asked:
                    if nearest is None:
                        nearest = _Nearest(np.concatenate(asked), np.concatenate(points), k, exclude_self)
                        points = []
                        probes = probing(nearest.points) if probing else None
                    nearest.meet(names, block, probes(row.column("cell")[0].as_py()) if probes else None)
        if nearest is not None:
            yield from nearest.results(*types)

    return run


def _block_neighbours(k: int, exclude_self: bool):
    """Local top ``k`` of one block against another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids, base_ids = row.column("ids").flatten(), row.column("base_ids").flatten()
                nearest = _Nearest(_names(ids), _points(row.column("points"), len(ids)), k, exclude_self)
                nearest.meet(_names(base_ids), _points(row.column("base_points"), len(base_ids)))
                yield from nearest.results(ids.type, base_ids.type)

    return run


# ---- approximate neighbours through an index ------------------------------------------------------------------------

# Cells of an index, hence rows of the pivot table that each task holds: 8 MB at 64 dimensions.
MAX_INDEX_CELLS = 16_384
# Upper pivots whose cells a vector is compared with.
BEAM = 4
# Points whose cells are looked up at a time: 64 MB of distances at most.
PROBE_ROWS = 512
# Query blocks that one copy of a base block serves before it is copied.
BLOCKS_PER_COPY = 64


@dataclass(frozen=True)
class PivotTree:
    """Two levels of pivots: every cell pivot hangs below its nearest upper pivot."""

    pivots: np.ndarray
    tops: np.ndarray
    members: list[np.ndarray]

    @staticmethod
    def grown(pivots: np.ndarray) -> PivotTree:
        tops = pivots[: max(1, int(np.ceil(np.sqrt(len(pivots)))))]
        owner = _squared_distances(pivots, tops).argmin(1)
        return PivotTree(pivots, tops, [np.flatnonzero(owner == t) for t in range(len(tops))])

    def nearest(self, points: np.ndarray, count: int, beam: int = BEAM) -> np.ndarray:
        """The ``count`` nearest cells of each point below its ``beam`` nearest upper pivots, -1 where there are fewer."""
        beam = min(beam, len(self.tops))
        if beam == len(self.tops):  # every cell is compared
            apart, last = _squared_distances(points, self.pivots), min(count, len(self.pivots)) - 1
            return np.argpartition(apart, last, axis=1)[:, : last + 1]
        away = _squared_distances(points, self.tops)
        chosen = np.argpartition(away, beam - 1, axis=1)[:, :beam]
        best, cells = np.full((len(points), count), np.inf), np.full((len(points), count), -1)
        for top in np.unique(chosen).tolist():
            rows, below = np.flatnonzero((chosen == top).any(1)), self.members[top]
            met = np.concatenate([best[rows], _squared_distances(points[rows], self.pivots[below])], 1)
            names = np.concatenate([cells[rows], np.broadcast_to(below, (len(rows), len(below)))], 1)
            order = np.argsort(met, axis=1, kind="stable")[:, :count]
            best[rows], cells[rows] = np.take_along_axis(met, order, 1), np.take_along_axis(names, order, 1)
        return cells

    def probing(self, points: np.ndarray, count: int) -> Callable[[int], np.ndarray]:
        """The points that have a given cell among their ``count`` nearest, from one bit a point and cell."""
        width = -(-len(points) // PROBE_ROWS) * PROBE_ROWS // 8
        bits = np.zeros((width, len(self.pivots)), dtype=np.uint8)
        for start in range(0, len(points), PROBE_ROWS):
            cells = self.nearest(points[start : start + PROBE_ROWS], count, max(BEAM, count))
            rows, column = np.nonzero(cells >= 0)
            marked = np.zeros((PROBE_ROWS, len(self.pivots)), dtype=bool)
            marked[rows, cells[rows, column]] = True
            bits[start // 8 : (start + PROBE_ROWS) // 8] = np.packbits(marked, axis=0)
        return lambda cell: np.flatnonzero(np.unpackbits(bits[:, cell])[: len(points)])


@dataclass(frozen=True)
class NeighbourIndex:
    """A base cut into cells around the pivots of a tree and cells into blocks, written as a table.

    ``blocks`` has (cell, block, ids, points) and ``sizes`` (cell, base_blocks); equal vectors are held by their smallest
    ids, as many as ``most`` neighbours can need.
    """

    tree: PivotTree
    blocks: DataFrame
    sizes: DataFrame
    most: int


def build_index(base: DataFrame, most: int = 100, block_rows: int = BLOCK_ROWS, max_cells: int = MAX_INDEX_CELLS) -> NeighbourIndex:
    """Index every base vector for searches of up to ``most`` neighbours.

    Of vectors that are equal in all dimensions only the ``most`` + 1 smallest ids can be among the nearest, so the others
    are left out of the blocks before the shuffle: a vector that a third of all rows repeat is no crowded cell.
    """
    base = cut_lineage(_without_spare_copies(base, most + 1))
    n_base = base.count()
    tree = PivotTree.grown(_pick_pivots(base, max(1, min(max_cells, -(-n_base // block_rows))))) if n_base else None
    id_type = base.schema["id"].dataType.simpleString()
    if tree is None:
        spark = base.sparkSession
        blocks = spark.createDataFrame([], f"cell int, block int, ids array<{id_type}>, points array<double>")
        return NeighbourIndex(PivotTree(np.zeros((0, 0)), np.zeros((0, 0)), []), blocks, blocks.select("cell", "block"), most)
    assigned = _in_cells(base, tree, 1)
    counts = assigned.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("base_blocks"))
    sizes = cut_lineage(counts)
    blocks = (
        assigned.join(F.broadcast(sizes), "cell")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("base_blocks")).cast("int"))
        .groupBy("cell", "block")
        .agg(F.collect_list("id").alias("ids"), F.flatten(F.collect_list("features")).alias("points"))
    )
    written = cut_lineage(blocks)
    release(base)
    return NeighbourIndex(tree, written, sizes, most)


def release_index(index: NeighbourIndex) -> None:
    """Delete the tables of an index that will not be read again."""
    release(index.blocks)
    release(index.sizes)


def _in_cells(vectors: DataFrame, tree: PivotTree, count: int) -> DataFrame:
    """(id, features, cell): every vector once for each of its ``count`` nearest cells."""
    shared = vectors.sparkSession.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            step = max(1, PROBE_ROWS // count)
            for start in range(0, len(batch), step):
                part = batch.iloc[start : start + step]
                cells = shared.value.nearest(_stack(part["features"]), count, max(BEAM, count))
                rows, column = np.nonzero(cells >= 0)
                yield part.iloc[rows].assign(cell=cells[rows, column].astype("int32"))

    id_type = vectors.schema["id"].dataType.simpleString()
    return vectors.select("id", "features").mapInPandas(assign, f"id {id_type}, features array<double>, cell int")


def knn_indexed(
    query: DataFrame, index: NeighbourIndex, k: int, probes: int = 8, exclude_self: bool = False, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(query_id, base_id, dist2, rank)``: the ``k`` nearest among the vectors of each query's ``probes`` nearest cells.

    Distances are exact, the candidates are not all: ``index_recall`` says how many of the true neighbours are found and
    ``tune_probes`` chooses ``probes`` by it. Few probes: a query block meets ``probes`` cells at most, so work grows with
    the queries and not with their product with the base. Where copying the queries for each probe would move more than
    copying the base along the grid of ``knn``, they are held and the blocks of the base pass them. Ties go to the smaller
    id.
    """
    if k > index.most:
        raise ValueError(f"the index serves up to {index.most} neighbours")
    query = query.select("id", "features")
    schema = _found_schema(query, index.blocks.schema["ids"].dataType.elementType)
    n_query = query.count()
    if not len(index.tree.pivots) or not n_query:
        return query.sparkSession.createDataFrame([], schema + ", rank int")
    n_base = index.blocks.agg(F.sum(F.size("ids"))).first()[0]
    probes = min(probes, len(index.tree.pivots))
    query_shares, base_shares = _grid_sides(query.sparkSession, n_query, n_base, block_rows)
    if n_query * probes <= n_query * base_shares + n_base * query_shares:
        found = block_pairs(query, index, probes, block_rows).mapInArrow(_block_neighbours(k, exclude_self), schema)
        return _ranked(found, k)
    shared = query.sparkSession.sparkContext.broadcast(index.tree)
    meet = _hold_and_meet(k, exclude_self, lambda points: shared.value.probing(points, probes))
    blocks = index.blocks.withColumn("number", F.xxhash64("cell", "block"))
    return _ranked(_grid(query, blocks, n_query, n_base, block_rows).mapInArrow(meet, schema), k)


def block_pairs(query: DataFrame, index: NeighbourIndex, probes: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of queries beside the base blocks of the cells that they probe; blocks of a sought cell are copied."""
    asked = _in_cells(query, index.tree, min(probes, len(index.tree.pivots)))
    # One row a cell, so at most MAX_INDEX_CELLS.
    plan = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("query_blocks"))
    plan = cut_lineage(plan.join(F.broadcast(index.sizes), "cell"))
    copies = F.ceil(F.col("query_blocks") / F.lit(BLOCKS_PER_COPY)).cast("int")
    asking = (
        asked.join(F.broadcast(plan), "cell")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("query_blocks")).cast("int"))
        .groupBy("cell", "block", "base_blocks", "query_blocks")
        .agg(F.collect_list("id").alias("ids"), F.flatten(F.collect_list("features")).alias("points"))
        .withColumn("base_block", F.explode(F.sequence(F.lit(0), F.col("base_blocks") - 1)))
        .withColumn("copy", F.pmod(F.xxhash64("cell", "block"), copies).cast("int"))
        .drop("block", "base_blocks", "query_blocks")
    )
    offered = index.blocks.join(F.broadcast(plan), "cell").select(
        "cell",
        F.col("block").alias("base_block"),
        F.col("ids").alias("base_ids"),
        F.col("points").alias("base_points"),
        F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"),
    )
    return asking.join(offered, ["cell", "base_block", "copy"]).select("ids", "points", "base_ids", "base_points")


def index_recall(
    query: DataFrame, base: DataFrame, index: NeighbourIndex, k: int, probes: int, exclude_self: bool = False, sample_rows: int = 200
) -> DataFrame:
    """One row ``(queries, probes, recall)``: the share of true neighbours that the index finds for a sample of queries.

    The sample is the ``sample_rows`` queries of the smallest id hashes; they are compared with the whole base.
    """
    sample, true = _true_neighbours(query, base, k, exclude_self, sample_rows)
    return _recall(sample, true, index, k, probes, exclude_self)


def _true_neighbours(query: DataFrame, base: DataFrame, k: int, exclude_self: bool, sample_rows: int) -> tuple[DataFrame, DataFrame]:
    """The sample of queries and its ``(query_id, base_id)`` by exact search."""
    sample = cut_lineage(query.select("id", "features").orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    return sample, cut_lineage(knn(sample, base, k, exclude_self).select("query_id", "base_id"))


def _recall(sample: DataFrame, true: DataFrame, index: NeighbourIndex, k: int, probes: int, exclude_self: bool) -> DataFrame:
    got = knn_indexed(sample, index, k, probes, exclude_self).select("query_id", "base_id", F.lit(1).alias("_hit"))
    share = F.coalesce(F.avg(F.coalesce("_hit", F.lit(0))), F.lit(1.0))
    hits = true.join(got, ["query_id", "base_id"], "left")
    return hits.agg(F.count_distinct("query_id").alias("queries"), F.lit(probes).alias("probes"), share.alias("recall"))


def tune_probes(
    query: DataFrame,
    base: DataFrame,
    index: NeighbourIndex,
    k: int,
    target: float = 0.9,
    exclude_self: bool = False,
    sample_rows: int = 200,
) -> int:
    """The first of 1, 2, 4, ... probes whose sampled recall reaches ``target``; all cells are an exact search."""
    probes, cells = 1, max(1, len(index.tree.pivots))
    sample, true = _true_neighbours(query, base, k, exclude_self, sample_rows)
    while probes < cells:
        if _recall(sample, true, index, k, probes, exclude_self).first()["recall"] >= target:
            return probes
        probes *= 2
    return cells


def knn_classify(
    query: DataFrame, train: DataFrame, k: int, index: NeighbourIndex | None = None, probes: int = 8, **options
) -> DataFrame:
    """``(id, predicted)``: majority label of the ``k`` nearest; ties go to the label seen first by rank.

    With an ``index`` of the training vectors the neighbours are those that it finds.
    """
    neighbours = knn_indexed(query, index, k, probes, **options) if index else knn(query, train, k, **options)
    labelled = neighbours.join(train.select(F.col("id").alias("base_id"), "label"), "base_id")
    votes = labelled.groupBy("query_id", "label").agg(
        F.count(F.lit(1)).alias("_votes"), F.min("rank").alias("_first")
    )
    best = F.max_by("label", F.struct("_votes", -F.col("_first")))
    return votes.groupBy(F.col("query_id").alias("id")).agg(best.alias("predicted"))


def accuracy(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """One row ``(accuracy)`` of ``(id, predicted)`` against ``(id, label)``."""
    return predicted.join(truth.select("id", "label"), "id").agg(
        F.avg((F.col("predicted") == F.col("label")).cast("double")).alias("accuracy")
    )


# ---- means, covariance, projections ---------------------------------------------------------------------------------


def _moments(vectors: DataFrame, shift: np.ndarray | None = None) -> DataFrame:
    """``(i, j, s)`` partial sums of products of (shifted) dimensions, i <= j; one row a pair and input partition."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                x = _stack(batch["features"])
                x = x if shift is None else x - shift
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "s": total[i, j]})

    return vectors.select("features").mapInPandas(partial, "i int, j int, s double")


def column_means(vectors: DataFrame) -> DataFrame:
    """``(dim, mean)`` of every dimension, counted from 0."""
    return (
        vectors.select(F.posexplode("features").alias("dim", "_x"))
        .groupBy("dim")
        .agg(F.avg("_x").alias("mean"))
    )


def _mean_vector(vectors: DataFrame) -> np.ndarray:
    rows = column_means(vectors).orderBy("dim").collect()
    return np.array([r["mean"] for r in rows], dtype=np.float64)


def center(vectors: DataFrame) -> DataFrame:
    """Vectors minus the mean vector."""
    mean = constant_vector(_mean_vector(vectors))
    return vectors.withColumn("features", F.zip_with("features", mean, lambda x, m: x - m))


def gram_matrix(vectors: DataFrame) -> DataFrame:
    """``(i, j, s)`` of X'X, i <= j."""
    return _moments(vectors).groupBy("i", "j").agg(F.sum("s").alias("s"))


def covariance(vectors: DataFrame) -> DataFrame:
    """``(i, j, cov)`` with ddof 1, i <= j; products are summed about the mean."""
    n = vectors.count()
    sums = _moments(vectors, _mean_vector(vectors)).groupBy("i", "j").agg(F.sum("s").alias("s"))
    return sums.select("i", "j", (F.col("s") / F.lit(float(n - 1))).alias("cov"))


def _symmetric(entries: DataFrame, value: str) -> np.ndarray:
    """A d x d matrix on the driver from its upper triangle."""
    rows = entries.select("i", "j", value).collect()
    d = max((r["j"] for r in rows), default=-1) + 1
    matrix = np.zeros((d, d))
    for i, j, v in rows:
        matrix[i, j] = matrix[j, i] = v
    return matrix


def top_eigen(matrix: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest ``n`` eigenvalues, falling, and their vectors as columns; the largest component is made positive."""
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:n]
    values, vectors = values[order], vectors[:, order]
    largest = vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


@dataclass(frozen=True)
class Projection:
    """A fitted linear map: ``mean`` is subtracted (zero for SVD), ``components`` has one row a component."""

    mean: np.ndarray
    components: np.ndarray
    values: np.ndarray

    def transform(self, vectors: DataFrame) -> DataFrame:
        """Replace ``features`` by their projection, as codegen-able arithmetic on literals."""
        shifted = F.zip_with("features", constant_vector(self.mean), lambda x, m: x - m)
        moved = vectors.withColumn("features", shifted)
        parts: list[Column] = [dot(F.col("features"), constant_vector(row)) for row in self.components]
        return moved.withColumn("features", F.array(*parts))


def pca_fit(vectors: DataFrame, n: int) -> Projection:
    """Top ``n`` eigenvectors of the covariance matrix and the mean."""
    mean = _mean_vector(vectors)
    values, components = top_eigen(_symmetric(covariance(vectors), "cov"), n)
    return Projection(mean, components.T, values)


def svd_fit(vectors: DataFrame, k: int) -> Projection:
    """Top ``k`` right singular vectors of the uncentred data, from the Gram matrix."""
    values, components = top_eigen(_symmetric(gram_matrix(vectors), "s"), k)
    return Projection(np.zeros(len(components)), components.T, np.sqrt(np.maximum(values, 0.0)))


def reduce_then_1nn(train: DataFrame, test: DataFrame, method: str, k: int, **options) -> DataFrame:
    """Fit on the training vectors, project both, classify by the nearest one: one row ``(accuracy)``."""
    fit = {"pca": pca_fit, "svd": svd_fit}[method]
    projection = fit(train, k)
    predicted = knn_classify(projection.transform(test), projection.transform(train), 1, **options)
    return accuracy(predicted, test)
