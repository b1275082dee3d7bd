"""Operator 10: documents whose word n-gram sets are alike, by count vectors and R-trees.

A document is a point: its shingles are hashed into ``GROUPS`` groups and the group counts are the coordinates. The sum of
the smaller coordinates of two points bounds their overlap from above, for two documents and for the boxes of an R-tree.
A tree over all documents rules out little (random texts of equal length are close in few dimensions), so points first
meet in buckets that are exact for the threshold: the shingles of every document are put in one global order, and two
documents that link share one of their first ``n - ceil(0.85 n) + 1`` shingles. Shingles that a sample shows in many
documents come last in that order; this only makes buckets small, the order itself decides nothing.

1. Equal sets become one node (the smallest ``doc_id``); copies are counted together before the shuffle.
2. In each bucket a document meets its neighbour by size and the smallest of fitting size: linear in the bucket. Pairs
   that pass the bound are verified on their whole texts; components follow.
3. Buckets of four or more documents that still hold several components get an R-tree, which yields every pair that is left
   between components and passes the bound. Of these pairs only a spanning forest leaves the bucket: it tells the clusters
   of documents that could link. Sets of a cluster's documents then meet whole, each document once or, in a cluster of
   several shares, once a pair of shares; pairs are decided there, and links that join components leave. So no link between
   components is lost, and rows grow with the documents, however many pairs of a group pass the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm import blocks as B
from minewright.llm.wordhash import mix, shingle_sets, words_of
from minewright.operators.graph import components
from minewright.plans.lineage import cut_lineage, release
from minewright.plans.spread import spread_join

SHINGLE = 4
PERCENT = 85
GROUPS = 256
LEAF = 64
# Shingles of a share of a cluster (32 MB); a task holds two shares.
SHARE_SHINGLES = 1 << 22
# Ranges of hashes that two sets are compared in, until those left cannot make a link.
RANGES = 8
# Documents whose clusters a task remembers from bucket to bucket.
FOREST_ROWS = 1_000_000
SLICE_BYTES = 2 << 20
ORDER_SAMPLE = 4000
ORDER_SEEN = 4
ORDER_LIST = 50_000
_FULL = np.uint8(255)


def _sets(table: pa.Table, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets(words_of(table.column("text"), lower=True), shingle)


def frequent_shingles(docs: DataFrame, shingle: int) -> np.ndarray:
    """Shingles to put last: those in ``ORDER_SEEN`` or more of about ``ORDER_SAMPLE`` documents, ``ORDER_LIST`` at most."""
    total = docs.count()
    if not total:
        return np.zeros(0, np.uint64)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, ORDER_SAMPLE / total)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in B.gathered(batches, "text", SLICE_BYTES):
            yield pa.RecordBatch.from_pydict({"s": pa.array(_sets(table, shingle)[0].view(np.int64), pa.int64())})

    counts = docs.filter(draw).select("text").mapInArrow(scan, "s long").groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.filter(F.col("n") >= ORDER_SEEN).orderBy(F.desc("n"), "s").limit(ORDER_LIST).collect()
    return np.sort(np.array([r["s"] for r in rows], np.int64).view(np.uint64))


def _prefix(own: np.ndarray, late: np.ndarray, percent: int) -> np.ndarray:
    count = len(own) - -(-percent * len(own) // 100) + 1
    if len(late):
        at = np.minimum(np.searchsorted(late, own), len(late) - 1)
        own = own[np.argsort(late[at] == own, kind="stable")]
    return own[:count]


def _vectors(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    cells = rows * GROUPS + (mix(values ^ np.uint64(99)) % np.uint64(GROUPS)).astype(np.int64)
    return np.minimum(np.bincount(cells, minlength=(len(bounds) - 1) * GROUPS), _FULL).astype(np.uint8).reshape(-1, GROUPS)


def _profiles(docs: DataFrame, shingle: int, percent: int, late) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in B.gathered(batches, "text", SLICE_BYTES):
            values, bounds = _sets(table, shingle)
            edges, vectors = bounds.tolist(), _vectors(values, bounds)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values), dtype=np.uint64)])
            marks = mix((sums[bounds[1:]] - sums[bounds[:-1]]) ^ np.diff(bounds).astype(np.uint64))
            keys = [_prefix(values[a:b], late.value, percent).view(np.int64) for a, b in zip(edges, edges[1:], strict=False)]
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": table.column("doc_id").combine_chunks().cast(pa.int64()),
                    "n": pa.array(np.diff(bounds), pa.int64()),
                    "mark": pa.array(marks.view(np.int64), pa.int64()),
                    "keys": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys), pa.int64())),
                    "point": pa.array([v.tobytes() for v in vectors], pa.binary()),
                }
            )

    schema = "doc_id long, n long, mark long, keys array<long>, point binary"
    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def overlap_needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap with which sets of these sizes link: 100 o >= percent (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap of points or boxes: the sum of smaller coordinates. A full coordinate has no bound."""
    low = np.minimum(a, b)
    return np.where((low == _FULL).any(-1), np.int64(1) << 60, low.sum(-1, dtype=np.int64))


def tree_pairs(
    points: np.ndarray, sizes: np.ndarray, groups: np.ndarray, percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of different ``groups`` that the bound leaves, with it, by an R-tree of leaves of ``LEAF`` points.

    Leaves are packed by size; a leaf's box has its largest coordinates and its smallest size. Leaves meet only when their
    boxes can hold a link.
    """
    order = np.lexsort((groups, sizes))
    edges = np.arange(0, len(order), LEAF)
    sorted_points, sorted_sizes, sorted_groups = points[order], sizes[order], groups[order]
    boxes = np.maximum.reduceat(sorted_points, edges)
    least = sorted_sizes[edges]
    most = np.maximum.reduceat(sorted_sizes, edges)
    same = np.minimum.reduceat(sorted_groups, edges) == np.maximum.reduceat(sorted_groups, edges)
    for i, start in enumerate(edges.tolist()):
        to = int(np.searchsorted(least * percent, most[i] * 100, "right"))
        near = np.arange(i, to)
        near = near[overlap_bound(boxes[i : i + 1], boxes[i:to]) >= overlap_needed(least[i], least[i:to], percent)]
        near = near[~(same[near] & same[i] & (sorted_groups[edges[near]] == sorted_groups[start]))]
        own = slice(start, start + LEAF)
        for j in near.tolist():
            other = slice(int(edges[j]), int(edges[j]) + LEAF)
            bound = overlap_bound(sorted_points[own, None], sorted_points[None, other])
            fits = bound >= overlap_needed(sorted_sizes[own, None], sorted_sizes[None, other], percent)
            fits &= sorted_groups[own, None] != sorted_groups[None, other]
            if j == i:
                fits = np.triu(fits, 1)
            x, y = np.nonzero(fits)
            yield order[x + start], order[y + int(edges[j])], bound[x, y]


def _meet(postings: DataFrame, percent: int) -> DataFrame:
    """First pairs of each bucket (kind 0: a, b) and the rows of larger buckets (kind 1: key, document)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, int, int] | None = None
        for batch in batches:
            key, n, doc = (batch.column(c).to_numpy() for c in ("key", "n", "doc_id"))
            carried = last is not None and len(key) > 0 and last[0] == key[0]
            if carried:
                key, n, doc = (np.concatenate([[v], a]) for v, a in zip(last, (key, n, doc), strict=True))
            if not len(key):
                continue
            last = (int(key[-1]), int(n[-1]), int(doc[-1]))
            fresh = np.concatenate([[True], key[1:] != key[:-1]])
            starts = np.flatnonzero(fresh)
            run = np.cumsum(fresh) - 1
            lengths = np.diff(np.concatenate([starts, [len(key)]]))
            rank = run.astype(np.float64) * float(1 << 32) + np.minimum(n, (1 << 31) - 1)
            least = run.astype(np.float64) * float(1 << 32) + np.minimum(-(-percent * n // 100), (1 << 31) - 1)
            head = np.searchsorted(rank, least, "left")
            i = np.arange(len(key))
            before = i[1:][~fresh[1:] & (percent * n[1:] <= 100 * n[:-1])]
            heads = i[head < i - 1]
            a, b = np.concatenate([doc[before - 1], doc[head[heads]]]), np.concatenate([doc[before], doc[heads]])
            big = lengths >= 4
            big[[0, -1]] |= [carried, True]
            rows = big[run] & (lengths[run] > 1 if not carried else True)
            rows[-1] = True
            if carried:
                rows[0] = True
            kinds = np.concatenate([np.zeros(len(a), np.int32), np.ones(int(rows.sum()), np.int32)])
            yield pa.RecordBatch.from_pydict(
                {
                    "kind": pa.array(kinds, pa.int32()),
                    "a": pa.array(np.concatenate([np.minimum(a, b), key[rows]]), pa.int64()),
                    "b": pa.array(np.concatenate([np.maximum(a, b), doc[rows]]), pa.int64()),
                }
            )

    return postings.mapInArrow(scan, "kind int, a long, b long")


def _bounded(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose points can overlap enough."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (_points(batch.column(c)) for c in ("xp", "yp"))
                sizes = [batch.column(c).to_numpy() for c in ("xn", "yn")]
                yield batch.filter(pa.array(overlap_bound(x, y) >= overlap_needed(*sizes, percent))).select(["a", "b"])

    x = nodes.select(F.col("doc_id").alias("a"), F.col("n").alias("xn"), F.col("point").alias("xp"))
    y = nodes.select(F.col("doc_id").alias("b"), F.col("n").alias("yn"), F.col("point").alias("yp"))
    return pairs.join(x, "a").join(y, "b").mapInArrow(scan, "a long, b long")


def _points(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, GROUPS)


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs whose whole texts link."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.byte_slices(batch, "s", SLICE_BYTES):
                sets = []
                for side in ("s", "t"):
                    values, bounds = shingle_sets(words_of(part.column(side), lower=True), shingle)
                    sets.append([values[p:q] for p, q in zip(bounds, bounds[1:], strict=False)])
                keep = []
                for one, two in zip(*sets, strict=True):
                    shared = len(one) + len(two) - len(np.union1d(one, two))
                    keep.append(100 * shared >= percent * (len(one) + len(two) - shared) and len(one) > 0)
                yield part.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = cut_lineage(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"))
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("s"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("t"))
    links = cut_lineage(pairs.join(one, "a").join(two, "b").mapInArrow(scan, "a long, b long").distinct())
    release(texts)
    return links


def _tree_rows(met: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the larger buckets that hold several components, sorted by bucket within partitions."""
    rows = met.filter("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("doc_id")).distinct()
    rows = rows.join(labels.withColumnRenamed("id", "doc_id"), "doc_id")
    mixed = rows.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    rows = rows.join(mixed.filter("_low < _high").select("key"), "key").join(nodes.select("doc_id", "n", "point"), "doc_id")
    ordered = rows.select("key", "doc_id", "n", "component", "point").repartition(B.partitions_for(met), "key")
    return ordered.sortWithinPartitions("key")


def _whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The rows of each group, which lie together in the partition."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        table = pa.Table.from_batches([*held, batch])
        if not table.num_rows:
            continue
        keys = np.stack([table.column(c).to_numpy() for c in names])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist()]
        for low, high in zip(edges, edges[1:], strict=False):
            yield table.slice(low, high - low).combine_chunks()
        held = table.slice(edges[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _join_apart(x: np.ndarray, y: np.ndarray, root: np.ndarray, linked=None) -> list[tuple[int, int]]:
    """Pairs that join different sets of ``root``, which are then one; ``linked`` decides on a pair, all do without it."""
    joined, at = [], 0
    apart = root[x] != root[y]
    x, y = x[apart], y[apart]
    while at < len(x):
        a, b = int(x[at]), int(y[at])
        at += 1
        if linked is None or linked(a, b):
            joined.append((a, b))
            root[root == root[b]] = root[a]
            apart = root[x[at:]] != root[y[at:]]
            x, y, at = x[at:][apart], y[at:][apart], 0
    return joined


def _candidate_edges(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): a forest that spans what the pairs between components join that the trees leave.

    A task joins what its buckets join and gives each document its set's smallest one: stars, so that few rounds find the
    clusters, and no more edges than documents in the task.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def top(doc: int) -> int:
            while (up := above.setdefault(doc, doc)) != doc:
                above[doc] = doc = above.setdefault(up, up)
            return doc

        def stars() -> pa.RecordBatch:
            edges = [(least, doc) for doc in above if (least := top(doc)) != doc]
            return pa.RecordBatch.from_pydict({e: pa.array([p[i] for p in edges], pa.int64()) for i, e in enumerate("ab")})

        for table in _whole_groups(batches, ["key"]):
            doc, n, label = (table.column(c).to_numpy() for c in ("doc_id", "n", "component"))
            root = np.arange(len(doc))
            for x, y, _ in tree_pairs(_points(table.column("point").combine_chunks()), n, label, percent):
                for i, j in _join_apart(x, y, root):
                    a, b = top(int(doc[i])), top(int(doc[j]))
                    above[max(a, b)] = min(a, b)
            if len(above) > FOREST_ROWS:
                yield stars()
                above.clear()
        yield stars()

    return rows.mapInArrow(scan, "a long, b long")


def _clusters(edges: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, component, cluster, shares) of the documents of ``edges``; a share has about ``SHARE_SHINGLES`` shingles."""
    touched = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    found = components(touched, _both_ways(edges.distinct())).select(F.col("id").alias("doc_id"), F.col("component").alias("cluster"))
    sized = cut_lineage(found.join(nodes.groupBy("doc_id").agg(F.sum("n").alias("n")), "doc_id"))
    shares = F.ceil(F.sum("n") / F.lit(SHARE_SHINGLES)).cast("int")
    large = F.broadcast(sized.groupBy("cluster").agg(shares.alias("shares")).filter("shares > 1"))
    known = sized.join(labels.withColumnRenamed("id", "doc_id"), "doc_id").join(large, "cluster", "left")
    return known.select("doc_id", "component", "cluster", F.coalesce("shares", F.lit(1)).alias("shares"))


def _cluster_links(clusters: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links that join components, by the whole sets: a spanning forest of all links between components of a cluster.

    Every two shares of a cluster meet in a task, which holds their sets; a cluster of one share is one group.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in B.gathered(batches, "text", SLICE_BYTES):
            values, bounds = _sets(table, shingle)
            edges = bounds.tolist()
            columns = {c: table.column(c).combine_chunks() for c in ("doc_id", "component", "cluster", "shares")}
            columns["set"] = pa.array([values[p:q].tobytes() for p, q in zip(edges, edges[1:], strict=False)], pa.binary())
            columns["point"] = pa.array([v.tobytes() for v in _vectors(values, bounds)], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["cluster", "low", "high"]):
            doc, label = (table.column(c).to_numpy() for c in ("doc_id", "component"))
            held = table.column("set").combine_chunks()
            ends = np.frombuffer(held.buffers()[1], np.int32)[held.offset : held.offset + len(held) + 1] // 8
            values = np.frombuffer(held.buffers()[2], np.uint64, int(ends[-1]))
            sizes = np.diff(ends).astype(np.int64)
            points = _points(table.column("point").combine_chunks())
            root = np.unique(label, return_inverse=True)[1]
            limits = np.arange(1, RANGES, dtype=np.uint64) * np.uint64((1 << 64) // RANGES)
            cuts = [np.concatenate([[p], p + np.searchsorted(values[p:q], limits), [q]]) for p, q in zip(ends, ends[1:], strict=False)]

            def linked(a: int, b: int) -> bool:
                need, shared = overlap_needed(sizes[a], sizes[b], percent), 0
                for i in range(RANGES):
                    one, two = values[cuts[a][i] : cuts[a][i + 1]], values[cuts[b][i] : cuts[b][i + 1]]
                    if len(one) and len(two):
                        shared += int((two[np.minimum(np.searchsorted(two, one), len(two) - 1)] == one).sum())
                    if shared + min(ends[a + 1] - cuts[a][i + 1], ends[b + 1] - cuts[b][i + 1]) < need:
                        return False
                return True

            links = []
            for x, y, bound in tree_pairs(points, sizes, root.copy(), percent):
                first = np.argsort(-bound, kind="stable")
                links += _join_apart(x[first], y[first], root, linked)
            if links:
                a, b = doc[[i for i, _ in links]], doc[[j for _, j in links]]
                yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    kinds = "doc_id long, component long, cluster long, shares int, set binary, point binary"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(clusters, "doc_id")
    members = cut_lineage(texts.mapInArrow(sets, kinds).filter(F.length("set") > 0))
    share = F.pmod(F.xxhash64("doc_id"), F.col("shares")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("shares") - 1), lambda i: (i != F.col("share")) | (F.col("shares") == 1))
    met = members.withColumn("share", share).withColumn("other", F.explode(others))
    met = met.withColumn("low", F.least("share", "other")).withColumn("high", F.greatest("share", "other"))
    place = ["cluster", "low", "high"]
    dealt = met.select(*place, "doc_id", "component", "set", "point").repartition(B.partitions_for(docs), *place)
    links = cut_lineage(dealt.sortWithinPartitions(*place).mapInArrow(scan, "a long, b long"))
    release(members)
    return links


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_components(
    spark: SparkSession, docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    Words are split at ASCII white space and A-Z lower-cased; a text with fewer words than ``shingle`` has its whole
    sequence as one shingle; null and wordless texts have none, link with nothing and are their own component. Documents
    link at ``100 * intersection >= percent * union``; ``component_id`` is the smallest ``doc_id`` that links reach. A row
    with a null ``doc_id`` stands outside: null component, and it links nothing. Rows that share a ``doc_id`` link as one.
    An empty table gives an empty result; other columns are ignored.
    """
    late = spark.sparkContext.broadcast(frequent_shingles(docs, shingle))
    profiles = cut_lineage(_profiles(docs, shingle, percent, late))
    linkable = profiles.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    first = linkable.groupBy("mark").agg(F.min(F.struct("doc_id", "n", "keys", "point")).alias("first"))
    nodes = cut_lineage(first.select("mark", "first.*"))
    postings = nodes.select(F.explode("keys").alias("key"), "n", "doc_id")
    spread = postings.repartition(B.partitions_for(docs), "key").sortWithinPartitions("key", "n", "doc_id")
    met = cut_lineage(_meet(spread, percent))
    pairs = met.filter("kind = 0 and a < b").select("a", "b").distinct()
    tried = cut_lineage(_bounded(pairs, nodes, percent))
    links = _verified(tried, docs, shingle, percent)
    ids = nodes.select(F.col("doc_id").alias("id")).distinct()
    labels = components(ids, _both_ways(links))
    edges = cut_lineage(_candidate_edges(_tree_rows(met, nodes, labels), percent))
    if not edges.isEmpty():
        labels = _merged(labels, _cluster_links(_clusters(edges, nodes, labels), docs, shingle, percent))
    release(edges)
    release(met)
    known = nodes.join(labels.withColumnRenamed("id", "doc_id"), "doc_id").select("mark", F.col("component"))
    known = known.groupBy("mark").agg(F.min("component").alias("component"))
    members = profiles.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0)).select("doc_id", "n", "mark")
    joined = spread_join(members, known, "mark", spread_by=["doc_id"])
    alone = profiles.filter(F.col("doc_id").isNull() | (F.col("n") == 0)).withColumn("component", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")]
    return joined.select(*columns).union(alone.select(*columns))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(
        links.select(F.col("b").alias("src"), F.col("a").alias("dst"))
    )


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links: only the components that these links join are gone through again."""
    of = [labels.select(F.col("id").alias(end), F.col("component").alias(name)) for end, name in (("a", "x"), ("b", "y"))]
    ends = spread_join(spread_join(links, of[0], "a", spread_by=["b"]), of[1], "b", spread_by=["a"])
    joined = cut_lineage(_ordered(ends.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))))
    if joined.isEmpty():
        return labels
    touched = joined.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    lower = components(touched, _both_ways(joined)).select(F.col("id").alias("component"), F.col("component").alias("lower"))
    renamed = spread_join(labels, lower, "component", "left", spread_by=["id"])
    return cut_lineage(renamed.select("id", F.coalesce("lower", "component").alias("component")))


def keep_first(spark: SparkSession, docs: DataFrame, *, shingle: int, percent: int) -> DataFrame:
    """One document of each component, the one with the smallest id, with all columns; rows without an id stay."""
    found = link_components(spark, docs, shingle=shingle, percent=percent)
    gone = found.filter(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
