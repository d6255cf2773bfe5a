"""Exact top-k by inner product with M-trees, searched best-first.

Scores are whole numbers (the inner product of floor(scale * x)). They become
a metric problem by one more coordinate: with M the largest length, v becomes
(v, sqrt(M^2 - |v|^2)) and a query (q, 0), and the squared distance is
|q|^2 + M^2 - 2 * score, so the nearest rows are the best scores.

*Forest.* Up to ``max_pivots`` vectors (those of least id hash) are pivots:
the root's routing objects, a bounded table. Each row belongs to its nearest
pivot; a pivot's rows are dealt to trees of about ``tree_rows``, so copies and
dense regions spread over tasks. A tree is bulk-loaded into pages: a node has
a routing object, the covering radius of all below it and its distance to its
parent's routing object; a leaf holds up to ``page`` rows with their distances
to it.

*Search.* A query first searches one tree of its own pivot, which bounds its
k-th distance; then it visits the trees of every pivot whose ball can hold
something at least as near, and the best k of all are kept. In a tree nodes
are taken from a heap by least possible distance. A child whose stored parent
distance differs from the query's distance to the parent by more than radius
and bound is left out without computing its distance, and so is a leaf row by
its distance to the leaf's object. Distances carry rounding errors, so bounds
get a margin; scores are computed in whole numbers, and ties go to the smaller
vec_id, so results are exact. Where a score may leave a long's range it is
computed in Python's whole numbers and counts as the nearest end of the range,
and so does a component beyond it.

Rows with a NULL vec_id or a vector that is NULL, empty or holds NULL or
non-finite components take no part; vectors of different dimension do not
meet. Repeated rows are candidates each (but none for a query of the same id).
Queries go in blocks of ``query_block``, so a task holds one tree and one
block. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contract_lake.llm.common import arrow_map, batch_of, sorted_groups, written

LONG = np.iinfo(np.int64)


def margin(longest: float) -> float:
    """Relative rounding error of a distance: squares below 2^52 are exact."""
    return 1e-9 if longest < 2.0 ** 52 else 1e-7

PAGE = pa.schema([("tree", pa.int64()), ("page", pa.int32()), ("parent", pa.int32()), ("center", pa.list_(pa.float64())), ("radius", pa.float64()),
                  ("parent_distance", pa.float64()), ("ids", pa.list_(pa.int64())), ("members", pa.list_(pa.int64())), ("distances", pa.list_(pa.float64()))])
PAGE_TYPE = ("tree long, page int, parent int, center array<double>, radius double, parent_distance double, ids array<long>, "
             "members array<long>, distances array<double>")


def matrix(column, kind=np.int64) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def lifted(v: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the coordinate that gives all the same length."""
    v = v.astype(np.float64)
    return np.column_stack([v, np.sqrt(np.maximum(0, longest - (v * v).sum(axis=1)))])


def pages_of(points: np.ndarray, root: np.ndarray, page: int, seed: int) -> list[tuple]:
    """Bulk load: (page, parent, center, radius, parent distance, member rows
    or None, member distances) of each node, the root first."""
    chance = np.random.default_rng(seed)
    out: list[tuple] = []
    stack = [(np.arange(len(points)), root, -1, 0.0)]
    while stack:
        rows, center, parent, parent_distance = stack.pop()
        away = np.sqrt(((points[rows] - center) ** 2).sum(axis=1))
        number = len(out)
        if len(rows) <= page:
            out.append((number, parent, center, float(away.max(initial=0)), parent_distance, rows, away))
            continue
        out.append((number, parent, center, float(away.max()), parent_distance, None, None))
        seeds = points[rows[chance.choice(len(rows), min(page, -(-len(rows) // page) + 1), replace=False)]]
        nearest = np.argmin((seeds * seeds).sum(axis=1) - 2 * points[rows] @ seeds.T, axis=1)
        groups = [(k, rows[nearest == k]) for k in np.unique(nearest)]
        if len(groups) == 1:  # all alike: cut by number
            groups = [(0, part) for part in np.array_split(rows, -(-len(rows) // page))]
        for k, part in groups:
            stack.append((part, seeds[k], number, float(np.sqrt(((seeds[k] - center) ** 2).sum()))))
    return out


class Tree:
    """The pages of one tree, ready for searches."""

    def __init__(self, pages: pa.Table, dim: int):
        order = np.argsort(pages.column("page").to_numpy())
        pages = pages.take(pa.array(order))
        self.centers = matrix(pages.column("center"), np.float64)
        self.radius = pages.column("radius").to_numpy()
        self.parent_distance = pages.column("parent_distance").to_numpy()
        children = defaultdict(list)
        for k, parent in enumerate(pages.column("parent").to_pylist()):
            children[parent].append(k)
        self.children = {k: np.array(v) for k, v in children.items()}
        self.ids = [np.array(x, np.int64) for x in pages.column("ids").to_pylist()]
        self.members = [np.array(x, np.int64).reshape(-1, dim) for x in pages.column("members").to_pylist()]
        self.distances = [np.array(x) for x in pages.column("distances").to_pylist()]

    def search(self, own: int, query: np.ndarray, longest: float, k: int, reach: float) -> list[tuple[int, int]]:
        """The best (score, id) of at most k rows that can lie within
        ``reach`` (a distance), best first."""
        point = np.append(query.astype(np.float64), 0.0)
        length = float(point @ point) + longest
        slack = margin(longest) * (length + 1) ** 0.5
        wide = longest >= 2.0 ** 62  # no score is beyond the longest square
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        bound = reach + slack
        distance = float(np.sqrt(((self.centers[0] - point) ** 2).sum()))
        queue = [(max(0.0, distance - self.radius[0]), 0, distance)]
        while queue:
            least, node, distance = heapq.heappop(queue)
            if least > bound:
                break
            if node in self.children:
                kids = self.children[node]
                kids = kids[np.abs(distance - self.parent_distance[kids]) - self.radius[kids] <= bound]
                if len(kids):
                    away = np.sqrt(((self.centers[kids] - point) ** 2).sum(axis=1))
                    for kid, d in zip(kids.tolist(), away.tolist(), strict=True):
                        if d - self.radius[kid] <= bound:
                            heapq.heappush(queue, (max(0.0, d - self.radius[kid]), kid, d))
                continue
            near = (np.abs(distance - self.distances[node]) <= bound) & (self.ids[node] != own)
            if not near.any():
                continue
            if wide:
                scores = np.clip(self.members[node][near].astype(object) @ query.astype(object), LONG.min, LONG.max)
            else:
                scores = self.members[node][near] @ query
            for score, i in zip(scores.tolist(), self.ids[node][near].tolist(), strict=True):
                if len(best) < k:
                    heapq.heappush(best, (score, -i))
                elif (score, -i) > best[0]:
                    heapq.heapreplace(best, (score, -i))
            if len(best) == k and best[0][0] > LONG.min:
                bound = min(bound, max(0.0, length - 2 * best[0][0]) ** 0.5 + slack)
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def whole_numbers(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id`` and ``v`` (floor(scale * x)) of the rows that take part."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("x"))
    return (rows.where(F.col("vec_id").isNotNull() & F.coalesce(F.forall("x", fine) & (F.size("x") > 0), F.lit(False)))
            .select("vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("v")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, max_pivots: int = 1024, tree_rows: int = 1024,
          page: int = 32, query_block: int = 1024) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best rows for each
    row of ``vectors`` that satisfies ``is_query``."""
    rows = written(whole_numbers(vectors, scale).withColumn("dim", F.size("v")), "mtree-rows")
    # One pass for the longest vector of each dimension; dimensions are few by nature.
    longest = {r.dim: r.m * (1 + 1e-12) for r in rows.groupBy("dim").agg(F.max(F.aggregate(F.col("v").cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x)).alias("m")).collect()}
    total = rows.count()
    wanted = min(max_pivots, max(1, -(-total // (8 * tree_rows))))
    pivots: dict[int, np.ndarray] = {}
    for dim in longest:
        some = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).select("v").toArrow()
        pivots[dim] = lifted(matrix(some.column("v")), longest[dim])

    def by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            yield int(dim), batch.filter(pa.array(dims == dim))

    celled = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int64())), ("dim", pa.int32()), ("cell", pa.int32()), ("away", pa.float64())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in by_dimension(batch):
                points = lifted(matrix(part.column("v")), longest[dim])
                near = np.argmin((pivots[dim] ** 2).sum(axis=1) - 2 * points @ pivots[dim].T, axis=1)
                away = np.sqrt(((points - pivots[dim][near]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("v").cast(pa.list_(pa.int64())), part.column("dim"),
                                                  pa.array(near, pa.int32()), pa.array(away)], schema=celled)

    inside = written(arrow_map(rows, assign, "vec_id long, v array<long>, dim int, cell int, away double"), "mtree-cells")
    # One row for each pivot and dimension: at most max_pivots for a dimension.
    cells = inside.groupBy("dim", "cell").agg(F.max("away").alias("radius"), F.ceil(F.count("*") / tree_rows).alias("trees")).collect()
    radius = {(r.dim, r.cell): r.radius for r in cells}
    trees = {(r.dim, r.cell): r.trees for r in cells}
    directory = inside.sparkSession.createDataFrame([(r.dim, r.cell, r.trees) for r in cells], "dim int, cell int, trees long")
    tree = F.xxhash64("dim", "cell", "number").alias("tree")
    dealt = (inside.join(F.broadcast(directory), ["dim", "cell"]).withColumn("number", F.pmod(F.xxhash64("vec_id"), F.col("trees")))
             .select(tree, "dim", "cell", "vec_id", "v"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "tree"):
            name, dim, cell = (group.column(c)[0].as_py() for c in ("tree", "dim", "cell"))
            order = np.argsort(group.column("vec_id").to_numpy(), kind="stable")  # the same tree from any order of rows
            ids, v = group.column("vec_id").to_numpy()[order], matrix(group.column("v"))[order]
            out = []
            for number, parent, center, reach, parent_distance, members, away in pages_of(lifted(v, longest[dim]), pivots[dim][cell], page, name & 0xFFFFFFFF):
                leaf = members is not None
                out.append((name, number, parent, center, reach, parent_distance, ids[members] if leaf else [], v[members].ravel() if leaf else [],
                            away if leaf else []))
            yield batch_of(PAGE, *zip(*out, strict=True))

    forest = written(arrow_map(dealt.repartition("tree").sortWithinPartitions("tree"), build, PAGE_TYPE), "mtree-pages")

    asked = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("query_id", pa.int64()), ("q", pa.list_(pa.int64())), ("dim", pa.int32()), ("reach", pa.float64())])
    hit = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "task"):
            is_page = group.column("page").is_valid().to_numpy()
            if is_page.all():
                continue
            queries, nodes = group.filter(pa.array(~is_page)), group.filter(pa.array(is_page))
            dim = queries.column("dim")[0].as_py()
            one = Tree(nodes, dim)
            out = []
            for own, q, reach in zip(queries.column("query_id").to_pylist(), matrix(queries.column("q")), queries.column("reach").to_pylist(), strict=True):
                out += [(own, i, score) for score, i in one.search(own, q, longest[dim], k, np.inf if reach is None else reach)]
            if out:
                yield batch_of(hit, *zip(*out, strict=True))

    def searched(queries: DataFrame) -> DataFrame:
        """The k best rows of the named tree for each of ``queries``."""
        blocks = queries.groupBy("tree").agg(F.ceil(F.count("*") / query_block).alias("blocks"))
        named = (queries.join(blocks, "tree").withColumn("task", F.xxhash64("tree", F.pmod(F.xxhash64("query_id"), F.col("blocks"))))
                 .select("task", "query_id", "q", "dim", "reach"))
        pages = (forest.join(blocks, "tree").withColumn("task", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                                                                                    lambda b: F.xxhash64("tree", b)))).drop("tree", "blocks"))
        both = named.unionByName(pages, allowMissingColumns=True)
        return arrow_map(both.repartition("task").sortWithinPartitions("task"), search, "query_id long, vec_id long, score long")

    queries = inside.where(is_query).withColumnRenamed("vec_id", "query_id").withColumnRenamed("v", "q").distinct()
    own_tree = queries.join(F.broadcast(directory), ["dim", "cell"]).withColumn("number", F.pmod(F.xxhash64("query_id"), F.col("trees"))).select(
        tree, "query_id", "q", "dim", F.lit(None).cast("double").alias("reach"))
    # The k-th best score in one tree bounds the search of the others (fewer rows there: no bound).
    kth = written(searched(own_tree).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")), "mtree-bounds")

    visit = pa.schema([("query_id", pa.int64()), ("q", pa.list_(pa.int64())), ("dim", pa.int32()), ("cell", pa.int32()), ("trees", pa.int64()), ("reach", pa.float64())])

    def cells_in_reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in by_dimension(batch):
                q = matrix(part.column("q"))
                points = np.column_stack([q.astype(np.float64), np.zeros(len(q))])
                length = (points * points).sum(axis=1) + longest[dim]
                least = part.column("least").to_numpy(zero_copy_only=False).astype(np.float64)
                reach = np.where(np.isnan(least), np.inf, np.sqrt(np.maximum(0, length - 2 * least)))
                reach[least <= float(LONG.min)] = np.inf
                reach += margin(longest[dim]) * np.sqrt(length + 1)
                for c, pivot in enumerate(pivots[dim]):
                    if (dim, c) in radius:
                        near = np.sqrt(((points - pivot) ** 2).sum(axis=1)) - radius[dim, c] <= reach
                        if near.any():
                            some = part.filter(pa.array(near))
                            n = some.num_rows
                            yield pa.RecordBatch.from_arrays(
                                [some.column("query_id"), some.column("q").cast(pa.list_(pa.int64())), some.column("dim"), pa.array(np.full(n, c), pa.int32()),
                                 pa.array(np.full(n, trees[dim, c]), pa.int64()), pa.array(reach[near])], schema=visit)

    bounded = queries.join(kth.where(F.col("n") >= k).select("query_id", "least"), "query_id", "left").select("query_id", "q", "dim", "least")
    visits = (arrow_map(bounded, cells_in_reach, "query_id long, q array<long>, dim int, cell int, trees long, reach double")
              .withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("trees") - 1)))
              .select(tree, "query_id", "q", "dim", "reach"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (searched(written(visits, "mtree-visits")).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
