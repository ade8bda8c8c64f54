"""Approximate nearest neighbours by inner product with a hierarchical k-means tree.

Equal vectors form one class with its ``k + 1`` smallest ids, which is all a result can show. Classes are
placed on a sphere, with one more component that makes up for shorter lengths, so that the
largest inner product is the smallest distance. The tree is fitted on at most ``SAMPLE`` classes (smallest hashes
first); every class then descends to its nearest leaf. A query visits leaves best-bin-first: a priority
queue holds the branches passed by, nearest centre first. The number of leaves visited is widened
until the calibration queries (at most ``CALIBRATION``), whose neighbours are found exactly over all
other classes, have recall ``TARGET``; with all leaves the search is exact.

The first ``FIRST`` leaves of a query give a bound, the score of the last neighbour found there; the other
leaves hand on only what reaches it. A query's leaves stay a list in its row until both are joined.

There are about as many leaves as a leaf has classes, both growing with the square root of the table, so a query
visits at most as many leaves however large they get. A leaf's classes and the queries that visit it are cut into blocks of at most about ``BLOCK`` rows, so no task
holds a whole leaf, however large or sought after. Scores are inner products of the original
vectors in double precision; ties go to the smaller id.

Rows take no part whose id or vector is null, or whose vector is zero, has null or non-finite components or
another length than most vectors (the shorter of equally frequent ones). Rows that repeat id and
vector count once.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ordermill.llm.common import Shared, bounded_batches, written

NEIGHBOURS = 20
SAMPLE = 200_000
#: Classes of a leaf at least, and fitted ones.
LEAF = 64
LEAF_FITTED = 8
BRANCHES = 16
ROUNDS = 8
CALIBRATION = 256
TARGET = 0.97
FIRST = 8
BLOCK = 2048
SEED = 11


class Tree:
    """Centres of inner nodes and their children; a negative child -1 - n is leaf n."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.random = np.random.default_rng(SEED)
        self.root = self._grow(points, leaf)

    def _grow(self, points: np.ndarray, leaf: int) -> int:
        if len(points) > leaf:
            centres, of = self._cluster(points, min(BRANCHES, -(-len(points) // leaf)))
            if len(centres) > 1:
                node = len(self.centres)
                self.centres.append(centres)
                self.children.append([])
                self.children[node] = [self._grow(points[of == c], leaf) for c in range(len(centres))]
                return node
        self.leaves += 1
        return -self.leaves

    def _cluster(self, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        centres = points[self.random.choice(len(points), k, replace=False)]
        for _ in range(ROUNDS):
            of = _nearest(points, centres)
            used, of = np.unique(of, return_inverse=True)
            sums = np.zeros((len(used), points.shape[1]))
            np.add.at(sums, of, points)
            centres = (sums / np.bincount(of)[:, None]).astype(points.dtype)
        used, of = np.unique(_nearest(points, centres), return_inverse=True)
        return centres[used], of

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                of = _nearest(points[rows], self.centres[node])
                todo += [(child, rows[of == c]) for c, child in enumerate(self.children[node])]
        return out

    def visits(self, point: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        queue, order = [(0.0, self.root)], []
        while queue and len(order) < most:
            _, node = heapq.heappop(queue)
            if node < 0:
                order.append(-1 - node)
            else:
                away = ((self.centres[node] - point) ** 2).sum(axis=1).tolist()
                for entry in zip(away, self.children[node]):
                    heapq.heappush(queue, entry)
        return order


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = [
        ((centres**2).sum(axis=1) - 2 * (points[low : low + 8192] @ centres.T)).argmin(axis=1)
        for low in range(0, len(points), 8192)
    ]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _on_sphere(vectors: np.ndarray, longest: float) -> np.ndarray:
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
    return np.hstack([scaled, rest[:, None]]).astype(np.float32)


def _directions(queries: np.ndarray) -> np.ndarray:
    unit = queries / np.sqrt((queries**2).sum(axis=1))[:, None]
    return np.hstack([unit, np.zeros((len(unit), 1))]).astype(np.float32)


def _best(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, id, score) of each query's k best, ties to smaller ids; scores as row sums, the same in any block."""
    rough = queries @ vectors.T
    numbers, chosen, scores = [], [], []
    for i in range(len(queries)):
        at = np.arange(len(ids))
        if len(at) > k:
            # Products in a block may differ in the last bits from row sums: take all that could reach the kth.
            least = np.partition(rough[i], len(at) - k)[len(at) - k]
            at = np.flatnonzero(rough[i] >= least - 1e-9 * max(1.0, abs(least)))
        exact = (vectors[at] * queries[i]).sum(axis=1)
        order = np.lexsort((ids[at], -exact))[:k]
        numbers.append(np.full(len(order), i))
        chosen.append(ids[at][order])
        scores.append(exact[order])
    return np.concatenate(numbers), np.concatenate(chosen), np.concatenate(scores)


def _reaching(queries: np.ndarray, bounds: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    """Like ``_best``, but all that reach the queries' bounds; queries without a bound (nan) get their k best."""
    open_ = np.flatnonzero(np.isnan(bounds))
    at, chosen, scores = _best(queries[open_], ids, vectors, k) if len(open_) else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    slack = bounds - 1e-9 * np.maximum(1.0, np.abs(bounds))
    row, column = np.nonzero(queries @ vectors.T >= slack[:, None])
    exact = (vectors[column] * queries[row]).sum(axis=1)
    keep = exact >= bounds[row]
    return (
        np.concatenate([open_[at], row[keep]]),
        np.concatenate([chosen, ids[column[keep]]]),
        np.concatenate([scores, exact[keep]]),
    )


def _valid(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    vector = F.col(embedding).cast("array<double>")
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), vector.alias("v"))
    # A sum of squares beyond all bounds would make lengths infinite; such vectors are not usable either.
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows = rows.withColumn("square", square).where("vec_id is not null and square > 0 and square < double('infinity')")
    widths = rows.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"))
    width = widths.orderBy(F.desc("n"), "width").first()
    return rows.where(F.size("v") == (width["width"] if width else 0)).distinct()


def _top(rows: DataFrame, by: str, k: int, order: list[Column]) -> DataFrame:
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def search(
    rows: DataFrame,
    asks: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = NEIGHBOURS,
    target: float = TARGET,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``asks``, a condition on ``vec_id``, holds."""
    spark = rows.sparkSession
    bounded_batches(spark)
    valid = written(_valid(rows, vec_id, embedding), "ann-vectors")
    first = valid.first()
    if first is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = len(first["v"])
    kept = _top(valid, "v", k + 1, [F.col("vec_id")])
    classes = kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    classes = written(classes.select(F.col("members")[0].alias("class"), "members", "v"), "ann-classes")
    queries = valid.where(asks).select("vec_id", "v").join(classes.select("v", "class"), "v")
    queries = written(queries.select(F.col("vec_id").alias("query_id"), "class"), "ann-queries")
    asking = written(classes.join(queries.select("class").distinct(), "class", "left_semi").select("class", "v"), "ann-asking")

    size = classes.agg(
        F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("longest")
    ).first()
    longest = size["longest"] * (1 + 1e-6)
    fitted = classes.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("v").toArrow()
    share = len(fitted) / size["n"]
    leaf_size = max(LEAF, size["n"] ** 0.5)
    tree = Tree(_on_sphere(_matrix(fitted["v"], width), longest), max(round(leaf_size * share), LEAF_FITTED))
    shared = Shared(spark, tree)

    @F.arrow_udf("long")
    def leaf(v: pa.Array) -> pa.Array:
        return pa.array(shared.value.leaf_of(_on_sphere(_matrix(v, width), longest)), pa.int64())

    placed = written(classes.select("class", "v", leaf("v").alias("leaf")), "ann-placed")

    # Calibration: exact neighbours of some queries, and how many visits reach their leaves.
    probes = asking.orderBy(F.xxhash64("class"), "class").limit(CALIBRATION).toArrow()
    visits = tree.leaves
    if len(probes):
        points = _matrix(probes["v"], width)
        exact, own = Shared(spark, points), probes["class"].to_numpy()

        def brute(batches):
            for batch in batches:
                if batch.num_rows:
                    ids, leaves = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                    at, chosen, scores = _best(exact.value, ids, _matrix(batch.column(1), width), k + 1)
                    # The query's own class is no neighbour, and nearly always in the first leaf.
                    other = chosen != own[at]
                    at, chosen, scores = at[other], chosen[other], scores[other]
                    order = np.argsort(ids)
                    found = leaves[order[np.searchsorted(ids, chosen, sorter=order)]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at), pa.array(chosen), pa.array(scores), pa.array(found)], names=["probe", "class", "score", "leaf"]
                    )

        truth = placed.select("class", "v", "leaf").mapInArrow(brute, "probe long, class long, score double, leaf long")
        truth = _top(truth, "probe", k, [F.desc("score"), F.col("class")]).select("probe", "leaf").collect()
        orders = [{leaf: n for n, leaf in enumerate(tree.visits(p, tree.leaves), 1)} for p in _directions(points)]
        reached = np.sort([orders[r["probe"]][r["leaf"]] for r in truth])
        visits = 1
        while np.searchsorted(reached, visits, side="right") < target * len(reached):
            visits += max(1, visits // 8)
        visits = min(visits, tree.leaves)

    @F.arrow_udf("array<long>")
    def route(v: pa.Array) -> pa.Array:
        return pa.array([shared.value.visits(p, visits) for p in _directions(_matrix(v, width))], pa.list_(pa.int64()))

    routed = written(asking.select("class", "v", route("v").alias("leaves")), "ann-routed")

    def blocks(table: DataFrame, name: str) -> DataFrame:
        counts = table.groupBy("leaf").agg(F.count("*").alias("n"))
        return counts.select("leaf", F.ceil(F.col("n") / BLOCK).cast("long").alias(name))

    def compare(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(candidates) or not len(asked):
            return pa.table({"query": pa.array([], pa.int64()), "class": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        vectors, ids = _matrix(candidates["v"], width), candidates["class"].to_numpy()
        bounds = asked["bound"].to_numpy(zero_copy_only=False).astype(float)
        at, chosen, scores = _reaching(_matrix(asked["v"], width), bounds, ids, vectors, k + 1)
        return pa.table({"query": asked["class"].to_numpy()[at], "class": chosen, "score": scores})

    def compared(visiting: DataFrame) -> DataFrame:
        grid = written(blocks(placed, "rows").join(blocks(visiting, "asks"), "leaf"), "ann-grid")
        left = placed.join(grid, "leaf").select(
            "leaf", F.pmod(F.xxhash64("class"), "rows").alias("r"), F.explode(F.sequence(F.lit(0), F.col("asks") - 1)).alias("q"), "class", "v"
        )
        right = visiting.join(grid, "leaf").select(
            "leaf", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("r"), F.pmod(F.xxhash64("class"), "asks").alias("q"), "class", "v", "bound"
        )
        found = left.groupBy("leaf", "r", "q").cogroup(right.groupBy("leaf", "r", "q"))
        found = found.applyInArrow(compare, "query long, class long, score double")
        return _top(found, "query", k + 1, [F.desc("score"), F.col("class")]).select("query", "class", "score")

    def visiting(rows: DataFrame, leaves: Column) -> DataFrame:
        return written(rows.select("class", "v", "bound", F.explode(leaves).alias("leaf")), "ann-visiting")

    unbound = routed.withColumn("bound", F.lit(None).cast("double"))
    near = written(compared(visiting(unbound, F.slice("leaves", 1, FIRST))), "ann-near")
    bounds = near.groupBy("query").agg(F.min("score").alias("bound"), F.count("*").alias("n"))
    bounds = written(bounds.where(F.col("n") > k).select(F.col("query").alias("class"), "bound"), "ann-bounds")
    later = F.slice("leaves", FIRST + 1, tree.leaves)
    far = compared(visiting(routed.join(bounds, "class", "left"), later))
    best = _top(near.union(far), "query", k + 1, [F.desc("score"), F.col("class")]).select("query", "class", "score")
    members = best.join(classes.select("class", "members"), "class").select("query", "score", F.explode("members").alias("vec_id"))
    members = _top(members, "query", k + 1, [F.desc("score"), F.col("vec_id")])
    lists = members.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    out = queries.join(lists, queries["class"] == lists["query"]).select(
        "query_id", F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("found")
    )
    return out.select("query_id", F.posexplode("found").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"
    )
