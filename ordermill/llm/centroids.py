"""k-means on whole numbers, assigned by Orchard's search: walk the centroids' sorted neighbour lists.

Every centroid has the list of all centroids, nearest first. The search for a vector starts at the centroid nearest to
the mean of its batch, goes along that centroid's list, and jumps to the head of the list of any closer centroid it
finds (of equally close ones the one with the smaller number counts as closer). Centroids once compared are marked.
It stops where the list's distance is strictly more than twice the current one, since whatever follows is farther than
the current centroid; in squares, more than four times. The result is the nearest centroid, exactly. All vectors of a
batch take their steps together.

Vectors take part that have exactly ``width`` components, none null or not finite. A component x counts as floor(1024 * x),
and has to stay within 2^27, beyond which squared distances would leave 64 bits; a larger one ends the job with an error.
The first centroids are the vectors with the smallest SHA-256 of ``<seed>:<vec_id>`` (a null id is the empty text; of
equal ids the smaller vector comes first). In each round tasks hand on one sum a centroid, which Spark adds up; only
these k sums of ``width`` numbers come to the driver. Rows that repeat are vectors of their own and get equal results;
of fewer than k vectors each is a centroid; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ordermill.llm.common import Shared, bounded_batches, written

CLUSTERS = 8
ROUNDS = 10
WIDTH = 64
SCALE = 1024
SEED = 3
LARGEST = 1 << 27
#: Vectors that take their steps together.
STEP_ROWS = 4096


class Neighbours:
    """Centroids, and for each one all centroids by distance, itself first."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, dtype=np.int64)
        apart = self.centroids[:, None, :] - self.centroids[None, :, :]
        square = (apart * apart).sum(axis=2)
        self.order = np.argsort(square, axis=1, kind="stable")
        self.square = np.take_along_axis(square, self.order, axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of every point's nearest centroid, and how many distances were computed."""
        n, k = len(points), len(self.centroids)
        rows = np.arange(n)
        middle = points.mean(axis=0) if n else 0
        start = int(((self.centroids - middle) ** 2).sum(axis=1).argmin())
        current = np.full(n, start)
        least = self._squares(points, current)
        marked = np.zeros((n, k), dtype=bool)
        marked[:, start] = True
        place, compared = np.zeros(n, dtype=np.int64), n
        while len(rows):
            # Of squares, four times the current one is twice the distance; divided and rounded up, so that nothing overflows.
            ahead = place[rows] < k
            rows = rows[ahead]
            rows = rows[-(-self.square[current[rows], place[rows]] // 4) <= least[rows]]
            candidate = self.order[current[rows], place[rows]]
            place[rows] += 1
            new = ~marked[rows, candidate]
            at, candidate = rows[new], candidate[new]
            marked[at, candidate] = True
            square = self._squares(points[at], candidate)
            compared += len(at)
            closer = (square < least[at]) | ((square == least[at]) & (candidate < current[at]))
            at = at[closer]
            current[at], least[at], place[at] = candidate[closer], square[closer], 0
        return current, least, compared

    def _squares(self, points: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        apart = points - self.centroids[numbers]
        return (apart * apart).sum(axis=1)


def _blocks(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for low in range(0, batch.num_rows, STEP_ROWS):
        part = batch.slice(low, STEP_ROWS).column(column)
        yield low, part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def whole_vectors(rows: DataFrame, vec_id: str, embedding: str, width: int) -> DataFrame:
    """``vec_id`` and ``v``, the whole components, of the vectors that take part."""
    vector = F.col(f"`{embedding}`").cast("array<double>")
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.where((F.size(vector) == width) & usable).select(F.col(f"`{vec_id}`").alias("vec_id"), vector.alias("x"))
    beyond = F.raise_error(F.lit(f"components beyond {LARGEST // SCALE} do not fit exact 64-bit distances")).cast("int")
    whole = F.transform("x", lambda x: F.when(F.abs(x) < LARGEST / SCALE, F.floor(SCALE * x).cast("int")).otherwise(beyond))
    return kept.select("vec_id", whole.alias("v"))


def _sums(vectors: DataFrame, lists: Shared, width: int) -> DataFrame:
    """(cluster, n, sums) of one round of assignments."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(lists.value.centroids)
        for batch in batches:
            n, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
            for _, points in _blocks(batch, 0, width):
                cluster, _, _ = lists.value.nearest(points)
                n += np.bincount(cluster, minlength=k)
                np.add.at(sums, cluster, points)
            found = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array(n[found]), pa.array(list(sums[found]), pa.list_(pa.int64()))],
                names=["cluster", "n", "sums"],
            )

    parts = vectors.select("v").mapInArrow(partial, "cluster int, n long, sums array<long>")
    totals = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *totals)


def cluster(
    rows: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    seed: int = SEED,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, compared) for every vector that takes part.

    ``compared`` is how many distances its step block computed in the last round, a vector on average.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    vectors = written(whole_vectors(rows, vec_id, embedding, width), "centroid-vectors")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    centroids = [list(r["v"]) for r in vectors.orderBy(hashed, "v").limit(k).select("v").collect()]
    for _ in range(rounds if centroids else 0):
        for r in _sums(vectors, Shared(spark, Neighbours(centroids)), width).collect():
            centroids[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    lists = Shared(spark, Neighbours(centroids or [[0] * width]))
    result = "cluster int, distance long, compared double"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, points in _blocks(batch, 1, width):
                number, square, compared = lists.value.nearest(points)
                mean = np.full(len(points), compared / max(len(points), 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(points)), pa.array(number, pa.int32()), pa.array(square), pa.array(mean)],
                    names=["vec_id", "cluster", "distance", "compared"],
                )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    assigned = written(vectors.mapInArrow(assign, f"vec_id {kind}, {result}"), "centroid-assigned")
    # At most k rows, like the centroids themselves.
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    final = [(c, s, sum(inertia.values()), ",".join(map(str, centroids[c]))) for c, s in sorted(inertia.items())]
    table = spark.createDataFrame(final, "cluster int, cluster_inertia long, inertia long, components string")
    table = table.select("cluster", "cluster_inertia", "inertia", F.sha2("components", 256).alias("centroid_sha256"))
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared"
    )


def _oracle() -> str:
    """The same clusters in SQL, one step for each round."""
    steps = []
    for n in range(ROUNDS + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT k, vec_id, v, min_by(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM (
    SELECT x.k, vec_id, x.v, c.cluster, list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
    FROM vectors x CROSS JOIN c{n} c) GROUP BY k, vec_id, v
)""")
        steps.append(f"""
c{n + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN (
    SELECT cluster, list(mean ORDER BY i) AS v FROM (
      SELECT cluster, i, (sum(v[i]) // count(*) - CASE WHEN sum(v[i]) < 0 AND sum(v[i]) % count(*) <> 0 THEN 1 ELSE 0 END)::BIGINT AS mean
      FROM (SELECT cluster, v, unnest(range(1, {WIDTH + 1})) AS i FROM a{n}) GROUP BY cluster, i) GROUP BY cluster) m USING (cluster)
)""")
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v
  FROM (SELECT v, sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h FROM vectors) QUALIFY cluster < {CLUSTERS}
),{",".join(steps[:-1])}
SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} c USING (cluster)
"""


ORACLE = _oracle()
