"""Centroid clustering: k-means rounds whose assignment is an Orchard search.

Every centroid has the list of the others by distance.  A vector walks the
list of its nearest centroid so far: a closer one found there becomes the
current one, whose list is walked from its start; centroids already measured
are marked and skipped; the walk ends at the first entry strictly farther than
twice the current distance, as nothing from there on can be nearer or as near
(triangle inequality).  All vectors of a batch walk in step, in arrays.

All figures are integers, so results do not depend on the partitioning.  A
round is one pass over the vectors that returns k rows of sums a task; the
centroids, k short rows, go back with the next pass.  Nothing else moves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table, written

DIM, SCALE, K, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Components up to this size keep 64 squares of differences within a long; beyond, Python's integers are used.
WORD = 1 << 27


def kept(batch: pa.RecordBatch, dim: int, scale: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and scaled integer vectors of a batch ``(vec_id, embedding)``:
    vectors of ``dim`` components, none null or not finite."""
    vectors = batch.column("embedding").cast(pa.list_(pa.float64()))
    sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    whole = pa.array(sizes == dim)
    ids, vectors = batch.column("vec_id").filter(whole), vectors.filter(whole)
    # null components become NaN and go with the others
    values = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), dim)
    fine = np.isfinite(values).all(axis=1)
    values = np.floor(values[fine] * float(scale))
    if values.size and np.abs(values).max() > WORD:
        return ids.filter(pa.array(fine)), np.array([[int(x) for x in row] for row in values], object)
    return ids.filter(pa.array(fine)), values.astype(np.int64)


def fits(x: int | None) -> int | None:
    """Null for what no long can hold."""
    return x if x is not None and x < 1 << 63 else None


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1)


class Orchard:
    """The centroids, each with the list of the others by distance."""

    def __init__(self, centroids: list[list[int]]) -> None:
        big = any(abs(x) > WORD for c in centroids for x in c)
        self.at = np.array(centroids, object if big else np.int64).reshape(len(centroids), -1)
        self.apart = np.array([squared(self.at, c) for c in self.at]).reshape(len(centroids), len(centroids))
        self.lists = np.array([[j for j in sorted(range(len(centroids)), key=lambda j: (row[j], j)) if j != c]
                               for c, row in enumerate(self.apart)], np.int64).reshape(len(centroids), -1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid; of
        equally near ones the smaller number."""
        n, k = len(vectors), len(self.at)
        current = np.zeros(n, np.int64)
        best = squared(vectors, self.at[0])
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        place = np.zeros(n, np.int64)
        walking = np.arange(n if k > 1 else 0)
        while len(walking):
            other = self.lists[current[walking], place[walking]]
            # strictly beyond twice the distance; on squares, four times
            on = self.apart[current[walking], other] <= 4 * best[walking]
            walking, other = walking[on.astype(bool)], other[on.astype(bool)]
            new = ~seen[walking, other]
            place[walking[~new]] += 1
            rows, found = walking[new], other[new]
            if len(rows):
                seen[rows, found] = True
                d = squared(vectors[rows], self.at[found])
                nearer = ((d < best[rows]) | (d == best[rows]) & (found < current[rows])).astype(bool)
                place[rows[~nearer]] += 1
                rows, found = rows[nearer], found[nearer]
                current[rows], best[rows], place[rows] = found, d[nearer], 0
            walking = walking[place[walking] < k - 1]
        return current, best


def _vectors(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("embedding"))


def start(vectors: DataFrame, k: int, seed: int, dim: int, scale: int) -> list[list[int]]:
    """The k kept vectors with the smallest hash of ``seed:vec_id``; equal
    hashes (repeated ids) by their components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[tuple[str, list[int]]] = []
        for batch in slices(batches, "embedding"):
            ids, values = kept(batch, dim, scale)
            said = ["" if i is None else str(i) for i in ids.to_pylist()]
            least += [(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v.tolist()) for i, v in zip(said, values)]
            least = sorted(least)[:k]
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in least], pa.string()),
                                          pa.array([[str(x) for x in v] for _, v in least], pa.list_(pa.string()))],
                                         names=["hash", "vector"])
    # k rows a task; of them the k least by hash, then by the text of the components, reach the driver
    rows = vectors.mapInArrow(run, "hash string, vector array<string>")
    first = rows.orderBy("hash", F.col("vector").cast("array<decimal(38,0)>")).limit(k).collect()
    return [[int(x) for x in r["vector"]] for r in first]


def _sums(vectors: DataFrame, trees: Orchard, dim: int, scale: int) -> DataFrame:
    """``(cluster, place, total, n)``: per cluster and component the sum over its vectors."""
    sent = vectors.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = sent.value
        totals = [[0] * dim for _ in search.at]
        counts = [0] * len(totals)
        for batch in slices(batches, "embedding"):
            _, values = kept(batch, dim, scale)
            cluster, _ = search.nearest(values)
            for c in range(len(totals)):
                mine = values[cluster == c]
                if len(mine):
                    counts[c] += len(mine)
                    totals[c] = [a + int(b) for a, b in zip(totals[c], mine.sum(axis=0))]
        used = [c for c, n in enumerate(counts) if n]
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c in used for _ in range(dim)], pa.int32()),
             pa.array([p for _ in used for p in range(dim)], pa.int32()),
             pa.array([str(x) for c in used for x in totals[c]], pa.string()),
             pa.array([counts[c] for c in used for _ in range(dim)], pa.int64())],
            names=["cluster", "place", "total", "n"])
    parts = vectors.mapInArrow(run, "cluster int, place int, total string, n long")
    return parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                                 F.sum("n").alias("n"))


def clusters(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM,
             scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """``(vec_id, cluster, distance)`` of each kept row of ``embeddings
    (vec_id, embedding)``, and the final centroids.

    Rows with a null vector, another number of components, or a component that
    is null or not finite are left out.  Fewer than k kept vectors make fewer
    centroids, none an empty result.  A row without an id is a vector like any
    other, with the empty text as its id in the hash; rows that repeat an id
    are vectors of their own.  A cluster that loses all vectors keeps its
    centroid.  A distance that no long can hold is null."""
    vectors = _vectors(embeddings)
    spark = embeddings.sparkSession
    centroids = start(vectors, k, seed, dim, scale)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    for _ in range(rounds):
        moved = [list(c) for c in centroids]
        for r in _sums(vectors, Orchard(centroids), dim, scale).collect():     # k x dim rows at most
            moved[r["cluster"]][r["place"]] = int(r["total"]) // r["n"]
        if moved == centroids:
            break       # a fixed point: further rounds change nothing
        centroids = moved
    sent = spark.sparkContext.broadcast(Orchard(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "embedding"):
            ids, values = kept(batch, dim, scale)
            cluster, distance = sent.value.nearest(values)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster.astype(np.int32)), pa.array([fits(d) for d in distance.tolist()], pa.int64())],
                names=["vec_id", "cluster", "distance"])
    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long"), centroids


def cluster_digests(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """Contract columns: per vector its cluster and squared distance, the
    inertia of the cluster and of all (null where no long can hold them), the
    hash of the final centroid."""
    spark = embeddings.sparkSession
    assigned, centroids = clusters(embeddings, k, rounds, seed)
    assigned = written(assigned, "clusters")
    whole = F.count("*") == F.count("distance")
    found = assigned.groupBy("cluster").agg(    # k rows at most
        F.when(whole, F.sum(F.col("distance").cast("decimal(38,0)"))).alias("inertia")).collect()
    inertia = {r["cluster"]: None if r["inertia"] is None else int(r["inertia"]) for r in found}
    total = None if None in inertia.values() else sum(inertia.values())
    facts = [(c, fits(inertia.get(c, 0)), fits(total),
              hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
             for c, centroid in enumerate(centroids)]
    of = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(of), "cluster").select(    # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns of centroid clustering over the whole ``embeddings``."""
    return cluster_digests(table(spark, sf_dir, "embeddings"))


def _oracle(k: int = K, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM, scale: int = SCALE) -> str:
    """The rounds as chained DuckDB queries over one row per vector and component."""
    steps = [f"""
v AS MATERIALIZED (
  SELECT vec_id, unnest(range({dim})) AS p,
         unnest(list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))) AS x
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c
          FROM (SELECT DISTINCT vec_id FROM v) ORDER BY c LIMIT {k}),
c0 AS MATERIALIZED (SELECT c, p, x FROM first JOIN v USING (vec_id))"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, min(struct_pack(d := d, c := c)) AS best
  FROM (SELECT v.vec_id, c.c, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{i} c USING (p) GROUP BY ALL) GROUP BY vec_id)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c, p, coalesce((s - (((s % n) + n) % n)) // n, x) AS x
  FROM c{i} LEFT JOIN (SELECT best.c AS c, p, sum(x) AS s, count(*) AS n FROM a{i} JOIN v USING (vec_id) GROUP BY ALL)
  USING (c, p))""")
    return f"""WITH {','.join(steps)},
h AS (SELECT c, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM (SELECT vec_id, best, best.c AS c FROM a{rounds}) JOIN h USING (c)"""


ORACLE_SQL = _oracle()
