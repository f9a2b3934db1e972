"""Centroid clustering of integer vectors with n-simplex projection.

Some of the first centroids are pivots. The distances of a vector to the n pivots, computed once and
kept, fix the apex of a simplex over the pivots: n coordinates, the last one the height over the
pivots' flat. For two apexes x and y the Euclidean distance of the vectors is at least |x - y| and at
most |x - y'|, where y' is y on the other side of the flat (last coordinate negated). Each round
projects the centroids, drops for each vector the centroids whose lower bound exceeds its least upper
bound, and compares the others exactly, in integers.

Vectors stay where they are in all rounds: a task keeps sums per centroid over all its batches, so a
round shuffles one row per task and centroid, and the driver holds the k centroids alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read_table, small_batches, stage

DIMS, CENTROIDS, ROUNDS, SCALE = 64, 40, 5, 256
PIVOTS = 16
#: A pivot must rise over the flat of those before it by this part of its distance from the first.
RISE = 0.2
#: What rounding may move a bound, as a part of the longest distance in play.
SLACK = 1e-6
#: Components beyond this could give distances beyond 64 bits.
LARGEST = 1 << 27


class Simplex:
    """Apex coordinates over pivots that are affinely independent."""

    def __init__(self, candidates: np.ndarray, most: int = PIVOTS, rise: float = RISE) -> None:
        base: list[np.ndarray] = []  # orthonormal axes of the flat through the first pivot
        chosen = candidates[:1].astype(float)
        for c in candidates[1:].astype(float):
            if len(chosen) == most:
                break
            side = c - chosen[0]
            up = side - sum(((side @ a) * a for a in base), np.zeros_like(side))
            up -= sum(((up @ a) * a for a in base), np.zeros_like(side))
            if np.linalg.norm(up) > rise * max(np.linalg.norm(side), 1.0):
                base.append(up / np.linalg.norm(up))
                chosen = np.vstack([chosen, c])
        self.pivots = chosen
        # vertex i of the base simplex in i coordinates: distances between pivots alone fix it
        self.vertices = np.array([[(p - chosen[0]) @ a for a in base] for p in chosen]).reshape(len(chosen), len(base))
        self.norms = (self.vertices ** 2).sum(axis=1)

    def distances2(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances to the pivots, one column each; these are what is cached."""
        return ((vectors[:, None, :].astype(float) - self.pivots[None]) ** 2).sum(axis=2)

    def apexes(self, distances2: np.ndarray) -> np.ndarray:
        """Coordinates from squared distances to the pivots: one triangular system, then the height."""
        # |x - v_i|^2 = d_i^2, less the same for v_0 = 0: 2 v_i x = |v_i|^2 + d_0^2 - d_i^2
        right = (self.norms[1:] + distances2[:, :1] - distances2[:, 1:]) / 2
        flat = np.linalg.solve(self.vertices[1:], right.T).T if len(self.norms) > 1 else np.zeros((len(distances2), 0))
        height = np.sqrt(np.maximum(distances2[:, 0] - (flat ** 2).sum(axis=1), 0.0))
        return np.column_stack([flat, height])

    @staticmethod
    def bounds2(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared lower and upper bounds of the distances between the rows of ``x`` and ``y``."""
        flat = (x[:, None, :-1] - y[None, :, :-1])
        flat2 = np.einsum("ijk,ijk->ij", flat, flat)
        a, b = x[:, -1][:, None], y[:, -1][None]
        return flat2 + (a - b) ** 2, flat2 + (a + b) ** 2


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number), squared distance and number of exact comparisons of each vector."""
    low, high = simplex.bounds2(apexes, simplex.apexes(simplex.distances2(centroids)))
    slack = SLACK * max(1.0, float(high.max(initial=0.0)))
    row, col = np.nonzero(low <= high.min(axis=1, keepdims=True) + slack)  # by row, then by centroid
    side = vectors[row] - centroids[col]
    exact = np.full(low.shape, np.iinfo(np.int64).max)
    exact[row, col] = np.einsum("ij,ij->i", side, side)
    best = exact.argmin(axis=1)
    return best, exact[np.arange(len(vectors)), best], np.bincount(row, minlength=len(vectors))


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)``: vectors of exactly ``dims`` finite components, as integers floor(scale * x).

    Other rows go: null vectors, another length, a null, NaN or infinite component. A component
    whose integer is beyond 2^27 raises an error, as distances might then exceed 64 bits.
    """
    x = F.col(f"`{vector_col}`").cast("array<double>")
    fine = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.when(F.abs(c * scale) <= LARGEST, F.floor(c * scale))
                        .otherwise(F.raise_error(F.lit("a vector component is too large for exact 64-bit distances")).cast("long")))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(f"`{id_col}`").alias("vec_id"), whole.alias("v"))


def first_centroids(kept: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The vectors of the ``k`` smallest SHA-256 of ``2:<vec_id>``; ties (repeated ids) by components, null ids last."""
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(order.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding",
             dims: int = DIMS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance, compared)`` per kept vector, and the final centroids.

    Vectors are those of ``whole_vectors``; repeated rows stay repeated. Fewer than ``k`` kept
    vectors are all centroids; with none there are no rows. A round replaces every centroid that has
    vectors by their componentwise floor of the mean. ``compared`` is the number of centroids that
    the bounds left over for the exact comparison. Other columns, of any name, are not read.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    kept = whole_vectors(vectors, id_col, vector_col, dims, scale)
    kept = stage(kept, "simplex-vectors")
    centroids = first_centroids(kept, k)
    if not len(centroids):
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).alias("compared")), centroids
    simplex = Simplex(centroids)
    n = len(simplex.pivots)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apex = simplex.apexes(simplex.distances2(_matrix(batch.column(1), dims, np.int64)))
            offsets = np.arange(len(apex) + 1, dtype=np.int32) * n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, apex.ravel())], ["vec_id", "v", "apex"])

    kind = kept.schema["vec_id"].dataType.simpleString()
    points = stage(kept.mapInArrow(project, f"vec_id {kind}, v array<bigint>, apex array<double>"), "simplex-points")

    def assigned(batches: Iterator[pa.RecordBatch], now: np.ndarray):
        for batch in batches:
            v = _matrix(batch.column("v"), dims, np.int64)
            yield batch, v, *nearest(v, _matrix(batch.column("apex"), n, float), now, simplex)

    def step(now: np.ndarray) -> np.ndarray:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros((len(now), dims), np.int64), np.zeros(len(now), np.int64)
            for _, v, best, _, _ in assigned(batches, now):
                np.add.at(total, best, v)
                count += np.bincount(best, minlength=len(now))
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_pydict({"cluster": at.astype(np.int32), "n": count[at], "total": list(total[at])})

        parts = points.select("v", "apex").mapInArrow(sums, "cluster int, n bigint, total array<bigint>")
        wide = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
        out = now.copy()
        for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *wide).collect():  # at most k rows
            out[row.cluster] = [int(row[f"s{i}"]) // row.n for i in range(dims)]
        return out

    for _ in range(rounds):
        centroids = step(centroids)
    final = centroids

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, best, far, compared in assigned(batches, final):
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(far), pa.array(compared.astype(np.int32))],
                                             ["vec_id", "cluster", "distance", "compared"])

    return points.mapInArrow(label, f"vec_id {kind}, cluster int, distance bigint, compared int"), final


def op12_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``embeddings``."""
    rows, centroids = clusters(read_table(spark, sf_dir, "embeddings"))
    rows = stage(rows, "simplex-labels")
    names = spark.createDataFrame([(i, ",".join(map(str, c))) for i, c in enumerate(centroids.tolist())], "number int, components string")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))  # at most k rows
    whole = F.sum("s").over(Window.partitionBy(F.lit(0)))  # over at most k rows
    per_cluster = (names.join(sums, F.col("number") == F.col("cluster"))
                   .select("number", F.col("s").cast("long").alias("cluster_inertia"), whole.cast("long").alias("inertia"),
                           F.sha2("components", 256).alias("centroid_sha256")))
    return (rows.join(F.broadcast(per_cluster), F.col("cluster") == F.col("number"))
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _oracle(k: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """DuckDB SQL of the rounds, each as its own tables."""
    steps = [f"""
e AS (SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
      WHERE len(embedding) = {DIMS} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {DIMS}),
r AS (SELECT row_number() OVER () AS rid, vec_id, v FROM e),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS c, v FROM
       (SELECT sha256('2:' || vec_id) AS h, v FROM r ORDER BY 1, 2 LIMIT {k}))"""]
    near = """
a{i} AS MATERIALIZED (SELECT rid, vec_id, v, min_by(c, (d, c)) AS c, min(d) AS d FROM (
       SELECT rid, vec_id, r.v AS v, c, CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(r.v, c{i}.v)]) AS BIGINT) AS d FROM r, c{i}) GROUP BY ALL)"""
    move = """
s{i} AS (SELECT c, j, CAST(sum(v[j]) AS HUGEINT) AS s, count(*) AS n FROM a{p}, (SELECT unnest(range(1, {end})) AS j) GROUP BY c, j),
c{i} AS (SELECT c{p}.c AS c, coalesce(m.v, c{p}.v) AS v FROM c{p} LEFT JOIN
       (SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM s{i} GROUP BY c) m ON m.c = c{p}.c)"""
    for i in range(rounds):
        steps += [near.format(i=i), move.format(i=i + 1, p=i, end=DIMS + 1)]
    steps.append(near.format(i=rounds))
    return "WITH" + ",".join(s.replace("GROUP BY ALL", "GROUP BY rid, vec_id, v") for s in steps) + f"""
SELECT vec_id, a.c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} f ON f.c = a.c"""


ORACLE_OP12 = _oracle()
