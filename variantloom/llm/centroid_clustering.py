"""Centroid clustering of whole-number vectors with a pivot table (LAESA).

Every vector's distances to a few fixed pivots are computed once and stored beside it. In each round the centroids'
distances to the pivots are computed too; by the triangle inequality no centroid is nearer to a vector than their
distances to any pivot differ. The centroid with the least such bound is measured exactly, and so are all centroids
whose bound does not exceed that distance; the others cannot be nearest. Distances that decide are exact whole numbers.

A round is one pass over the stored table: tasks send one row of counts and sums per cluster, whatever the number of
vectors, and only the centroids (``clusters`` rows) come to the driver. A vector of any other length than
``DIMENSIONS``, null, or with a null or non-finite component takes no part. Repeated rows count each; a row without
``vec_id`` takes part and comes last where ids order. With fewer vectors than clusters there are as many clusters as
vectors; an empty table has no rows. Other columns are left out. A component of 131072 or more in absolute value is an
error, because squared distances might not fit a 64-bit number."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import clear, stage, work_folder

DIMENSIONS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
PIVOTS = 6
#: Vectors, first by hash, from which the pivots are chosen: they change the time only, never the result.
PIVOT_SAMPLE = 512
#: Scaled components stay below this, so that squared distances of 64 components are below 2 ** 63.
LIMIT = 1 << 27
#: Relative room for rounding when bounds are compared: far above the error of a double, far below 1.
SLACK = 1e-9
_STEP = 8192


@dataclass(frozen=True)
class Pivots:
    """The pivots, one a row."""

    places: np.ndarray

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Euclidean distances of all vectors (rows) to all pivots (columns)."""
        out = np.empty((len(vectors), len(self.places)))
        for j, place in enumerate(self.places):
            out[:, j] = np.sqrt(squared(vectors, place).astype(np.float64))
        return out


def squared(vectors: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number vectors to one."""
    apart = vectors - place
    return np.einsum("ij,ij->i", apart, apart)


def nearest(vectors: np.ndarray, table: np.ndarray, centroids: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each vector the nearest centroid (the first of equals), its squared distance, and how many were measured.

    ``table`` and ``to_pivots`` are the distances of the vectors and of the centroids to the pivots."""
    n, k = len(vectors), len(centroids)
    bounds = np.zeros((n, k))
    for j in range(table.shape[1]):
        np.maximum(bounds, np.abs(table[:, j, None] - to_pivots[None, :, j]), out=bounds)
    first = bounds.argmin(1)
    apart = vectors - centroids[first]
    best = np.einsum("ij,ij->i", apart, apart)
    cluster, measured = first.copy(), n
    reach = np.sqrt(best.astype(np.float64)) * (1 + SLACK) + SLACK
    for c in range(k):
        rows = np.flatnonzero((bounds[:, c] <= reach) & (first != c))
        found = squared(vectors[rows], centroids[c])
        measured += len(rows)
        nearer = (found < best[rows]) | ((found == best[rows]) & (c < cluster[rows]))
        cluster[rows[nearer]], best[rows[nearer]] = c, found[nearer]
    return cluster, best, measured


def whole_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, place``: the vectors that take part, each component x as floor(scale * x)."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        (F.size("embedding") == dimensions) & sound)
    limit = F.lit(float(LIMIT))
    whole = lambda x: F.when(F.abs(x * scale) < limit, F.floor(x * F.lit(float(scale)))).otherwise(
        F.raise_error(F.lit("a component is too large for exact distances")).cast("bigint"))
    return kept.select("vec_id", F.transform("embedding", lambda x: whole(x).cast("int")).alias("place"))


def first_vectors(vectors: DataFrame, n: int) -> np.ndarray:
    """The ``n`` vectors that come first by the hash of their id, in that order (equal ids: by components)."""
    turn = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(turn.alias("turn"), "place").orderBy(F.col("turn").asc_nulls_last(), "place").limit(n).collect()
    return np.array([r["place"] for r in rows], np.int64)


def far_apart(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the sample that lie far from each other: each the one furthest from those before it."""
    if not len(sample):
        return sample
    chosen = [int(squared(sample, sample[0]).argmax())]
    gap = squared(sample, sample[chosen[0]])
    while len(chosen) < n and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, squared(sample, sample[chosen[-1]]))
    return sample[chosen]


def _places(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), -1)


def with_pivot_table(vectors: DataFrame, pivots: Pivots) -> DataFrame:
    """Adds ``pivot_distances``, once for all rounds."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pivots.distances(_places(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(found), pa.list_(pa.float64()))], ["vec_id", "place", "pivot_distances"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(measure, f"vec_id {kind}, place array<int>, pivot_distances array<double>")


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for low in range(0, batch.num_rows, _STEP):
            part = batch.slice(low, _STEP)
            yield part, _places(part.column(1)), part.column(2).flatten().to_numpy().reshape(part.num_rows, -1)


def assigned(table: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    """``vec_id, cluster, distance`` (squared) of every vector."""
    to_pivots = pivots.distances(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, places, known in _steps(batches):
            cluster, distance, _ = nearest(places, known, centroids, to_pivots)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    kind = table.schema["vec_id"].dataType.simpleString()
    return table.mapInArrow(assign, f"vec_id {kind}, cluster int, distance bigint")


def cluster_sums(table: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    """``cluster, n, measured, sums``: per task and cluster the number of vectors, the distances measured and the
    componentwise sums. A task sends at most one row a cluster."""
    to_pivots = pivots.distances(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = centroids.shape
        n, sums, measured = np.zeros(k, np.int64), np.zeros((k, width), np.int64), 0
        for _, places, known in _steps(batches):
            cluster, _, some = nearest(places, known, centroids, to_pivots)
            measured += some
            n += np.bincount(cluster, minlength=k)
            for c in range(k):
                sums[c] += places[cluster == c].sum(0)
        here = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(here, pa.int32()), pa.array(n[here]), pa.array(np.where(np.arange(len(here)) == 0, measured, 0)),
            pa.array(list(sums[here]), pa.list_(pa.int64())),
        ], ["cluster", "n", "measured", "sums"])

    return table.mapInArrow(add, "cluster int, n bigint, measured bigint, sums array<bigint>")


def moved(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """The centroids after a round: floor(sum / count) per component, empty ones as they were."""
    parts = sums.select("cluster", "n", F.posexplode("sums").alias("component", "sum"))
    # decimals hold the sums of any number of vectors
    total = parts.groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
    out = centroids.copy()
    for row in total.collect():  # one row a centroid and component
        out[row["cluster"], row["component"]] = int(row["sum"]) // row["n"]
    return out


def clustered(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
              scale: int = SCALE, pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """(``vec_id, cluster, distance`` of every vector, the centroids) after ``rounds`` rounds."""
    vectors = whole_vectors(embeddings, dimensions, scale)
    sample = first_vectors(vectors, max(PIVOT_SAMPLE, clusters)).reshape(-1, dimensions)
    centroids, fixed = sample[:clusters], Pivots(far_apart(sample, pivots))
    if not len(centroids):
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint"), centroids
    spark, folder = vectors.sparkSession, work_folder(vectors.sparkSession, "pivot-table")
    table = stage(with_pivot_table(vectors, fixed), "table", folder)
    for _ in range(rounds):
        centroids = moved(centroids, cluster_sums(table, centroids, fixed))
    found = stage(assigned(table, centroids, fixed), "clusters")
    clear(spark, folder)
    return found, centroids


def digest(embeddings: DataFrame) -> DataFrame:
    """Every vector with its cluster, the sums of squared distances and a digest of its centroid."""
    found, centroids = clustered(embeddings)
    spark = embeddings.sparkSession
    listed = spark.createDataFrame(
        [(i, ",".join(map(str, c))) for i, c in enumerate(centroids.tolist())], "cluster int, _centroid string")
    per_cluster = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = per_cluster.agg(F.sum("cluster_inertia")).scalar()
    facts = per_cluster.join(listed, "cluster").withColumn("inertia", whole)
    return found.join(F.broadcast(facts), "cluster").select(  # one row a cluster
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("_centroid", 256).alias("centroid_sha256"))


def _sql(rounds: int = ROUNDS) -> str:
    """The rounds written out, every vector measured against every centroid."""
    parts = [f"""kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS place
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}
)""", f"""c0 AS (
  SELECT row_number() OVER (ORDER BY turn, place) - 1 AS cluster, place
  FROM (SELECT sha256('3:' || vec_id) AS turn, place FROM kept ORDER BY turn NULLS LAST, place LIMIT {CLUSTERS})
)"""]
    apart = "list_sum(list_transform(list_zip(v.place, c.place), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := {apart}, c := c.cluster)) AS best FROM kept v, c{i} c GROUP BY r
)""")
        if i < rounds:
            parts.append(f"""m{i} AS (
  SELECT cluster, list(s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END ORDER BY pos) AS place
  FROM (SELECT a.best.c AS cluster, pos, sum(x)::BIGINT AS s, count(*) AS n
    FROM a{i} a JOIN (SELECT r, unnest(place) AS x, generate_subscripts(place, 1) AS pos FROM kept) k ON a.r = k.r
    GROUP BY 1, 2) GROUP BY cluster
), c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.place, c.place) AS place FROM c{i} c LEFT JOIN m{i} m ON c.cluster = m.cluster
)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT k.vec_id, a.best.c::INTEGER AS cluster, a.best.d AS distance,
  (sum(a.best.d) OVER (PARTITION BY a.best.c))::BIGINT AS cluster_inertia, (sum(a.best.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.place, ',')) AS centroid_sha256
FROM kept k JOIN a{rounds} a ON k.r = a.r JOIN c{rounds} c ON a.best.c = c.cluster
"""


SQL = _sql()
