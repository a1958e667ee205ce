"""Exact integer k-means whose assignments are filtered in a rotated space.

Vectors become integers. Their leading principal coordinates and the norm of
what those leave are stored once. For a vector and a centroid, the squared
distance of the leading coordinates plus the squared difference of the two
residual norms is a lower bound of the squared distance: the residuals differ at
least by their norms. The centroid of the least bound is measured in integers;
only centroids whose bound does not exceed that are measured too.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.llm.staging import Staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH, SCALE, CLUSTERS, ROUNDS, LEADING, SEED = 64, 1024, 8, 10, 16, 3
#: Integers beyond this have no exact 64-bit distance; see ``integer_vectors``.
LARGEST = 1 << 27
#: Rows of a batch that are measured at a time.
SLICE = 8192


def integer_vectors(
    table: DataFrame, id_col: str, vector_col: str, width: int = WIDTH, scale: int = SCALE
) -> DataFrame:
    """(id, v) of the vectors that are kept, v as array of long.

    Vectors of another width, with a null or non-finite component or with one
    whose integer is over LARGEST in size (their squared distances would not fit
    64 bits) are left out.
    """
    v = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    table = table.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("x"))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST / scale))
    return table.where((F.size("x") == width) & fine).select("id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def _moments(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(width), np.zeros((width, width))
        for batch in _parts(batches):
            x = _matrix(batch.column("v"), width, np.float64)
            n, first, second = n + len(x), first + x.sum(axis=0), second + x.T @ x
        if n:
            values = np.concatenate([[n], first, second[np.triu_indices(width)]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["i", "value"])

    return work


def rotation(vectors: DataFrame, width: int = WIDTH, leading: int = LEADING) -> np.ndarray:
    """The ``leading`` principal axes as columns, from sums that Spark adds up.

    Any orthonormal axes give right bounds; these give tight ones.
    """
    sums = vectors.select("v").mapInArrow(_moments(width), "i int, value double").groupBy("i").agg(F.sum("value").alias("value"))
    values = np.array([r.value for r in sums.orderBy("i").collect()])
    if not len(values):
        return np.eye(width)[:, :leading]
    mean, upper = values[1 : width + 1] / values[0], np.zeros((width, width))
    upper[np.triu_indices(width)] = values[width + 1 :] / values[0]
    covariance = upper + np.triu(upper, 1).T - np.outer(mean, mean)
    return np.linalg.eigh(covariance)[1][:, ::-1][:, :leading]


def split(x: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates of each row and the norm of the rest of it."""
    lead = x @ axes
    return lead, np.linalg.norm(x - lead @ axes.T, axis=1)


def rotated(vectors: DataFrame, axes: np.ndarray, width: int = WIDTH) -> DataFrame:
    """``vectors`` with the columns lead (coordinates along ``axes``) and rest (norm of the remainder)."""
    leading = axes.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            lead, rest = split(_matrix(batch.column("v"), width, np.float64), axes)
            ends = pa.array(np.arange(0, lead.size + 1, leading, dtype=np.int32))
            columns = [batch.column("id"), batch.column("v"), pa.ListArray.from_arrays(ends, pa.array(lead.ravel())), pa.array(rest)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "lead", "rest"])

    return vectors.mapInArrow(work, "id long, v array<long>, lead array<double>, rest double")


class Centroids:
    """Integer centroids and their place in the rotated space."""

    def __init__(self, centroids: list[list[int]], axes: np.ndarray):
        self.exact = np.array(centroids, np.int64)
        self.lead, self.rest = split(self.exact.astype(np.float64), axes)
        self.size = np.sqrt(self.lead**2 @ np.ones(self.lead.shape[1]) + self.rest**2)

    def nearest(self, x: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of the nearest centroid of each row, and how many were measured.

        Of equally near ones the smallest number. Bounds are lowered by more than
        rounding can raise them, so no nearest centroid is ever passed over.
        """
        bound = ((lead[:, None, :] - self.lead[None]) ** 2).sum(axis=2) + (rest[:, None] - self.rest[None]) ** 2
        size = np.sqrt((lead**2).sum(axis=1) + rest**2)
        bound -= 1e-9 * (size[:, None] + self.size[None]) ** 2 + 1e-6
        every = np.arange(len(x))
        best = bound.argmin(axis=1)
        least = ((x - self.exact[best]) ** 2).sum(axis=1)
        measured, first = len(x), best.copy()
        for c in range(len(self.exact)):
            at = every[(bound[:, c] <= least) & (first != c)]
            if not len(at):
                continue
            measured += len(at)
            far = ((x[at] - self.exact[c]) ** 2).sum(axis=1)
            won = (far < least[at]) | (far == least[at]) & (c < best[at])
            best[at[won]], least[at[won]] = c, far[won]
        return best, least, measured


def _assign(centroids: list[list[int]], axes: np.ndarray, width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at = Centroids(centroids, axes)
        for batch in _parts(batches):
            x = _matrix(batch.column("v"), width, np.int64)
            lead = _matrix(batch.column("lead"), axes.shape[1], np.float64)
            yield batch, x, *at.nearest(x, lead, batch.column("rest").to_numpy())

    return work


def _sums(centroids: list[list[int]], axes: np.ndarray, width: int):
    """Per task and cluster: rows and sums of the components."""
    assign = _assign(centroids, axes, width)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        rows, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for _, x, best, _, _ in assign(batches):
            for c in range(k):
                mine = best == c
                rows[c] += mine.sum()
                total[c] += x[mine].sum(axis=0)
        there = [c for c in range(k) if rows[c]]
        columns = [pa.array(there, pa.int32()), pa.array([int(rows[c]) for c in there], pa.int64()), pa.array([total[c].tolist() for c in there], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "rows", "total"])

    return work


def moved(table: DataFrame, centroids: list[list[int]], axes: np.ndarray, width: int = WIDTH) -> list[list[int]]:
    """The centroids after one round: floors of the exact means, empty ones as they were."""
    parts = table.select("v", "lead", "rest").mapInArrow(_sums(centroids, axes, width), "cluster int, rows long, total array<long>")
    # Decimals: the sum over all tasks may be beyond 64 bits.
    wide = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    out = [list(c) for c in centroids]
    for row in parts.groupBy("cluster").agg(F.sum("rows").alias("rows"), *wide).collect():
        out[row.cluster] = [int(row[f"s{i}"]) // row.rows for i in range(width)]
    return out


def _labels(centroids: list[list[int]], axes: np.ndarray, width: int):
    assign = _assign(centroids, axes, width)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, best, least, _ in assign(batches):
            columns = [batch.column("id"), pa.array(best.astype(np.int32)), pa.array(least)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

    return work


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors whose ``seed:id`` has the smallest SHA-256; equal ids by their components, null ids last."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.orderBy(mark.asc_nulls_last(), "v").limit(clusters)
    return [list(r.v) for r in rows.collect()]


def kmeans(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    width: int = WIDTH, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, leading: int = LEADING, seed: int = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of every vector kept, and the final centroids.

    Each of ``rounds`` rounds assigns all vectors to the nearest centroid (squared
    distance of the integers, of equally near ones the smaller number) and moves
    every centroid that has any to the componentwise floor of their mean. Then
    all are assigned once more. Fewer vectors than ``clusters`` make as many
    centroids; without any there are no rows. Repeated rows and ids each keep
    their row, null ids are kept. Other columns are not read. See
    ``integer_vectors`` for what is left out.
    """
    spark = table.sparkSession
    staged = Staged(spark, "centroids")
    vectors = staged.write(integer_vectors(table, id_col, vector_col, width, scale))
    axes = rotation(vectors, width, leading)
    placed = staged.write(rotated(vectors, axes, width))
    centroids = first_centroids(vectors, clusters, seed)
    staged.drop(vectors)
    if not centroids:
        return spark.createDataFrame([], "id long, cluster int, distance long"), centroids
    for _ in range(rounds):
        centroids = moved(placed, centroids, axes, width)
    labels = staged.write(placed.mapInArrow(_labels(centroids, axes, width), "id long, cluster int, distance long"))
    staged.drop(placed)
    return labels, centroids


def op13_rotated_centroids(spark, sf_dir: str) -> DataFrame:
    labels, centroids = kmeans(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    by_cluster = labels.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = by_cluster.agg(F.sum("cluster_inertia").alias("inertia")).scalar()
    named = spark.createDataFrame([(c, ",".join(map(str, v))) for c, v in enumerate(centroids)], "cluster int, listed string")
    clusters = named.join(by_cluster, "cluster").select(
        "cluster", "cluster_inertia", inertia.alias("inertia"), F.sha2("listed", 256).alias("centroid_sha256")
    )
    # One row a cluster, CLUSTERS at most.
    found = labels.withColumnRenamed("id", "vec_id").join(F.broadcast(clusters), "cluster")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same rounds in SQL, one pair of common tables a round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
    SELECT vec_id, v, cluster, distance FROM (
        SELECT vec_id, v, c.cluster, list_sum(list_transform(list_zip(v, c.m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance, row_no
        FROM kept CROSS JOIN c{r} c
    ) QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY distance, cluster) = 1
)"""
        )
        if r < rounds:
            steps.append(
                f"""c{r + 1} AS MATERIALIZED (
    SELECT c.cluster, coalesce(new.m, c.m) AS m FROM c{r} c LEFT JOIN (
        SELECT cluster, list(floor_mean ORDER BY i) AS m FROM (
            SELECT cluster, i, ((s - (((s % n) + n) % n)) // n)::BIGINT AS floor_mean FROM (
                SELECT cluster, i, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM (
                    SELECT cluster, unnest(v) AS x, unnest(range({WIDTH})) AS i FROM a{r}
                ) GROUP BY cluster, i
            )
        ) GROUP BY cluster
    ) new ON new.cluster = c.cluster
)"""
            )
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS row_no, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}
),
c0 AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id::VARCHAR)) - 1)::INTEGER AS cluster, v AS m
    FROM kept ORDER BY 1 LIMIT {clusters}
),
{", ".join(steps)},
inertias AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY cluster)
SELECT a.vec_id, a.cluster, a.distance, i.cluster_inertia,
       (SELECT sum(distance)::BIGINT FROM a{rounds}) AS inertia,
       sha256(array_to_string(c.m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN inertias i ON i.cluster = a.cluster JOIN c{rounds} c ON c.cluster = a.cluster
"""


OP13_SQL = _sql()
