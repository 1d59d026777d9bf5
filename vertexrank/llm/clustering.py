"""Centroid clustering in integers, with a PCA-rotated filter.

Every component x of a vector becomes ``floor(1024 * x)``; from there on all
distances, sums and centroids are integers, so the clusters do not depend on how
Spark deals the rows. Rounds are Lloyd's: assign to the nearest centroid (ties:
the smaller number), then replace every non-empty centroid by the componentwise
floor of its members' mean.

The filter spares exact distances. The vectors are rotated once to the
eigenvectors of their covariance; of a rotated vector the ``LEADING`` first
coordinates are stored beside the integers, with the norm of what they leave. For
vector x and centroid c, ``|p(x) - p(c)|^2 + (r(x) - r(c))^2`` (p: leading
coordinates, r: residual norm) is never above ``|x - c|^2``. The centroid with
the smallest bound is measured exactly; of the others only those whose bound,
less a margin for floating point, does not exceed that distance are. Survivors
are verified in integers.

The covariance is summed over all vectors by a Spark aggregate; the rotated
table is written once and read by every round. The driver holds the ``k``
centroids and their sums, ``k * dim`` numbers, sent back to the tasks as literals;
a task sends one row per cluster.

Defined cases: vectors that are null, of another length than ``dim``, or that
hold null or non-finite components are left out; a vector without id is
clustered but never a first centroid; rows repeated are vectors of their own,
and of repeated ids the smaller vector comes first; with fewer than ``k``
vectors that have an id there are as many centroids; without any, vectors keep
a null cluster, distance and digest; other columns are ignored; an empty table
gives an empty result. Integers beyond ``LARGEST`` would not leave distances in
a long: they are an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, final, scratch

DIM, CLUSTERS, ROUNDS, SEED = 64, 8, 10, 3
SCALE = 1024
LEADING = 32  # supplied vectors spread evenly over all directions: at 16 hardly any bound decides
LARGEST = 1 << 27  # 64 squared differences of such integers stay below 2**63
_SLICE = 4096  # vectors measured at a time


def integer_vectors(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``vec_id, v`` (array of long) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(F.size("x") == dim)
    rows = rows.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    whole = lambda c: F.floor(c * scale)
    fits = lambda c: F.abs(c * scale) <= LARGEST
    error = F.raise_error(F.lit(f"a component is beyond {LARGEST} / {scale}")).cast("array<bigint>")
    return rows.select("vec_id", F.when(F.forall("x", fits), F.transform("x", whole)).otherwise(error).alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ``seed:id`` has the smallest SHA-256, in that order."""
    named = rows.where("vec_id is not null")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = named.select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()  # k rows
    return np.array([r["v"] for r in chosen], np.int64)


def _matrix(column: pa.Array, dim: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), dim)


def rotation(rows: DataFrame, dim: int, leading: int) -> np.ndarray:
    """The ``leading`` main directions (dim x leading, orthonormal) of all vectors,
    from sums and products added up in the tasks: ``dim + 1`` rows from each."""

    def moments(batches):
        total = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            x = _matrix(batch.column("v"), dim, np.float64)
            x = np.hstack([x, np.ones((len(x), 1))])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "s"])

    parts = rows.select("v").mapInArrow(moments, "i int, s array<double>")
    sums = [F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(dim + 1)]
    table = np.array([r[1:] for r in sorted(parts.groupBy("i").agg(*sums).collect())], np.float64)  # dim + 1 rows
    if not len(table) or not table[dim, dim]:
        return np.eye(dim)[:, :leading]
    mean = table[dim, :dim] / table[dim, dim]
    _, directions = np.linalg.eigh(table[:dim, :dim] / table[dim, dim] - np.outer(mean, mean))
    return np.ascontiguousarray(directions[:, ::-1][:, :leading])


def rotated(x: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and residual norm."""
    x = x.astype(np.float64)
    p = x @ axes
    return p, np.sqrt(np.maximum((x * x).sum(axis=1) - (p * p).sum(axis=1), 0.0))


def nearest(x: np.ndarray, p: np.ndarray, r: np.ndarray, centres: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and squared distance of integer vectors ``x`` (rotated: ``p, r``),
    and how many exact distances it took."""
    cp, cr = rotated(centres, axes)
    bound = ((p[:, None, :] - cp[None]) ** 2).sum(axis=2) + (r[:, None] - cr[None]) ** 2
    # floating point: coordinates err by some ulps of the norms, their squares accordingly
    size = (p * p).sum(axis=1) + r * r
    bound -= 1e-9 * (size[:, None] + ((cp * cp).sum(axis=1) + cr * cr)[None] + 1.0)

    def exact(rows, cols):
        d = x[rows] - centres[cols]
        return (d * d).sum(axis=1)

    at = np.arange(len(x))
    own = bound.argmin(axis=1)
    least = exact(at, own)
    others = bound <= least[:, None]
    others[at, own] = False
    rows, cols = np.nonzero(others)  # ascending in row, then in centroid
    if len(rows):
        d = exact(rows, cols)
        by = np.lexsort((cols, d, rows))
        first = by[np.append(True, rows[by][1:] != rows[by][:-1])]
        better = (d[first] < least[rows[first]]) | ((d[first] == least[rows[first]]) & (cols[first] < own[rows[first]]))
        first = first[better]
        own[rows[first]], least[rows[first]] = cols[first], d[first]
    return own, least, len(x) + len(rows)


def _assigned(batches, centres: np.ndarray, axes: np.ndarray):
    dim, leading = axes.shape
    for batch in batches:
        for lo in range(0, batch.num_rows, _SLICE):
            part = batch.slice(lo, _SLICE)
            x = _matrix(part.column("v"), dim)
            p, r = _matrix(part.column("p"), leading, np.float64), part.column("r").to_numpy()
            yield part, x, *nearest(x, p, r, centres, axes)


def round_of(table: DataFrame, centres: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, int]:
    """Centroids after one more round, and the exact distances it took."""
    k, dim = centres.shape

    def sums(batches):
        total, count, spent = np.zeros((k, dim), object), np.zeros(k, np.int64), 0
        for _, x, own, _, measured in _assigned(batches, centres, axes):
            part = np.zeros((k, dim), np.int64)
            np.add.at(part, own, x)
            total, count, spent = total + part, count + np.bincount(own, minlength=k), spent + measured
        texts = [[str(v) for v in row] for row in total]  # sums of any size; added up as decimals
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k), pa.int32()), pa.array(count, pa.int64()), pa.array([spent] + [0] * (k - 1), pa.int64()), pa.array(texts, pa.list_(pa.string()))],
            names=["cluster", "n", "spent", "s"],
        )

    parts = table.mapInArrow(sums, "cluster int, n long, spent long, s array<string>")
    added = [F.sum(F.col("s")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(dim)]
    got = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("spent").alias("spent"), *added).collect()  # k rows
    out = centres.copy()
    for row in got:
        if row["n"]:
            out[row["cluster"]] = [int(row[f"s{j}"]) // row["n"] for j in range(dim)]
    return out, sum(row["spent"] for row in got)


def cluster(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED, leading: int = LEADING
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of
    every vector that takes part (``vectors``: ``vec_id, embedding``)."""
    spark = vectors.sparkSession
    with scratch(spark):
        rows = cut(integer_vectors(vectors, dim, scale))
        centres = first_centroids(rows, k, seed)
        if not len(centres):
            lost = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string"}
            return final(rows.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in lost.items()]))
        axes = rotation(rows, dim, min(leading, dim))

        def rotate(batches):
            for batch in batches:
                p, r = rotated(_matrix(batch.column("v"), dim), axes)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * axes.shape[1], pa.int32()), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), flat, pa.array(r)], names=["vec_id", "v", "p", "r"])

        table = cut(rows.mapInArrow(rotate, "vec_id long, v array<bigint>, p array<double>, r double"))
        for _ in range(rounds):
            centres, _ = round_of(table, centres, axes)

        def assign(batches):
            for part, _, own, least, _ in _assigned(batches, centres, axes):
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(own, pa.int32()), pa.array(least, pa.int64())], names=["vec_id", "cluster", "distance"])

        done = cut(table.mapInArrow(assign, "vec_id long, cluster int, distance long"))
        inertia = {r["cluster"]: r["d"] for r in done.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # at most k rows
        digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
        facts = [(i, inertia[i], sum(inertia.values()), digests[i]) for i in sorted(inertia)]
        facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
        out = done.join(F.broadcast(facts), "cluster")  # at most k rows
        return final(out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
