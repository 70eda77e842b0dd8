"""Centroid clustering of vectors in integers, with a PCA-rotated filter before exact distances.

Vectors with exactly ``dims`` components, all of them finite numbers, are kept; a component x counts as the integer
floor(scale * x).  The vectors are rotated onto the principal axes of all kept ones.  Each is stored
with its ``lead`` first rotated coordinates and the norm of the others (the residual).  For a vector and a
centroid, the squared distance of the leading coordinates plus the squared difference of the residual
norms is a lower bound of their squared distance (the triangle inequality in the residual space).  The
nearest centroid by the bound is measured exactly; the others only where their bound, less a slack
for rounding, does not exceed that.  All distances and sums that decide are integers, so rotation,
order and partitions have no influence on the result.

Tasks send sums of their vectors: at most k x (dims + 1) integers, in limbs of 32 bits so that a sum of
any size is exact.  The driver holds k centroids and dims x dims covariances, whatever the
number of vectors, and broadcasts them with the tasks.

A null or short vector, or one with a null, NaN or infinite component, is left out.  A missing vec_id
counts as an empty one in the hash.  Equal hashes (repeated vec_ids) are ordered by the vectors;
repeated rows are each clustered.  Fewer kept vectors than k make fewer centroids; an empty table gives no rows.
Components beyond 2^27 are measured with Python's unbounded integers; a squared distance or an inertia that a
long cannot hold is null."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Integer components up to which 64-bit arithmetic is exact for up to 128 dimensions.
SMALL = 1 << 27
MOST_LONG = (1 << 63) - 1
LIMB = 32
#: Share of the squared norms that the bound may err by in floating point.
SLACK = 1e-9
#: Vectors handled at a time.
ROWS = 16_384


def kept(vectors: DataFrame, vec_id: str, vector: str, dims: int) -> DataFrame:
    """(vec_id, x) of the vectors with ``dims`` finite components."""
    x = F.col("x")
    fit = (F.size(x) == dims) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    some = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    return some.where(x.isNotNull()).where(fit)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def integers(x: np.ndarray, scale: int) -> tuple[np.ndarray, list[tuple[int, list[int]]]]:
    """floor(scale * x), zeros where a component is not small, and those rows in unbounded integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * scale)
    large = ~(np.abs(scaled) <= SMALL).all(axis=1)
    exact = [(r, [math.floor(v) if math.isfinite(v) else int(w) * scale for v, w in zip(scaled[r].tolist(), x[r].tolist())]) for r in np.flatnonzero(large).tolist()]
    scaled[large] = 0
    return scaled.astype(np.int64), exact


def limbs(total: int) -> Iterator[tuple[int, int]]:
    """(position, signed limb) of an integer, but for zeros."""
    sign, rest, k = (1 if total >= 0 else -1), abs(total), 0
    while rest:
        if rest & ((1 << LIMB) - 1):
            yield k, sign * (rest & ((1 << LIMB) - 1))
        rest, k = rest >> LIMB, k + 1


class Rotation:
    """Principal axes and mean of all small vectors; any orthogonal rotation keeps the bound valid."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray, lead: int):
        self.mean, self.axes, self.lead = mean, axes, min(lead, len(mean))

    @classmethod
    def of(cls, some: DataFrame, dims: int, scale: int, lead: int) -> Rotation:
        """From the sums and products of all vectors: dims x (dims + 1) + 1 numbers a task."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total, square = 0, np.zeros(dims), np.zeros((dims, dims))
            for batch in batches:
                v, large = integers(matrix(batch.column(0), dims), scale)
                n, total, square = n + len(v) - len(large), total + v.sum(axis=0), square + v.T.astype(float) @ v
            flat = np.concatenate(([n], total, square.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["i", "v"])

        flat = np.zeros(1 + dims + dims * dims)
        for r in some.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            flat[r.i] = r.v
        n = max(flat[0], 1)
        mean = flat[1:dims + 1] / n
        covariance = flat[dims + 1:].reshape(dims, dims) / n - np.outer(mean, mean)
        return cls(mean, np.linalg.eigh(covariance)[1][:, ::-1].copy(), lead)

    def __call__(self, v: np.ndarray) -> np.ndarray:
        """The leading coordinates and the residual norm of each vector."""
        with np.errstate(over="ignore", invalid="ignore"):
            z = (v - self.mean) @ self.axes
            return np.column_stack((z[:, :self.lead], np.sqrt((z[:, self.lead:] ** 2).sum(axis=1))))


class Centroids:
    """Nearest centroids of batches of vectors; ``points`` are lists of integers."""

    def __init__(self, points: list[list[int]], rotation: Rotation):
        self.points, self.rotation = points, rotation
        self.large = any(abs(c) > SMALL for p in points for c in p)
        if not self.large:
            self.exact = np.array(points, np.int64)
            self.rotated = rotation(self.exact.astype(float))

    def nearest(self, v: np.ndarray, rotated: np.ndarray, large: list[tuple[int, list[int]]]) -> tuple[np.ndarray, list, int]:
        """The nearest centroid of each row (the first of equals), its squared distance, and how
        many exact distances it took."""
        if self.large:
            return self.nearest_plain(v.tolist(), dict(large))
        n, rows = len(v), np.arange(len(v))
        a, b = rotated, self.rotated
        # leading coordinates and residual norm enter alike: the squared distance of the stored columns
        norms, sizes = (a * a).sum(axis=1)[:, None], (b * b).sum(axis=1)
        bound = norms + sizes - 2 * (a @ b.T) - SLACK * (norms + sizes + 1)
        best = bound.argmin(axis=1)
        distance = ((v - self.exact[best]) ** 2).sum(axis=1)
        measured = n
        first = best.copy()
        for j in range(len(self.points)):
            some = rows[(bound[:, j] <= distance) & (first != j)]
            if len(some):
                measured += len(some)
                d = ((v[some] - self.exact[j]) ** 2).sum(axis=1)
                nearer = (d < distance[some]) | (d == distance[some]) & (j < best[some])
                best[some[nearer]], distance[some[nearer]] = j, d[nearer]
        found = distance.tolist()
        if large:
            at, far, more = self.nearest_plain([x for _, x in large], {})
            for (r, _), j, d in zip(large, at.tolist(), far):
                best[r], found[r] = j, d
            measured += more
        return best, found, measured

    def nearest_plain(self, v: list[list[int]], large: dict[int, list[int]]) -> tuple[np.ndarray, list[int], int]:
        """The same in unbounded integers, without the filter."""
        v = [large.get(r, x) for r, x in enumerate(v)]
        found = [min((sum((a - b) ** 2 for a, b in zip(x, p)), j) for j, p in enumerate(self.points)) for x in v]
        return np.array([j for _, j in found], np.int64), [d for d, _ in found], len(v) * len(self.points)


class Clustering:
    """``fit`` gives the final centroids and the assignment of every kept vector."""

    def __init__(self, k: int = 16, rounds: int = 3, seed: int = 1, dims: int = 64, scale: int = 64, lead: int = 16):
        self.k, self.rounds, self.seed, self.dims, self.scale, self.lead = k, rounds, seed, dims, scale, lead

    def first(self, some: DataFrame) -> list[list[int]]:
        """The vectors with the smallest hashes of seed and vec_id: k rows."""
        key = F.sha2(F.concat(F.lit(f"{self.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
        rows = some.select(key.alias("key"), "x").orderBy("key", "x").limit(self.k).collect()
        v, large = integers(np.array([r.x for r in rows]).reshape(-1, self.dims), self.scale)
        return [dict(large).get(r, x) for r, x in enumerate(v.tolist())]

    def rotated(self, some: DataFrame, rotation: Rotation) -> DataFrame:
        """The kept vectors with their leading coordinates and residual norm, written once."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                r = rotation(integers(matrix(batch.column(1), self.dims), self.scale)[0].astype(float))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, r.size + 1, r.shape[1], dtype=np.int32)), pa.array(r.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, flat], ["vec_id", "x", "rotated"])
        return written(some.mapInArrow(run, "vec_id long, x array<double>, rotated array<double>"), "centroid-vectors")

    def parts(self, batch: pa.RecordBatch):
        """Slices of a batch: the rows, their integers, the large ones, and the rotated columns."""
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            yield part, *integers(matrix(part.column("x"), self.dims), self.scale), matrix(part.column("rotated"), min(self.lead, self.dims) + 1)

    def moved(self, vectors: DataFrame, centroids: Centroids) -> list[list[int]]:
        """Every non-empty centroid becomes the floored mean of its vectors."""
        k, dims = len(centroids.points), self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, total, extra = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), {}
            for batch in batches:
                for _, v, large, rotated in self.parts(batch):
                    best, *_ = centroids.nearest(v, rotated, large)
                    counts += np.bincount(best, minlength=k)
                    for j in np.unique(best).tolist():
                        total[j] += v[best == j].sum(axis=0)
                    for r, x in large:
                        at = extra.setdefault(int(best[r]), [0] * dims)
                        at[:] = map(int.__add__, at, x)
            # component -1 is the count
            whole = [(j, i, n + extra.get(j, [0] * dims)[i]) for j in range(k) for i, n in enumerate(total[j].tolist())]
            out = [(j, i, at, v) for j, i, n in [*whole, *((j, -1, n) for j, n in enumerate(counts.tolist()))] for at, v in limbs(n)]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["j", "i", "at", "v"])

        sums: dict[tuple[int, int], int] = {}
        for r in vectors.mapInArrow(run, "j int, i int, at int, v long").groupBy("j", "i", "at").agg(F.sum("v").alias("v")).collect():
            sums[r.j, r.i] = sums.get((r.j, r.i), 0) + (r.v << LIMB * r["at"])
        return [[sums.get((j, i), 0) // sums[j, -1] for i in range(dims)] if (j, -1) in sums else p for j, p in enumerate(centroids.points)]

    def assigned(self, vectors: DataFrame, centroids: Centroids) -> DataFrame:
        """(vec_id, cluster, distance, measured); measured: exact distances of the row's batch, on its first row."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, v, large, rotated in self.parts(batch):
                    best, distance, measured = centroids.nearest(v, rotated, large)
                    exact = pa.array([d if d <= MOST_LONG else None for d in distance], pa.int64())
                    work = np.zeros(len(v), np.int64)
                    work[0] = measured
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best.astype(np.int32)), exact, pa.array(work)], ["vec_id", "cluster", "distance", "measured"])
        return vectors.mapInArrow(run, "vec_id long, cluster int, distance long, measured long")

    def fit(self, vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
        """The written assignment and the centroids that it used."""
        some = kept(vectors, vec_id, vector, self.dims)
        points = self.first(some)
        if not points:
            return some.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS measured").limit(0), []
        rotation = Rotation.of(some, self.dims, self.scale, self.lead)
        stored = self.rotated(some, rotation)
        for _ in range(self.rounds):
            points = self.moved(stored, Centroids(points, rotation))
        return written(self.assigned(stored, Centroids(points, rotation)), "centroid-assignment"), points


def digest(point: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, point)).encode()).hexdigest()


def with_inertia(assignment: DataFrame, points: list[list[int]]) -> DataFrame:
    """vec_id, cluster, distance, and for the cluster its inertia, that of all and its centroid's
    digest: one row a cluster, k at most, joined to the vectors."""
    spark = assignment.sparkSession
    total = F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(19,0)")))
    sums = {r["cluster"]: None if r["sum"] is None else int(r["sum"]) for r in assignment.groupBy("cluster").agg(total.alias("sum")).collect()}
    whole = None if None in sums.values() else sum(sums.values())
    table = [(j, *(None if s is None or s > MOST_LONG else s for s in (own, whole)), digest(points[j])) for j, own in sums.items()]
    of = spark.createDataFrame(table, "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assignment.join(F.broadcast(of), F.col("cluster") == F.col("c")).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
