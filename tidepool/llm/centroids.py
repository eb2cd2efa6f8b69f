"""Clusters of integer vectors: centroids by tournaments of bisecting planes.

The points that are as near to one centroid as to another lie on a plane; its
normal and threshold are integers and are worked out once a round for every
pair. A vector starts with centroid 0 and meets centroids 1 to k-1 in turn;
the sign of (normal . x - threshold) tells the loser of each meeting, zero
favours the smaller number. So k-1 sign tests find the nearest centroid, and
one squared distance, to the winner, is worked out exactly.

Tasks send sums and counts of their clusters, k * (dims + 1) rows each; no
vector moves. Numbers are exact at any size: arithmetic is done in doubles or
64-bit integers where a bound proves that they hold every value, otherwise in
Python integers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import in_batches, to_batch
from tidepool.session import materialize

# Vectors that a task works on together.
ROWS = 1 << 13

# Sums travel as digits of this many bits, so that Spark can add them as longs.
DIGIT_BITS = 40

LONG = 1 << 63


def integer_vectors(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of exactly ``dims`` finite numbers, and floor(scale * x) of their components.

    The second array is of 64-bit integers, or of Python's where those are too small.
    """
    lists = column.cast(pa.large_list(pa.float64()))
    lengths = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dims)
    values = lists.take(pa.array(rows)).flatten()
    found = values.fill_null(math.nan).to_numpy(zero_copy_only=False).reshape(-1, dims)
    finite = np.isfinite(found).all(axis=1)
    rows, found = rows[finite], found[finite]
    if not np.abs(found).max(initial=0) * scale < 1 << 53:
        # From 2^53 on doubles are whole numbers.
        exact = [int(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale) for x in found.ravel().tolist()]
        return rows, np.array(exact, object).reshape(-1, dims)
    return rows, np.floor(found * scale).astype(np.int64)


def largest(values: np.ndarray) -> int:
    """The largest magnitude, as a Python integer."""
    return max(abs(int(values.min())), abs(int(values.max()))) if values.size else 0


class Tournament:
    """Normals and thresholds of all pairs of centroids, rows of integers in order."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, object)
        k = len(centroids)
        squares = [sum(x * x for x in c) for c in centroids]
        self.normals = np.array([[[2 * (b - a) for a, b in zip(centroids[i], centroids[j], strict=True)]
                                  for j in range(k)] for i in range(k)], object)
        self.thresholds = np.array([[squares[j] - squares[i] for j in range(k)] for i in range(k)], object)
        self.most = max(largest(self.normals), 1)
        self.far = largest(self.thresholds)
        self.reach = largest(self.centroids)
        self.typed: dict = {}

    def _as(self, kind) -> tuple[np.ndarray, np.ndarray]:
        if kind not in self.typed:
            self.typed[kind] = self.normals.astype(kind), self.thresholds.astype(kind)
        return self.typed[kind]

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each row; of equally near ones the smallest."""
        bound = x.shape[1] * largest(x) * self.most + self.far
        kind = np.float64 if bound < 1 << 53 else np.int64 if bound < LONG else object
        normals, thresholds = self._as(kind)
        x = x.astype(kind)
        best = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            side = (x * normals[best, j]).sum(axis=1) > thresholds[best, j]
            best[side] = j
        return best

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Exact squared distances of the rows to the centroids ``best``."""
        bound = x.shape[1] * (largest(x) + self.reach) ** 2
        kind = np.int64 if bound < LONG else object
        away = x.astype(kind) - self.centroids.astype(kind)[best]
        return (away * away).sum(axis=1)


def digits(value: int) -> list[int]:
    """The value's digits, least first, each with its sign; zero has none."""
    sign, left, out = (-1 if value < 0 else 1), abs(value), []
    while left:
        out.append(sign * (left & (1 << DIGIT_BITS) - 1))
        left >>= DIGIT_BITS
    return out


def _chunks(batches: Iterator[pa.RecordBatch], dims: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            rows, x = integer_vectors(part.column(part.num_columns - 1), dims, scale)
            if len(rows):
                yield part, rows, x


def first_centroids(vectors: DataFrame, k: int, dims: int, scale: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the least sha256 of ``seed:id``; equal hashes go by their components."""
    schema = pa.schema([("h", pa.string()), ("x", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[tuple[str, list[int]]] = []
        for part, rows, x in _chunks(batches, dims, scale):
            names = part.column(0).take(pa.array(rows)).to_pylist()
            bound = least[-1][0] if len(least) == k else None
            some = [i for i, h in enumerate(names) if bound is None or h <= bound]
            least = sorted(least + [(names[i], x[i].tolist()) for i in some])[:k]
        if least:
            yield to_batch([(h, [str(v) for v in c]) for h, c in least], schema)

    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    found = vectors.select(named.alias("h"), "x").mapInArrow(run, "h string, x array<string>")
    # At most k rows a task, and k in all.
    kept = found.orderBy("h").limit(k + 1).collect()
    edge = [r.h for r in kept[k - 1:]]
    if len(edge) == 2 and edge[0] == edge[1]:  # a tie at the border: all rows of that hash, k a task at most
        kept = [r for r in kept if r.h < edge[0]] + found.where(F.col("h") == edge[0]).collect()
    return [x for _, x in sorted((r.h, [int(v) for v in r.x]) for r in kept)][:k]


def cluster_sums(vectors: DataFrame, planes, dims: int, scale: int) -> dict[tuple[int, int], int]:
    """Sum of each (cluster, component), and the count as component -1; at most k * (dims + 1) of them."""
    schema = pa.schema([("c", pa.int32()), ("i", pa.int32()), ("digit", pa.int32()), ("part", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for _, _, x in _chunks(batches, dims, scale):
            best = planes.value.winners(x)
            if x.dtype != object and len(x) * largest(x) >= LONG:
                x = x.astype(object)
            order = np.argsort(best, kind="stable")
            starts = np.flatnonzero(np.diff(best[order], prepend=-1))
            sums = np.add.reduceat(x[order], starts, axis=0)
            counts = np.diff(np.append(starts, len(order)))
            for c, own, n in zip(best[order][starts].tolist(), sums.tolist(), counts.tolist(), strict=True):
                for i, v in zip(range(-1, dims), [n, *own], strict=True):
                    total[c, i] = total.get((c, i), 0) + v
        yield from in_batches(((c, i, d, part) for (c, i), v in total.items() for d, part in enumerate(digits(v))), schema)

    parts = vectors.select("x").mapInArrow(run, "c int, i int, digit int, part bigint")
    out: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("c", "i", "digit").agg(F.sum("part").alias("part")).collect():
        out[r.c, r.i] = out.get((r.c, r.i), 0) + (r.part << DIGIT_BITS * r.digit)
    return out


def moved(centroids: list[list[int]], sums: dict[tuple[int, int], int]) -> list[list[int]]:
    """Floors of the means of the clusters' vectors; empty clusters keep their centroid."""
    return [[sums.get((c, i), 0) // sums[c, -1] for i in range(len(old))] if sums.get((c, -1)) else old
            for c, old in enumerate(centroids)]


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 16,
                    rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """Per kept vector ``id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid``.

    Components become floor(scale * x). Centroids start as the ``k`` vectors
    with the least sha256 of ``seed:id`` and take the floor of their vectors'
    mean after each of ``rounds`` assignments; one more assignment gives the
    result. ``distance`` is squared, ``cluster_inertia`` and ``inertia`` are
    its sums over the cluster and over all; ``centroid`` is the final one as
    decimal text. What grows with the input stays in the tasks; the driver
    holds k centroids and k * k normals.

    Defined cases: null vectors and those with another number of components,
    a null or a value that is not finite are left out, whatever their length;
    with fewer than ``k`` vectors each is a centroid; of equally near
    centroids the one with the smaller number wins; rows with equal ids are
    vectors of their own, and where their hashes are equal the one with
    smaller components comes first; a null id hashes as empty text; a
    distance or sum that passes 64 bits is null (clusters stay exact); an
    empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("x"))
    id_type = vectors.schema[id_col].dataType
    centroids = first_centroids(named, k, dims, scale, seed)
    if not centroids:
        return spark.createDataFrame([], f"id {id_type.simpleString()}, cluster int, distance bigint, cluster_inertia bigint, "
                                         "inertia bigint, centroid_sha256 string, centroid string").withColumnRenamed("id", id_col)
    for _ in range(rounds):
        planes = spark.sparkContext.broadcast(Tournament(centroids))
        centroids = moved(centroids, cluster_sums(named, planes, dims, scale))
    planes = spark.sparkContext.broadcast(Tournament(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, x in _chunks(batches, dims, scale):
            best = planes.value.winners(x)
            away = planes.value.distances(x, best)
            fits = [d if d < LONG else None for d in away.tolist()]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(best, pa.int32()),
                                              pa.array(fits, pa.int64())], names=["id", "cluster", "distance"])

    found = materialize(named.mapInArrow(assign, f"id {id_type.simpleString()}, cluster int, distance bigint"))

    inertia: dict[int, int | None] = {}
    whole = (F.count("distance") == F.count(F.lit(1))).alias("whole")
    for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"), whole).collect():
        inertia[r.cluster] = int(r.d) if r.whole else None

    def in_long(parts: list[int | None]) -> int | None:
        total = None if None in parts else sum(parts)
        return None if total is None or total >= LONG else total

    rows = []
    for c, centroid in enumerate(centroids):
        text = ",".join(map(str, centroid))
        rows.append((c, in_long([inertia.get(c, 0)]), in_long(list(inertia.values())),
                     hashlib.sha256(text.encode()).hexdigest(), text))
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid string")
    # One row a centroid: the size is the parameter k.
    joined = found.join(F.broadcast(about), "cluster")
    return joined.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia",
                         "centroid_sha256", "centroid")
