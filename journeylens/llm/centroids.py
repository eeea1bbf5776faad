"""Lloyd's clustering in whole numbers, distances filtered by a PCA rotation.

Every vector is stored with its integer components, the first LEADING coordinates of its PCA rotation and the norm of
the rest. For a centroid turned the same way, the squared distance of the leading coordinates plus the squared
difference of the two rest norms never exceeds the squared distance; centroids whose bound lies above the exact
distance to the likeliest one are left out, the others are compared exactly in integers. What a round sends are one
partial sum per task and cluster, added up by Spark; centroids (a fixed number) are all the driver holds.

Kept are vectors of exactly WIDTH components, none null or not finite; an empty table gives no rows, and fewer vectors
than centroids as many centroids as vectors. Repeated rows count each time. A null id hashes as an empty text. Of equal
hashes the smaller components come first. Components of any size are exact (beyond 2**26 they take Python's whole
numbers); a distance or inertia that no long can hold is null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize

WIDTH = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
LEADING = 16
#: Components up to this size have squared distances that a long holds.
SMALL = 1 << 26
#: Rounding errors of bounds are far below this share of the squared norms.
SLACK = 1e-9
LONG = (1 << 63) - 1
SALTS = 16


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of each component: longs if all are small, else Python's whole numbers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * SCALE)
    if not scaled.size or np.abs(scaled).max() <= SMALL:
        return scaled.astype(np.int64)
    exact = [math.floor(x * SCALE) if abs(x) < 2.0**900 else int(x) * SCALE for x in vectors.ravel().tolist()]
    return np.array(exact, object).reshape(vectors.shape)


def _numbers(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding) of the vectors that take part, as doubles."""
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole_ones = vectors.filter((F.size("embedding") == WIDTH) & finite)
    return whole_ones.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("embedding"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors of the smallest hashes of `seed:id`; `clusters` rows reach the driver."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(text.cast("binary"), 256).alias("hash"), "embedding")
    taken = rows.orderBy("hash", "embedding").limit(clusters).collect()
    return [[int(x) for x in whole(np.array([row.embedding]))[0]] for row in taken]


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((WIDTH + 1, WIDTH))
    rows = 0
    for batch in batches:
        if batch.num_rows:
            values = np.clip(whole(_numbers(batch.column(1), WIDTH)).astype(float), -1e100, 1e100)
            total[0] += values.sum(axis=0)
            total[1:] += values.T @ values
            rows += len(values)
    numbers = np.concatenate([[rows], total.ravel()])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(numbers))), pa.array(numbers)], ["place", "value"])


def rotation(vectors: DataFrame) -> np.ndarray:
    """The principal axes, the widest first, from sums of components and of their products."""
    sums = vectors.mapInArrow(_moments, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    numbers = np.zeros(1 + (WIDTH + 1) * WIDTH)
    for place, value in sums.collect():  # one row per place, however many vectors
        numbers[place] = value
    mean = numbers[1 : WIDTH + 1] / max(numbers[0], 1)
    spread = numbers[WIDTH + 1 :].reshape(WIDTH, WIDTH) / max(numbers[0], 1) - np.outer(mean, mean)
    if not np.isfinite(spread).all():
        return np.eye(WIDTH)
    return np.linalg.eigh(spread)[1][:, ::-1]


def turned(values: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leading coordinates, norm of the rest and squared norm of each row."""
    with np.errstate(over="ignore", invalid="ignore"):
        all_of = values.astype(float) @ axes
        rest = np.sqrt((all_of[:, LEADING:] ** 2).sum(axis=1))
        return all_of[:, :LEADING], rest, (all_of**2).sum(axis=1)


def store(vectors: DataFrame, axes: np.ndarray) -> DataFrame:
    """Rows (vec_id, embedding, leading, rest, norm), written once and read by every round."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leading, rest, norm = turned(whole(_numbers(batch.column(1), WIDTH)), axes)
            flat = pa.array(leading.ravel())
            lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, LEADING, dtype=np.int32), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists, pa.array(rest), pa.array(norm)],
                ["vec_id", "embedding", "leading", "rest", "norm"],
            )

    schema = "vec_id long, embedding array<double>, leading array<double>, rest double, norm double"
    return materialize(vectors.mapInArrow(apply, schema))


def exact(values: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances row by row."""
    if values.dtype == object or centroids.dtype == object:
        values, centroids = values.astype(object), centroids.astype(object)
    return ((values - centroids) ** 2).sum(axis=1)


def nearest(
    values: np.ndarray, leading: np.ndarray, rest: np.ndarray, norm: np.ndarray, centroids: np.ndarray, axes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of and squared distance to the nearest centroid, ties to the smaller number; how many were compared."""
    own, own_rest, own_norm = turned(centroids, axes)
    with np.errstate(over="ignore", invalid="ignore"):
        bound = ((leading[:, None, :] - own[None]) ** 2).sum(axis=2) + (rest[:, None] - own_rest[None]) ** 2
        likely = np.argmin(np.nan_to_num(bound, nan=0.0), axis=1)
        at_most = exact(values, centroids[likely])
        slack = SLACK * (norm[:, None] + own_norm[None]) + 1.0
        # What cannot be compared (too large for doubles) is not left out either.
        open_ = ~(bound - slack > at_most.astype(float)[:, None])
    row, number = np.nonzero(open_)
    distance = exact(values[row], centroids[number])
    # Rows come in order and numbers rise within them: a stable sort by distance keeps the smaller number first.
    order = np.lexsort((number, distance, row)) if distance.dtype != object else sorted(
        range(len(row)), key=lambda i: (row[i], distance[i], number[i])
    )
    order = np.asarray(order, np.int64)
    best = order[np.flatnonzero(np.r_[True, row[order][1:] != row[order][:-1]])] if len(order) else order
    return number[best], distance[best], len(row)


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    rest, norm = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
    return whole(_numbers(batch.column(1), WIDTH)), _numbers(batch.column(2), LEADING), rest, norm


def _array(centroids: list[list[int]]) -> np.ndarray:
    small = all(abs(x) <= SMALL for row in centroids for x in row)
    return np.array(centroids, np.int64 if small else object).reshape(len(centroids), WIDTH)


def _add_up(frame: pd.DataFrame) -> pd.DataFrame:
    """Partial counts and sums of one cluster, as texts of whole numbers of any size."""
    sums = [0] * WIDTH
    for text in frame["sums"]:
        sums = [a + int(b) for a, b in zip(sums, text.split(","))]
    return pd.DataFrame(
        {"cluster": frame["cluster"][:1], "salt": 0, "n": frame["n"].sum(), "sums": ",".join(map(str, sums))}
    )


PARTIAL = "cluster int, salt int, n long, sums string"


def moved(stored: DataFrame, centroids: list[list[int]], axes: np.ndarray) -> list[list[int]]:
    """The centroids after one round: the floored mean of each one's vectors; without vectors it stays."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _array(centroids)
        counts, sums = [0] * len(own), [np.zeros(WIDTH, object) for _ in own]
        for batch in batches:
            if batch.num_rows:
                values, *turns = _columns(batch)
                number, _, _ = nearest(values, *turns, own, axes)
                for k in np.unique(number):
                    mine = values[number == k]
                    counts[k] += len(mine)
                    sums[k] = sums[k] + mine.sum(axis=0).astype(object)
        used = [k for k, n in enumerate(counts) if n]
        salt = TaskContext.get().partitionId() % SALTS
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()), pa.array([salt] * len(used), pa.int32()),
                pa.array([counts[k] for k in used], pa.int64()), pa.array([",".join(map(str, sums[k])) for k in used], pa.string()),
            ],
            ["cluster", "salt", "n", "sums"],
        )

    parts = stored.mapInArrow(apply, PARTIAL)
    halves = parts.groupBy("cluster", "salt").applyInPandas(_add_up, PARTIAL)
    after = [list(row) for row in centroids]
    for cluster, _, n, sums in halves.groupBy("cluster").applyInPandas(_add_up, PARTIAL).collect():  # one row each
        after[cluster] = [int(x) // n for x in sums.split(",")]
    return after


def assign(stored: DataFrame, centroids: list[list[int]], axes: np.ndarray) -> DataFrame:
    """Rows (vec_id, cluster, distance)."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _array(centroids)
        for batch in batches:
            if batch.num_rows:
                values, *turns = _columns(batch)
                number, distance, _ = nearest(values, *turns, own, axes)
                fitting = [int(d) if d <= LONG else None for d in distance]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(number.astype(np.int32)), pa.array(fitting, pa.int64())],
                    ["vec_id", "cluster", "distance"],
                )

    return stored.mapInArrow(apply, "vec_id long, cluster int, distance long")


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED
) -> tuple[DataFrame, list[list[int]]]:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia), one per vector that takes part; the final centroids."""
    kept = usable(vectors.select("vec_id", "embedding"))
    axes = rotation(kept)
    stored = store(kept, axes)
    centroids = first_centroids(stored, clusters, seed)
    for _ in range(rounds):
        centroids = moved(stored, centroids, axes)
    placed = materialize(assign(stored, centroids, axes))
    # One row per cluster; a sum that misses a distance, or fits no long, is null.
    wide = F.col("distance").cast("decimal(38,0)")
    per_cluster = placed.groupBy(F.col("cluster").alias("of")).agg(
        F.sum(wide).alias("own"), F.count(F.lit(1)).alias("n"), F.count("distance").alias("known")
    )
    rows = per_cluster.collect()
    sums = {row.of: int(row.own) if row.known == row.n else None for row in rows}
    total = None if None in sums.values() else sum(sums.values())
    fit = lambda x: None if x is None or x > LONG else x
    spark = vectors.sparkSession
    table = spark.createDataFrame([(k, fit(x), fit(total)) for k, x in sums.items()], "of int, cluster_inertia long, inertia long")
    joined = placed.join(F.broadcast(table), F.col("cluster") == F.col("of"))
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia"), centroids


def with_digest(placed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds the SHA-256 of each row's centroid, its components joined by commas."""
    hashes = [(k, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for k, row in enumerate(centroids)]
    table = placed.sparkSession.createDataFrame(hashes, "number int, centroid_sha256 string")
    return placed.join(F.broadcast(table), F.col("cluster") == F.col("number")).drop("number")
