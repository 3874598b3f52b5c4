"""Centroid clustering of integer vectors, filtered in PCA-rotated coordinates.

The covariance of all vectors gives a rotation. A vector is stored with its leading rotated coordinates and the norm of
the rest. Rotations keep distances, and the rest of two vectors differ by at least the difference of their norms, so the
squared distance of the leading coordinates plus the squared difference of the norms is a lower bound of the squared
distance. Per vector the centroid of the smallest bound is measured first, in integers; the others are measured, in
integers too, only where their bound does not exceed what was found. Stored coordinates are rounded; a margin on the
bounds covers that, so rounding never decides an assignment.

Each round scans the stored vectors once and sends one row of sums per centroid and task on; nothing else is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, take

# Fixed values of the task: components, their scale, centroids, rounds.
DIMENSIONS, SCALE, CENTROIDS, ROUNDS = 64, 64, 16, 3
# Leading rotated coordinates that are stored.
LEADING = 16
# Larger components are set to this bound, so that every squared distance fits 63 bits.
LARGEST = 1 << 27
# Rows per numpy block, and tasks that add up partial sums before the driver does.
BLOCK, COMBINERS = 8192, 8
LONGEST = 2**63 - 1


def _matrix(column: pa.Array, dimensions: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dimensions)


def integer_vectors(vectors: DataFrame, dimensions: int, scale: int, columns: Sequence[str]) -> DataFrame:
    """vec_id and the components as integers, floor(scale * x) in double precision; other vectors are left out."""
    rows = take(vectors, *columns).toDF("vec_id", "embedding")
    x = F.col("embedding").cast("array<double>")
    fits = (F.size(x) == dimensions) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    bound = float(LARGEST)

    def whole(c):
        # Multiplying first could overflow; beyond the bound the product is not needed.
        return F.floor(F.greatest(F.least(c, F.lit(bound)), F.lit(-bound)) * scale).cast("long")

    def held(c):
        return F.greatest(F.least(whole(c), F.lit(LARGEST).cast("long")), F.lit(-LARGEST).cast("long")).cast("int")

    return rows.filter(F.coalesce(fits, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, held).alias("v"))


def _added(parts: DataFrame) -> DataFrame:
    """Rows (part, data) of equal part, arrays of longs or doubles, added up; a few rows per part are left."""
    kind = parts.schema["data"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch["part"].to_pylist(), batch["data"], strict=True):
                x = data.values.to_numpy(zero_copy_only=False)
                total[part] = total[part] + x if part in total else x
        if total:
            arrays = pa.array([total[p] for p in total], pa.list_(pa.int64() if kind.simpleString() == "bigint" else pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), arrays], ["part", "data"])

    return parts.repartition(COMBINERS).mapInArrow(run, parts.schema)


def rotation(vectors: DataFrame, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and principal axes (columns, leading first) of all vectors: one product matrix per task is added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(dimensions), np.zeros((dimensions, dimensions))
        for batch in batches:
            x = _matrix(batch["v"], dimensions, np.float64)
            n, total, products = n + len(x), total + x.sum(axis=0), products + x.T @ x
        data = pa.array([np.concatenate([[n], total, products.ravel()])], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), data], ["part", "data"])

    parts = [np.array(r.data) for r in _added(vectors.select("v").mapInArrow(run, "part int, data array<double>")).collect()]
    summed = np.sum(parts, axis=0) if parts else np.zeros(1 + dimensions + dimensions**2)
    n = max(summed[0], 1.0)
    mean = summed[1 : 1 + dimensions] / n
    covariance = summed[1 + dimensions :].reshape(dimensions, dimensions) / n - np.outer(mean, mean)
    _, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    return mean, axes[:, ::-1]


def rotated(x: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates and the norm of the others."""
    y = (x.astype(np.float64) - mean) @ axes
    return y[:, :leading], np.sqrt((y[:, leading:] ** 2).sum(axis=1))


def nearest_centroids(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, spots: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: smaller number) and squared distance of each row, and how many distances were measured."""
    lead, rest = lead.astype(np.float64), rest.astype(np.float64)
    spot_lead, spot_rest = spots
    square = (lead[:, None, :] - spot_lead[None, :, :]) ** 2
    bounds = np.sqrt(square.sum(axis=2) + (rest[:, None] - spot_rest[None, :]) ** 2)
    # Single precision rounds a coordinate by 2^-24 of itself; four times that, and the centroid's own rounding.
    size = np.sqrt((lead**2).sum(axis=1) + rest**2)
    reach = np.sqrt((spot_lead**2).sum(axis=1) + spot_rest**2)
    bounds = bounds - 2.0**-22 * (1 + size[:, None] + reach[None, :])

    def measured(rows: np.ndarray | slice, numbers: np.ndarray | int) -> np.ndarray:
        return ((x[rows] - centroids[numbers]) ** 2).sum(axis=1)

    number = bounds.argmin(axis=1)
    best = measured(slice(None), number)
    count = len(x)
    for j in range(len(centroids)):
        # The root is rounded too, by far less than this factor.
        open_ = np.flatnonzero((bounds[:, j] <= np.sqrt(best.astype(np.float64)) * (1 + 1e-12)) & (number != j))
        d = measured(open_, j)
        count += len(open_)
        better = (d < best[open_]) | ((d == best[open_]) & (j < number[open_]))
        best[open_[better]], number[open_[better]] = d[better], j
    return number, best, count


def _blocks(batch: pa.RecordBatch, dimensions: int, leading: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    x, lead = _matrix(batch["v"], dimensions, np.int64), _matrix(batch["lead"], leading, np.float32)
    rest = batch["rest"].to_numpy(zero_copy_only=False)
    for at in range(0, len(x), BLOCK):
        yield at, x[at : at + BLOCK], lead[at : at + BLOCK], rest[at : at + BLOCK]


def _moved(held: DataFrame, centroids: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int) -> np.ndarray:
    """Centroids after a round: the floor of each component's mean; a centroid without vectors stays."""
    k, dimensions = centroids.shape
    spots = rotated(centroids, mean, axes, leading)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dimensions), dtype=np.int64)
        for batch in batches:
            for _, x, lead, rest in _blocks(batch, dimensions, leading):
                number, _, _ = nearest_centroids(x, lead, rest, centroids, spots)
                counts += np.bincount(number, minlength=k)
                for j in np.unique(number):
                    sums[j] += x[number == j].sum(axis=0)
        rows = np.concatenate([counts[:, None], sums], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(rows), pa.list_(pa.int64()))], ["part", "data"])

    totals = [[0] * (1 + dimensions) for _ in range(k)]
    for r in _added(held.select("v", "lead", "rest").mapInArrow(run, "part int, data array<bigint>")).collect():
        totals[r.part] = [a + b for a, b in zip(totals[r.part], r.data, strict=True)]
    return np.array([[s // t[0] for s in t[1:]] if t[0] else list(c) for t, c in zip(totals, centroids.tolist(), strict=True)], dtype=np.int64)


def cluster(
    vectors: DataFrame,
    columns: Sequence[str] = ("vec_id", "embedding"),
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    leading: int = LEADING,
) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid (its components).

    Vectors that are NULL, of another length, or hold NULL or non-finite components are left out. Components beyond
    +-2^27 after scaling are set to that bound, sums of distances beyond 63 bits to the largest long. Centroids start as
    the vectors of the smallest SHA-256 of ``1:<vec_id>``, a NULL id as the empty text, ties by smaller components; fewer
    vectors than ``k`` give fewer centroids. Repeated rows each count and each get their row. No vectors give no rows.
    Further columns are ignored.
    """
    spark, leading = vectors.sparkSession, min(leading, dimensions)
    whole = stored(integer_vectors(vectors, dimensions, scale, columns), "cluster-vectors")
    mean, axes = rotation(whole, dimensions)

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = rotated(_matrix(batch["v"], dimensions, np.int64), mean, axes, leading)
            packed = pa.FixedSizeListArray.from_arrays(pa.array(lead.astype(np.float32).ravel()), leading).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["v"], packed, pa.array(rest.astype(np.float32))], ["vec_id", "v", "lead", "rest"])

    held = stored(whole.mapInArrow(rotate, "vec_id long, v array<int>, lead array<float>, rest float"), "cluster-rotated")
    rank = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = whole.select(rank.alias("rank"), "v").orderBy("rank", "v").limit(k).collect()
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not first:
        return spark.createDataFrame([], result)
    centroids = np.array([r.v for r in first], dtype=np.int64)
    for _ in range(rounds):
        centroids = _moved(held, centroids, mean, axes, leading)
    spots = rotated(centroids, mean, axes, leading)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x, lead, rest in _blocks(batch, dimensions, leading):
                number, distance, _ = nearest_centroids(x, lead, rest, centroids, spots)
                ids = batch["vec_id"].slice(at, len(x))
                yield pa.RecordBatch.from_arrays([ids, pa.array(number.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    assigned = stored(held.select("vec_id", "v", "lead", "rest").mapInArrow(assign, "vec_id long, cluster int, distance long"), "cluster-assigned")
    # One row per centroid: k rows at most.
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    per = {r.cluster: int(r.d) for r in sums}
    facts = [(j, min(per[j], LONGEST), min(sum(per.values()), LONGEST), centroids[j].tolist()) for j in sorted(per)]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return assigned.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def oracle_sql() -> str:
    """The same by unrolled rounds: all distances, then the exact floor of each component's mean."""
    def assigned(r: int) -> str:
        distance = "list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i])))"
        return f"""
a{r} AS MATERIALIZED (
  SELECT n, vec_id, v, (least_pair).c AS cluster, (least_pair).d AS distance
  FROM (SELECT v.n, v.vec_id, v.v, min(struct_pack(d := CAST({distance} AS BIGINT), c := c.c)) AS least_pair
        FROM k v, c{r} c GROUP BY v.n, v.vec_id, v.v))"""

    def moved(r: int) -> str:
        return f"""
s{r} AS (SELECT cluster, i, sum(CAST(v[i] AS HUGEINT)) AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY cluster, i),
m{r} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{r} GROUP BY cluster),
c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m ON m.cluster = c.c)"""

    rounds = ",".join(f"{assigned(r)},{moved(r)}" for r in range(ROUNDS))
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY rank, v) - 1 AS INTEGER) AS c, v
  FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS rank, v FROM k ORDER BY rank, v LIMIT 16)),
{rounds},{assigned(ROUNDS)}
SELECT a.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.c = a.cluster"""
