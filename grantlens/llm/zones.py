"""Centroid clustering over zone maps in space-filling-curve order.

Vectors become integers and are put in the order of a Hilbert curve; runs of
neighbours are stored as blocks with the least and greatest value of each
component. In each round a block's box bounds its distance to every centroid
from below and above: only centroids that may be nearest to some point of the
box are compared, exactly and all at once, with the block's vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm.common import load, saved

# Fixed values of the contract.
DIMENSIONS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = 2

BLOCK = 256
# Bits of each component that decide the place on the curve.
CURVE_BITS = 4
# Beyond this a squared distance may not fit in 64 bits.
LARGEST = 1 << 27
# Whole numbers below this are exact in floating point, whatever the order of a sum.
EXACT = float(1 << 53)

BLOCKS = "ids array<bigint>, v array<int>, low array<int>, high array<int>"


def vectors(table: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) with v the components as whole numbers, for vectors of the right length without gaps.

    Null vectors and those with a null, infinite or undefined component are
    left out. A scaled component beyond 2^27 raises an error: its squared
    distances would not fit in the 64 bits that results have.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * scale))
    fits = F.forall(x, lambda c: F.abs(c) * scale < LARGEST)
    v = F.when(fits, whole.cast("array<int>")).otherwise(
        F.raise_error(F.lit(f"a component beyond {LARGEST // scale} is too large for 64-bit distances")).cast("array<int>")
    )
    return table.filter((F.size("embedding") == dimensions) & finite).select("vec_id", v.alias("v"))


def first_centroids(rows: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors of the k smallest hashes of their ids; equal ids by components, a null id counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = rows.select(F.sha2(name.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in chosen], dtype=np.int64)


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells (numbers of so many bits) on the Hilbert curve, as rows of bytes.

    All bits are undone from the highest down: a set bit flips the lower bits of
    the first component, a clear one exchanges them with those of its own; the
    Gray code of the result is the place, read bit by bit across components.
    """
    x = cells.T.astype(np.uint32)
    for bit in range(bits - 1, 0, -1):
        lower = np.uint32((1 << bit) - 1)
        for i in range(len(x)):
            is_set = (x[i] >> np.uint32(bit) & np.uint32(1)).astype(bool)
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & lower).astype(np.uint32)
            x[0] ^= np.where(is_set, lower, swap)
            x[i] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    flip = np.zeros(x.shape[1], dtype=np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> np.uint32(bit) & np.uint32(1), np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= flip
    planes = [x.T >> np.uint32(bit) & np.uint32(1) for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel(), kind), rows.shape[1]).cast(pa.list_(kind))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length, as rows of numbers."""
    if not len(column):
        return np.zeros((0, 0), dtype=np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64)


def blocks(rows: DataFrame, dimensions: int = DIMENSIONS, bits: int = CURVE_BITS, size: int = BLOCK) -> DataFrame:
    """Runs of at most `size` vectors in curve order, with the bounds of their box.

    Each component's range is cut into equal cells. Equal places are ordered by
    id and row, so that many equal vectors are still dealt to many tasks.
    """
    of = [F.element_at("v", i + 1).alias(f"v{i}") for i in range(dimensions)]
    ends = [f(f"v{i}").alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(dimensions)]
    bounds = rows.select(*of).agg(*ends).first()
    # An empty table has no bounds and no blocks.
    low = np.array([bounds[f"low{i}"] or 0 for i in range(dimensions)], dtype=np.int64)
    wide = np.array([bounds[f"high{i}"] or 0 for i in range(dimensions)], dtype=np.int64) - low + 1

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = ((matrix(batch.column("v")) - low) << bits) // wide
                key = pa.array([k.tobytes() for k in hilbert_key(cells, bits)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("row"), batch.column("v"), key], names=["vec_id", "row", "v", "key"]
                )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def block(ids: pa.Array, v: np.ndarray) -> pa.RecordBatch:
            one = [lists(x.reshape(1, -1), pa.int32()) for x in (v, v.min(axis=0), v.max(axis=0))]
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *one], names=["ids", "v", "low", "high"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, v = batch.column("vec_id"), matrix(batch.column("v"))
            if held is not None:
                ids, v = pa.concat_arrays([held[0], ids]), np.concatenate([held[1], v])
            whole = len(ids) // size * size
            for at in range(0, whole, size):
                yield block(ids.slice(at, size), v[at : at + size])
            held = (ids.slice(whole), v[whole:])
        if held is not None and len(held[0]):
            yield block(*held)

    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    keyed = keyed.mapInArrow(placed, "vec_id bigint, row bigint, v array<int>, key binary")
    order = ["key", "vec_id", "row"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "v").mapInArrow(packed, BLOCKS)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some point of the box.

    A centroid is out if it is farther from all of the box than some other one
    is from the box's farthest corner.
    """
    inside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    corner = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    near, far = (inside * inside).sum(axis=1), (corner * corner).sum(axis=1)
    return np.flatnonzero(near <= far.min())


def nearest(v: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector of a block, the smaller number on ties, and the squared distance."""
    some = candidates(low, high, centroids)
    c = centroids[some]
    most = float(max(np.abs(v).max(initial=0), np.abs(c).max(initial=0), 1))
    if 4 * v.shape[1] * most * most < EXACT:
        # Whole numbers throughout, none too large for a double: exact in any order.
        x, y = v.astype(np.float64), c.astype(np.float64)
        far = ((x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)).astype(np.int64)
    else:
        far = np.stack([((v - one) ** 2).sum(axis=1) for one in c], axis=1)
    at = far.argmin(axis=1)
    return some[at], far[np.arange(len(v)), at]


def _each_block(batch: pa.RecordBatch, dimensions: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    for i in range(batch.num_rows):
        v, low, high = (batch.column(c)[i].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("v", "low", "high"))
        yield batch.column("ids")[i].values, v.reshape(-1, dimensions), low, high


def moved(zones: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: floors of the means of the vectors nearest to each; empty ones stay.

    Every task sends one row of sums per centroid, and one row per centroid reaches the driver.
    """
    k, dimensions = centroids.shape
    shared = zones.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dimensions), dtype=np.int64)
        for batch in batches:
            for _, v, low, high in _each_block(batch, dimensions):
                cluster, _ = nearest(v, low, high, shared.value)
                order = np.argsort(cluster, kind="stable")
                kinds, starts = np.unique(cluster[order], return_index=True)
                sums[kinds] += np.add.reduceat(v[order], starts, axis=0)
                n += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(n[used]), lists(sums[used], pa.int64())], names=["cluster", "n", "sums"]
        )

    sums = [F.sum(F.element_at("sums", i + 1)).alias(f"s{i}") for i in range(dimensions)]
    found = zones.mapInArrow(run, "cluster bigint, n bigint, sums array<bigint>")
    out = centroids.copy()
    for row in found.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():
        out[row.cluster] = [row[f"s{i}"] // row.n for i in range(dimensions)]
    return out


def assigned(zones: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) for every vector."""
    shared = zones.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, v, low, high in _each_block(batch, shared.value.shape[1]):
                cluster, far = nearest(v, low, high, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cluster.astype(np.int32)), pa.array(far)], names=["vec_id", "cluster", "distance"]
                )

    return zones.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def clustered(
    table: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    size: int = BLOCK,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector kept of a table (vec_id, embedding), and the centroids.

    Repeated rows give repeated results. With fewer than k vectors each is a
    centroid. Equal distances go to the smaller number. An empty table gives
    an empty result and no centroids.
    """
    rows = vectors(table, dimensions, scale)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        empty = rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")).filter("false")
        return empty, np.zeros((0, dimensions), dtype=np.int64)
    zones = saved(blocks(rows, dimensions, size=size), "zones")
    for _ in range(rounds):
        centroids = moved(zones, centroids)
    return saved(assigned(zones, centroids), "assigned"), centroids


def op13_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clustered(load(spark, sf_dir, "embeddings"))
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # One row per centroid.
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()
    inertia = sum(r.n for r in sums)
    per_cluster = spark.createDataFrame(
        [(r.cluster, r.n, inertia, names[r.cluster]) for r in sums],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return found.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _round(i: int) -> str:
    """SQL of one round: centroids c{i} from c{i - 1}."""
    return f"""
a{i} AS (
  SELECT vec_id, v, arg_min(cluster, (list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(v, c)]), cluster)) AS cluster
  FROM rows, c{i - 1} GROUP BY vec_id, v
), m{i} AS (
  SELECT cluster, d, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x
  FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, {DIMENSIONS + 1})) AS d FROM a{i}) GROUP BY cluster, d
), n{i} AS (
  SELECT cluster, list(x ORDER BY d) AS c FROM m{i} GROUP BY cluster
), c{i} AS (
  SELECT old.cluster, coalesce(n{i}.c, old.c) AS c FROM c{i - 1} AS old LEFT JOIN n{i} USING (cluster)
),"""


SQL = f"""
WITH rows AS MATERIALIZED (
  SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS cluster, v AS c
  FROM rows ORDER BY sha256('{SEED}:' || vec_id) LIMIT {CENTROIDS}
),{"".join(_round(i) for i in range(1, ROUNDS + 1))} far AS (
  SELECT vec_id, cluster, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(v, c)]) AS distance
  FROM rows, c{ROUNDS}
), last AS (
  SELECT vec_id, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM far GROUP BY vec_id
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM last JOIN c{ROUNDS} USING (cluster)
"""
