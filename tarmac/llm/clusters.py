"""Centroid clustering of quantised vectors by bit planes and popcounts.

A component x becomes the integer floor(256 * x). A vector of 64 integers is packed into
bit planes: plane j is one uint64 whose bit i is bit j of component i in two's complement;
there are as many planes as the largest component of the table needs. With the plane
weights 2**j (negative for the sign plane) the dot product of a vector and a centroid is

    sum over planes j, k of weight[j] * weight[k] * popcount(vector[j] & centroid[k])

which is exact, and |v|^2 + |c|^2 - 2 v.c is the exact squared distance.

The packed vectors are written once and read in every round. A task assigns its vectors
and returns one row per centroid with the component sums of its vectors, so a centroid
that holds a third of all vectors costs one row per task. What reaches the driver is the
``k`` centroids of a round; they go back to the tasks with the function (``k`` x 64 bits x
planes, whatever the table's size).

Defined cases: vectors that are null, hold a null, NaN or infinite component or have
another length than 64 are left out. Components outside +-2**27 are an error, as the
distance would not fit a long. Rows with equal vec_ids are vectors of their own; among the
first centroids they are ordered by their components. A null vec_id is clustered like any
other but starts no centroid unless fewer than ``k`` ids are there. With fewer than ``k``
vectors there are as many centroids as vectors; an empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import map_arrow, table

DIM = 64
SCALE = 256
K = 40
ROUNDS = 5
SEED = 2
LARGEST_BITS = 28  # two's complement bits of a component
_BIT = np.arange(DIM, dtype=np.uint64)


def plane_weights(planes: int) -> np.ndarray:
    """Two's complement weights of the bit planes, the sign plane last."""
    w = np.int64(1) << np.arange(planes, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes (rows x planes, uint64) of rows of 64 integers."""
    out = np.empty((len(values), planes), np.uint64)
    for j in range(planes):
        out[:, j] = np.bitwise_or.reduce(((values >> j) & 1).astype(np.uint64) << _BIT, axis=1)
    return out


def unpack(packed: np.ndarray) -> np.ndarray:
    """The rows of 64 integers behind the bit planes."""
    w = plane_weights(packed.shape[1])
    out = np.zeros((len(packed), DIM), np.int64)
    for j in range(packed.shape[1]):
        out += ((packed[:, j, None] >> _BIT) & np.uint64(1)).astype(np.int64) * w[j]
    return out


def dots(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact dot products (vectors x centroids) of packed rows by weighted AND-popcounts."""
    wv, wc = plane_weights(vectors.shape[1]), plane_weights(centroids.shape[1])
    out = np.zeros((len(vectors), len(centroids)), np.int64)
    for j in range(vectors.shape[1]):
        of_plane = np.zeros_like(out)
        for k in range(centroids.shape[1]):
            both = vectors[:, j, None] & centroids[None, :, k]
            of_plane += np.bitwise_count(both).astype(np.int64) * wc[k]
        out += of_plane * wv[j]
    return out


def norms(packed: np.ndarray) -> np.ndarray:
    """Squared lengths of packed rows, by the same popcounts."""
    w = plane_weights(packed.shape[1])
    out = np.zeros(len(packed), np.int64)
    for j in range(packed.shape[1]):
        for k in range(packed.shape[1]):
            out += np.bitwise_count(packed[:, j] & packed[:, k]).astype(np.int64) * (w[j] * w[k])
    return out


def nearest(packed: np.ndarray, norm: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, squared distance) of each row; ties go to the smaller number."""
    distance = norm[:, None] + norms(centroids)[None, :] - 2 * dots(packed, centroids)
    at = np.argmin(distance, axis=1)
    return at, distance[np.arange(len(at)), at]


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id and the 64 integers ``q`` of every vector that takes part."""
    x = F.col("embedding")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    # the cast of a component that no long can hold fails; the bound below is tighter
    q = F.transform(F.col("v"), lambda v: F.floor(v * SCALE).cast("long"))
    return (vectors.select("vec_id", x.cast("array<double>").alias("v"), x.alias("embedding"))
            .filter(x.isNotNull() & (F.size(x) == DIM)).filter(whole).select("vec_id", q.alias("q")))


def planes_needed(kept: DataFrame) -> int:
    """Bits of the largest component, the sign included (0 for no rows)."""
    low, high = kept.agg(F.min(F.array_min("q")), F.max(F.array_max("q"))).first()
    if low is None:
        return 0
    planes = max(int(high).bit_length(), (-int(low) - 1).bit_length() if low < 0 else 0) + 1
    if planes > LARGEST_BITS:
        raise ValueError(f"a component of {planes} bits: distances of components beyond +-2**{LARGEST_BITS - 1} do not fit a long")
    return planes


def packed_table(spark: SparkSession, kept: DataFrame, planes: int) -> DataFrame:
    """vec_id, bit planes and squared length of every vector, written once."""
    def rows(batches):
        for batch in batches:
            values = batch.column("q").flatten().to_numpy().reshape(-1, DIM)
            bits = pack(values, planes)
            cells = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * planes), len(bits), [None, pa.py_buffer(bits.tobytes())])
            yield pa.record_batch([batch.column("vec_id"), cells.cast(pa.binary()), pa.array(norms(bits))],
                                  names=["vec_id", "planes", "norm"])

    kind = kept.schema["vec_id"].dataType.simpleString()
    return table(spark, map_arrow(kept, rows, f"vec_id {kind}, planes binary, norm long"), "planes")


def first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``, in that order (top k per task)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(key.alias("key"), "q").orderBy(F.asc_nulls_last("key"), "q").limit(k).collect()
    return [list(r.q) for r in rows]


def _read(batch: pa.RecordBatch, planes: int) -> tuple[np.ndarray, np.ndarray]:
    cells = b"".join(batch.column("planes").to_pylist())
    return np.frombuffer(cells, np.uint64).reshape(-1, planes), batch.column("norm").to_numpy()


def _sums(packed: DataFrame, centroids: np.ndarray, planes: int) -> DataFrame:
    """n and the component sums of the vectors nearest to each centroid."""
    k = len(centroids)

    def assign(batches):
        n, sums = np.zeros(k, np.int64), np.zeros((k, DIM), np.int64)
        for batch in batches:
            bits, norm = _read(batch, planes)
            at, _ = nearest(bits, norm, centroids)
            n += np.bincount(at, minlength=k)
            np.add.at(sums, at, unpack(bits))
        held = np.flatnonzero(n)
        yield pa.record_batch([pa.array(held), pa.array(n[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))],
                              names=["cluster", "n", "sums"])

    parts = map_arrow(packed, assign, "cluster long, n long, sums array<long>")
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(DIM)])


def centroid_planes(centroids: list[list[int]], planes: int) -> np.ndarray:
    return pack(np.array(centroids, np.int64).reshape(-1, DIM), planes)


def fit(packed: DataFrame, centroids: list[list[int]], planes: int, rounds: int) -> list[list[int]]:
    """The centroids after ``rounds`` rounds; an empty centroid stays where it is."""
    centroids = [list(c) for c in centroids]
    for _ in range(rounds):
        for row in _sums(packed, centroid_planes(centroids, planes), planes).collect():
            centroids[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(DIM)]
    return centroids


def assigned(packed: DataFrame, centroids: list[list[int]], planes: int) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    at_planes = centroid_planes(centroids, planes)

    def assign(batches):
        for batch in batches:
            bits, norm = _read(batch, planes)
            at, distance = nearest(bits, norm, at_planes)
            yield pa.record_batch([batch.column("vec_id"), pa.array(at.astype(np.int32)), pa.array(distance)],
                                  names=["vec_id", "cluster", "distance"])

    kind = packed.schema["vec_id"].dataType.simpleString()
    return map_arrow(packed, assign, f"vec_id {kind}, cluster int, distance long")


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(spark: SparkSession, vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    kept = quantised(vectors)
    planes = planes_needed(kept)
    if not planes:
        kind = kept.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    packed = packed_table(spark, kept, planes)
    centroids = fit(packed, first_centroids(kept, k, seed), planes, rounds)
    rows = table(spark, assigned(packed, centroids, planes), "clusters")
    per = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # a window without a key, over the at most k rows of the sums
    per = per.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))
    digests = spark.createDataFrame([(i, digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    per = per.join(F.broadcast(digests), "cluster")  # at most k rows on either side
    return rows.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
