"""Centroid clustering of integer vectors by bit-plane popcounts.

Method: a vector of 64 components, each turned into the integer floor(scale * x), is kept as bit planes: plane j packs
bit j of all components into one 64-bit word (two's complement, so the last plane's weight is negative). With centroids
in the same form, the sum over planes i, j of weight(i) * weight(j) * popcount(vector plane i AND centroid plane j) is the exact
dot product, and with the squared lengths the exact squared distance. Sums of a cluster's components are its planes' bit counts
by position, weighted alike. Nothing is rounded, so results don't depend on the order of rows or on partitions.

Each of the rounds is one pass over the staged planes; a task hands on at most one row a centroid, Spark adds these up, and
the driver holds the centroids only (``k`` x 64 integers), which go to the tasks with the job.

Defined results: rows whose vector isn't of exactly 64 non-null finite components are left out; every other row is a vector, repeated
rows included. Initial centroids are the first vectors by the hash of (seed, id), ties by the components; with fewer vectors
than centroids there are as many centroids as vectors. A null id hashes as the empty string and comes back as null. A component
beyond 2^27 after scaling, whose squared distances may not fit 64 bits, is an error. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage

WIDTH = 64
LIMIT = 1 << 27
SCALE = 1024
SEED = 3


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as an array of longs; null where the vector isn't kept."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ints = F.transform(vector, lambda x: F.when(F.abs(x.cast("double") * scale) < LIMIT, F.floor(x.cast("double") * scale)).otherwise(
        F.raise_error(F.lit(f"a component is beyond {LIMIT} after scaling")).cast("long")))
    return F.when((F.size(vector) == WIDTH) & good, ints)


def bit_planes(ints: np.ndarray, bits: int) -> np.ndarray:
    """(n, 64) integers -> (n, bits) planes."""
    out = np.empty((len(ints), bits), np.uint64)
    for j in range(bits):
        out[:, j] = np.packbits((ints >> j & 1).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def plane_weights(bits: int) -> np.ndarray:
    weights = np.int64(1) << np.arange(bits, dtype=np.int64)
    weights[-1] = -weights[-1]
    return weights


def dot_products(planes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(n, bits) and (k, bits) planes -> (n, k) exact dot products."""
    weights = plane_weights(planes.shape[1])
    out = np.zeros((len(planes), len(centroids)), np.int64)
    columns = [np.ascontiguousarray(planes[:, i]) for i in range(planes.shape[1])]
    for k, centroid in enumerate(centroids):
        for w, plane in zip(weights, centroid, strict=True):
            if plane:
                for v, column in zip(weights, columns, strict=True):
                    out[:, k] += w * v * np.bitwise_count(column & plane)
    return out


def nearest(planes: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector; of equally near centroids the first. ``centroids``: (k, 64) integers."""
    dist = norms[:, None] - 2 * dot_products(planes, bit_planes(centroids, planes.shape[1])) + (centroids * centroids).sum(axis=1)
    cluster = dist.argmin(axis=1)
    return cluster, dist[np.arange(len(dist)), cluster]


def plane_sums(planes: np.ndarray) -> np.ndarray:
    """Component sums of the vectors, from the number of set bits in each plane and position."""
    bits = np.unpackbits(planes.view(np.uint8).reshape(len(planes), -1, 8), axis=2, bitorder="little")
    return plane_weights(planes.shape[1]) @ bits.sum(axis=0, dtype=np.int64)


def _read(batch: pa.RecordBatch, bits: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(b"".join(batch.column("planes").to_pylist()), np.uint64).reshape(-1, bits)
    return planes, batch.column("norm").to_numpy(zero_copy_only=False)


def pack_vectors(vectors: DataFrame, bits: int) -> DataFrame:
    """(vec_id, ints) -> (vec_id, planes, norm)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = batch.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            planes = bit_planes(ints, bits)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([p.tobytes() for p in planes], pa.binary()),
                                              pa.array((ints * ints).sum(axis=1))], names=["vec_id", "planes", "norm"])

    return vectors.mapInArrow(run, "vec_id long, planes binary, norm long")


def _cluster_sums(packed: DataFrame, centroids: np.ndarray, bits: int) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (vectors, component sums), of at most as many rows as there are centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), WIDTH), np.int64)
        for batch in batches:
            planes, norms = _read(batch, bits)
            cluster, _ = nearest(planes, norms, centroids)
            for k in np.unique(cluster):
                mine = np.ascontiguousarray(planes[cluster == k])
                n[k] += len(mine)
                sums[k] += plane_sums(mine)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(n[has]), pa.array(list(sums[has]), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "sums"])

    parts = packed.mapInArrow(run, "cluster int, n long, sums array<long>")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(WIDTH)])
    return {r["cluster"]: (r["n"], [r[f"s{i}"] for i in range(WIDTH)]) for r in total.collect()}


def _assigned(packed: DataFrame, centroids: np.ndarray, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = nearest(*_read(batch, bits), centroids)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    return packed.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, k: int, rounds: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
                    seed: int = SEED) -> tuple[DataFrame, Sequence[Sequence[int]]]:
    """((vec_id, cluster, distance) for each kept vector, the final centroids)."""
    kept = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), quantised(F.col(f"`{vector_col}`"), scale).alias("ints")).where("ints IS NOT NULL")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    span = kept.agg(F.max(F.array_max("ints")).alias("high"), F.min(F.array_min("ints")).alias("low")).first()
    bits = max((span["high"] or 0), -(span["low"] or 0) - 1).bit_length() + 1
    packed = stage(pack_vectors(kept, bits), "planes")
    first = kept.select(order.alias("hash"), "ints").orderBy("hash", "ints").limit(k).collect()  # k rows
    centroids = np.array([r["ints"] for r in first], np.int64).reshape(-1, WIDTH)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), []
    for _ in range(rounds):
        found = _cluster_sums(packed, centroids, bits)
        moved = centroids.copy()
        for cluster, (n, sums) in found.items():
            moved[cluster] = [s // n for s in sums]
        if (moved == centroids).all():
            break  # further rounds repeat this one
        centroids = moved
    return stage(_assigned(packed, centroids, bits), "clusters"), centroids.tolist()


def with_inertia(assigned: DataFrame, centroids: Sequence[Sequence[int]]) -> DataFrame:
    """``assigned`` with the summed distances of each cluster and of all, and a hash of each final centroid."""
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row a centroid
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    own = F.lit(None).cast("long")
    sha = F.lit(None).cast("string")
    for cluster, name in enumerate(names):
        own = F.when(F.col("cluster") == cluster, F.lit(sums.get(cluster, 0)).cast("long")).otherwise(own)
        sha = F.when(F.col("cluster") == cluster, F.lit(name)).otherwise(sha)
    return assigned.select("vec_id", "cluster", "distance", own.alias("cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia"),
                           sha.alias("centroid_sha256"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(*cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=8, rounds=10))


def _round_sql(i: int) -> str:
    """Assignment to the centroids c<i> and their successors."""
    return f"""
a{i} AS MATERIALIZED (SELECT vec_id, k, d FROM (SELECT vec_id, k, sum((v.x - c.x) * (v.x - c.x)) AS d, row_number() OVER
       (PARTITION BY vec_id ORDER BY sum((v.x - c.x) * (v.x - c.x)), k) AS r FROM v JOIN c{i} c USING (p) GROUP BY vec_id, k) WHERE r = 1),
m{i} AS (SELECT k, p, sum(x) AS s, count(*) AS n FROM a{i} JOIN v USING (vec_id) GROUP BY k, p),
c{i + 1} AS MATERIALIZED (SELECT k, p, CAST(CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x
       FROM c{i} LEFT JOIN m{i} USING (k, p))"""


OP13_SQL = f"""
WITH e AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS p, CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM e),
h AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM e),
c0 AS MATERIALIZED (SELECT k, p, x FROM h JOIN v USING (vec_id) WHERE k < 8),{",".join(_round_sql(i) for i in range(10))},
z AS MATERIALIZED (SELECT vec_id, k, d FROM (SELECT vec_id, k, sum((v.x - c.x) * (v.x - c.x)) AS d, row_number() OVER
       (PARTITION BY vec_id ORDER BY sum((v.x - c.x) * (v.x - c.x)), k) AS r FROM v JOIN c10 c USING (p) GROUP BY vec_id, k) WHERE r = 1),
n AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p)) AS centroid_sha256 FROM c10 GROUP BY k)
SELECT vec_id, CAST(k AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM z JOIN n USING (k)
"""
