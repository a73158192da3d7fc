"""Centroid clustering of integer vectors by popcounts of their bit planes.

A vector of 64 components is floored to integers and shifted so that none is
below zero. Bit i of all its components makes plane i, one 64-bit word. The dot
product of two vectors is the sum over pairs of planes of 2^(i+j) times the
number of bits set in both, so dot products and squared distances are exact
integers (distances don't change by the shift). Each round is one job over the
packed planes: a task counts, for each cluster and plane, how often each
component's bit is set in the cluster's vectors, and these counts are added up
in a shuffle of (clusters x planes) rows a task. The driver holds centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from hestia.llm.common import fresh_path

#: Components of a vector: bits of a plane.
DIMS = 64
#: Vectors compared at a time.
BLOCK = 8192
_LONG = (-(1 << 63), (1 << 63) - 1)


def floored(x: float, scale: int) -> int:
    """floor(scale * x) for a scale that is a power of two, exact for any finite double."""
    return int(np.floor(x * scale)) if abs(x) < 2**52 else int(x) * scale


def planes_of(u: np.ndarray, planes: int) -> np.ndarray:
    """(n, planes) words of the non-negative integers ``u`` of shape (n, 64); bit d of word i is bit i of component d."""
    out = np.empty((len(u), planes), np.uint64)
    for i in range(planes):
        bits = ((u >> i) & 1).astype(np.uint8)
        out[:, i] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _weights(planes: int) -> np.ndarray:
    """2^i for each plane; Python's integers where a sum of 64 products could leave 62 bits."""
    return np.array([1 << i for i in range(planes)], np.int64 if 2 * planes + 6 <= 62 else object)


def dots(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products (n, k) of the packed vectors ``v`` with the packed centroids ``c``."""
    w = _weights(v.shape[1])
    out = np.zeros((len(v), len(c)), w.dtype)
    for k, centroid in enumerate(c):
        for j, word in enumerate(centroid):
            if word:
                out[:, k] += (np.bitwise_count(v & word).astype(w.dtype) @ w) * w[j]
    return out


def squares(v: np.ndarray) -> np.ndarray:
    """Exact squared lengths of the packed vectors."""
    w = _weights(v.shape[1])
    out = np.zeros(len(v), w.dtype)
    for j in range(v.shape[1]):
        out += (np.bitwise_count(v & v[:, j : j + 1]).astype(w.dtype) @ w) * w[j]
    return out


def distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (n, k)."""
    return squares(v)[:, None] - 2 * dots(v, c) + squares(c)[None, :]


def nearest(v: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (of equals the smaller number) and the squared distance."""
    d = distances(v, c)
    best = np.argmin(d, axis=1)
    return best, d[np.arange(len(v)), best]


def bit_counts(v: np.ndarray) -> np.ndarray:
    """(planes, 64): how many of the packed vectors have each bit set."""
    bits = np.unpackbits(v.view(np.uint8).reshape(len(v), v.shape[1], 8), axis=2, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def _words(column: pa.Array, planes: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat, np.int64).view(np.uint64).reshape(len(column), planes)


def kept(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has exactly 64 components, none null or non-finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(vector).isNotNull() & (F.size(vector) == DIMS)).where(fine)


class Packed:
    """The packed vectors (``__planes``, array of longs) with their kept columns, in the shared folder; ``low`` was taken off each component."""

    def __init__(self, rows: DataFrame, low: int, planes: int):
        self.rows, self.low, self.planes = rows, low, planes


def pack(df: DataFrame, *, vector: str = "embedding", scale: int = 1024, keep: Sequence[str] = ()) -> Packed | None:
    """Writes the planes of all kept vectors; None where there are none."""
    rows = kept(df.withColumn("__vector", F.col(vector).cast("array<double>")), "__vector").select(*keep, "__vector")
    lo, hi = rows.agg(F.min(F.array_min("__vector")), F.max(F.array_max("__vector"))).first()
    if lo is None:
        return None
    low, high = floored(lo, scale), floored(hi, scale)
    planes = max(1, (high - low).bit_length())
    small = max(abs(low), abs(high)) < 2**52

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                *rest, vectors = part.columns
                x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMS)
                if small:
                    u = np.floor(x * scale).astype(np.int64) - low
                else:
                    u = np.array([[floored(y, scale) - low for y in row] for row in x.tolist()], object)
                words = planes_of(u, planes).view(np.int64).reshape(-1)
                ends = np.arange(0, len(words) + 1, planes, dtype=np.int32)
                made = pa.ListArray.from_arrays(pa.array(ends), pa.array(words))
                yield pa.RecordBatch.from_arrays([*rest, made], names=[*batch.schema.names[:-1], "__planes"])

    schema = StructType([*rows.schema.fields[:-1], StructField("__planes", ArrayType(LongType()))])
    path = fresh_path(df.sparkSession, "planes")
    rows.mapInArrow(run, schema).write.parquet(path)
    return Packed(df.sparkSession.read.parquet(path), low, planes)


def _centroid_words(centroids: list[list[int]], planes: int) -> np.ndarray:
    return planes_of(np.array(centroids, object), planes)


def means(packed: Packed, centroids: list[list[int]]) -> list[list[int]]:
    """The floored mean of the vectors nearest to each centroid; a centroid without any stays."""
    planes, c = packed.planes, _centroid_words(centroids, packed.planes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(c), planes, DIMS), np.int64)
        rows = np.zeros(len(c), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                v = _words(batch.column(0).slice(at, BLOCK), planes)
                best, _ = nearest(v, c)
                for k in np.unique(best):
                    total[k] += bit_counts(np.ascontiguousarray(v[best == k]))
                rows += np.bincount(best, minlength=len(c))
        for k in np.flatnonzero(rows):
            counts = pa.ListArray.from_arrays(pa.array(np.arange(0, planes * DIMS + 1, DIMS, dtype=np.int32)), pa.array(total[k].reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(k)] * planes, pa.int32()), pa.array(range(planes), pa.int32()), pa.array([int(rows[k])] * planes, pa.int64()), counts],
                names=["k", "plane", "n", "counts"],
            )

    counted = packed.rows.select("__planes").mapInArrow(run, "k int, plane int, n long, counts array<long>")
    sums = F.array(*[F.sum(F.get("counts", F.lit(d))) for d in range(DIMS)]).alias("counts")
    found = counted.groupBy("k", "plane").agg(F.sum("n").alias("n"), sums).collect()
    added: dict[int, list[int]] = {}
    size = {r.k: r.n for r in found}
    for r in found:
        now = added.setdefault(r.k, [0] * DIMS)
        for d, x in enumerate(r.counts):
            now[d] += x << r.plane
    return [[x // size[k] for x in added[k]] if k in added else old for k, old in enumerate(centroids)]


def assigned(packed: Packed, centroids: list[list[int]], keep: Sequence[str]) -> DataFrame:
    """``keep``, the number of the nearest centroid and the squared distance (null beyond a long)."""
    planes, c = packed.planes, _centroid_words(centroids, packed.planes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                *rest, words = part.columns
                best, d = nearest(_words(words, planes), c)
                far = pa.array([x if x <= _LONG[1] else None for x in map(int, d)], pa.int64())
                yield pa.RecordBatch.from_arrays([*rest, pa.array(best.astype(np.int32)), far], names=[*batch.schema.names[:-1], "cluster", "distance"])

    chosen = packed.rows.select(*keep, "__planes")
    return chosen.mapInArrow(run, StructType([*chosen.schema.fields[:-1], *StructType.fromDDL("cluster int, distance long").fields]))


def cluster(
    df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", clusters: int = 8, rounds: int = 10, scale: int = 1024, salt: str = "3:"
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid (its components, comma-joined), centroid_sha256 for each vector of 64 finite components.

    The first centroids are the vectors of the smallest SHA-256 of ``salt`` and
    their id, in that order (those with a null id come last; of equal ids the
    one of the lesser planes); a round assigns all vectors and moves each
    centroid to the floored mean of its own. Rounds end early only where no
    centroid moves, as then none ever would.

    Vectors that are null, of another length, or hold a null, NaN or infinite
    component are left out. Repeated rows are returned each; fewer vectors than
    clusters give fewer clusters; without any the result is empty. Distances
    and inertias beyond a long are null, the clusters exact all the same. Only
    the two columns named are read.
    """
    spark = df.sparkSession
    chosen = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("__embedding"))
    packed = pack(chosen, vector="__embedding", scale=scale, keep=["vec_id"])
    fields = "cluster int, distance long, cluster_inertia long, inertia long, centroid string, centroid_sha256 string"
    if packed is None:
        return spark.createDataFrame([], StructType([*chosen.schema.fields[:1], *StructType.fromDDL(fields).fields]))
    order = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = packed.rows.orderBy(order.asc_nulls_last(), "__planes").limit(clusters).collect()
    unpacked = lambda words: [sum(((w >> d) & 1) << i for i, w in enumerate(words)) for d in range(DIMS)]
    centroids = [unpacked(r["__planes"]) for r in first]
    for _ in range(rounds):
        moved = means(packed, centroids)
        if moved == centroids:
            break
        centroids = moved
    path = fresh_path(spark, "clusters")
    assigned(packed, centroids, ["vec_id"]).write.parquet(path)
    found = spark.read.parquet(path)
    whole = F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)")))
    # A row for each cluster.
    sums = {r.cluster: r.s for r in found.groupBy("cluster").agg(whole.alias("s")).collect()}
    fits = lambda x: int(x) if x is not None and x <= _LONG[1] else None
    total = fits(sum(sums.values())) if None not in sums.values() else None
    texts = [",".join(str(x + packed.low) for x in c) for c in centroids]
    rows = [(k, fits(s), total, texts[k], hashlib.sha256(texts[k].encode()).hexdigest()) for k, s in sums.items()]
    per = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid string, centroid_sha256 string")
    return found.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")
