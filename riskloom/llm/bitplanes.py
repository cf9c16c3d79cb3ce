"""Centroid clustering of whole-numbered vectors by popcounts of bit planes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize

WIDTH = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
#: Whole components are held within this distance of zero, so that every squared distance fits 64 bits.
LIMIT = 2**27 - 1
#: Vectors measured at once.
STEP = 4096


def quantised(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite components, within LIMIT."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * SCALE), -LIMIT, LIMIT).astype(np.int64)


def planes_of(whole: np.ndarray) -> np.ndarray:
    """(vectors, planes) bit planes of whole numbers in two's complement: bit c of plane p is bit p of component c.

    There are as many planes as the largest number needs and one for the sign, which is the last.
    """
    top = int(np.maximum(whole, ~whole).max(initial=0)).bit_length()
    out = np.empty((len(whole), top + 1), dtype=np.uint64)
    for p in range(top + 1):
        bits = (whole >> p & 1).astype(np.uint8)
        out[:, p] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def weights(planes: int) -> list[int]:
    """What a bit of each plane stands for; the sign plane counts down."""
    return [1 << p for p in range(planes - 1)] + [-(1 << (planes - 1))]


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products of all vectors of ``a`` with all of ``b``, both as planes: the popcounts of the planes' common
    bits, weighted by what the planes stand for."""
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    for i, x in enumerate(weights(a.shape[1])):
        for j, y in enumerate(weights(b.shape[1])):
            out += np.bitwise_count(a[:, i, None] & b[None, :, j]).astype(np.int64) * (x * y)
    return out


def norms(a: np.ndarray) -> np.ndarray:
    """Exact squared lengths."""
    out = np.zeros(len(a), dtype=np.int64)
    for i, x in enumerate(weights(a.shape[1])):
        for j, y in enumerate(weights(a.shape[1])):
            out += np.bitwise_count(a[:, i] & a[:, j]).astype(np.int64) * (x * y)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid, the smaller number at equal distance."""
    apart = norms(planes)[:, None] - 2 * dots(planes, centroids) + norms(centroids)[None, :]
    best = apart.argmin(axis=1)
    return best, apart[np.arange(len(best)), best]


def sums_of(planes: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """(k, WIDTH) sums of the vectors of each cluster, from the number of set bits in each plane."""
    member = (cluster[None, :] == np.arange(k)[:, None]).astype(np.float64)
    out = np.zeros((k, WIDTH), dtype=np.int64)
    for p, weight in enumerate(weights(planes.shape[1])):
        bits = np.unpackbits(planes[:, p].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += (member @ bits).astype(np.int64) * weight
    return out


def encoded(vectors: DataFrame) -> DataFrame:
    """vec_id and planes (binary) of the vectors with WIDTH components, all finite; the others are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), WIDTH), False))
            raw = pc.list_flatten(fit.column(1)).to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            finite = np.isfinite(raw).all(axis=1)
            whole = quantised(raw[finite])
            tops = np.maximum(whole, ~whole).max(axis=1, initial=0)
            sizes = np.frexp(tops.astype(np.float64))[1]
            ids = fit.column(0).filter(pa.array(finite))
            for size in np.unique(sizes).tolist():  # rows of equally many planes
                at = np.flatnonzero(sizes == size)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at)), pa.array([v.tobytes() for v in planes_of(whole[at])], pa.binary())],
                    ["vec_id", "planes"],
                )

    chosen = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
    return chosen.mapInArrow(run, "vec_id bigint, planes binary")


def plane_groups(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch with equally many planes, in steps: their places and planes."""
    raw = batch.column(1).to_pylist()
    sizes = np.array([len(r) for r in raw])
    for size in np.unique(sizes).tolist():
        same = np.flatnonzero(sizes == size)
        for i in range(0, len(same), STEP):
            at = same[i : i + STEP]
            yield at, np.frombuffer(b"".join([raw[k] for k in at]), dtype="<u8").reshape(len(at), -1).astype(np.uint64)


def assigned(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster and distance of every row of ``encoded``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = planes_of(np.array(centroids, dtype=np.int64))
        for batch in batches:
            for at, planes in plane_groups(batch):
                cluster, distance = nearest(planes, centres)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

    return rows.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round. Every task adds up its vectors per centroid; Spark adds up the tasks' sums."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = planes_of(np.array(centroids, dtype=np.int64))
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, WIDTH), dtype=np.int64)
        for batch in batches:
            for _, planes in plane_groups(batch):
                cluster, _ = nearest(planes, centres)
                counts += np.bincount(cluster, minlength=k)
                sums += sums_of(planes, cluster, k)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(counts[met]), pa.array(sums[met].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"],
        )

    parts = rows.mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    totals = parts.select("cluster", "n", F.posexplode("sums").alias("component", "part")).groupBy(
        "cluster", "component"
    ).agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    out = [list(c) for c in centroids]
    for row in totals.collect():  # at most CENTROIDS x WIDTH rows
        out[row.cluster][row.component] = int(row.total) // row.n
    return out


def starting(rows: DataFrame, k: int) -> list[list[int]]:
    """The k vectors whose ids have the smallest hashes, in the order of the hashes (equal ids: of the planes)."""
    name = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = rows.orderBy(F.sha2(name.cast("binary"), 256), "planes").limit(k).select("planes").collect()
    out = []
    for row in chosen:
        planes = np.frombuffer(bytes(row.planes), dtype="<u8")
        bits = np.unpackbits(planes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
        out.append((bits * np.array(weights(len(planes)))[:, None]).sum(axis=0).tolist())
    return out


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of the vectors (vec_id, embedding).

    Vectors of exactly WIDTH finite components become whole numbers floor(SCALE * x) and are stored as bit planes, one
    64-bit word for a bit of all components. All distances are sums of weighted popcounts and exact. Centroids start as
    the k vectors whose ids hash lowest (all, if there are fewer) and move to the floored means of their vectors in each
    round; one without vectors stays. Vectors never leave their tasks; only sums per task and centroid do, so a cluster
    that holds most rows costs no more than any other.

    Vectors that are null, of another length, or with null or non-finite components are left out. Whole components beyond
    LIMIT count as LIMIT. Null vec_ids are kept and hash as "1:"; repeated vec_ids are rows of their own. An inertia
    beyond a 64-bit number is null. No vector left: no rows. Other columns are ignored.
    """
    rows = materialize(encoded(vectors), "planes")
    centroids = starting(rows, k)
    if not centroids:
        return rows.selectExpr(
            "vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256"
        )
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    near = materialize(assigned(rows, centroids), "assigned")
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    wide = near.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()
    known = [
        (row.cluster, fitting(row.own), fitting(sum(r.own for r in wide)), hashes[row.cluster]) for row in wide
    ]  # at most k rows
    summary = near.sparkSession.createDataFrame(
        known, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return near.join(F.broadcast(summary), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def fitting(value) -> int | None:
    return int(value) if value < 2**63 else None
