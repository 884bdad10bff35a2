"""Centroid clustering over a zone map along the Hilbert curve.

Vectors become whole numbers, are sorted along a Hilbert curve and packed into blocks, each with the box of its
least and largest components. In a round, the box's distance bounds say which centroids can be nearest for any of the block's
vectors; only those are compared with the vectors, in whole numbers. Blocks are written once and read in each round;
what meets the driver in a round is a sum for each centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.scratch import settle

#: Vectors of a block, and bits of a component that the curve goes by.
BLOCK, CURVE_BITS = 256, 4
#: Components beyond this are taken for it, so that squared distances of up to 128 components fit 64 bits.
BOUND = 1 << 27
_LONG_MAX = (1 << 63) - 1


def whole_vector(vector: Column, dims: int, scale: int) -> Column:
    """floor(scale * x) of each component as a long, or null for vectors of another length or with a null or non-finite component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    clamped = lambda x: F.floor(F.least(F.greatest(F.lit(float(scale)) * x.cast("double"), F.lit(float(-BOUND))), F.lit(float(BOUND)))).cast("long")
    return F.when((F.size(vector) == dims) & ~F.exists(vector, bad), F.transform(vector, clamped))


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """The place of each row of ``cells`` (whole numbers below 2**bits) along the Hilbert curve, as bytes that sort alike."""
    x = cells.astype(np.int64)
    dims = x.shape[1]
    for level in range(bits - 1, 0, -1):
        high, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            turned = (x[:, i] & high) != 0
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, i] ^= swap
            x[:, 0] ^= np.where(turned, low, swap)
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip[:, None]
    planes = (x[:, None, :] >> np.arange(bits - 1, -1, -1)[None, :, None]) & 1
    return [row.tobytes() for row in np.packbits(planes.reshape(len(x), -1).astype(np.uint8), axis=1)]


def nearest(vectors: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector of a block with the box from ``low`` to ``high``: the number of the nearest centroid (of several, the smallest)
    and its squared distance."""
    inside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    outside = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    # A centroid goes if the box's nearest point is farther from it than the farthest point is from another.
    candidates = np.flatnonzero((inside**2).sum(axis=1) <= (outside**2).sum(axis=1).min())
    distances = np.stack([((vectors - centroids[c]) ** 2).sum(axis=1) for c in candidates], axis=1)
    best = distances.argmin(axis=1)
    return candidates[best], distances[np.arange(len(vectors)), best]


def zone_map(vectors: DataFrame, id_col: str, dims: int, block: int = BLOCK) -> DataFrame:
    """Blocks of the whole-number vectors ``v`` along the curve: ``ids``, and as 32-bit numbers ``vectors``, ``low`` and ``high``."""
    span = vectors.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    least, width = span[0] or 0, (span[1] or 0) - (span[0] or 0) + 1

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column("v").flatten().to_numpy().reshape(-1, dims)
            keys = hilbert_keys(((v - least) << CURVE_BITS) // width, CURVE_BITS)
            rows = [r.tobytes() for r in v.astype("<i4")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.binary()), pa.array(keys, pa.binary())], names=["id", "v", "key"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        rows: list[bytes] = []

        def one() -> pa.RecordBatch:
            v = np.frombuffer(b"".join(rows[:block]), "<i4").reshape(-1, dims)
            made = {"ids": [ids[:block]], "vectors": [v.tobytes()], "low": [v.min(axis=0).tobytes()], "high": [v.max(axis=0).tobytes()]}
            del ids[:block], rows[:block]
            return pa.RecordBatch.from_pydict(made, pa.schema([("ids", pa.list_(pa.int64())), ("vectors", pa.binary()), ("low", pa.binary()), ("high", pa.binary())]))

        for batch in batches:
            ids += batch.column("id").to_pylist()
            rows += batch.column("v").to_pylist()
            while len(rows) >= block:
                yield one()
        if rows:
            yield one()

    named = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), "v")
    keys = named.mapInArrow(keyed, "id long, v binary, key binary")
    # The last column deals out copies of one vector, of which a third of all rows may be.
    dealt = keys.withColumn("spread", F.monotonically_increasing_id())
    along = dealt.repartitionByRange("key", "id", "spread").sortWithinPartitions("key", "id", "spread")
    return settle(along.mapInArrow(packed, "ids array<long>, vectors binary, low binary, high binary"))


def _blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    for k in range(batch.num_rows):
        v, low, high = (np.frombuffer(batch.column(c)[k].as_py(), "<i4").astype(np.int64) for c in ("vectors", "low", "high"))
        yield batch.column("ids")[k].values, v.reshape(-1, dims), low, high


def _moved(blocks: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """The centroids after one round: the floor of each cluster's mean, or as they were without vectors."""
    at = np.array(centroids, np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(at.shape, np.int64), np.zeros(len(at), np.int64)
        for batch in batches:
            for _, v, low, high in _blocks(batch, dims):
                cluster, _ = nearest(v, low, high, at)
                for c in np.unique(cluster):
                    mine = v[cluster == c]
                    sums[c] += mine.sum(axis=0)
                    counts[c] += len(mine)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen]), pa.array(sums[seen].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = blocks.mapInArrow(work, "cluster long, n long, sums array<long>")
    wide = parts.select("cluster", "n", F.posexplode("sums").alias("pos", "part"))
    totals = wide.groupBy("cluster", "pos").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    moved = [list(c) for c in centroids]
    for r in totals.collect():
        moved[r["cluster"]][r["pos"]] = int(r["total"]) // r["n"]
    return moved


def cluster_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, block: int = BLOCK
) -> DataFrame:
    """One row for each vector of ``dims`` finite components: ``vec_id``, ``cluster`` (the nearest of ``k`` centroids after ``rounds`` rounds; of several, the
    smallest), ``distance`` (squared, between vectors of floor(scale * x)), ``cluster_inertia`` and ``inertia`` (its sums over
    the cluster and all) and ``centroid_sha256`` (of the final centroid's components, joined by commas).

    Centroids start as the vectors with the smallest sha256 of ``seed:id``, null ids last, and a vector before a larger one of the
    same id. Vectors that are null, of another length or with a null or non-finite component are left out; repeated rows
    and ids count each. With fewer than ``k`` vectors there are as many centroids; an empty table has no rows. Components beyond 2**27 after scaling
    are taken for that bound, and inertias for the largest long.
    """
    kept = settle(vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), whole_vector(F.col(f"`{vector_col}`"), dims, scale).alias("v")).where("v IS NOT NULL"))
    named = kept.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256))
    centroids = [list(r["v"]) for r in named.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()]
    blocks = zone_map(kept, "vec_id", dims, block)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(blocks, centroids, dims)
    at = np.array(centroids, np.int64).reshape(-1, dims)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, v, low, high in _blocks(batch, dims):
                cluster, distance = nearest(v, low, high, at)
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    assigned = settle(blocks.mapInArrow(work, "vec_id long, cluster int, distance long"))
    totals = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    inertias = {r["cluster"]: int(r["s"]) for r in totals.collect()}
    of_cluster = F.array(*[F.lit(min(inertias.get(c, 0), _LONG_MAX)).cast("long") for c in range(max(1, len(at)))])
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids] or [""]
    number = F.col("cluster") + 1
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        F.element_at(of_cluster, number).alias("cluster_inertia"),
        F.lit(min(sum(inertias.values()), _LONG_MAX)).cast("long").alias("inertia"),
        F.element_at(F.array(*[F.lit(d) for d in digests]), number).alias("centroid_sha256"),
    )
