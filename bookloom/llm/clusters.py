"""Clustering around centroids, in exact integers, over Hilbert-ordered blocks with bounding boxes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.llm.common import col, stored

LARGEST = 1 << 27  # components beyond this count as this, so that a squared distance fits 63 bits
EXACT_FLOAT = 1 << 22  # up to this, squared distances are exact in doubles


@dataclass(frozen=True)
class Clusters:
    assigned: DataFrame  # vec_id, cluster, distance
    centroids: np.ndarray  # one row of integers per cluster


def integer_vectors(rows: DataFrame, size: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows whose vector has `size` components, none null or non-finite; v holds floor(scale * x)."""
    vector = col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    bound = F.lit(float(LARGEST))
    return rows.select(col(id_col).cast("long").alias("vec_id"), F.when((F.size(vector) == size) & finite, vector).alias("e")).where(
        "e IS NOT NULL").select("vec_id", F.transform("e", lambda x: F.floor(
            F.greatest(-bound, F.least(bound, x.cast("double") * scale))).cast("int")).alias("v"))


def first_centroids(vectors: DataFrame, n: int, most: int, seed: int) -> np.ndarray:
    """The `most` vectors whose sha256 of `seed:vec_id` comes first, in that order (equal hashes: smaller vector first).

    Sorting all would make every task offer `most` rows. A bound on the hash first leaves about twice as many as asked;
    should it leave too few, all are sorted, with the same result.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    bound = min((1 << 256) - 1, (most << 257) // max(1, n))
    keyed = vectors.select(key.alias("key"), "v")
    near = keyed.where(F.col("key") <= f"{bound:064x}")
    enough = near if near.count() >= min(most, n) else keyed
    return np.array([r["v"] for r in enough.orderBy("key", "v").limit(most).collect()], np.int64)


def extent(vectors: DataFrame, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of vectors, smallest and largest component of each dimension: one row per task and dimension is shuffled."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.full(size, LARGEST), np.full(size, -LARGEST)
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(0), size)
                n, low, high = n + len(rows), np.minimum(low, rows.min(axis=0)), np.maximum(high, rows.max(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size, dtype=np.int32)), pa.array(np.full(size, n)), pa.array(low), pa.array(high)], ["place", "n", "low", "high"])

    found = vectors.select("v").mapInArrow(measure, "place int, n long, low long, high long").groupBy("place").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("place").collect()
    if not found:
        return 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
    return found[0]["n"], np.array([r["low"] for r in found], np.int64), np.array([r["high"] for r in found], np.int64)


def hilbert_keys(vectors: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve through the box from low to high, as rows of bytes that sort like the places.

    Each component becomes one of 2**bits steps. Skilling's transformation turns the steps of all components into the
    bits of the place, for all vectors at once.
    """
    n, dims = vectors.shape
    width = np.maximum(high - low, 1)
    x = ((vectors - low) * ((1 << bits) - 1) // width).astype(np.int64).clip(0, (1 << bits) - 1).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(turned, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    planes = [(x >> b & 1).T for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)


def hilbert_blocks(vectors: DataFrame, low: np.ndarray, high: np.ndarray, bits: int = 4, block: int = 1024) -> DataFrame:
    """Blocks of up to `block` vectors that lie next to each other on the curve: (ids, vectors as packed 32-bit values,
    box: smallest and largest component of each dimension, packed).

    Rows are dealt out by ranges of (place, id, spread), so that even a vector that a third of all rows share spreads
    over many tasks. Written once; each round reads the blocks.
    """
    size = len(low)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                packed = _matrix(batch.column(1), size)
                places = hilbert_keys(packed.astype(np.int64), low, high, bits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), _rows(packed.astype(np.int32)), _rows(places)], ["vec_id", "packed", "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _regrouped(batches, block):
            rows = _unpacked(batch.column(1), size)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), batch.column(0)), pa.array([rows.tobytes()], pa.binary()),
                 pa.array([np.stack([rows.min(axis=0), rows.max(axis=0)]).tobytes()], pa.binary())], ["ids", "packed", "box"])

    keyed = vectors.mapInArrow(key, "vec_id long, packed binary, place binary").withColumn("spread", F.monotonically_increasing_id())
    return (keyed.repartitionByRange("place", "vec_id", "spread").sortWithinPartitions("place", "vec_id").select("vec_id", "packed")
            .mapInArrow(cut, "ids array<long>, packed binary, box binary"))


def candidates(box: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids that can be nearest to some point of the box (or as near): those whose distance to the box is at most
    the least, over the centroids, of the distance to its farthest corner."""
    low, high = box
    below, above = np.maximum(low - centroids, 0), np.maximum(centroids - high, 0)
    nearest = ((below + above) ** 2).sum(axis=1)
    farthest = (np.maximum(np.abs(centroids - low), np.abs(centroids - high)) ** 2).sum(axis=1)
    return np.flatnonzero(nearest <= farthest.min())


def nearest(rows: np.ndarray, box: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster (ties: the smaller number) and squared distance of every row of a block."""
    chosen = candidates(box, centroids)
    few = centroids[chosen]
    if max(np.abs(box).max(), np.abs(few).max()) <= EXACT_FLOAT:
        x, c = rows.astype(np.float64), few.astype(np.float64)
        distance = ((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * (x @ c.T)).astype(np.int64)
    else:
        distance = np.stack([((rows - c) ** 2).sum(axis=1) for c in few], axis=1)
    best = distance.argmin(axis=1)
    return chosen[best], distance[np.arange(len(rows)), best]


def cluster(
    rows: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2, id_col: str = "vec_id",
    vector_col: str = "embedding", bits: int = 4, block: int = 1024,
) -> Clusters:
    """Lloyd's rounds in integers from the `k` vectors that come first by hash, then a last assignment.

    A round assigns each vector to the nearest centroid (ties: the smaller number) and moves each centroid that has
    vectors to the floor of their mean; rounds that no longer move one are left out, as they change nothing. Vectors of
    another size, or with a null or non-finite component, are left out; null vectors too. A null id counts as the empty
    text in the hash and stays null in the result; repeated rows count each; fewer than k vectors give fewer clusters;
    an empty table gives no rows. Other columns are not looked at. Components beyond 2**27 in size count as 2**27.

    The driver holds the centroids and one sum per component of them, nothing that grows with the rows. Each task
    adds up its blocks before anything is shuffled.
    """
    vectors = integer_vectors(rows, size, scale, id_col, vector_col)
    n, low, high = extent(vectors, size)
    spark = rows.sparkSession
    if not n:
        return Clusters(spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, size), np.int64))
    centroids = first_centroids(vectors, n, k, seed)
    blocks = stored(hilbert_blocks(vectors, low, high, bits, block), "blocks")
    for _ in range(rounds):
        moved = _moved(blocks, centroids)
        if (moved == centroids).all():
            break
        centroids = moved
    return Clusters(_assigned(blocks, centroids), centroids)


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact sums per task, added up as decimals, floors of the means."""
    k, size = centroids.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for _, rows, box in _blocks_of(batches, size):
            label, _ = nearest(rows, box, centroids)
            order = np.argsort(label, kind="stable")
            present, starts = np.unique(label[order], return_index=True)
            sums[present] += np.add.reduceat(rows[order], starts, axis=0)
            counts += np.bincount(label, minlength=k)
        # one row per cluster and component, and the count as component -1
        full = np.flatnonzero(counts)
        values = np.concatenate([counts[full][:, None], sums[full]], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(full, size + 1).astype(np.int32)), pa.array(np.tile(np.arange(-1, size, dtype=np.int32), len(full))),
             pa.array(values.ravel())], ["cluster", "place", "total"])

    found = blocks.select("packed", "box").mapInArrow(add_up, "cluster int, place int, total long").groupBy("cluster", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    counts = {r["cluster"]: int(r["total"]) for r in found if r["place"] < 0}
    moved = centroids.copy()
    for r in found:
        if r["place"] >= 0:
            moved[r["cluster"], r["place"]] = int(r["total"]) // counts[r["cluster"]]
    return moved


def _assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    size = centroids.shape[1]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows, box in _blocks_of(batches, size, with_ids=True):
            found, distance = nearest(rows, box, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(found.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return blocks.select("packed", "box", "ids").mapInArrow(label, "vec_id long, cluster int, distance long")


def _blocks_of(batches: Iterator[pa.RecordBatch], size: int, with_ids: bool = False) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            rows = np.frombuffer(batch.column(0)[i].as_py(), np.int32).reshape(-1, size).astype(np.int64)
            box = np.frombuffer(batch.column(1)[i].as_py(), np.int32).reshape(2, size).astype(np.int64)
            yield batch.column(2)[i].values if with_ids else None, rows, box


def _matrix(lists: pa.ListArray, size: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _rows(matrix: np.ndarray) -> pa.Array:
    """Each row of a matrix as a binary value."""
    width = matrix.shape[1] * matrix.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(matrix), [None, pa.py_buffer(np.ascontiguousarray(matrix).tobytes())]).cast(pa.binary())


def _unpacked(values: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), np.int32).reshape(-1, size)


def _regrouped(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of `rows`, the last one of a task smaller."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows - size)
            held.append(part)
            at, size = at + part.num_rows, size + part.num_rows
            if size == rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def digits(centroid: np.ndarray) -> str:
    """A centroid's components as decimal integers joined by commas."""
    return ",".join(map(str, centroid.tolist()))


def with_inertia(found: Clusters) -> DataFrame:
    """The assignment with cluster_inertia and inertia (sums of distances, null if they don't fit a long) and each final
    centroid's components. Written once, as both the sums and the rows need it. The joined side has one row per cluster."""
    assigned = stored(found.assigned, "assigned")
    sums = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    top = (1 << 63) - 1
    total = sum(sums.values())
    rows = [(c, s if s <= top else None, total if total <= top else None, digits(found.centroids[c])) for c, s in sorted(sums.items())]
    per_cluster = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid string")
    return assigned.join(F.broadcast(per_cluster), "cluster")


def candidate_share(blocks: DataFrame, centroids: np.ndarray) -> float:
    """The share of (block, centroid) pairs that the boxes leave to be compared."""
    size = centroids.shape[1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [len(candidates(box, centroids)) for _, _, box in _blocks_of(batches, size)]
        yield pa.RecordBatch.from_arrays([pa.array([len(found)], pa.int64()), pa.array([sum(found)], pa.int64())], ["blocks", "pairs"])

    n, pairs = blocks.select("packed", "box").mapInArrow(count, "blocks long, pairs long").agg(F.sum("blocks"), F.sum("pairs")).first()
    return pairs / (n * len(centroids)) if n else math.nan
