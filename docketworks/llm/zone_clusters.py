"""Clusters of vectors around centroids, compared through zone maps along a Hilbert curve.

1. Vectors become integers, ``floor(scale * x)``, so that every sum and distance below is exact.
2. They are ordered by their place on the Hilbert curve through all dimensions and cut into blocks
   of ``BLOCK`` neighbours. A block is stored with its zone map: the smallest and largest value in
   each dimension, and the sum of its vectors.
3. A round asks the zone map which centroids can be nearest to any vector in the box. A centroid
   is out if its smallest distance to the box passes the largest distance of another, or if the
   one nearest to the middle of the box beats it in every point of it. What is left is compared with the
   vectors, all at once. Where one centroid is left, the stored sum replaces the vectors.

Centroids are few and small and travel with the tasks. A task returns sums per centroid only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketworks.llm.tables import through
from docketworks.sources.scratch import Scratch

DIMENSIONS, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
#: Bits of the curve in each dimension.
BITS = 4
BLOCK = 64
#: Largest component whose squared distances stay below 2**63, and below 2**53.
LARGEST, LARGEST_IN_DOUBLE = 1 << 27, 1 << 22

KEPT = "vec_id long, components binary, curve binary, at long"
BLOCKS = "vec_ids array<long>, vectors binary, low binary, high binary, sums binary"
SUMS = "cluster int, dimension int, total long, members long"
ASSIGNED = "vec_id long, cluster int, distance long"
RESULT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
          "centroid_sha256 string")


class ComponentTooLarge(ValueError):
    """A squared distance would not fit a 64-bit number."""


def kept(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and integer ``components`` of the vectors that are whole and finite."""
    values = F.col("embedding").cast("array<double>")
    whole = (F.size(values) == dimensions) & F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.filter(F.coalesce(whole, F.lit(False))).select(
        "vec_id", F.transform(values, lambda x: F.floor(x * F.lit(float(scale)))).alias("components")
    )


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    found = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    if len(found) and max(int(found.max()), -int(found.min())) > LARGEST:
        raise ComponentTooLarge(f"a component is beyond {LARGEST}")
    return found


def _decoded(column: pa.Array, kind, dimensions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dimensions)


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places of ``cells`` (rows x dimensions, below 2**bits) on the curve, as sortable bytes.

    Axes are turned and reflected bit by bit from the highest (Skilling 2004), for all rows at once.
    """
    axes = np.ascontiguousarray(cells.T).astype(np.uint16)
    for bit in range(bits - 1, 0, -1):
        low = np.uint16((1 << bit) - 1)
        for i in range(len(axes)):
            hit = (axes[i] >> bit & 1).astype(bool)
            swap = np.where(hit, 0, (axes[0] ^ axes[i]) & low).astype(np.uint16)
            axes[0] ^= np.where(hit, low, swap)
            if i:
                axes[i] ^= swap
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    turned = np.zeros(axes.shape[1], np.uint16)
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where(axes[-1] >> bit & 1, (1 << bit) - 1, 0).astype(np.uint16)
    axes ^= turned
    levels = [np.packbits((axes >> bit & 1).astype(np.uint8).T, axis=1) for bit in range(bits - 1, -1, -1)]
    return [row.tobytes() for row in np.concatenate(levels, axis=1)]


def bounding_box(rows: DataFrame, dimensions: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Smallest and largest value in each dimension; a row per dimension and task is shuffled."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            found = _matrix(batch.column(1), dimensions)
            lows, highs = found.min(axis=0), found.max(axis=0)
            low = lows if low is None else np.minimum(low, lows)
            high = highs if high is None else np.maximum(high, highs)
        if low is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(low), pa.array(high)],
                names=["dimension", "low", "high"])

    found = through(rows, "dimension int, low long, high long", work).groupBy("dimension").agg(
        F.min("low").alias("low"), F.max("high").alias("high")
    ).collect()
    if not found:
        return None
    found.sort(key=lambda r: r["dimension"])
    return np.array([r["low"] for r in found]), np.array([r["high"] for r in found])


def _with_curve(box: tuple[np.ndarray, np.ndarray], dimensions: int, bits: int):
    low, high = box

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _matrix(batch.column(1), dimensions)
            cells = (found - low << bits) // (high - low + 1)
            rows = found.astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary()),
                pa.array(hilbert_keys(cells, bits), pa.binary()), batch.column(2),
            ], names=["vec_id", "components", "curve", "at"])

    return work


def _cut(dimensions: int, size: int):
    """Blocks of neighbours on the curve; the rows of a task come in its order."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            vectors = _decoded(batch.column(1), np.int32, dimensions)
            rows = []
            for at in range(0, len(ids), size):
                some = vectors[at:at + size]
                rows.append((ids[at:at + size], some.tobytes(), some.min(axis=0).tobytes(),
                             some.max(axis=0).tobytes(), some.sum(axis=0, dtype=np.int64).tobytes()))
            kinds = (pa.list_(pa.int64()),) + (pa.binary(),) * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)],
                names=["vec_ids", "vectors", "low", "high", "sums"])

    return work


def stored_blocks(
    vectors: DataFrame, box: tuple[np.ndarray, np.ndarray], scratch: Scratch, dimensions: int = DIMENSIONS,
    bits: int = BITS, size: int = BLOCK,
) -> DataFrame:
    """``vectors`` (vec_id, components) in the order of the curve, a row per block.

    Rows with one place on the curve are kept apart by where they were read, so that a vector that
    a third of all rows repeat is cut like any other stretch.
    """
    numbered = vectors.select("vec_id", "components", F.monotonically_increasing_id().alias("at"))
    placed = through(numbered, KEPT, _with_curve(box, dimensions, bits))
    ordered = placed.repartitionByRange("curve", "at").sortWithinPartitions("curve", "at")
    return scratch.stage(through(ordered, BLOCKS, _cut(dimensions, size)), "blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each box (rows of ``low`` and ``high``) the centroids that some point in it may have nearest.

    Equal distances go to the smaller number, so a later centroid is out where it can at best tie.
    """
    low, high = low.astype(np.int64), high.astype(np.int64)
    near, far = [], []
    for c in centroids:
        below, above = low - c, c - high
        outside = np.maximum(np.maximum(below, above), 0)
        near.append((outside * outside).sum(axis=1))
        reach = np.maximum(np.abs(below), np.abs(above))
        far.append((reach * reach).sum(axis=1))
    near, far = np.stack(near, axis=1), np.stack(far, axis=1)
    possible = near <= far.min(axis=1, keepdims=True)
    middle = (low + high) // 2
    rivals = np.stack([((middle - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    pivot = np.where(possible, rivals, np.iinfo(np.int64).max).argmin(axis=1)
    chosen = centroids[pivot]
    for k, c in enumerate(centroids):
        # distance to the pivot less distance to c is linear in the point, so its maximum is at a corner
        lean = c - chosen
        lead = (chosen * chosen - c * c).sum(axis=1) + 2 * (np.where(lean > 0, high, low) * lean).sum(axis=1)
        possible[:, k] &= (lead > 0) | (lead == 0) & (k <= pivot)
    return possible


@dataclass(frozen=True)
class Comparison:
    """Nearest centroids of the vectors of blocks, exact."""

    centroids: np.ndarray
    in_double: bool

    def nearest(self, vectors: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest of the ``chosen`` centroids (ascending)."""
        kind = np.float64 if self.in_double else np.int64
        x, c = vectors.astype(kind), self.centroids[chosen].astype(kind)
        apart = (c * c).sum(axis=1) - 2 * (x @ c.T)
        which = apart.argmin(axis=1)
        distance = apart[np.arange(len(x)), which] + (x * x).sum(axis=1)
        return chosen[which], distance.astype(np.int64)


def _add_up(compare: Comparison, dimensions: int):
    """Sums per centroid of the vectors that have it nearest."""
    count = len(compare.centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, members = np.zeros((count, dimensions), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            low, high = (_decoded(batch.column(c), np.int32, dimensions) for c in ("low", "high"))
            possible = candidates(low, high, compare.centroids)
            sums = _decoded(batch.column("sums"), np.int64, dimensions)
            alone = possible.sum(axis=1) == 1
            only = possible.argmax(axis=1)
            sizes = batch.column("vec_ids").value_lengths().to_numpy()
            np.add.at(total, only[alone], sums[alone])
            np.add.at(members, only[alone], sizes[alone])
            rest = np.flatnonzero(~alone)
            blobs = batch.column("vectors").take(pa.array(rest)).to_pylist()
            for i, blob in zip(rest, blobs):
                vectors = np.frombuffer(blob, np.int32).reshape(-1, dimensions)
                which, _ = compare.nearest(vectors, np.flatnonzero(possible[i]))
                for k in np.unique(which):
                    mine = vectors[which == k]
                    total[k] += mine.sum(axis=0, dtype=np.int64)
                    members[k] += len(mine)
        for k in np.flatnonzero(members):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(dimensions, k, np.int32)), pa.array(np.arange(dimensions, dtype=np.int32)),
                pa.array(total[k]), pa.array(np.full(dimensions, members[k])),
            ], names=["cluster", "dimension", "total", "members"])

    return work


def _assign(compare: Comparison, dimensions: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = (_decoded(batch.column(c), np.int32, dimensions) for c in ("low", "high"))
            possible = candidates(low, high, compare.centroids)
            found = [
                compare.nearest(np.frombuffer(blob, np.int32).reshape(-1, dimensions), np.flatnonzero(p))
                for blob, p in zip(batch.column("vectors").to_pylist(), possible)
            ]
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_ids").flatten(),
                pa.array(np.concatenate([w for w, _ in found]).astype(np.int32)),
                pa.array(np.concatenate([d for _, d in found])),
            ], names=["vec_id", "cluster", "distance"])

    return work


def moved(centroids: np.ndarray, blocks: DataFrame, compare: Comparison) -> np.ndarray:
    """The centroids after a round; one row per centroid and dimension reaches the driver."""
    sums = through(blocks, SUMS, _add_up(compare, centroids.shape[1])).groupBy("cluster", "dimension").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
        F.sum(F.col("members").cast("decimal(38,0)")).alias("members"),
    )
    after = centroids.copy()
    for row in sums.collect():
        after[row["cluster"], row["dimension"]] = int(row["total"]) // int(row["members"])
    return after


def pruned_share(blocks: DataFrame, centroids: np.ndarray) -> float:
    """Share of the comparisons of a vector with a centroid that the zone maps spare."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = whole = 0
        for batch in batches:
            low, high = (_decoded(batch.column(c), np.int32, centroids.shape[1]) for c in ("low", "high"))
            sizes = batch.column("vec_ids").value_lengths().to_numpy()
            done += int((candidates(low, high, centroids).sum(axis=1) * sizes).sum())
            whole += int(sizes.sum()) * len(centroids)
        yield pa.RecordBatch.from_arrays([pa.array([done]), pa.array([whole])], names=["done", "whole"])

    done, whole = through(blocks, "done long, whole long", work).agg(F.sum("done"), F.sum("whole")).first()
    return 1 - done / whole if whole else 0.0


def first_centroids(vectors: DataFrame, count: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes; rows without an id come last."""
    digest = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    chosen = vectors.select(digest.alias("_hash"), "components").orderBy(
        F.asc_nulls_last("_hash"), "components"
    ).limit(count).collect()
    return np.array([r["components"] for r in chosen], np.int64)


def cluster(
    vectors: DataFrame, scratch: Scratch, dimensions: int = DIMENSIONS, count: int = CENTROIDS,
    rounds: int = ROUNDS, scale: int = SCALE, bits: int = BITS, block: int = BLOCK,
) -> DataFrame:
    """Cluster of every whole and finite vector of ``vectors`` (vec_id, embedding).

    Columns: ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia`` and ``inertia``
    (distances summed over the cluster and over all) and ``centroid_sha256``. Vectors that are null, of
    another length, or with a null or non-finite component are left out. Rows with a null or repeated
    ``vec_id`` are clustered like others; a null one starts no centroid as long as others can, and of rows with one id
    the smaller components come first. With fewer vectors than centroids each starts one; an empty
    table gives an empty result. Other columns are not looked at. Components beyond 2**27 stop the
    job with ``ComponentTooLarge``, as no 64-bit distance holds them; a sum beyond 64 bits is null.
    """
    spark = vectors.sparkSession
    rows = kept(vectors, dimensions, scale)
    box = bounding_box(rows, dimensions)
    if box is None:
        return spark.createDataFrame([], RESULT)
    in_double = max(int(box[1].max()), -int(box[0].min())) <= LARGEST_IN_DOUBLE
    blocks = stored_blocks(rows, box, scratch, dimensions, bits, block)
    centroids = first_centroids(rows, count)
    for _ in range(rounds):
        centroids = moved(centroids, blocks, Comparison(centroids, in_double))
    assigned = scratch.stage(
        through(blocks, ASSIGNED, _assign(Comparison(centroids, in_double), dimensions)), "assigned"
    )
    sums = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # a row per centroid
    inertia = sum(sums.values())

    def fitting(value: int) -> int | None:
        return value if value < 1 << 63 else None

    named = spark.createDataFrame([
        (k, fitting(total), fitting(inertia),
         hashlib.sha256(",".join(map(str, centroids[k].tolist())).encode()).hexdigest())
        for k, total in sums.items()
    ], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(named), "cluster").select(  # as many rows as centroids
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
