"""Near-duplicate documents: MinHash, banding, signature and full verification, components.

1. Texts with equal shingle sets are one class from the start, named by its smallest id.
2. A class gets minima of universal hashes. Bands of ``ROWS`` minima give bucket keys;
   classes that share a key are candidates. With 20 bands of 4, a pair at the limit of 0.85
   shares no key with a probability of 4e-7.
3. Members of shared buckets get a longer signature of ``HASHES`` minima, and their sets are kept.
4. Every member of a bucket is compared with the bucket's smallest member: first the signatures
   (a pair passes unless its agreement is five standard deviations below the limit), then
   bounds from sizes and parities, which never refuse a link, then the full sets. Links
   give components.
5. Buckets that still hold several components are compared in full, in blocks, but only pairs
   from different components are kept; these go through the same verification. Pairs inside a
   component need no comparison, so a large group of near copies costs one comparison per member.

Ids and keys are shuffled for all documents; signatures and sets only for members of shared
buckets, after their texts were looked up once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketworks.llm.components import components
from docketworks.llm.shingles import (
    SHINGLE, alike, hash_family, may_be_alike, parity, set_key, shingle_set, signature,
)
from docketworks.llm.tables import through
from docketworks.sources.scratch import Scratch

HASHES = 256
BANDS, ROWS = 20, 4
PERCENT = 85
BLOCK = 512
DEVIATIONS = 5

FEATURES = "doc_id long, n_shingles long, set_key binary, keys array<long>"
MEMBER = "doc_id long, n_shingles long, minima binary, parity binary, shingles binary"
PAIR = "u long, v long"


def least_agreement(percent: int, hashes: int = HASHES) -> int:
    """Equal minima below which a pair at the limit falls with a probability under 1e-6."""
    share = percent / 100
    return math.floor(hashes * share - DEVIATIONS * math.sqrt(hashes * share * (1 - share)))


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One number per band from the first minima, of which 16 bits count as in the signatures."""
    rows = minima[:BANDS * ROWS].astype("<u2").astype(np.uint64).reshape(BANDS, ROWS)
    mixed = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for column in rows.T:
        mixed = (mixed ^ column) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return mixed.astype(np.int64)


def _features(size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = tuple(part[:BANDS * ROWS] for part in hash_family(HASHES))
        for batch in batches:
            counts, set_keys, keys = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text, size)
                counts.append(len(found))
                set_keys.append(set_key(found) if len(found) else None)
                keys.append(band_keys(signature(found, family)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(set_keys, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "keys"],
            )

    return work


def _members(size: int):
    """(doc_id, text, set_key of its class) to signature and set, if the text is that of the class."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(HASHES)
        for batch in batches:
            rows = []
            for doc_id, text, expected in zip(*(c.to_pylist() for c in batch.columns)):
                found = shingle_set(text, size)
                if len(found) and set_key(found) == expected:
                    # 16 bits of each minimum tell different minima apart well enough
                    rows.append((doc_id, len(found), signature(found, family).astype("<u2").tobytes(),
                                 parity(found).tobytes(), found.tobytes()))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)],
                    names=["doc_id", "n_shingles", "minima", "parity", "shingles"],
                )

    return work


def _rows_of(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _agreeing(least: int, percent: int):
    """Pairs (u, v, sizes, minima, parities) that may be alike."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, other_sizes = (batch.column(i).to_numpy() for i in (2, 3))
            minima, others = (_rows_of(batch.column(i), "<u2") for i in (4, 5))
            bits, other_bits = (_rows_of(batch.column(i), np.uint8) for i in (6, 7))
            chosen = (minima == others).sum(axis=1) >= least
            chosen &= may_be_alike(sizes, other_sizes, bits, other_bits, percent)
            yield batch.select(["u", "v"]).filter(pa.array(chosen))

    return work


def _linked(percent: int):
    """Pairs (u, v, set of u, set of v) that are alike."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ones, others = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            chosen = pa.array([
                alike(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)
                for a, b in zip(ones, others)
            ], pa.bool_())
            yield batch.select(["u", "v"]).filter(chosen)

    return work


def _both_ends(pairs: DataFrame, members: DataFrame, *values: str) -> DataFrame:
    """u, v and ``values`` of either end, from ``members`` by ``doc_id``."""
    one, other = (
        members.select(F.col("doc_id").alias(end), *[F.col(c).alias(f"_{end}_{c}") for c in values])
        for end in ("u", "v")
    )
    ends = [f"_{end}_{c}" for c in values for end in ("u", "v")]
    return pairs.join(one, "u").join(other, "v").select("u", "v", *ends)


def _confirm(pairs: DataFrame, members: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    sets = _both_ends(pairs, members, "shingles")
    return scratch.stage(through(sets, PAIR, _linked(percent)).distinct(), "links")


def _across(least: int, percent: int):
    """Pairs of one block pair of a bucket that lie in different components.

    A pair is left to the first band that its minima share, so it comes out once.
    """
    def work(key, rows):
        band = key[1].as_py()
        ids, owners, sizes, sides = (
            rows.column(c).to_numpy() for c in ("doc_id", "component", "n_shingles", "side")
        )
        minima, bits = _rows_of(rows.column("minima"), "<u2"), _rows_of(rows.column("parity"), np.uint8)
        keys = np.ascontiguousarray(minima[:, :BANDS * ROWS]).view("<u8")  # a number per band
        same_block = key[2].as_py() == key[3].as_py()
        left = np.flatnonzero(sides == 0)
        right = left if same_block else np.flatnonzero(sides == 1)
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in left:
            others = right[right > i] if same_block else right
            others = others[owners[others] != owners[i]]
            others = others[(minima[others] == minima[i]).sum(axis=1) >= least]
            others = others[may_be_alike(sizes[i], sizes[others], bits[i], bits[others], percent)]
            others = others[(keys[others] == keys[i]).argmax(axis=1) == band] if len(others) else others
            us.append(np.maximum(ids[i], ids[others]))
            vs.append(np.minimum(ids[i], ids[others]))
        return pa.table({"u": pa.array(np.concatenate(us)), "v": pa.array(np.concatenate(vs))})

    return work


def _cross_pairs(
    bands: DataFrame, members: DataFrame, labels: DataFrame, percent: int, scratch: Scratch, block: int
) -> DataFrame:
    """Candidate pairs of different components in the buckets that hold several."""
    named = bands.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    mixed = named.groupBy("key").agg(
        F.count(F.lit(1)).alias("_members"), F.min("component").alias("_low"),
        F.max("component").alias("_high"),
    ).filter("_low < _high").select("key", F.ceil(F.col("_members") / block).alias("_blocks"))
    spread = named.join(mixed, "key").withColumn(
        "_block", F.pmod(F.xxhash64("doc_id"), F.col("_blocks"))
    ).join(members.select("doc_id", "n_shingles", "minima", "parity"), "doc_id")
    # block b meets itself, all blocks before it and all behind it
    rows = spread.withColumn("_other", F.explode_outer(F.expr("sequence(0L, _blocks - 1)"))).select(
        "doc_id", "component", "n_shingles", "minima", "parity", "key", "band",
        F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"),
        F.when(F.col("_block") <= F.col("_other"), 0).otherwise(1).alias("side"),
    )
    found = rows.groupBy("key", "band", "_i", "_j").applyInArrow(_across(least_agreement(percent), percent), PAIR)
    return scratch.stage(found.distinct(), "cross-pairs")


def near_duplicates(
    docs: DataFrame, scratch: Scratch, percent: int = PERCENT, size: int = SHINGLE, block: int = BLOCK
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row of ``docs`` (doc_id, text).

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets. The component
    is named by its smallest id, whose rows are kept. A null, empty or blank text has no
    shingles and is linked with nothing. A row without an id is linked with nothing, has no component
    and is kept; rows that repeat an id are one node. An empty table gives an empty result.
    """
    source = docs.select(F.col("doc_id").cast("long"), "text")
    features = scratch.stage(through(source, FEATURES, _features(size)), "features")
    present = features.filter("doc_id IS NOT NULL AND set_key IS NOT NULL")
    owners = present.groupBy("set_key").agg(F.min("doc_id").alias("class_id"))
    firsts = present.join(
        owners.select("set_key", F.col("class_id").alias("doc_id")), ["set_key", "doc_id"]
    ).select("doc_id", "set_key", "keys")
    classes = scratch.stage(firsts, "classes")
    keys = classes.select("doc_id", "set_key", F.posexplode_outer("keys").alias("band", "key"))
    shared = keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("_members"), F.min("doc_id").alias("hub")
    ).filter("_members > 1").drop("_members")
    bands = scratch.stage(keys.join(shared, "key"), "bands")

    # one plan at every size: the members of a large corpus never fit a broadcast
    involved = bands.select("doc_id", "set_key").distinct().hint("merge")
    texts = source.join(involved, "doc_id").select("doc_id", "text", "set_key")
    members = scratch.stage(through(texts, MEMBER, _members(size)), "members")
    bands = bands.drop("set_key")

    stars = bands.filter("doc_id <> hub").select(F.col("doc_id").alias("u"), F.col("hub").alias("v")).distinct()
    near = through(_both_ends(stars, members, "n_shingles", "minima", "parity"), PAIR,
                   _agreeing(least_agreement(percent), percent))
    links = _confirm(scratch.stage(near.distinct(), "star-pairs"), members, percent, scratch)
    labels = components(links, scratch)

    across = _cross_pairs(bands.drop("hub"), members, labels, percent, scratch, block)
    more = _confirm(across, members, percent, scratch)
    labels = components(
        labels.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more), scratch
    )

    owned = features.select("doc_id", "n_shingles", "set_key").join(owners, "set_key", "left")
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id")
    )
    return owned.join(labels, owned["class_id"] == labels["node"], "left").select(
        "doc_id", "n_shingles", component.alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
