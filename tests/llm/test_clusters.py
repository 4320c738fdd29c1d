from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from docketworks.llm import zone_clusters as zones

VECTORS = "vec_id long, embedding array<float>, cluster string, distance string"


def plain(rows, dimensions, count, rounds=3, scale=64):
    """Every vector against every centroid, in Python integers."""
    kept = [(i, [math.floor(scale * x) for x in e]) for i, e in rows
            if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(c) for _, c in kept[:count]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        members: dict[int, list] = {}
        for _, x in kept:
            members.setdefault(nearest(x)[1], []).append(x)
        for k, mine in members.items():
            centroids[k] = [sum(column) // len(mine) for column in zip(*mine)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    of = {k: sum(d for _, c, d in found if c == k) for _, k, _ in found}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, of[k], sum(of.values()), digest[k]) for i, k, d in found), key=str)


def run(frame, scratch, **settings):
    return sorted((tuple(r) for r in zones.cluster(frame, scratch, **settings).collect()), key=str)


def test_awkward_vectors(spark, scratch):
    random = np.random.default_rng(3)
    rows = [(i, random.normal(0, 1, 3).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100, [0.5, 0.5, 0.5])] * 40 + [(None, [0.25, -1.0, 0.0]), (None, None), (101, None), (102, []),
             (103, [1.0, 2.0]), (104, [1.0, None, 2.0]), (105, [1.0, float("nan"), 0.0]),
             (106, [float("inf"), 0.0, 0.0]), (107, [0.0, 0.0, 0.0]), (107, [-0.0, -0.001, 1.0])]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS).repartition(4)
    for settings in ({"count": 4, "block": 3, "bits": 2}, {"count": 200, "block": 1000, "bits": 7}):
        assert run(frame, scratch, dimensions=3, **settings) == plain(rows, 3, settings["count"])


def test_ties_go_to_the_smaller_number(spark, scratch):
    rows = [(i, [float(x), float(y)]) for i, (x, y) in enumerate((x, y) for x in range(4) for y in range(4))] * 2
    frame = spark.createDataFrame([(*r, "", "") for r in rows], VECTORS)
    assert run(frame, scratch, dimensions=2, count=6, block=2) == plain(rows, 2, 6)


def test_empty_tables(spark, scratch):
    empty = spark.createDataFrame([], VECTORS)
    found = zones.cluster(empty, scratch)
    assert found.columns == [c.split()[0] for c in zones.RESULT.split(", ")] and found.collect() == []
    assert run(spark.createDataFrame([(1, [1.0], "", "")], VECTORS), scratch) == []


def test_large_components(spark, scratch):
    rows = [(i, [float((i * 7919) % 1000) * 2000, float(-i) * 1000]) for i in range(30)]
    frame = spark.createDataFrame([(*r, "", "") for r in rows], VECTORS)
    assert run(frame, scratch, dimensions=2, count=4) == plain(rows, 2, 4)  # beyond what a double holds
    beyond = spark.createDataFrame([(1, [3e30, 0.0], "", "")], VECTORS)
    with pytest.raises(Exception, match="ComponentTooLarge"):
        run(beyond, scratch, dimensions=2)


def test_zone_maps_spare_comparisons_of_separate_clusters(spark, scratch):
    random = np.random.default_rng(1)
    middles = random.normal(0, 4, (16, 64))
    rows = [(i, (middles[i % 16] + random.normal(0, 0.05, 64)).astype(np.float32).tolist()) for i in range(2000)]
    vectors = zones.kept(spark.createDataFrame([(*r, "", "") for r in rows], VECTORS))
    blocks = zones.stored_blocks(vectors, zones.bounding_box(vectors, 64), scratch, size=16)
    assert blocks.count() >= 2000 / 16
    centroids = np.floor(64 * middles).astype(np.int64)
    assert zones.pruned_share(blocks, centroids) > 0.8
    # and the sums of blocks with one candidate give the same centroids
    compare = zones.Comparison(centroids, True)
    moved = zones.moved(centroids, blocks, compare)
    mine = np.array([[math.floor(64 * x) for x in e] for _, e in rows])
    which = ((mine[:, None] - centroids[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (moved == [mine[which == k].sum(axis=0) // (which == k).sum() for k in range(16)]).all()


def test_candidates_always_hold_the_nearest():
    random = np.random.default_rng(2)
    for _ in range(200):
        points = random.integers(-20, 20, (6, 3))
        centroids = random.integers(-25, 25, (7, 3))
        possible = zones.candidates(points.min(axis=0)[None], points.max(axis=0)[None], centroids)[0]
        nearest = ((points[:, None] - centroids[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert possible[nearest].all()


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), axis=-1).reshape(-1, dimensions)
    keys = zones.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()
