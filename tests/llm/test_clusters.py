"""Clustering against plain rounds in Python, candidates of boxes, and the edge cases of the docstrings."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from brute import sha

from bookloom.llm import clusters
from bookloom.llm.common import stored
from bookloom.llm.queries import QUERIES


def plain(rows, k=40, rounds=5, size=64, scale=256, seed=2, bound=1 << 27):
    """rows: (id, vector) -> sorted (id, cluster, distance), centroids."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(max(-bound, min(bound, x * scale))) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(centroids)]
    found = [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept]
    return sorted(found, key=repr), centroids


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster string")


def check(spark, rows, kind="float", **options):
    found = clusters.cluster(frame(spark, rows, kind), **options)
    want, centroids = plain(rows, **options)
    assert sorted((tuple(r) for r in found.assigned.collect()), key=repr) == want
    assert found.centroids.tolist() == centroids
    return found


def test_small_vectors_with_ties(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(-4, 4) / 4 for _ in range(3)]) for i in range(200)]
    rows += [(i, [0.0, 0.0, 0.0]) for i in range(200, 300)] + [(7, [0.0, 0.0, 0.0])] * 20 + [(None, [1.0, 1.0, 1.0])] * 2
    check(spark, rows, k=6, size=3, scale=2)


def test_rows_left_out_and_few_rows(spark):
    rows = [(1, [0.5, 1.0]), (2, [0.5, None]), (3, [0.5, float("nan")]), (4, [0.5, float("inf")]), (5, [1.0]), (6, None), (7, []), (8, [-0.001, 0.0])]
    found = check(spark, rows, k=5, size=2)
    assert len(found.centroids) == 2
    assert clusters.cluster(frame(spark, []), k=5, size=2).assigned.count() == 0
    assert clusters.with_inertia(clusters.cluster(frame(spark, rows[1:3]), k=5, size=2)).count() == 0


def test_large_components(spark):
    rows = [(1, [3e38, -3e38]), (2, [1e6, 1.0]), (3, [-1e6, 2.0]), (4, [5e5, 5e5]), (5, [0.1, 0.2])]
    check(spark, rows, k=2, size=2)
    check(spark, [(i, [x * 1.0 for x in v]) for i, v in rows], kind="double", k=3, size=2)


def test_candidates_hold_the_nearest():
    rng = np.random.default_rng(4)
    for _ in range(300):
        points = rng.integers(-20, 20, (30, 4)) + rng.integers(-60, 60, 4)
        centroids = rng.integers(-80, 80, (12, 4))
        box = np.stack([points.min(axis=0), points.max(axis=0)])
        distance = ((points[:, None] - centroids) ** 2).sum(axis=2)
        assert set(np.flatnonzero((distance == distance.min(axis=1, keepdims=True)).any(axis=0))) <= set(clusters.candidates(box, centroids))
        label, found = clusters.nearest(points, box, centroids)
        assert (label == distance.argmin(axis=1)).all() and (found == distance.min(axis=1)).all()


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_neighbours_touch(dims, bits):
    """Along the curve each step changes one component by one, and every place is met once."""
    top = (1 << bits) - 1
    cells = np.array(list(itertools.product(range(top + 1), repeat=dims)))
    keys = clusters.hilbert_keys(cells, np.zeros(dims, np.int64), np.full(dims, top), bits)
    walk = cells[np.lexsort(keys.T[::-1])]
    assert len(np.unique(keys, axis=0)) == len(cells)
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_boxes_spare_comparisons(spark):
    """With clear groups most blocks are left with few candidates."""
    rng = random.Random(6)
    centres = [[rng.uniform(-50, 50) for _ in range(8)] for _ in range(20)]
    rows = [(i, [x + rng.uniform(-1, 1) for x in centres[i % 20]]) for i in range(2000)]
    vectors = clusters.integer_vectors(frame(spark, rows), 8, 256, "vec_id", "embedding")
    _, low, high = clusters.extent(vectors, 8)
    blocks = stored(clusters.hilbert_blocks(vectors, low, high, block=50), "blocks")
    assert blocks.selectExpr("explode(ids)").count() == 2000
    assert clusters.candidate_share(blocks, np.array([[int(x * 256) for x in c] for c in centres])) < 0.4


def test_query(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want, centroids = plain(rows)
    total, sums = sum(d for *_, d in want), {}
    for _, c, d in want:
        sums[c] = sums.get(c, 0) + d
    found = sorted((tuple(r) for r in QUERIES["op12_centroids"](spark, small).collect()), key=repr)
    assert found == sorted(((i, c, d, sums[c], total, sha(",".join(map(str, centroids[c])))) for i, c, d in want), key=repr)
