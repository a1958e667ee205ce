"""Integer k-means with filtering in a rotated space, against plain loops."""

import hashlib
import math
import random

import numpy as np

from dqspark.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, cluster string, lead int, rest string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "v", "c", 2, "r") for i, v in rows], SCHEMA)


def slow(rows, width=64, k=8, rounds=10):
    kept = []
    for key, v in rows:
        if v is None or len(v) != width or any(x is None or not math.isfinite(x) or abs(np.float32(x)) > 2**17 for x in v):
            continue
        kept.append((key, [math.floor(1024 * float(np.float32(x))) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    at = [list(v) for _, v in order[:k]]

    def nearest(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in at]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        own = [[] for _ in at]
        for _, v in kept:
            own[nearest(v)[0]].append(v)
        at = [[sum(x) // len(o) for x in zip(*o)] if o else c for o, c in zip(own, at)]
    return sorted(((key, *nearest(v)) for key, v in kept), key=repr), at


def fast(frame):
    labels, at = centroids.kmeans(frame)
    return sorted(((r.id, r.cluster, r.distance) for r in labels.collect()), key=repr), at


def vectors(n, seed=1):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [m + rng.gauss(0, 0.4) for m in rng.choice(middles)]) for i in range(n)]


def test_like_loops(spark):
    rows = vectors(300)
    assert fast(table(spark, rows).repartition(5)) == slow(rows)


def test_awkward_rows(spark):
    rows = vectors(40, 2)
    same = rows[3][1]
    rows += [(3, same), (3, same), (None, same), (None, rows[5][1]), (50, None), (51, []), (52, same[:63]), (53, same + [0.0])]
    rows += [(54, [None] + same[1:]), (55, [math.nan] + same[1:]), (56, [math.inf] + same[1:]), (57, [3e38] + same[1:])]
    rows += [(58, [1e5] * 64), (59, [-1e5] * 64), (60, [0.0] * 64)]
    found, at = fast(table(spark, rows))
    expected, other = slow(rows)
    assert at == other and found == expected


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = vectors(3)
    assert fast(table(spark, rows)) == slow(rows)
    assert fast(table(spark, [])) == ([], [])
    assert fast(table(spark, [(1, [0.5])])) == ([], [])


def test_equal_vectors_take_the_smallest_number(spark):
    rows = [(i, [1.0] * 64) for i in range(20)]
    found, at = fast(table(spark, rows))
    assert {c for _, c, _ in found} == {0} and (found, at) == slow(rows)


def test_filter_measures_few_and_misses_none():
    rng = np.random.default_rng(3)
    middles = rng.normal(0, 800, (8, 64))
    x = np.floor(middles[rng.integers(0, 8, 2000)] + rng.normal(0, 120, (2000, 64))).astype(np.int64)
    axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, : centroids.LEADING]
    lead, rest = centroids.split(x.astype(float), axes)
    at = centroids.Centroids(np.floor(middles).astype(int).tolist(), axes)
    best, least, measured = at.nearest(x, lead, rest)
    every = ((x[:, None] - at.exact[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (least == every.min(axis=1)).all()
    assert measured < 1.2 * len(x)


def test_ties_are_exact():
    """A vector halfway between two centroids goes to the smaller number, whatever the bounds say."""
    rng = np.random.default_rng(5)
    step = rng.integers(-9000, 9000, (50, 64))
    x = rng.integers(-9000, 9000, (50, 64))
    axes = np.linalg.qr(rng.normal(size=(64, 64)))[0][:, :16]
    for v, s in zip(x, step):
        at = centroids.Centroids([(v + s).tolist(), (v - s).tolist()], axes)
        lead, rest = centroids.split(v[None].astype(float), axes)
        best, least, _ = at.nearest(v[None], lead, rest)
        assert best[0] == 0 and least[0] == (s * s).sum()
