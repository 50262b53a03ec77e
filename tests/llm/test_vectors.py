"""Hard negatives and centroids against plain versions, on rows with ties, copies, odd vectors and clashing columns."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import centroids, hard_negatives
from quarry.llm.centroids import VantageTree

SCHEMA = "vec_id long, embedding array<float>, label int, row string, v string, bucket int, anchor string, cluster string"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, label, "r", "v", 1, "a", "c") for i, v, label in rows], SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def odd_vectors():
    rnd = random.Random(11)
    rows = []
    for i in range(700):
        base = [rnd.gauss(0, 0.2) for _ in range(12)]
        if i % 3 == 0:
            base = [0.25 * ((i + j) % 3 - 1) for j in range(12)]  # many equal vectors and scores
        rows.append((i, [float(np.float32(x)) for x in base], rnd.randrange(4)))
    rows += [(5, rows[5][1], rows[5][2])] * 2 + [(100, rows[100][1], rows[100][2])]  # repeated rows and ids, an anchor among them
    rows += [(None, rows[3][1], 1), (None, rows[4][1], 2), (800, [0.0] * 12, 1), (801, [], 2), (802, [0.5] * 3, 0), (803, [0.1] * 15, 3)]
    rows += [(900, None, 1), (901, [0.1] * 11 + [None], 1), (902, [math.nan] * 12, 1), (903, [math.inf] * 12, 1), (904, [0.3] * 12, None)]
    rows += [(1000, [9.0] * 12, 77), (1100, [5.0] * 12, 3)]  # an anchor whose label no other row has; a long one
    return rows


def plain_negatives(rows):
    """All scores of every anchor; rows told apart by their order."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v, label) in enumerate(kept):
        if i is None or i % 100:
            continue
        scored = [(sum(x * y for x, y in zip(v, w, strict=False)), j, other) for b, (j, w, other) in enumerate(kept) if b != a]
        by = lambda r: (-r[0], r[1] is None, r[1] or 0)
        for p in sorted((s for s in scored if s[2] == label), key=by)[:5]:
            found = sorted((s for s in scored if s[2] != label and 80 * p[0] <= 100 * s[0] <= 100 * p[0]), key=by)[:5]
            out += [(i, p[1], n, s[1], p[0], s[0]) for n, s in enumerate(found, 1)]
    return out


@pytest.mark.parametrize(("bucket", "block", "growth"), [(4096, 8192, 8), (50, 2, 2), (200, 3, 8)])
def test_hard_negatives(spark, odd_vectors, monkeypatch, bucket, block, growth):
    for name, value in (("BUCKET", bucket), ("BLOCK", block), ("GROWTH", growth)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = hard_negatives.prepared(frame(spark, odd_vectors), F.col("label"))
    got = hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0).drop("anchor_row", "positive_row").collect()
    by = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=by) == sorted(plain_negatives(odd_vectors), key=by)


def test_coordinate_pruning_leaves_rows_out(spark):
    """Ranges of the focus coordinates leave out most rows of clustered vectors, and none that reach the score."""
    rnd = np.random.default_rng(2)
    middle = rnd.normal(size=(20, 16))
    v = np.floor(256 * (middle[rnd.integers(0, 20, 3000)] + 0.05 * rnd.normal(size=(3000, 16)))).astype(np.int64)
    v = v[np.argsort(-(v * v).sum(1), kind="stable")]
    rows = spark.createDataFrame([(n + 1, n, 0, x) for n, x in enumerate(v.tolist())], "row long, vec_id long, label long, v array<long>")
    bucket = hard_negatives.Bucket(hard_negatives.length_buckets(rows).toArrow(), 16, int(np.abs(v).max()))
    lengths, unit = hard_negatives.directions(v)
    left = 0
    for a in range(0, 3000, 100):
        scores = v @ v[a]
        asked = np.sort(scores)[-6]
        found = bucket.candidates(unit[a], lengths[a], float(asked))
        assert set(np.flatnonzero(scores >= asked)) <= set(found.tolist())
        left += len(found)
    assert left < 30 * 3000 / 3


def test_hard_negatives_of_no_rows(spark, odd_vectors):
    empty = frame(spark, odd_vectors).limit(0)
    assert hard_negatives.hard_negatives(hard_negatives.prepared(empty, F.col("label")), F.col("vec_id") % 100 == 0).count() == 0
    none = hard_negatives.prepared(frame(spark, odd_vectors).where("vec_id % 100 <> 0"), F.col("label"))
    assert hard_negatives.hard_negatives(none, F.col("vec_id") % 100 == 0).count() == 0


def test_components_beyond_bounds_fail(spark):
    rows = hard_negatives.prepared(frame(spark, [(1, [1e30], 1)]), F.col("label"))
    with pytest.raises(Exception, match="beyond"):
        rows.collect()


def nearest(vectors, middles):
    gaps = ((vectors[:, None, :] - middles[None]) ** 2).sum(2)
    return gaps.argmin(1), gaps.min(1)


@pytest.mark.parametrize("k", [1, 2, 3, 8, 60])
def test_vantage_tree_finds_the_nearest(k):
    rnd = np.random.default_rng(k)
    vectors = rnd.integers(-3, 4, (2000, 3))  # many ties
    middles = rnd.integers(-3, 4, (k, 3))
    number, distance = VantageTree(middles).nearest(vectors)
    want = nearest(vectors, middles)
    assert (number == want[0]).all() and (distance == want[1]).all()
    far = rnd.integers(-(1 << 26), 1 << 26, (200, 64))  # products beyond exact floats
    number, distance = VantageTree(far[:k]).nearest(far)
    want = nearest(far, far[:k])
    assert (number == want[0]).all() and (distance == want[1]).all()


def test_vantage_tree_leaves_centroids_out(monkeypatch):
    """Of well separated centroids most are not looked at."""
    looked = []
    real = np.einsum
    monkeypatch.setattr(centroids.np, "einsum", lambda spec, a, b: looked.append(len(a)) or real(spec, a, b))
    middles = np.array([[1000 * i, 0] for i in range(128)])
    vectors = np.repeat(middles, 10, 0) + 1
    number, _ = VantageTree(middles).nearest(vectors)
    assert (number == np.repeat(np.arange(128), 10)).all() and sum(looked) < 0.3 * 128 * len(vectors)


def plain_clusters(rows, k=8, rounds=10, dims=64):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    v = np.array([x[1] for x in kept], np.int64).reshape(-1, dims)
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    middles = np.array([x for _, x in order[:k]], np.int64).reshape(-1, dims)
    for _ in range(rounds):
        number, _ = nearest(v, middles)
        for c in set(number.tolist()):
            mine = v[number == c]
            middles[c] = [sum(col) // len(mine) for col in mine.T.tolist()]
    number, distance = nearest(v, middles)
    sums = np.bincount(number, distance, minlength=k)
    return sorted(
        ((i, int(c), int(d), int(sums[c]), int(distance.sum()), middles[c].tolist()) for (i, _), c, d in zip(kept, number, distance, strict=True)),
        key=lambda r: (r[0] is None, r[0] or 0, r),
    )


@pytest.mark.parametrize(("n", "dims", "k"), [(600, 64, 8), (5, 64, 8), (300, 4, 8), (40, 4, 20)])
def test_clusters(spark, n, dims, k):
    rnd = random.Random(n)
    rows = [(i, [float(np.float32(rnd.choice([0.1, -0.1, 0.3]) if i % 4 == 0 else rnd.gauss(i % 5, 0.2))) for _ in range(dims)], 1) for i in range(n)]
    rows += [rows[3]] * 3 + [(4, rows[1][1], 2), (None, rows[2][1], None)]
    rows += [(9001, None, 1), (9002, [0.1] * (dims - 1), 1), (9003, [math.nan] * dims, 1), (9004, [None] * dims, 1), (9005, [], 1)]
    vectors = centroids.prepared(frame(spark, rows), dims=dims)
    got = centroids.cluster(vectors, k=k).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0] is None, r[0] or 0, r)) == plain_clusters(rows, k=k, dims=dims)


def test_clusters_of_no_rows(spark):
    assert centroids.cluster(centroids.prepared(frame(spark, [(1, None, 1)]))).count() == 0
