"""Centroid clustering against plain Lloyd rounds over all rows in Python integers."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from takepick.llm.lloyd import cluster, quantise, weighted_sums


def plain_version(rows, k, rounds, dims, scale, seed):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    first = sorted(kept, key=lambda r: (sha(f"{seed}:{'' if r[0] is None else r[0]}"), np.array(r[1], "<i4").tobytes()))[:k]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, g in groups.items():
            centroids[n] = [sum(x) // len(g) for x in zip(*g)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    return [(i, n, d, sum(e for _, e, m in found if m == n), total, sha(",".join(map(str, centroids[n])))) for i, d, n in found]


def same(spark, rows, **how):
    df = spark.createDataFrame([(i, v, i, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster long, v string")
    got = cluster(df, **how).drop("centroid").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_version(rows, how["k"], how["rounds"], how["dims"], how["scale"], how["seed"]), key=repr)
    return got


def test_random_vectors_ties_and_copies(spark):
    r = random.Random(5)
    rows = [(i, [r.choice((-1.0, -0.3, 0.0, 0.4, 1.1)) for _ in range(3)]) for i in range(300)]
    rows += [(300 + i, [0.25, -0.5, 7.0]) for i in range(200)]  # one vector holds two fifths of the rows
    rows += [(7, rows[7][1]), (7, [9.0, 9.0, 9.0]), (None, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 2.0]), (904, [1.0, math.nan, 2.0]), (905, [math.inf, 0.0, 0.0]), (906, [1.0] * 4)]
    for k, rounds in ((5, 4), (8, 10), (1, 2)):
        got = same(spark, rows, k=k, rounds=rounds, dims=3, scale=16, seed=3)
        assert len(got) == 504


def test_few_equal_and_no_vectors(spark):
    same(spark, [(1, [1.0, 2.0]), (2, [5.0, 5.0])], k=8, rounds=10, dims=2, scale=4, seed=3)
    same(spark, [(i, [1.0, 2.0]) for i in range(20)], k=8, rounds=10, dims=2, scale=4, seed=3)  # all centroids are equal, all but one empty
    assert cluster(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0


def test_integers_are_exact():
    most = (1 << 27) - 1
    assert weighted_sums(np.array([[most], [-5]]), np.array([1 << 40, 1])) == [most * (1 << 40) - 5]
    lists = pa.array([[2.0**17], [1.0, 2.0], None, [-0.0001]], pa.list_(pa.float64()))
    rows, q = quantise(lists.slice(1), 1, 1024)
    assert rows.tolist() == [2] and q.tolist() == [[-1]]
    with pytest.raises(ValueError):
        quantise(pa.array([[2.0**18]], pa.list_(pa.float64())), 1, 1024)
