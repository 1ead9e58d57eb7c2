"""Centroid clustering and product codes against plain Lloyd rounds, and the bounds that spare their work."""

import math
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from frameloom.llm import clusters, codes, entries  # noqa: E402
from frameloom.llm.vectors import moved  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, label int"
nan, inf = math.nan, math.inf


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def read(spark, tiny):
    return [(r["vec_id"], r["label"], r["embedding"]) for r in spark.read.parquet(f"{tiny}/embeddings.parquet").collect()]


def test_clusters(spark, tiny):
    want = brute.clusters([(i, v) for i, _, v in read(spark, tiny)], 16, 3, 64)
    assert _rows(entries.op12_clusters(spark, tiny)) == sorted(want, key=str)


def test_codes(spark, tiny):
    want = brute.codes(read(spark, tiny), 8, 16, 6, 4096)
    assert _rows(entries.op13_codes(spark, tiny)) == sorted(want, key=str)


def odd(dims):
    rnd = random.Random(5)
    grid = lambda: [rnd.randrange(-2, 3) / 2 for _ in range(dims)]
    same = grid()
    good = [(i, grid(), i % 3 or None) for i in range(60)] + [(7, same, 1), (7, same, 1), (None, same, None), (None, grid(), 2)] + [(100 + i, same, 9) for i in range(40)]
    bad = [(201, None, 1), (202, [nan] * dims, 1), (203, [inf] + [0.0] * (dims - 1), 1), (204, [None] + [0.0] * (dims - 1), 1), (205, [], 1), (206, [1.0] * (dims - 1), 1)]
    return good, bad


@pytest.mark.parametrize("parts", [1, 7])
def test_odd_vectors(spark, parts):
    good, bad = odd(8)
    df = spark.createDataFrame(good + bad, VECTORS).withColumnRenamed("label", "cluster").repartition(parts)
    got = clusters.cluster(df.selectExpr("*", "1 as slot", "2 as distance"), k=5, rounds=4, dims=8, scale=2)
    assert _rows(got) == sorted(brute.clusters([(i, v) for i, v, _ in good], 5, 4, 2), key=str)
    got = codes.compress(df.selectExpr("*", "1 as code", "2 as slot"), label="cluster", parts=4, entries=6, rounds=3, scale=2)
    assert _rows(got) == sorted(brute.codes([(i, lab, v) for i, v, lab in good], 4, 6, 3, 2), key=str)


def test_few_and_no_vectors(spark):
    few = [(3, [1.0, -1.0], 1), (2, [1.0, -1.0], None)]
    df = spark.createDataFrame(few, VECTORS)
    assert _rows(clusters.cluster(df, dims=2)) == sorted(brute.clusters([(i, v) for i, v, _ in few], 16, 3, 64), key=str)
    assert _rows(codes.compress(df, parts=2)) == sorted(brute.codes([(i, lab, v) for i, v, lab in few], 2, 16, 6, 4096), key=str)
    one = df.where("vec_id = 2")
    assert [r["distance"] for r in clusters.cluster(one, dims=2).collect()] == [0]
    for none in (df.limit(0), df.selectExpr("cast(null as long) vec_id", "embedding", "label")):
        assert clusters.cluster(none, dims=2).collect() == [] and codes.compress(none, parts=2).collect() == []
    with pytest.raises(Exception, match="too large"):
        clusters.cluster(spark.createDataFrame([(1, [3e7, 0.0], 1)], VECTORS), dims=2).collect()


def blobs(n=4000, dims=8, k=12):
    rng = np.random.default_rng(3)
    centres = rng.integers(-400, 400, (k, dims))
    return centres, (centres[rng.integers(0, k, n)] + rng.normal(0, 30, (n, dims)).astype(int)).astype(np.float64)


def test_adaptive_bounds_spare_distances_and_change_nothing():
    centres, v = blobs()
    c, keep, made = centres[:, :] + 25, 3, []
    it = clusters.Assigner(c, np.zeros(len(c)), keep)
    own, upper, near, low = it.assign(v, *it.fresh(len(v)))
    for _ in range(6):
        made.append(it.compared)
        exact = ((v[:, None] - c[None]) ** 2).sum(-1)
        assert (own == exact.argmin(1)).all()
        # every bound holds, whatever was compared
        d = np.sqrt(exact)
        assert (upper >= d[np.arange(len(v)), own]).all()
        rest = d.copy()
        rest[np.arange(len(v)), own] = np.inf
        for j in range(keep):
            assert (low[:, j] <= rest.min(1)).all()
            np.put_along_axis(rest, near[:, j : j + 1], np.inf, axis=1)
        assert (low[:, keep] <= rest.min(1)).all()
        new = np.array([np.floor(v[own == i].mean(0)) if (own == i).any() else c[i] for i in range(len(c))]).astype(np.int64)
        it = clusters.Assigner(new, moved(c, new), keep)
        c = new
        own, upper, near, low = it.assign(v, own, upper, near, low)
    assert made[0] >= 12 * len(v) and made[-1] < len(v)


def test_triangle_inequality_spares_distances_and_changes_nothing():
    centres, v = blobs(dims=6)
    books = (centres + 20).reshape(12, 2, 3).transpose(1, 0, 2).copy()
    it = codes.Coder(books, np.zeros((2, 12)), 1.0)
    state, made = it.code(v, *it.fresh(len(v))), []
    for _ in range(5):
        made.append(it.compared)
        exact = ((v.reshape(-1, 2, 1, 3) - books[None]) ** 2).sum(-1)
        assert (state[0] == exact.argmin(2)).all()
        assert (state[1] >= np.sqrt(exact.min(2))).all() and (state[2] <= np.sqrt(exact)).all()
        new = books.copy()
        for p in range(2):
            for e in range(12):
                if (state[0][:, p] == e).any():
                    new[p, e] = np.floor(v[state[0][:, p] == e, 3 * p : 3 * p + 3].mean(0))
        it = codes.Coder(new, moved(books, new), 1.0)
        books = new
        state = it.code(v, *state)
    assert made[-1] < made[0] / 4


def test_ties_go_to_the_lower_index():
    books = np.array([[[0], [2], [2]]])
    it = codes.Coder(books, np.zeros((1, 3)), 1.0)
    got = it.code(np.array([[1.0], [2.0], [3.0]]), np.array([[2], [2], [0]], dtype=np.uint8), np.full((3, 1), np.inf), np.zeros((3, 1, 3), dtype=np.uint16))
    assert got[0].ravel().tolist() == [0, 1, 1]
    it = clusters.Assigner(np.array([[0], [2], [2]]), np.zeros(3), 1)
    assert it.assign(np.array([[1.0], [2.0], [3.0]]), *it.fresh(3))[0].tolist() == [0, 1, 1]
