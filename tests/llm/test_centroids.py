"""Operator 11 against plain integer k-means."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp
from pyspark.sql import functions as F

from gridcast.llm import centroids as c

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, dims, k, rounds, seed):
    """rows: (vec_id, embedding, label)."""
    kept = [(i, [int(np.floor(1024 * np.float64(x))) for x in np.array(v, np.float32)]) for i, v, *_ in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept)[:k]
    centres = [v for *_, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, q)), n) for n, q in enumerate(centres))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for n in range(len(centres)):
            mine = [v for (_, v), m in zip(kept, of) if m == n]
            if mine:
                centres[n] = [sum(x) // len(mine) for x in zip(*mine)]
    got = [(i, *nearest(v)) for i, v in kept]
    inertia = {n: sum(d for _, d, m in got if m == n) for n in range(len(centres))}
    sign = [hashlib.sha256(",".join(map(str, q)).encode()).hexdigest() for q in centres]
    return sorted((str(i), n, d, inertia[n], sum(inertia.values()), sign[n]) for i, d, n in got)


def check(spark, rows, schema=SCHEMA, dims=4, k=3, rounds=5, seed=3, **options):
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = c.cluster_vectors(df, dims=dims, k=k, rounds=rounds, seed=seed, **options).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute(rows, dims, k, rounds, seed)


def vectors(n, dims, seed=0, spread=2.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(0, spread, 4)[rng.integers(4)] + rng.normal(0, 0.2, dims)).tolist(), i % 3) for i in range(n)]


def test_equal_to_brute_force(spark):
    rows = vectors(300, 4)
    rows += [(1000 + i, rows[7][1], None) for i in range(150)]  # a third of the rows are one vector
    check(spark, rows)
    check(spark, rows, chunk_rows=17, rounds=1)
    check(spark, vectors(200, 6, 5), dims=6, k=8, rounds=10, chunk_rows=64)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 1), (1, [1.0, 2.0, 3.0, 4.0], 1), (2, None, 0), (3, [1.0, None, 3.0, 4.0], 0), (4, [nan, 0.0, 0.0, 0.0], 0),
            (5, [0.0, 0.0, 0.0, -inf], 0), (6, [1.0, 2.0], 0), (7, [], 0), (None, [-0.0001, 0.0, 0.0, 1.0], None), (8, [-1.5, 0.25, 9.0, 4.0], 2)]
    check(spark, rows)
    check(spark, rows, k=9)  # fewer vectors than centroids, ties between equal ones
    clash = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit(1).alias(n) for n in ("id", "vector", "cluster", "distance")))
    assert c.cluster_vectors(clash, dims=4, k=2).count() == 4
    empty = c.cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.count() == 0


def test_large_components(spark):
    check(spark, [(i, [131071.0 * (-1) ** (i >> j) for j in range(4)], 0) for i in range(40)])
    try:
        c.cluster_vectors(spark.createDataFrame([(1, [1e30] * 4, 0)], SCHEMA), dims=4).count()
        raise AssertionError("no error")
    except OverflowError:
        pass


@settings(max_examples=60, deadline=None, database=None, derandomize=True)
@given(hnp.arrays(np.int64, st.tuples(st.integers(1, 40), st.integers(1, 9)), elements=st.integers(-3, 3)))
def test_dictionaries_are_lossless(x):
    blocks = c.encode(x)
    assert (np.hstack([sub[codes] for _, sub, codes in blocks]) == x).all()
    assert all(len(np.unique(sub, axis=0)) == len(sub) for _, sub, _ in blocks)
    q = x[:3] + 1
    assert (c.distances(blocks, q) == ((x[:, None] - q[None]) ** 2).sum(2)).all()


def test_repeats_make_wide_blocks():
    few = np.random.default_rng(1).integers(-500, 500, (5, 16))
    assert [b[1].shape for b in c.encode(np.repeat(few, 400, axis=0))] == [(5, 16)]
    assert all(b[1].shape[1] == 1 for b in c.encode(np.random.default_rng(2).integers(-200, 200, (2000, 16))))
