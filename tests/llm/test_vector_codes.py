"""Operator 13 against plain integer codebooks."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.llm import vector_codes as v

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts, entries, rounds, dims):
    kept = [(i, [int(np.floor(1024 * np.float64(x))) for x in np.array(e, np.float32)], lab) for i, e, lab in rows
            if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    odd = [(str(i), None, None) for i, e, _ in kept if len(e) != dims]
    full = [r for r in kept if len(r[1]) == dims]
    w = dims // parts
    first = sorted(full, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * w:(p + 1) * w] for r in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            cut = [r[1][p * w:(p + 1) * w] for r in full]
            of = [nearest(p, x)[1] for x in cut]
            books[p] = [[sum(c) // len(mine) for c in zip(*mine)] if (mine := [x for x, m in zip(cut, of) if m == n]) else e
                        for n, e in enumerate(books[p])]
    out = []
    for i, x, lab in full:
        near = [nearest(p, x[p * w:(p + 1) * w]) for p in range(parts)]
        out.append((str(i), "".join(f"{n:02x}" for _, n in near), sum(d for d, _ in near), lab))
    per = {}
    for *_, e, lab in out:
        per[lab] = per.get(lab, 0) + e
    labels = {i: per.get(lab) for i, lab in [(str(i), lab) for i, e, lab in kept if len(e) != dims]}
    sign = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted([(i, c, e, per[lab], sign) for i, c, e, lab in out] + [(i, c, e, labels[i], sign) for i, c, e in odd], key=str)


def check(spark, rows, dims, parts=4, entries=256, rounds=4, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = v.vector_codes(df, parts=parts, entries=entries, rounds=rounds, **options).collect()
    assert sorted(((str(r[0]), *r[1:]) for r in got), key=str) == brute(rows, parts, entries, rounds, dims)


def vectors(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.integers(-3, 4, dims) + rng.normal(0, 0.05, dims)).tolist(), int(rng.integers(3)) or None) for i in range(n)]


def test_equal_to_brute_force(spark):
    rows = vectors(220, 8)
    rows += [(1000 + i, rows[3][1], 1) for i in range(110)]  # a third of the rows are one vector
    check(spark, rows, 8, entries=12, block_rows=8)
    check(spark, rows, 8, entries=256, rounds=2, chunk_rows=50, block_rows=4)
    check(spark, vectors(90, 6, 3), 6, parts=2, entries=5, rounds=10, block_rows=16)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 2.0, 3.0, 4.0], 1), (5, [1.0, 2.0, 3.0, 4.0], 1), (2, None, 0), (3, [1.0, None, 3.0, 4.0], 0), (4, [nan, 0.0, 0.0, 0.0], 0),
            (5, [0.0, 0.0, 0.0, -inf], 0), (6, [1.0, 2.0], 0), (7, [], 1), (None, [-0.0001, 0.0, 0.0, 1.0], None), (8, [-1.5, 0.25, 9.0, 4.0], None),
            (9, [1.0] * 8, 7)]
    check(spark, rows, 4)
    check(spark, rows, 4, entries=2)
    clash = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit(1).alias(n) for n in ("id", "vector", "code", "of", "label_error")))
    assert v.vector_codes(clash).count() == 7
    for none in ([], [(1, None, 2)], [(1, [0.5, 1.0], 2)]):
        got = v.vector_codes(spark.createDataFrame(none, SCHEMA))
        assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert [tuple(r)[:3] for r in got.collect()] == [(1, None, None)] * (len(none) if none and none[0][1] else 0)


def test_large_components(spark):
    check(spark, [(i, [131071.0 * (-1) ** (i >> j) for j in range(8)], 0) for i in range(40)], 8, entries=7)


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        order = v.hilbert_order(grid, bits)
        assert (np.abs(np.diff(grid[order], axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("spread,most", [(0.02, 0.3), (5.0, 1.0)])
def test_shortlists_keep_the_nearest(spread, most):
    rng = np.random.default_rng(4)
    centres = rng.integers(-900, 900, (40, 6))
    x = centres[rng.integers(40, size=3000)] + np.floor(rng.normal(0, spread * 100, (3000, 6))).astype(np.int64)
    part = v.flat_blocks(x, 32)
    may = v.shortlists(part["low"], part["high"], centres)
    best = ((part["values"][:, None] - centres[None]) ** 2).sum(2).argmin(1)
    assert may[np.arange(3000) // 32, best].all() and may.mean() <= most
    codes, n, sums = v.assign_part(part, centres, 32)
    assert (codes == best).all() and (n == np.bincount(best, minlength=40)).all()
    assert all((sums[e] == part["values"][best == e].sum(0)).all() for e in range(40))
