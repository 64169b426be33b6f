"""Whitening against whole-number arithmetic in plain Python, and numpy's eigh."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pairloom.llm import whitening
from pairloom.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<double>, `row` string, id int, vector string, n int, component string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "r", 1, "v", 2, "c") for i, v in rows], SCHEMA).repartition(3)


def by_rule(rows, dim):
    """Usable x vectors, the row count and sums of the distinct ones, and their covariance times n squared."""
    used = [
        (i, [math.floor(64 * float(c)) + 1_000_000 for c in v])
        for i, v in rows
        if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = list(dict.fromkeys(tuple(x) for _, x in used))
    n, s = len(fit), [sum(x[d] for x in fit) for d in range(dim)]
    square = [[n * sum(x[a] * x[b] for x in fit) - s[a] * s[b] for b in range(dim)] for a in range(dim)]
    return used, fit, n, s, square


def check(got, rows, dim, id_col="vec_id"):
    used, fit, n, s, square = by_rule(rows, dim)
    v = np.array([[float(Fraction(c, n * n)) for c in row] for row in square])
    e = np.linalg.eigh(v)[0][::-1]
    kept = min(16, int((e > e[0] * whitening.RANK_FLOOR).sum()))
    rows_of = {}
    for r in got:
        assert r["n"] == n
        rows_of.setdefault((r[id_col], int(r["deviation"])), {}).setdefault(r["component"], []).append(r)
    assert len(got) == kept * len(used)
    want = sorted(((i, sum((n * a - b) ** 2 for a, b in zip(x, s))) for i, x in used), key=str)
    assert sorted((k for k, c in rows_of.items() for _ in c[1]), key=str) == want
    # The projections' Gram matrix is free of the eigenvectors' signs.
    x_of = {}
    for i, x in used:
        x_of.setdefault((i, sum((n * a - b) ** 2 for a, b in zip(x, s))), np.array([float(Fraction(n * a - b, n)) for a, b in zip(x, s)]))
    keys = sorted(rows_of, key=str)[:300]
    w = np.array([[rows_of[k][c][0]["whitened"] for c in range(1, kept + 1)] for k in keys])
    x = np.array([x_of[k] for k in keys])
    vectors = np.linalg.eigh(v)[1][:, ::-1][:, :kept]
    mine = x @ vectors / np.sqrt(e[:kept])
    assert np.allclose(w @ w.T, mine @ mine.T, atol=1e-6 * max(1, np.abs(mine @ mine.T).max()))
    for k in keys[:20]:
        for c in range(1, kept + 1):
            assert rows_of[k][c][0]["explained"] == pytest.approx(e[c - 1] / np.trace(v), rel=1e-4)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]}
    assert got[0]["identity_error"] <= 1e-4


def test_cross_products_are_exact():
    draw = np.random.default_rng(3)
    for n, dim, most in ((1, 1, 5), (64, 3, 1 << 20), (65, 5, 100), (200, 4, 1 << 40), (70, 3, 1 << 61)):
        y = draw.integers(-most, most, (n, dim))
        y[:, 0] = 7  # no planes at all
        limbs = whitening.cross_products(y)
        full = np.column_stack([y, np.ones(n, np.int64)]).astype(object)
        want = full.T @ full
        for i in range(dim + 1):
            for j in range(i, dim + 1):
                assert sum(int(limbs[k, i, j]) << 32 * k for k in range(whitening.LIMBS)) == want[i, j]


def test_packed_names_round_trip_and_do_not_depend_on_the_batch():
    y = np.array([[1, -128], [1, -129], [40_000, 0], [1 << 40, -5], [1, -128]])
    names = whitening.packed(y)
    assert names[0] == names[4] == whitening.packed(y[:1])[0] and len(set(names)) == 4
    assert (whitening.unpacked(names, 2) == y).all()


def test_awkward_rows(spark):
    draw = np.random.default_rng(5)
    good = [(k % 40, draw.normal(0, 0.3, 5).tolist()) for k in range(90)]
    rows = [
        *good,
        *good[:7],  # repeats count once in the fit
        *[(100 + k, [0.5, 0.25, 0.125, 0.0, -1.0]) for k in range(30)],
        (None, good[0][1]),
        (None, None),
        (1, []),
        (2, [0.1, None, 0.2, 0.3, 0.4]),
        (3, [0.1, float("nan"), 0.2, 0.3, 0.4]),
        (4, [0.1, float("inf"), 0.2, 0.3, 0.4]),
        (5, [1.0, 2.0]),
    ]
    got = whitening.whiten(table(spark, rows)).collect()
    check(got, rows, 5)
    huge = [*rows, (6, [1e300, 0.0, 0.0, 0.0, 0.0])]
    assert len(whitening.whiten(table(spark, huge)).collect()) == len(got)


def test_wide_values_stay_exact(spark):
    rows = [(k, [float((k * 7919) % 101) * 2.0**40, float(k % 13), 3.0]) for k in range(80)]
    got = whitening.whiten(table(spark, rows)).collect()
    used, fit, n, s, _ = by_rule(rows, 3)
    want = {(i, sum((n * a - b) ** 2 for a, b in zip(x, s))) for i, x in used}
    assert {(r["vec_id"], int(r["deviation"])) for r in got} == want
    assert {r["component"] for r in got} == {1}  # the others vanish beside it, or are constant


def test_no_variance_and_no_rows(spark):
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    none = whitening.whiten(table(spark, [(1, None)]).filter("vec_id > 5"))
    assert none.collect() == [] and none.columns[0] == "vec_id"


def test_registered_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    query = QUERIES["op12_whitening"](spark, sf)
    assert dict(query.dtypes)["deviation"] == "bigint"
    check(query.collect(), rows, 64)
