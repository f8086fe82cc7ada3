"""Whitening against plain numpy and whole-number arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanac.llm import queries, whitening
from tests.llm import data

SCHEMA = "vec_id bigint, embedding array<double>, id string, n string, x int, dim string, whitened string"


def plain(vectors):
    """Whole vectors, exact sums, covariance in fractions, eigenvalues and vectors."""
    x = [[math.floor(64 * c) + 1000000 for c in v] for v in vectors]
    n, dims = len(x), range(len(x[0]))
    s = [sum(r[d] for r in x) for d in dims]
    deviations = [sum((n * r[d] - s[d]) ** 2 for d in dims) for r in x]
    v = np.array([[float(Fraction(sum((n * r[a] - s[a]) * (n * r[b] - s[b]) for r in x), n**3)) for a in dims] for b in dims])
    values, basis = np.linalg.eigh(v)
    return np.array(x, float), n, s, deviations, v, values[::-1], basis[:, ::-1]


def test_query_over_a_whole_table(spark):
    rows = {r.vec_id: [float(c) for c in r.embedding] for r in spark.read.parquet(f"{data.DATA}/embeddings.parquet").collect()}
    got = queries.op12_whitening(spark, data.DATA).collect()
    _, n, s, deviations, v, values, basis = plain(list(rows.values()))
    deviation = dict(zip(rows, deviations, strict=True))
    assert len(got) == 32 * len(rows) and {r.component for r in got} == set(range(1, 33))
    by = {(r.vec_id, r.component): r.whitened for r in got}
    x = {k: np.array([Fraction(math.floor(64 * c) + 1000000) - Fraction(t, n) for c, t in zip(row, s, strict=True)], float) for k, row in rows.items()}
    for k in range(min(32, np.linalg.matrix_rank(v))):
        mine = np.array([by[i, k + 1] for i in rows])
        want = np.array([x[i] @ basis[:, k] for i in rows]) / math.sqrt(values[k])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-7
    for r in got:
        assert (r.n, r.deviation) == (n, deviation[r.vec_id]) and r.identity_error <= 1e-4
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-6, abs=1e-12)


def test_polarised_covariance_is_exact():
    draw = np.random.default_rng(3)
    for scale in (1, 10**6, 10**14):
        x = draw.integers(-scale, scale, (40, 5), endpoint=True) + 1000000
        n, sums = len(x), [int(v) for v in whitening.exact_sum(x)]
        squares = dict(whitening._pair_squares({5: (n, sums)})(5, x))
        own = [int(v) for v in squares.pop((0, 0))]
        pair = {(a - 1, b + k): int(v) for (a, b), values in squares.items() for k, v in enumerate(values)}
        want = [[float(Fraction(sum((n * int(r[a]) - sums[a]) * (n * int(r[b]) - sums[b]) for r in x), n**3)) for a in range(5)] for b in range(5)]
        assert whitening.covariance(n, sums, own, pair).tolist() == want
        fit = whitening.Whitening(n, sums, np.ones(5), np.eye(5), 5.0)
        exact = [sum((n * int(r[d]) - sums[d]) ** 2 for d in range(5)) for r in x]
        assert fit.deviations(x) == [v if v < 1 << 63 else None for v in exact]


def test_odd_vectors(spark):
    draw = np.random.default_rng(5)
    usual = [(k, draw.normal(0, 1, 3).tolist()) for k in range(50)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 0.0, 1.0]), (105, [1e300, 0.0, 1.0]), (None, [0.5, 0.25, 2.0]), (7, usual[7][1]), (106, [0.5, 0.5]), (107, [0.25])]
    rows = [(*r, "a", "b", 1, "c", "d") for r in [*usual, *odd]]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    three = [v for k, v in [*usual, odd[6], odd[7]]]
    _, n, _, deviations, v, values, _ = plain(three)
    mine = [r for r in got if r.dim == 3]
    assert len(got) == n + 2 and sorted(r.deviation for r in mine) == sorted(deviations) and {r.n for r in mine} == {n}
    w = np.array([r.whitened for r in mine])
    assert np.abs(w.T @ w / n - np.eye(3)).max() < 1e-9 and all(r.identity_error < 1e-9 for r in got)
    assert mine[0].explained == pytest.approx((values / np.trace(v)).tolist())
    # One row of its length has no variance, so nothing to whiten by.
    assert sorted((r.dim, r.n, r.deviation, tuple(r.whitened), tuple(r.explained)) for r in got if r.dim < 3) == [(1, 1, 0, (None,), (0.0,)), (2, 1, 0, (None, None), (0.0, 0.0))]
    flat = whitening.components(whitening.whiten(spark.createDataFrame(rows, SCHEMA)))
    assert flat.count() == 3 * n + 3 and flat.where(F.col("whitened").isNull()).count() == 3
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([r for r in rows if r[0] in (100, 102)], SCHEMA)).collect() == []
