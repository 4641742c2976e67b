import math
import random

import numpy as np
import pytest
from textloom.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, n int, component string"
SF = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, "c") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, k=16):
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dims)]
    centred = np.array([[float(n * x[d] - sums[d]) / n for d in range(dims)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = int((values[:k] > 1e-11 * values[0]).sum())
    out = {}
    for i, x in kept:
        exact = [n * x[d] - sums[d] for d in range(dims)]
        w = (np.array(exact) / n) @ vectors[:, :k] / np.sqrt(values[:k])
        out.setdefault(i, []).append((sum(e * e for e in exact), w))
    return n, out, values[:k] / values.sum()


def compare(got, rows):
    n, want, explained = brute(rows)
    k = len(explained)
    assert len(got) == k * sum(len(x) for x in want.values())
    signs, seen = {}, {}
    for r in got:
        dev, w = want[r.vec_id][0]
        assert r.n == n and r.deviation == dev
        assert abs(r.explained - explained[r.component - 1]) < 1e-9
        assert r.identity_error < 1e-9
        expected = w[r.component - 1]
        if abs(expected) > 1e-3:
            signs.setdefault(r.component, set()).add(np.sign(expected) == np.sign(r.whitened))
        assert abs(abs(expected) - abs(r.whitened)) < 1e-7
        seen.setdefault((r.vec_id, r.component), set()).add(r.whitened)
    assert all(len(s) == 1 for s in signs.values()) and all(len(s) == 1 for s in seen.values())


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    compare(whitening.whiten(df).collect(), rows)


def test_odd_rows(spark):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0, 1 + d) for d in range(9)]) for i in range(200)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]  # copies count once
    rows += [(5, rows[5][1]), (2000, None), (2001, [None] * 9), (2002, [1.0] * 8 + [float("nan")]), (2003, [float("inf")] + [0.0] * 8), (2004, [])]
    compare(whitening.whiten(table(spark, rows)).collect(), rows)
    # Another length, an entry beyond all bounds, and no id.
    more = [(3000, [1.0, 2.0]), (3001, [1e30] + [0.0] * 8), (None, rows[0][1])]
    got = whitening.whiten(table(spark, rows + more)).collect()
    assert {r.vec_id for r in got} == {i for i, v in rows if i not in range(2000, 2005)} | {None}
    compare([r for r in got if r.vec_id is not None], rows)


def test_flat_directions(spark):
    """Rank two in five dimensions: two components, the rest has no variance."""
    draw = random.Random(1)
    rows = [(i, [float(a), float(b), float(a + b), 3.0, float(a - b)]) for i, (a, b) in enumerate((draw.randint(-9, 9), draw.randint(-9, 9)) for _ in range(100))]
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2}
    compare(got, rows)


def test_none(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None)])).count() == 0
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


@pytest.mark.parametrize("dims, block", [(40, 4), (60, 16), (7, 3)])
def test_lanczos_stops_early_and_survives_breakdown(dims, block):
    draw = np.random.default_rng(2)
    q, _ = np.linalg.qr(draw.standard_normal((dims, dims)))
    for values in (10.0 ** -np.arange(dims), np.r_[[5.0] * 3, np.zeros(dims - 3)], np.linspace(1, 2, dims)[::-1]):
        matrix, passes = (q * values) @ q.T, []
        got, vectors = whitening.leading_eigenpairs(lambda v: passes.append(v.shape[1]) or matrix @ v, dims, 3, block)
        assert np.abs(got - values[:3]).max() < 1e-13 * values[0] * dims
        assert np.abs(matrix @ vectors - vectors * got).max() < 1e-13 * values[0] * dims
        assert np.abs(vectors.T @ vectors - np.eye(3)).max() < 1e-12
        assert sum(passes) <= dims
        if dims > 7 and values[1] < 0.2:
            assert sum(passes) < dims


def test_deviation_beyond_a_long():
    w = whitening.Whitener.__new__(whitening.Whitener)
    w.n, w.dims, w.rest, w.shift, w.mean, w.values, w.vectors = 10**9, 2, [1, -1], np.array([0, 0]), np.zeros(2), np.empty(0), np.empty((2, 0))
    deviation, _ = w.rows(np.array([[2, 1], [10**6, 0]]))
    assert deviation == [(2 * 10**9 - 1) ** 2 + (10**9 + 1) ** 2, None]
