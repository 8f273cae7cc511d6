"""Embedding whitening against numpy on exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest
from cohortflow.llm import whiten

SCHEMA = "vec_id long, embedding array<float>, I string, x int, whitened string"


def rows_of(vectors):
    return [(i, v, "clash", 1, "clash") for i, v in vectors]


def plain(vectors, components):
    xs = [(i, tuple(math.floor(float(np.float32(c)) * 64) + 1_000_000 for c in v)) for i, v in vectors]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    a = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
    e, u = np.linalg.eigh(a.T @ a / n)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for i, x in xs:
        row = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums)])
        out[i] = (n, sum((n * c - s) ** 2 for c, s in zip(x, sums)), (row @ u / np.sqrt(e))[:components])
    return out, (e / e.sum())[:components]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 6)) @ np.diag([3, 2, 1, 0.8, 0.6, 0.3]) / 3
    out = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    return out + [(1000 + k, out[7][1]) for k in range(150)]  # a third are copies


@pytest.mark.parametrize("block", [1024, 64])
def test_whitening_equals_numpy(spark, vectors, block, monkeypatch):
    monkeypatch.setattr(whiten, "BLOCK", block)
    monkeypatch.setattr(whiten, "SPLIT", 2)
    bad = [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (2004, []), (2005, [1.0, 2.0]), (2006, [1e30] * 6)]
    df = spark.createDataFrame(rows_of([*vectors, *bad]), SCHEMA).repartition(3)
    got = whiten.whiten(df, components=4).collect()
    want, shares = plain(vectors, 4)
    assert len(got) == 4 * len(vectors) and {r.vec_id for r in got} == set(want)
    by = {(r.vec_id, r.component): r for r in got}
    ids = sorted(want)
    for c in range(4):
        mine = np.array([by[i, c + 1].whitened for i in ids])
        theirs = np.array([want[i][2][c] for i in ids])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-9
        assert abs(by[0, c + 1].explained - shares[c]) < 1e-12
    assert all((r.n, r.deviation) == want[r.vec_id][:2] for r in got)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_nulls_repeats_and_vectors_without_spread(spark):
    same = whiten.whiten(spark.createDataFrame(rows_of([(None, [0.5, 0.25]), (1, [0.5, 0.25]), (1, [0.5, 0.25])]), SCHEMA)).collect()
    assert sorted(((r.vec_id or 0, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same)) == sorted(
        (i, c, 1, 0, 0.0, 0.0, 0.0) for i in (0, 1, 1) for c in (1, 2)
    )
    flat = whiten.whiten(spark.createDataFrame(rows_of([(1, [0.0, 1.0]), (2, [2.0, 1.0]), (3, [4.0, 1.0])]), SCHEMA)).collect()
    assert {(r.vec_id, r.component): round(abs(r.whitened), 9) for r in flat} == {(1, 1): 1.224744871, (2, 1): 0.0, (3, 1): 1.224744871, (1, 2): 0, (2, 2): 0, (3, 2): 0}
    assert {(r.component, r.explained) for r in flat} == {(1, 1.0), (2, 0.0)} and flat[0].identity_error < 1e-9
    assert whiten.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whiten.whiten(spark.createDataFrame(rows_of([(1, None), (2, [])]), SCHEMA)).collect() == []
