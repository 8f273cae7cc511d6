"""The kernel classifier against a plain dual solver over all rows."""

import random

import numpy as np
import pytest

from cohortflow.operators import svc


@pytest.fixture(scope="module")
def folded(spark):
    rng = random.Random(4)
    rows = []
    for cutoff in ("week5", "week10"):
        for i in range(90):
            a, b = round(rng.random() * 3, 1), rng.randint(0, 6)
            rows.append((cutoff, "m", "p", i, a, b, int(a + b / 3 + rng.gauss(0, 0.6) > 2.5), i % 3))
        rows += [(cutoff, "m", "p", 200 + i, 1.5, 3, int(i < 9), 1) for i in range(12)]  # copies of both labels
    return spark.createDataFrame(rows, "cutoff string, code_module string, code_presentation string, id_student long, a double, b long, target_at_risk int, fold long").repartition(3)


def plain(train, test):
    """Decision values from projected-gradient-free exact pairs over single rows."""
    x, y = np.array([[r.a, r.b] for r in train], float), np.array([1.0 if r.target_at_risk else -1.0 for r in train])
    mean, dev = x.mean(axis=0), x.std(axis=0)
    x, t = (x - mean) / dev, (np.array([[r.a, r.b] for r in test], float) - mean) / dev
    gamma = 1 / (2 * x.var())
    k = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    a, f = np.zeros(len(y)), y.copy()
    for _ in range(200_000):  # the most violating pair each time
        up, low = np.where(y > 0, a < 1, a > 0), np.where(y > 0, a > 0, a < 1)
        i, j = np.argmax(np.where(up, f, -9e9)), np.argmin(np.where(low, f, 9e9))
        if f[i] - f[j] < 1e-9:
            break
        step = min((f[i] - f[j]) / max(2 - 2 * k[i, j], 1e-12), 1 - a[i] if y[i] > 0 else a[i], a[j] if y[j] > 0 else 1 - a[j])
        a[i], a[j] = np.clip(a[i] + y[i] * step, 0, 1), np.clip(a[j] - y[j] * step, 0, 1)
        f -= step * (k[i] - k[j])
    free = (a > 1e-8) & (a < 1 - 1e-8)
    b = f[free].mean() if free.any() else (f[np.where(y > 0, a < 1, a > 0)].max() + f[np.where(y > 0, a > 0, a < 1)].min()) / 2
    return np.exp(-gamma * ((t[:, None] - x[None]) ** 2).sum(-1)) @ (a * y) + b


@pytest.mark.parametrize("size", [1024, 24])
def test_decision_values_equal_a_plain_dual_solver(folded, size, monkeypatch):
    """In one working set, and in many small ones."""
    monkeypatch.setattr(svc, "WORKING_SET", size)
    tolerance = 1e-7 if size == 1024 else 1e-3
    rows = folded.collect()
    got = {(r.cutoff, r.id_student): r for r in svc.svc_predictions(folded, ["a", "b"], n_folds=3, tolerance=tolerance).collect()}
    assert len(got) == len(rows)
    for cutoff in ("week5", "week10"):
        for k in range(3):
            test = [r for r in rows if r.cutoff == cutoff and r.fold == k]
            want = plain([r for r in rows if r.cutoff == cutoff and r.fold != k], test)
            mine = np.array([got[cutoff, r.id_student].score for r in test])
            assert np.abs(mine - want).max() < (1e-5 if size == 1024 else 0.02)
            assert all(got[cutoff, r.id_student].prediction == (s > 0) for r, s in zip(test, want) if abs(s) > 0.02)


def test_one_class_and_a_feature_without_spread(spark):
    rows = [("w", "m", "p", i, 1.0, i % 4, int(i % 2 == 0 or i >= 8), i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "cutoff string, code_module string, code_presentation string, id_student long, a double, b long, target_at_risk int, fold long")
    got = svc.svc_predictions(df, ["a", "b"], n_folds=2).collect()
    assert len(got) == 20 and {r.score for r in got if r.fold == 1} == {1.0}  # its training rows are all positive


def conditions_gap(rows):
    """How much a pair of variables violates the optimality conditions, by the exact kernel."""
    rows = [r for r in rows if r.y is not None]
    z, y, cap, alpha = np.array([[r.z0, r.z1] for r in rows]), *(np.array([float(r[c]) for r in rows]) for c in ("y", "cap", "alpha"))
    assert (alpha >= 0).all() and (alpha <= cap).all() and abs((alpha * y).sum()) < 1e-4
    f = y - np.exp(-rows[0].gamma * ((z[:, None] - z[None]) ** 2).sum(-1)) @ (alpha * y)
    up, low = np.where(y > 0, alpha < cap, alpha > 0), np.where(y > 0, alpha > 0, alpha < cap)
    return f[up].max() - f[low].min()


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(9)
    rows = []
    for cutoff in ("week5", "week10"):
        rows += [(cutoff, "m", "p", i, round(a := rng.expovariate(0.5), 4), b := rng.randint(0, 9), int(a + b / 3 + rng.gauss(0, 1.5) > 3.5), i % 2) for i in range(1400)]
        rows += [(cutoff, "m", "p", 2000 + i, 0.0, 0, int(i % 5 < 2), i % 2) for i in range(900)]  # a crowded point of both labels
    return spark.createDataFrame(rows, "cutoff string, code_module string, code_presentation string, id_student long, a double, b long, target_at_risk int, fold long").repartition(5)


@pytest.mark.parametrize("pivots", [1024, 8])
def test_fits_of_many_variables_need_no_rounds(many, pivots, monkeypatch):
    """A number of passes that does not grow with the variables; too few pivots leave the rounds."""
    monkeypatch.setattr(svc, "WORKING_SET", 128 if pivots == 1024 else 640)
    monkeypatch.setattr(svc.svc_smooth, "MOST_PIVOTS", pivots)
    rounds, solved = [], svc._solved
    monkeypatch.setattr(svc, "_solved", lambda *a: rounds.append(1) or solved(*a))
    some = many if pivots == 1024 else many.where("cutoff = 'week5'")
    start, _ = svc.scaled_variables(some, ["a", "b"], "target_at_risk", 2, 1.0)
    state, bias = svc.dual_solution(start, 2)
    rows = state.collect()
    fits = {(r.cutoff, r.held_out) for r in rows}
    assert len(fits) == bias.count() == (4 if pivots == 1024 else 2)
    for fit in fits:
        assert conditions_gap([r for r in rows if (r.cutoff, r.held_out) == fit]) <= svc.TOLERANCE * 1.01
    assert (len(rounds) == 0) == (pivots == 1024)
