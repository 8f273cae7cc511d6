"""Exact trees and forests against plain recursion."""

import random

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import trees

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def folded(spark):
    rng = random.Random(8)
    rows = []
    for cutoff in ("week5", "week10"):
        for i in range(130):
            a, b = round(rng.random() * 3, 1), rng.randint(0, 6)
            rows.append((cutoff, "m", "p", i, a, b, int(a + b / 3 + rng.gauss(0, 0.8) > 2.5), i % 5))
        rows += [(cutoff, "m", "p", 200 + i, 1.5, 3, 1, 0) for i in range(40)]  # a hot point of one label
    return spark.createDataFrame(rows, "cutoff string, code_module string, code_presentation string, id_student long, a double, b long, target_at_risk int, fold long").repartition(3)


def grow(points, seed, visited):
    """points: (x, w, p); a function from x to the share of its leaf."""
    live = [q for q in points if q[1]]
    w, p = sum(q[1] for q in live), sum(q[2] for q in live)
    m = len(points[0][0]) if points else 0
    best = {}
    for f in range(m):
        values = sorted({q[0][f] for q in live})
        for lo, hi in zip(values, values[1:]):
            w1, p1 = (float(sum(q[k] for q in live if q[0][f] <= lo)) for k in (1, 2))
            w2, p2 = w - w1, p - p1
            s = (p1 * p1 + (w1 - p1) * (w1 - p1)) / w1 + (p2 * p2 + (w2 - p2) * (w2 - p2)) / w2
            if f not in best or s > best[f][0]:
                best[f] = (s, (lo + hi) / 2)
    if p in (0, w) or not best:
        return lambda x: p / max(w, 1)
    start = seed % m if visited < m else 0
    turns = [(start + k) % m for k in range(m)]
    inside = [f for f in turns[:visited] if f in best]
    f = max(inside, key=lambda f: (best[f][0], -turns.index(f))) if inside else next(f for f in turns if f in best)
    cut = best[f][1]
    sides = [grow([q for q in points if (q[0][f] > cut) == bool(k)], trees.child_seed(seed, k), visited) for k in (0, 1)]
    return lambda x: sides[x[f] > cut](x)


def plain(rows, weight, visited, tree):
    out = {}
    for cutoff in {r.cutoff for r in rows}:
        for k in range(5):
            train = [((r.a, float(r.b)), weight[r.cutoff, r.id_student, tree], weight[r.cutoff, r.id_student, tree] * r.target_at_risk) for r in rows if r.cutoff == cutoff and r.fold != k]
            model = grow(train, (tree * 7919 + 12345) % trees.MODULUS, visited)
            out |= {(r.cutoff, r.id_student): model((r.a, float(r.b))) for r in rows if r.cutoff == cutoff and r.fold == k}
    return out


@pytest.mark.parametrize("small", [1 << 16, 12])
def test_tree_equals_plain_recursion(folded, small, monkeypatch):
    """With nodes finished in tasks, and with levels split over range partitions."""
    monkeypatch.setattr(trees, "SMALL", small)
    monkeypatch.setattr(trees, "TASK", 100 if small == 12 else 1 << 18)
    rows = folded.collect()
    want = plain(rows, {(r.cutoff, r.id_student, 0): 1 for r in rows}, 2, 0)
    got = trees.decision_tree_predictions(folded, FEATURES).collect()
    assert {(r.cutoff, r.id_student): r.score for r in got} == want and len(got) == len(rows)
    assert all(r.prediction == (r.score > 0.5) for r in got) and len({r.score for r in got}) > 2


@pytest.mark.parametrize("small", [1 << 16, 40])
def test_forest_equals_plain_recursion(folded, small, monkeypatch):
    monkeypatch.setattr(trees, "SMALL", small)
    monkeypatch.setattr(trees, "TREES_AT_ONCE", 2)
    rows, n = folded.collect(), 3
    weights = folded.select("cutoff", "id_student", F.explode(F.array(*map(F.lit, range(n)))).alias("tree"), *trees.E[:2]).withColumn("w", trees.bootstrap_weight(F.col("tree"), 42)).collect()
    weight = {(r.cutoff, r.id_student, r.tree): r.w for r in weights}
    assert {0, 1, 2} <= set(weight.values()) and 0.8 < sum(weight.values()) / len(weight) < 1.2
    want = [plain(rows, weight, 1, t) for t in range(n)]
    got = trees.random_forest_predictions(folded, FEATURES, trees=n).collect()
    assert len(got) == len(rows)
    assert all(abs(r.score - sum(w[r.cutoff, r.id_student] for w in want) / n) < 1e-9 for r in got)
