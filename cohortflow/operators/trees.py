"""Exact decision trees and random forests, all folds of all cutoffs at once.

A fit is (cutoff, held-out fold, tree).  Training rows of equal features are one
point with a weight and a positive weight; held-out points travel through the
same nodes with weight 0, so a leaf's positive share is at once their score and
no model is ever gathered.

A node splits at the midpoint of two neighbouring distinct training values that
maximises (p1^2 + q1^2) / w1 + (p2^2 + q2^2) / w2 (least Gini impurity), until it
is pure or has one distinct value per feature: no bins, no depth limit.  Of
``visited`` features (in turn, from one that the node's seed picks; all of them,
from the first, in a plain tree) the best wins; ties go to the earlier feature,
then to the smaller threshold.  If none of these can split, the next one that
can is taken.

Nodes of more than ``SMALL`` points split level by level: one histogram per
(node, feature, value) over all open nodes, range-partitioned, with running class
sums from partition offsets, so no task holds a node.  Smaller nodes are finished
in one pass, many to a task, by the same rule in numpy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.schemas import ENTITY_KEY
from cohortflow.session import materialize

E = ENTITY_KEY
FIT = ["cutoff", "held_out", "tree"]
NODE = [*FIT, "path", "seed"]
#: Points of a node that one task may hold, and of a task that holds many nodes.
SMALL, TASK = 1 << 16, 1 << 18
TREES_AT_ONCE = 50
MODULUS = 2147483647


def child_seed(seed, side):
    """Seed of a node's child, for Spark columns and for numpy alike."""
    return (seed * 48271 + side * 69621 + 1) % MODULUS


def bootstrap_weight(tree: Column, seed: int) -> Column:
    """Poisson(1) weight of a row in a tree, from a hash of tree and entity."""
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), tree, *E, "cutoff"), 11)
    below, cuts = 0.0, []
    for k in range(12):
        below += math.exp(-1) / math.factorial(k)
        cuts.append(int(below * (1 << 53)))
    out = F.lit(len(cuts))
    for k, cut in reversed(list(enumerate(cuts))):
        out = F.when(u < cut, k).otherwise(out)
    return out.cast("long")


def fit_points(folded: DataFrame, features: Sequence[str], label: str, n_folds: int, weight: Column | None = None, trees: Sequence[int] = (0,)) -> DataFrame:
    """(fit, path, seed, x0, x1, ..., w, p, test): the points of every fit."""
    xs = [f"x{k}" for k in range(len(features))]
    rows = folded.select("cutoff", "fold", *E, F.col(label).cast("long").alias("y"), *(F.round(F.col(f).cast("double"), 6).alias(x) for f, x in zip(features, xs)))
    rows = rows.withColumn("tree", F.explode(F.array(*map(F.lit, trees))))
    rows = rows.withColumn("w", F.lit(1).cast("long") if weight is None else weight)
    own = rows.withColumn("held_out", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_folds - 1).cast("long"))))
    test = F.col("fold") == F.col("held_out")
    own = own.where(test | (F.col("w") > 0))
    w = F.when(test, F.lit(0).cast("long")).otherwise(F.col("w"))
    points = own.groupBy(*FIT, *xs).agg(F.sum(w).alias("w"), F.sum(w * F.col("y")).alias("p"), F.max(test).alias("test"))
    return points.select(*FIT, F.lit("").alias("path"), ((F.col("tree") * 7919 + 12345) % MODULUS).cast("long").alias("seed"), *xs, "w", "p", "test")


def finish(x: np.ndarray, node: np.ndarray, seed: np.ndarray, w: np.ndarray, p: np.ndarray, visited: int) -> np.ndarray:
    """Positive share of the leaf of every point; all nodes of a level at once."""
    n, m = x.shape
    share, rows = np.zeros(n), np.arange(n)
    _, first, node = np.unique(node, return_index=True, return_inverse=True)
    seed = seed[first]
    while len(rows):
        k = len(seed)
        total, pos = np.bincount(node, w[rows], k), np.bincount(node, p[rows], k)
        score, cut = np.full((m, k), -np.inf), np.zeros((m, k))
        live = w[rows] > 0
        for f in range(m):
            at, code = rows[live], node[live]
            order = np.lexsort((x[at, f], code))
            at, code, v = at[order], code[order], x[at[order], f]
            new = np.append(True, (code[1:] != code[:-1]) | (v[1:] != v[:-1]))
            start = np.flatnonzero(new)
            code, v = code[start], v[start]
            below_w, below_p = (np.cumsum(np.add.reduceat(a[at], start)) for a in (w, p)) if len(at) else (np.zeros(0),) * 2
            before = np.searchsorted(code, np.arange(k))  # first value of each node
            base_w, base_p = (np.append(0, a)[before] for a in (below_w, below_p))
            last = np.append(code[1:] != code[:-1], True)[: len(code)]
            i = np.flatnonzero(~last)
            if not len(i):
                continue
            c = code[i]
            w1, p1 = (below_w[i] - base_w[c]).astype(float), (below_p[i] - base_p[c]).astype(float)
            w2, p2 = total[c] - w1, pos[c] - p1
            q1, q2 = w1 - p1, w2 - p2
            s = (p1 * p1 + q1 * q1) / w1 + (p2 * p2 + q2 * q2) / w2
            best = np.full(k, -np.inf)
            np.maximum.at(best, c, s)
            top = np.flatnonzero(s == best[c])[::-1]  # the smallest threshold is set last
            score[f], cut[f][c[top]] = best, (v[i[top]] + v[i[top] + 1]) / 2
        turn = (np.arange(m)[:, None] - (seed % m) * (visited < m)) % m
        valid = np.isfinite(score)
        inside = valid & (turn < visited)
        rank = np.where(inside, 0, np.where(valid, 1 + turn, 2 * m + 2))  # features beyond those visited: in turn
        value = np.where(inside, score, 0.0)
        chosen = np.zeros(k, np.int64)
        for f in range(1, m):
            a, b = (f, np.arange(k)), (chosen, np.arange(k))
            better = (rank[a] < rank[b]) | ((rank[a] == rank[b]) & inside[a] & ((value[a] > value[b]) | ((value[a] == value[b]) & (turn[a] < turn[b]))))
            chosen = np.where(better, f, chosen)
        leaf = (pos == 0) | (pos == total) | ~valid.any(axis=0)
        done = leaf[node]
        share[rows[done]] = (pos / np.maximum(total, 1))[node[done]]
        rows, node = rows[~done], node[~done]
        f = chosen[node]
        side = (x[rows, f] > cut[f, node]).astype(np.int64)
        code, node = np.unique(node * 2 + side, return_inverse=True)
        seed = child_seed(seed[code // 2], code % 2)
    return share


def _finish_small(nodes: DataFrame, xs: list[str], visited: int) -> DataFrame:
    """(fit, x..., test, share) of the points of small nodes, many to a task."""
    n = nodes.count()
    units = max(1, -(-n // TASK))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        node = pdf.groupby(NODE, sort=False).ngroup().to_numpy()
        share = finish(pdf[xs].to_numpy(float), node, pdf["seed"].to_numpy(), pdf["w"].to_numpy(), pdf["p"].to_numpy(), visited)
        return pdf[[*FIT, *xs, "test"]].assign(share=share)

    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*FIT, *xs, "test"]) + ", share double"
    unit = F.pmod(F.xxhash64(*NODE), F.lit(units))
    return nodes.withColumn("unit", unit).groupBy("unit").applyInPandas(run, schema)


def _best_splits(big: DataFrame, stats: DataFrame, xs: list[str], visited: int) -> DataFrame:
    """(node, feature, cut) of every large node that can split."""
    m = len(xs)
    values = big.where("w > 0").select(*NODE, "w", "p", F.posexplode(F.array(*xs)).alias("feature", "v"))
    hist = values.groupBy(*NODE, "feature", "v").agg(F.sum("w").alias("w"), F.sum("p").alias("p"))
    hist = materialize(hist.repartitionByRange(*NODE, "feature", "v").withColumn("_b", F.spark_partition_id()), "tree-histogram")
    g = [*NODE, "feature"]
    # one row per node, feature and partition that it touches
    part = hist.groupBy(*g, "_b").agg(F.sum("w").alias("_w"), F.sum("p").alias("_p"), F.min("v").alias("_v"))
    order = Window.partitionBy(*g).orderBy("_b")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    part = part.select(*g, "_b", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_w"), F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_p"), F.lead("_v").over(order).alias("_v"))
    inside = Window.partitionBy(*g, "_b").orderBy("v")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    x = hist.join(part, [*g, "_b"]).select(*g, "v", (F.col("_w") + F.sum("w").over(upto)).cast("double").alias("w1"), (F.col("_p") + F.sum("p").over(upto)).cast("double").alias("p1"), F.coalesce(F.lead("v").over(inside), "_v").alias("next"))
    x = x.where("next is not null").join(stats.select(*NODE, F.col("w").cast("double").alias("w0"), F.col("p").cast("double").alias("p0")), NODE)
    x = x.withColumns({"w2": F.expr("w0 - w1"), "p2": F.expr("p0 - p1"), "q1": F.expr("w1 - p1")}).withColumn("q2", F.expr("w2 - p2"))
    x = x.withColumn("score", F.expr("(p1 * p1 + q1 * q1) / w1 + (p2 * p2 + q2 * q2) / w2")).withColumn("cut", F.expr("(v + next) / 2"))
    best = x.groupBy(*g).agg(F.max_by("cut", F.struct("score", -F.col("cut"))).alias("cut"), F.max("score").alias("score"))
    start = F.col("seed") % m if visited < m else F.lit(0)
    turn = F.pmod(F.col("feature") - start, F.lit(m))
    key = F.struct((turn < visited).cast("int"), F.when(turn < visited, F.col("score")).otherwise(-turn.cast("double")), -turn)
    return best.groupBy(*NODE).agg(F.max_by(F.struct("feature", "cut"), key).alias("split")).select(*NODE, "split.feature", "split.cut")


def leaf_shares(points: DataFrame, n_features: int, visited: int) -> DataFrame:
    """(fit, x..., test, share) of every point: positive share of its leaf."""
    xs = [f"x{k}" for k in range(n_features)]
    out: list[DataFrame] = []
    state = materialize(points, "tree-points")
    while True:
        stats = state.groupBy(*NODE).agg(F.sum("w").alias("w"), F.sum("p").alias("p"), F.count("*").alias("rows"))
        large = materialize(stats.where(F.col("rows") > SMALL), "tree-nodes")
        none = large.isEmpty()
        small = state if none else state.join(large.select(*NODE), NODE, "left_anti")
        out.append(materialize(_finish_small(small, xs, visited), "tree-leaves"))
        if none:
            return _union(out)
        big = state.join(large.select(*NODE, F.col("w").alias("_w"), F.col("p").alias("_p")), NODE)
        splits = materialize(_best_splits(state.join(large.where("p > 0 and p < w").select(*NODE), NODE), large, xs, visited), "tree-splits")
        moved = big.join(splits, NODE, "left")
        ends = moved.where("cut is null or _p = 0 or _p = _w")
        out.append(materialize(ends.select(*FIT, *xs, "test", (F.col("_p") / F.greatest("_w", F.lit(1))).alias("share")), "tree-leaves"))
        side = (F.get(F.array(*xs), F.col("feature")) > F.col("cut")).cast("long")
        moved = moved.where("cut is not null and _p > 0 and _p < _w").select(
            *FIT, F.concat("path", side.cast("string")).alias("path"), child_seed(F.col("seed"), side).alias("seed"), *xs, "w", "p", "test"
        )
        state = materialize(moved, "tree-points")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _predictions(folded: DataFrame, shares: DataFrame, features: Sequence[str], label: str, model: str) -> DataFrame:
    """One row per held-out row, from (cutoff, fold, x..., score) of its point."""
    at = {f"x{k}": F.round(F.col(f).cast("double"), 6) for k, f in enumerate(features)}
    rows = folded.withColumns(at).join(shares, ["cutoff", "fold", *at])
    return rows.select(
        "cutoff", F.lit(model).alias("model"), "fold", *E, F.col(label).cast("long").alias("label"),
        (F.col("score") > 0.5).cast("long").alias("prediction"), "score",
    )


def decision_tree_predictions(folded: DataFrame, features: Sequence[str], label: str = "target_at_risk", n_folds: int = 5) -> DataFrame:
    """M2: out-of-fold predictions of one fully grown tree per cutoff and fold."""
    shares = leaf_shares(fit_points(folded, features, label, n_folds), len(features), len(features))
    shares = shares.where("test").select("cutoff", F.col("held_out").alias("fold"), *(f"x{k}" for k in range(len(features))), F.col("share").alias("score"))
    return _predictions(folded, shares, features, label, "DecisionTreeClassifier")


def _chunks(trees: int) -> Iterator[list[int]]:
    for a in range(0, trees, TREES_AT_ONCE):
        yield list(range(a, min(trees, a + TREES_AT_ONCE)))


def random_forest_predictions(folded: DataFrame, features: Sequence[str], label: str = "target_at_risk", n_folds: int = 5, trees: int = 200, seed: int = 42) -> DataFrame:
    """M4: mean leaf share over ``trees`` trees, each on Poisson bootstrap
    weights, with the root of the number of features visited per node."""
    xs, visited = [f"x{k}" for k in range(len(features))], max(1, math.isqrt(len(features)))
    sums = []
    for some in _chunks(trees):
        points = fit_points(folded, features, label, n_folds, bootstrap_weight(F.col("tree"), seed), some)
        shares = leaf_shares(points, len(features), visited).where("test")
        sums.append(materialize(shares.groupBy("cutoff", F.col("held_out").alias("fold"), *xs).agg(F.sum(F.col("share").cast("decimal(38,18)")).alias("s")), "forest-sums"))
    score = _union(sums).groupBy("cutoff", "fold", *xs).agg((F.sum("s") / F.lit(trees)).cast("double").alias("score"))
    return _predictions(folded, score, features, label, "RandomForestClassifier")
