"""RBF support vector classifier: the exact dual, all folds of all cutoffs at once.

A row of the state is a dual variable: a distinct scaled training point of one
label, with the box [0, C * copies] (equal points share one variable exactly), its
alpha and u = sum of alpha y K over all variables.  Held-out points are rows with
an empty box; their u is their decision value.

A fit of more than ``WORKING_SET`` variables of two labels starts from the solution
that ``svc_smooth`` finds in passes over them, which mostly leaves no round to do.
Each round takes the ``WORKING_SET`` variables of every fit that violate the
optimality conditions most, solves the dual over them to the tolerance (sequential
minimal optimisation with second-order pairs; the other alphas stand still), and
adds what changed to every u.  Rounds end when no pair of variables of any fit
violates the conditions by more than ``tolerance``: the whole dual is solved then,
however many support vectors there are.  A round moves at most ``WORKING_SET``
rows a fit to one task and to the driver; the rest is one pass over the state.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.operators import svc_smooth
from cohortflow.schemas import ENTITY_KEY
from cohortflow.session import materialize

E = ENTITY_KEY
FIT = ["cutoff", "held_out"]
WORKING_SET = 1024
TOLERANCE = 1e-3
PENALTY = 1.0
ROUNDS = 100_000


def scaled_variables(folded: DataFrame, features: Sequence[str], label: str, n_folds: int, penalty: float) -> tuple[DataFrame, DataFrame]:
    """(fit, x..., z..., gamma, y, cap, alpha, u) rows, y null for held-out
    points; and (fit, mean and deviation per feature, gamma).

    M9: z is scaled by the mean and population deviation of the training rows;
    gamma is 1 / (features * variance of z)."""
    m = len(features)
    xs = [f"x{k}" for k in range(m)]
    rows = folded.select("cutoff", "fold", F.when(F.col(label) == 1, 1).otherwise(-1).alias("y"), *(F.round(F.col(f).cast("double"), 6).alias(x) for f, x in zip(features, xs)))
    own = rows.withColumn("held_out", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_folds - 1).cast("long"))))
    test = F.col("fold") == F.col("held_out")
    points = materialize(own.groupBy(*FIT, *xs, F.when(~test, F.col("y")).alias("y")).agg(F.count("*").cast("double").alias("n")), "svc-points")
    train = points.where("y is not null")
    mean = lambda x: F.sum(F.col(x) * F.col("n")) / F.sum("n")
    stats = train.groupBy(*FIT).agg(*(mean(x).alias(f"m{k}") for k, x in enumerate(xs)))
    spread = lambda k, x: F.sqrt(F.sum(F.col("n") * (F.col(x) - F.col(f"m{k}")) * (F.col(x) - F.col(f"m{k}"))) / F.sum("n"))
    spreads = train.join(F.broadcast(stats), FIT).groupBy(*FIT).agg(*(spread(k, x).alias(f"s{k}") for k, x in enumerate(xs)))  # a row a fit
    varying = sum(((F.col(f"s{k}") > 0).cast("int") for k in range(m)), F.lit(0))
    stats = stats.join(spreads, FIT).withColumn("gamma", 1.0 / F.greatest(varying, F.lit(1)))
    z = [((F.col(x) - F.col(f"m{k}")) / F.when(F.col(f"s{k}") > 0, F.col(f"s{k}")).otherwise(1.0)).alias(f"z{k}") for k, x in enumerate(xs)]
    cap = F.when(F.col("y").isNotNull(), penalty * F.col("n")).otherwise(0.0)
    zero = F.lit(0.0)
    return points.join(F.broadcast(stats), FIT).select(*FIT, *xs, *z, "gamma", "y", cap.alias("cap"), zero.alias("alpha"), zero.alias("u")), stats


def solve(z: np.ndarray, y: np.ndarray, cap: np.ndarray, alpha: np.ndarray, u: np.ndarray, gamma: float, tolerance: float) -> np.ndarray:
    """New alphas of these variables; the sum of alpha y does not change."""
    square = (z * z).sum(axis=1)
    kernel = np.exp(-gamma * np.maximum(square[:, None] + square[None, :] - 2 * z @ z.T, 0))
    alpha, f = alpha.copy(), y - u
    slack = 1e-12 * np.maximum(cap, 1)
    while True:
        up = np.where(y > 0, alpha < cap - slack, alpha > slack)
        low = np.where(y > 0, alpha > slack, alpha < cap - slack)
        if not up.any() or not low.any():
            return alpha
        i = int(np.argmax(np.where(up, f, -np.inf)))
        gap = np.where(low, f[i] - f, -np.inf)
        if gap.max() <= tolerance:
            return alpha
        curve = np.maximum(2 - 2 * kernel[i], 1e-12)
        j = int(np.argmax(np.where(gap > 0, gap * gap / curve, -np.inf)))
        room_i = cap[i] - alpha[i] if y[i] > 0 else alpha[i]
        room_j = alpha[j] if y[j] > 0 else cap[j] - alpha[j]
        step = min(gap[j] / curve[j], room_i, room_j)
        # a bound that is reached is set exactly
        alpha[i] = (cap[i] if y[i] > 0 else 0.0) if step == room_i else alpha[i] + y[i] * step
        alpha[j] = (0.0 if y[j] > 0 else cap[j]) if step == room_j else alpha[j] - y[j] * step
        f -= step * (kernel[i] - kernel[j])


def _sides(state: DataFrame) -> DataFrame:
    """Variables that can move up or down, with f = y - u."""
    trained = state.where("y is not null").withColumn("f", F.col("y") - F.col("u"))
    slack = F.expr("1e-12 * greatest(cap, 1)")
    can_grow, can_shrink = F.col("alpha") < F.col("cap") - slack, F.col("alpha") > slack
    return trained.withColumns({
        "up": F.when(F.col("y") > 0, can_grow).otherwise(can_shrink), "low": F.when(F.col("y") > 0, can_shrink).otherwise(can_grow),
    })


def working_sets(state: DataFrame, open_fits: list[tuple], size: int, zs: list[str]) -> DataFrame:
    """The variables of each open fit that violate the conditions most: the
    first by f among those that can move up, the last among the others."""
    mine = reduce(lambda a, b: a | b, ((F.col("cutoff") == c) & (F.col("held_out") == h) for c, h in open_fits))
    sides = _sides(state).where(mine)
    keys = [*zs, "y"]
    ranked = lambda side, order: sides.where(side).withColumn("_r", F.row_number().over(Window.partitionBy(*FIT).orderBy(order, *keys))).where(F.col("_r") <= size // 2).drop("_r")
    return ranked("up", F.desc("f")).unionByName(ranked("low", F.asc("f"))).distinct()


def _solved(sets: DataFrame, zs: list[str], tolerance: float) -> list:
    """Changes of beta = alpha y per variable; a fit's set is one bounded group."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*zs, "y"])
        y, old = pdf["y"].to_numpy(float), pdf["alpha"].to_numpy()
        new = solve(pdf[zs].to_numpy(), y, pdf["cap"].to_numpy(), old, pdf["u"].to_numpy(), float(pdf["gamma"].iloc[0]), tolerance)
        moved = new != old
        return pdf.loc[moved, [*FIT, *zs, "gamma", "y"]].assign(alpha=new[moved], change=((new - old) * y)[moved])

    kinds = {f.name: f.dataType.simpleString() for f in sets.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*FIT, *zs, "gamma", "y"]) + ", alpha double, change double"
    return sets.groupBy(*FIT).applyInPandas(run, schema).collect()  # at most WORKING_SET rows a fit


def _moved(state: DataFrame, changes: list, zs: list[str]) -> DataFrame:
    """The state after the changes: new alphas, and every u."""
    alphas = {(r.cutoff, r.held_out, *(r[z] for z in zs), r.y): r.alpha for r in changes}
    fits: dict[tuple, list] = {}
    for r in changes:
        fits.setdefault((r.cutoff, r.held_out), []).append(([r[z] for z in zs], r.change, r.gamma))
    fits = {k: (np.array([v[0] for v in x]), np.array([v[1] for v in x]), x[0][2]) for k, x in fits.items()}
    names = state.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 2048):  # bounds the kernel block
                pdf = batch.slice(s, 2048).to_pandas()
                z, u, alpha = pdf[zs].to_numpy(), pdf["u"].to_numpy().copy(), pdf["alpha"].to_numpy().copy()
                key = list(zip(pdf["cutoff"], pdf["held_out"]))
                for fit in set(key):
                    if fit in fits:
                        mine = np.array([k == fit for k in key])
                        at, change, gamma = fits[fit]
                        d = (z[mine] ** 2).sum(axis=1)[:, None] + (at**2).sum(axis=1)[None, :] - 2 * z[mine] @ at.T
                        u[mine] += np.exp(-gamma * np.maximum(d, 0)) @ change
                for k, v in enumerate(zip(pdf["cutoff"], pdf["held_out"], *(pdf[c] for c in zs), pdf["y"])):
                    alpha[k] = alphas.get(v, alpha[k])
                part = batch.slice(s, 2048)
                cols = {n: part.column(n) for n in names} | {"u": pa.array(u), "alpha": pa.array(alpha)}
                yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)

    return state.mapInArrow(run, state.schema)


def dual_solution(state: DataFrame, n_features: int, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """The state at the optimum, and (fit, b)."""
    zs = [f"z{k}" for k in range(n_features)]
    state = materialize(state, "svc-state")
    sizes = state.where("y is not null").groupBy(*FIT).agg(F.count("*").alias("n"), F.count_distinct("y").alias("labels"), F.first("gamma").alias("gamma"), F.sum("cap").alias("caps"))
    many = sizes.where((F.col("n") > WORKING_SET) & (F.col("labels") > 1)).collect()  # fits
    if many:
        state = materialize(svc_smooth.smooth_solution(state, zs, {(r.cutoff, r.held_out): (r.gamma, r.caps) for r in many}, tolerance), "svc-state")
    for _ in range(ROUNDS):
        edges = _sides(state).groupBy(*FIT).agg(F.max(F.when(F.col("up"), F.col("f"))).alias("top"), F.min(F.when(F.col("low"), F.col("f"))).alias("bottom"))
        left = [(r.cutoff, r.held_out) for r in edges.where(F.col("top") - F.col("bottom") > tolerance).collect()]  # fits
        if not left:
            break
        changes = _solved(working_sets(state, left, WORKING_SET, zs), zs, tolerance / 2)
        state = materialize(_moved(state, changes, zs), "svc-state")
    else:
        raise RuntimeError(f"the dual is not solved after {ROUNDS} rounds")
    free = F.when(F.col("up") & F.col("low"), F.col("f"))
    bias = _sides(state).groupBy(*FIT).agg(
        F.avg(free).alias("mean"), F.max(F.when(F.col("up"), F.col("f"))).alias("top"), F.min(F.when(F.col("low"), F.col("f"))).alias("bottom")
    )
    # one class only: every decision value is its label
    return state, bias.select(*FIT, F.coalesce("mean", (F.col("top") + F.col("bottom")) / 2, "top", "bottom").alias("b"))


def svc_predictions(folded: DataFrame, features: Sequence[str], label: str = "target_at_risk", n_folds: int = 5, penalty: float = PENALTY, tolerance: float = TOLERANCE) -> DataFrame:
    """M5: out-of-fold decision values (score) and their signs."""
    xs = [f"x{k}" for k in range(len(features))]
    start, _ = scaled_variables(folded, features, label, n_folds, penalty)
    state, bias = dual_solution(start, len(features), tolerance)
    # a row a fit
    scores = state.where("y is null").join(F.broadcast(bias), FIT).select("cutoff", F.col("held_out").alias("fold"), *xs, (F.col("u") + F.col("b")).alias("score"))
    at = {x: F.round(F.col(f).cast("double"), 6) for x, f in zip(xs, features)}
    return folded.withColumns(at).join(scores, ["cutoff", "fold", *xs]).select(
        "cutoff", F.lit("SVC").alias("model"), "fold", *E, F.col(label).cast("long").alias("label"), (F.col("score") > 0).cast("long").alias("prediction"), "score",
    )
