"""The kernel dual of fits with many variables, by Newton steps on the primal.

The hinge is rounded off within ``tolerance / 4`` of its corner.  At the least
value of that primal, alpha = cap * slope of the hinge solves the dual to half the
tolerance, whatever the number of variables: a variable that can still move lies
within the rounded part, so no pair violates the conditions by more than its width.

The kernel is written as phi . phi over pivots among the points (a pivoted Cholesky
factor: found a partition at a time, then among the partitions' pivots) until what
it misses of any kernel value is too little to move a decision value by an eighth
of the tolerance.  A Newton step is one aggregate over the points: every task keeps
a gradient and a Hessian of the pivots' size per fit, and writes nothing per point.
The rounded part narrows from step to step.  Fits whose kernel needs more than
``MOST_PIVOTS`` pivots, or which do not settle, keep their state: the caller solves
them exactly by rounds of working sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.session import materialize

FIT = ["cutoff", "held_out"]
MOST_PIVOTS = 1024
BLOCK = 2048  # points whose kernel rows a task holds
FIRST_WIDTH, NARROWER = 4.0, 4.0
PASSES = 500
STEPS = 2.0 ** -np.arange(41)
RIDGE = 1e-3  # on the intercept, which no point may hold


@dataclass
class Model:
    """A fit on its way: the decision function is phi . w[:-1] + w[-1]."""

    gamma: float
    caps: float
    points: np.ndarray  # pivots
    factor: np.ndarray  # kernel with the pivots @ factor = phi
    w: np.ndarray
    width: float = FIRST_WIDTH
    step: np.ndarray | None = None
    slope: float = 0.0  # along step, at w
    missed: float = 0.0
    settled: bool = False
    regular: np.ndarray = field(init=False)

    def __post_init__(self):
        self.regular = np.ones(len(self.w))
        self.regular[-1] = 0


def kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    return np.exp(-gamma * np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T, 0))


def pivots(blocks: Iterable[np.ndarray], gamma: float, missed: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Points and factor so that every point's own kernel value, 1, is met to
    ``missed``, or ``most`` points. Blocks come one after the other."""
    points, lower = None, np.zeros((0, 0))
    for z in blocks:
        points = z[:0] if points is None else points
        have = len(points)
        phi = np.zeros((len(z), max(64, 2 * have)))
        if have:
            phi[:, :have] = kernel(z, points, gamma) @ np.linalg.inv(lower).T
        rest = 1 - (phi * phi).sum(axis=1)
        rows, k = [], have
        while k < most and rest.max() > missed:
            i = int(np.argmax(rest))
            if k == phi.shape[1]:
                phi = np.hstack([phi, np.zeros_like(phi)])
            column = (kernel(z, z[i : i + 1], gamma)[:, 0] - phi[:, :k] @ phi[i, :k]) / np.sqrt(rest[i])
            phi[:, k] = column
            rest = rest - column * column
            rest[i] = 0
            rows.append(i)
            k += 1
        if rows:
            grown = np.zeros((k, k))
            grown[:have, :have] = lower
            grown[have:] = np.tril(phi[rows, :k], have)
            points, lower = np.vstack([points, z[rows]]), grown
    return points, np.linalg.inv(lower).T


def hinge_slope(t: np.ndarray, width: float) -> np.ndarray:
    """Slope of max(t, 0), rounded off within width / 2."""
    return np.clip(t / width + 0.5, 0, 1)


def _by_fit(batches: Iterable[pa.RecordBatch], columns: list[str], wanted) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Blocks of at most ``BLOCK`` rows of one fit."""
    for batch in batches:
        pdf = pa.Table.from_batches([batch]).select(columns).to_pandas()
        for fit, mine in pdf.groupby(FIT, sort=False):
            if fit in wanted:
                for s in range(0, len(mine), BLOCK):
                    yield fit, mine.iloc[s : s + BLOCK]


def _pivots_of(state: DataFrame, zs: list[str], fits: dict[tuple, tuple[float, float, float]]) -> dict[tuple, Model]:
    """A model per fit: pivots of each partition, then pivots among these."""
    kinds = {f.name: f.dataType.simpleString() for f in state.schema}
    columns, most = [*FIT, *zs], MOST_PIVOTS
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns)

    def of_partition(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, tuple] = {}
        for fit, mine in _by_fit(batches, columns, fits):
            gamma, missed, _ = fits[fit]
            z = mine[zs].to_numpy()
            if fit in found:  # the points that the pivots so far miss
                points, factor = found[fit]
                phi = kernel(z, points, gamma) @ factor
                far = 1 - (phi * phi).sum(axis=1) > missed
                if not far.any() or len(points) >= most:
                    continue
                z = z[far]
                found[fit] = pivots([points, z], gamma, missed, most)
            else:
                found[fit] = pivots([z], gamma, missed, most)
        for (cutoff, held_out), (points, _) in found.items():
            out = pd.DataFrame(points, columns=zs).assign(cutoff=cutoff, held_out=held_out)
            yield pa.RecordBatch.from_pandas(out[columns], preserve_index=False)

    def of_fit(pdf: pd.DataFrame) -> pd.DataFrame:
        # a fit has at most MOST_PIVOTS rows of each partition here
        pdf = pdf.sort_values(zs)
        gamma, missed, _ = fits[pdf["cutoff"].iloc[0], pdf["held_out"].iloc[0]]
        z = pdf[zs].to_numpy()
        points, factor = pivots((z[s : s + BLOCK] for s in range(0, len(z), BLOCK)), gamma, missed, most)
        return pd.DataFrame({"cutoff": pdf["cutoff"].iloc[:1], "held_out": pdf["held_out"].iloc[:1], "points": [np.ascontiguousarray(points).tobytes()], "factor": [np.ascontiguousarray(factor).tobytes()]})

    found = state.select(*columns).mapInArrow(of_partition, schema).groupBy(*FIT).applyInPandas(of_fit, ", ".join(f"{c} {kinds[c]}" for c in FIT) + ", points binary, factor binary")
    models = {}
    for r in found.collect():  # fits
        gamma, _, caps = fits[r.cutoff, r.held_out]
        points = np.frombuffer(r.points).reshape(-1, len(zs))
        models[r.cutoff, r.held_out] = Model(gamma, caps, points, np.frombuffer(r.factor).reshape(len(points), -1), np.zeros(len(points) + 1))
    return models


def _pass(state: DataFrame, zs: list[str], models: dict[tuple, Model]) -> list:
    """Per fit: what phi misses, and at w + step the gradient, the Newton step from
    there and the slopes along step for ``STEPS``."""
    columns = [*FIT, *zs, "y", "cap"]
    kinds = {f.name: f.dataType.simpleString() for f in state.schema}
    keys = ", ".join(f"{c} {kinds[c]}" for c in FIT)

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, list] = {}
        for fit, mine in _by_fit(batches, columns, models):
            m = models[fit]
            y, cap = mine["y"].to_numpy(float), mine["cap"].to_numpy()
            phi = kernel(mine[zs].to_numpy(), m.points, m.gamma) @ m.factor
            missed = (1 - (phi * phi).sum(axis=1)).max()
            trained = ~np.isnan(y)
            y, cap, phi = y[trained], cap[trained], np.column_stack([phi[trained], np.ones(int(trained.sum()))])
            t, slopes = 1 - y * (phi @ m.w), np.zeros(len(STEPS))
            if m.step is not None:
                change = -y * (phi @ m.step)
                slopes = ((cap * change)[:, None] * hinge_slope(t[:, None] + change[:, None] * STEPS, m.width)).sum(axis=0)
                t = t + change
            gradient = -phi.T @ (cap * y * hinge_slope(t, m.width))
            inside = np.abs(t) < m.width / 2
            free = phi[inside] * np.sqrt(cap[inside] / m.width)[:, None]
            parts = [gradient, free.T @ free, slopes]
            if fit in total:
                total[fit] = [max(total[fit][0], missed), *(a + b for a, b in zip(total[fit][1:], parts))]
            else:
                total[fit] = [missed, *parts]
        for (cutoff, held_out), (missed, *parts) in total.items():
            out = pd.DataFrame({"cutoff": [cutoff], "held_out": [held_out], "missed": [missed], "sums": [np.concatenate([p.ravel() for p in parts]).tobytes()]})
            yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    def newton(pdf: pd.DataFrame) -> pd.DataFrame:
        m = models[pdf["cutoff"].iloc[0], pdf["held_out"].iloc[0]]
        n = len(m.w)
        total = np.zeros(n + n * n + len(STEPS))
        for s in sorted(pdf["sums"]):  # a row a partition that has points of the fit
            total += np.frombuffer(s)
        gradient, hessian, slopes = total[:n], total[n : n + n * n].reshape(n, n), total[n + n * n :]
        at = m.w if m.step is None else m.w + m.step
        gradient = gradient + m.regular * at
        hessian = hessian + np.diag(np.where(m.regular > 0, 1.0, RIDGE))
        if m.step is not None:
            slopes = slopes + ((m.regular * m.w) @ m.step + STEPS * ((m.regular * m.step) @ m.step))
        answer = np.concatenate([gradient, -np.linalg.solve(hessian, gradient), slopes])
        return pd.DataFrame({"cutoff": pdf["cutoff"].iloc[:1], "held_out": pdf["held_out"].iloc[:1], "missed": [pdf["missed"].max()], "sums": [answer.tobytes()]})

    schema = f"{keys}, missed double, sums binary"
    return state.select(*columns).mapInArrow(sums, schema).groupBy(*FIT).applyInPandas(newton, schema).collect()  # fits


def _advance(m: Model, missed: float, answer: np.ndarray, tolerance: float) -> None:
    n = len(m.w)
    gradient, direction, slopes = answer[:n], answer[n : 2 * n], answer[2 * n :]
    m.missed = missed
    if m.step is not None:
        if slopes[0] > 0.5 * abs(m.slope):  # beyond the least value: where the slope changes its sign
            k = int(np.argmax(slopes <= 0)) if (slopes <= 0).any() else len(STEPS) - 1
            low, high = slopes[k], slopes[k - 1]
            s = STEPS[k] + ((STEPS[k - 1] - STEPS[k]) * -low / (high - low) if low <= 0 else 0)
            m.w, m.step = m.w + s * m.step, None
            return
        m.w, m.step = m.w + m.step, None
    last = m.width <= tolerance / 2
    if np.linalg.norm(gradient) <= (tolerance / 100 if last else max(tolerance / 100, 1e-6 * m.caps)):
        m.settled = last
        m.width = max(tolerance / 2, m.width / NARROWER)
    else:
        m.step, m.slope = direction, float(gradient @ direction)


def _with_solution(state: DataFrame, zs: list[str], models: dict[tuple, Model], tolerance: float) -> DataFrame:
    """alpha and u of the settled fits' rows."""
    names = state.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = pa.Table.from_batches([batch]).select([*FIT, *zs, "y", "cap", "alpha", "u"]).to_pandas()
            u, alpha = pdf["u"].to_numpy().copy(), pdf["alpha"].to_numpy().copy()
            for fit, rows in pdf.groupby(FIT, sort=False).indices.items():
                if fit in models:
                    m = models[fit]
                    for s in range(0, len(rows), BLOCK):
                        r = rows[s : s + BLOCK]
                        mine = pdf.iloc[r]
                        y, cap = mine["y"].to_numpy(float), mine["cap"].to_numpy()
                        u[r] = kernel(mine[zs].to_numpy(), m.points, m.gamma) @ m.factor @ m.w[:-1]
                        slope = hinge_slope(1 - y * (u[r] + m.w[-1]), tolerance / 2)
                        alpha[r] = np.where(np.isnan(y), 0.0, cap * slope)
            cols = {n: batch.column(n) for n in names} | {"u": pa.array(u), "alpha": pa.array(alpha)}
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)

    return state.mapInArrow(run, state.schema)


def smooth_solution(state: DataFrame, zs: list[str], fits: dict[tuple, tuple[float, float]], tolerance: float) -> DataFrame:
    """The state with alpha and u of these fits, (gamma, sum of caps) each, at the
    solution to half the tolerance; fits that do not settle are left as they are."""
    spark = state.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # by fit, so that a task holds the sums of few
    state = materialize(state.repartitionByRange(n, *FIT, *zs), "svc-ranges")
    enough = {fit: max(tolerance / (8 * caps), 1e-12) for fit, (_, caps) in fits.items()}
    models = _pivots_of(state, zs, {fit: (gamma, enough[fit] / 16, caps) for fit, (gamma, caps) in fits.items()})
    left = {fit: m for fit, m in models.items() if len(m.points) < MOST_PIVOTS}
    for _ in range(PASSES):
        for r in _pass(state, zs, left):
            _advance(left[r.cutoff, r.held_out], r.missed, np.frombuffer(r.sums), tolerance)
        left = {fit: m for fit, m in left.items() if not m.settled and m.missed * m.caps <= tolerance / 4}
        if not left:
            break
    good = {fit: m for fit, m in models.items() if m.settled}
    return _with_solution(state, zs, good, tolerance) if good else state
