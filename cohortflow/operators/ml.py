"""Model evaluation on Spark: stratified folds, per-fold fits, metrics.

* Folds: exact stratification (every fold gets floor or ceil of n/5 of each
  label) without a global window. Rows are ordered by a seeded arithmetic
  hash, split into hash buckets, ranked locally inside each bucket, and the
  small per-bucket count table (groups x buckets rows) supplies the offsets.
* Gaussian naive Bayes is one conditional aggregate (prior, mean, variance per
  class and held-out fold), so predictions are plain column arithmetic and an
  SQL oracle can check them.
* ROC AUC is the Mann-Whitney statistic with ties counted half, computed from
  a range-partitioned score histogram; cumulative negatives come from
  per-partition totals, so no task ever holds a whole fold.
* k-nearest neighbours is exact: each query is placed by rank on the sorted
  points of every integer value of the second feature and meets 2k of them there.
* Trees and forests are in ``trees``, the kernel classifier in ``svc``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.operators.cutoffs import day_of
from cohortflow.schemas import ENTITY_KEY
from cohortflow.session import materialize

E = ENTITY_KEY
SEED = 42
N_FOLDS = 5
FOLD_BUCKETS = 4096
HASH_PRIME = 1000003
NB_VAR_SMOOTHING = 1e-9


def seeded_hash(key: str = "id_student", seed: int = SEED) -> Column:
    """Deterministic arithmetic hash in [0, HASH_PRIME) (reproducible in
    any SQL engine)."""
    return F.pmod(F.pmod(F.col(key), F.lit(HASH_PRIME)) * 7919 + seed * 104729, F.lit(HASH_PRIME))


def assign_folds(
    df: DataFrame,
    label: str = "target_at_risk",
    group: Sequence[str] = ("cutoff",),
    n_folds: int = N_FOLDS,
    seed: int = SEED,
    buckets: int = FOLD_BUCKETS,
) -> DataFrame:
    """M1: ``fold`` column, stratified by ``label`` within ``group``.

    Global order = (hash, key); buckets are ranges of the hash, so rank =
    bucket offset + local rank whatever ``buckets`` is: it only sets how many
    pieces a (group, label) is ranked in, i.e. the parallelism and the rows of
    a window task. fold = rank mod n_folds."""
    g = [*group, label]
    x = df.withColumn("_h", seeded_hash(seed=seed)).withColumn("_b", F.floor(F.col("_h") * buckets / HASH_PRIME))
    local = Window.partitionBy(*g, "_b").orderBy("_h", *E)
    x = x.withColumn("_r", F.row_number().over(local))
    sizes = x.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    # offsets has at most (#groups x #labels x buckets) rows: a proven bound.
    x = x.join(F.broadcast(offsets), [*g, "_b"])
    return x.withColumn("fold", F.pmod(F.col("_off") + F.col("_r") - 1, F.lit(n_folds)).cast("long")).drop(
        "_h", "_b", "_r", "_off"
    )


# ---------------------------------------------------------------- Gaussian NB


def gaussian_nb_predictions(
    folded: DataFrame,
    features: Sequence[str],
    label: str = "target_at_risk",
    group: Sequence[str] = ("cutoff",),
    n_folds: int = N_FOLDS,
) -> DataFrame:
    """M3: out-of-fold Gaussian NB (population variances plus the usual
    smoothing of 1e-9 x the largest feature variance of the training set).

    All training statistics come from one conditional aggregate: per held-out
    fold and class the count, means and (two-pass-free, numerically stable)
    ``var_pop`` of the other folds; one row per group leaves the shuffle."""
    g, xs = list(group), [F.col(f).cast("double") for f in features]
    aggs = []
    for k in range(n_folds):
        other = F.col("fold") != k
        for c in (0, 1):
            mine = other & (F.col(label) == c)
            aggs.append(F.count_if(mine).alias(f"n_{k}_{c}"))
            for i, x in enumerate(xs):
                aggs += [F.avg(F.when(mine, x)).alias(f"m_{k}_{c}_{i}"), F.var_pop(F.when(mine, x)).alias(f"v_{k}_{c}_{i}")]
        aggs += [F.var_pop(F.when(other, x)).alias(f"all_{k}_{i}") for i, x in enumerate(xs)]
    stats = folded.groupBy(*g).agg(*aggs)

    def fold_params(k: int) -> Column:
        spread = [F.col(f"all_{k}_{i}") for i in range(len(xs))]
        eps = (F.greatest(*spread) if len(spread) > 1 else spread[0]) * NB_VAR_SMOOTHING
        rows = F.col(f"n_{k}_0") + F.col(f"n_{k}_1")
        cols = [F.lit(k).cast("long").alias("fold")]
        for c in (0, 1):
            cols.append((F.col(f"n_{k}_{c}") / rows).alias(f"prior_{c}"))
            for i in range(len(xs)):
                cols += [F.col(f"m_{k}_{c}_{i}").alias(f"m_{i}_{c}"), (F.col(f"v_{k}_{c}_{i}") + eps).alias(f"v_{i}_{c}")]
        return F.struct(*cols)

    # per-model parameter table: groups x folds rows (bounded)
    params = stats.select(*g, F.inline(F.array(*[fold_params(k) for k in range(n_folds)])))
    x = folded.join(F.broadcast(params), [*g, "fold"])

    def loglik(k: int) -> Column:
        total = F.log(F.col(f"prior_{k}"))
        for i, f in enumerate(features):
            v, m = F.col(f"v_{i}_{k}"), F.col(f"m_{i}_{k}")
            total = total - 0.5 * F.log(2 * math.pi * v) - (F.col(f).cast("double") - m) ** 2 / (2 * v)
        return total

    l0, l1 = loglik(0), loglik(1)
    score = 1 / (1 + F.exp(l0 - l1))
    return x.select(
        *g,
        F.lit("GaussianNB").alias("model"),
        "fold",
        *E,
        F.col(label).cast("long").alias("label"),
        (l1 > l0).cast("long").alias("prediction"),
        score.alias("score"),
    )


# ---------------------------------------------------------------- nearest neighbours


def _scale(c: str) -> Column:
    return F.when(F.col(c) > 0, F.col(c)).otherwise(F.lit(1.0))


def _home_lines(lines: DataFrame, queries: DataFrame, g: list[str], k: int) -> DataFrame:
    """(g, qr, r): per integer value that is asked for, its nearest lines up to
    the one that completes k points. Rows of values only, not of points."""
    asked = queries.select(*g, "qr").distinct()
    near = Window.partitionBy(*g, "qr").orderBy(F.abs(F.col("r") - F.col("qr")), "r")
    held = F.coalesce(F.sum("points").over(near.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return asked.join(lines, g).withColumn("held", held).where(F.col("held") < k).select(*g, "qr", "r")


def _lines_within(home: DataFrame, lines: DataFrame, homes: DataFrame, spread: DataFrame, g: list[str], k: int) -> DataFrame:
    """(g, r, qr, qv): the lines, home lines aside, that may hold a point as near
    as the query's k-th so far. A query with fewer than k has seen every line."""
    bound = home.groupBy(*g, "qr", "qv").agg(F.max("dist").alias("bound"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    bound = bound.join(F.broadcast(spread), g)
    reach = F.ceil(F.sqrt("bound") * _scale("sr")) + 1
    values = F.sequence(F.greatest("first", F.col("qr") - reach), F.least("last", F.col("qr") + reach))
    near = bound.where(F.greatest("first", F.col("qr") - reach) <= F.least("last", F.col("qr") + reach)).withColumn("r", F.explode(values))
    near = near.where(((F.col("r") - F.col("qr")) / _scale("sr")) ** 2 <= F.col("bound"))
    near = near.join(homes, [*g, "qr", "r"], "left_anti")
    return near.join(lines, [*g, "r"], "left_semi").select(*g, "r", "qr", "qv")


def _nearest(near: DataFrame, spread: DataFrame, g: list[str], k: int) -> DataFrame:
    """The k best candidates of every query, with their scaled distance."""
    near = near.join(F.broadcast(spread), g).withColumn(
        "dist", ((F.col("v") - F.col("qv")) / _scale("sv")) ** 2 + ((F.col("r") - F.col("qr")) / _scale("sr")) ** 2
    )
    best = Window.partitionBy(*g, "qr", "qv").orderBy("dist", "key", *E)
    near = near.withColumn("i", F.row_number().over(best)).where(F.col("i") <= k)
    return near.select(*g, "qr", "qv", "dist", "key", *E, "y")


def _on_lines(train: DataFrame, placed: DataFrame, g: list[str], k: int) -> DataFrame:
    """Candidates of the queries on lines, ``placed`` (g, r, qr, qv): k points to
    either side. Ranks come from range partitions with offsets, so a line with a
    third of all rows is spread over many tasks."""
    placed = placed.withColumnRenamed("qv", "v")
    # points before queries at equal values: a query's place is the points up to it
    none = F.lit(None)
    both = train.select(*g, "r", "v", F.lit(0).alias("kind"), "key", *E, "y", none.cast("long").alias("qr")).unionByName(
        placed.select(*g, "r", "v", F.lit(1).alias("kind"), none.cast("long").alias("key"), *[none.cast(train.schema[c].dataType).alias(c) for c in E], none.cast("long").alias("y"), "qr")
    )
    sorted_ = materialize(both.repartitionByRange(*g, "r", "v", "kind", "key", *E).withColumn("_b", F.spark_partition_id()), "knn-lines")
    is_point = F.when(F.col("kind") == 0, 1).otherwise(0)
    before = Window.partitionBy(*g, "r").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # one row per line and partition it touches
    offsets = sorted_.groupBy(*g, "r", "_b").agg(F.sum(is_point).alias("_n"))
    offsets = offsets.select(*g, "r", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*g, "r", "_b").orderBy("v", "kind", "key", *E).rowsBetween(Window.unboundedPreceding, 0)
    ranked = sorted_.join(offsets, [*g, "r", "_b"]).withColumn("rank", F.col("_off") + F.sum(is_point).over(inside))
    # within a point the ranks ascend by key; to its left they must descend
    size = Window.partitionBy(*g, "r", "v")
    points = ranked.where("kind = 0").select(*g, "r", "v", "key", *E, "y", "rank")
    points = points.withColumn("mirror", F.min("rank").over(size) + F.max("rank").over(size) - F.col("rank"))
    asked = ranked.where("kind = 1").select(*g, "r", F.col("v").alias("qv"), "qr", "rank")
    left = asked.withColumn("want", F.explode(F.sequence(F.col("rank") - (k - 1), F.col("rank"))))
    right = asked.withColumn("want", F.explode(F.sequence(F.col("rank") + 1, F.col("rank") + k)))
    return left.drop("rank").join(points.withColumn("want", F.col("mirror")), [*g, "r", "want"]).unionByName(
        right.drop("rank").join(points.withColumn("want", F.col("rank")), [*g, "r", "want"])
    )


def knn_predictions(
    folded: DataFrame,
    value: str,
    row: str,
    label: str = "target_at_risk",
    key: str = "id_student",
    k: int = 5,
    n_folds: int = N_FOLDS,
) -> DataFrame:
    """M6: exact out-of-fold k-nearest neighbours on two scaled features, one
    of them (``row``, here active days) an integer with few values.

    Training points of one integer value lie on a line, sorted by ``value``: the
    k nearest of a query among them are within k places of where the query
    would stand (``_on_lines``). Each distinct query visits its home lines
    first, the nearest ones that hold k points together (mostly its own): their
    k-th distance bounds the lines that are left to visit, and only those within
    it are. Every visit is an equi-join on ranks and meets at most 2k points; no
    pair of rows is formed beyond that.
    Neighbours are ordered by distance, then key; equal points keep their k
    smallest keys (a limit that is applied before the shuffle), which can never
    lose a neighbour.

    Score is the positive share of the k neighbours, prediction its majority."""
    g = ["cutoff", "held_out"]
    x = folded.select(
        "cutoff", "fold", *E, F.round(F.col(value).cast("double"), 6).alias("v"), F.col(row).cast("long").alias("r"),
        F.col(label).cast("long").alias("y"), F.col(key).alias("key"),
    )
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(n_folds - 1).cast("long")), lambda h: h != F.col("fold"))
    # the k smallest keys of each point and fold, then of each point and held-out fold
    point = Window.partitionBy("cutoff", "fold", "r", "v").orderBy("key", *E)
    top = x.withColumn("i", F.row_number().over(point)).where(F.col("i") <= k)
    top = top.select("cutoff", F.explode(others).alias("held_out"), "r", "v", "key", *E, "y")
    point = Window.partitionBy(*g, "r", "v").orderBy("key", *E)
    train = materialize(top.withColumn("i", F.row_number().over(point)).where(F.col("i") <= k), "knn-points").drop("i")
    queries = x.select("cutoff", F.col("fold").alias("held_out"), F.col("r").alias("qr"), F.col("v").alias("qv")).distinct()
    # groups x folds rows (bounded), and one row per integer value of them
    spread = x.select("cutoff", F.explode(others).alias("held_out"), "v", "r").groupBy(*g).agg(
        F.stddev_pop("v").alias("sv"), F.stddev_pop("r").alias("sr"), F.min("r").alias("first"), F.max("r").alias("last")
    )
    spread = materialize(spread, "knn-spread")
    lines = train.groupBy(*g, "r").agg(F.count(F.lit(1)).alias("points"))
    homes = materialize(_home_lines(lines, queries, g, k), "knn-homes")

    first = queries.join(homes, [*g, "qr"]).select(*g, "r", "qr", "qv")
    home = materialize(_nearest(_on_lines(train, first, g, k), spread, g, k), "knn-home")
    rest = _lines_within(home, lines, homes, spread, g, k)
    more = _nearest(_on_lines(train, rest, g, k), spread, g, k)
    best = Window.partitionBy(*g, "qr", "qv").orderBy("dist", "key", *E)
    voted = (
        home.unionByName(more).withColumn("i", F.row_number().over(best)).where(F.col("i") <= k)
        .groupBy(*g, "qr", "qv").agg(F.avg("y").alias("score"))
    )
    rows = x.join(voted.withColumnsRenamed({"held_out": "fold", "qr": "r", "qv": "v"}), ["cutoff", "fold", "r", "v"])
    return rows.select(
        "cutoff",
        F.lit("KNeighborsClassifier").alias("model"),
        "fold",
        *E,
        F.col("y").alias("label"),
        (F.col("score") > 0.5).cast("long").alias("prediction"),
        "score",
    )


# ---------------------------------------------------------------- metrics


def classification_metrics(preds: DataFrame, group: Sequence[str] = ("cutoff", "model", "fold")) -> DataFrame:
    """M7 + W4: precision, recall, F1 (positive class), accuracy and ROC AUC
    per group. ``preds`` has label (0/1), prediction (0/1), score.

    One histogram per (group, score) feeds both the confusion counts and AUC =
    sum over distinct scores of pos x (negatives below + half the negatives
    tied) / (P x N). It is range-partitioned by score and written; a partition
    is a bucket, so crowded scores make no large bucket, and "negatives below"
    is the bucket's offset plus a running sum inside the bucket."""
    g = list(group)
    y, p = F.col("label") == 1, F.col("prediction") == 1
    hist = preds.groupBy(*g, "score").agg(
        F.count_if(y).alias("pos"),
        F.count_if(~y).alias("neg"),
        F.count_if(y & p).alias("_tp"),
        F.count_if(~y & p).alias("_fp"),
    )
    hist = materialize(hist.repartitionByRange(*g, "score").withColumn("_b", F.spark_partition_id()), "score-histogram")
    # one row per group and partition: bounded by groups x shuffle partitions
    btot = hist.groupBy(*g, "_b").agg(F.sum("neg").alias("_bneg"))
    prior = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    boff = btot.withColumn("_boff", F.coalesce(F.sum("_bneg").over(prior), F.lit(0))).drop("_bneg")
    inner = Window.partitionBy(*g, "_b").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    h = hist.join(F.broadcast(boff), [*g, "_b"]).withColumn(
        "_below", F.col("_boff") + F.coalesce(F.sum("neg").over(inner), F.lit(0))
    )
    m = h.groupBy(*g).agg(
        F.sum(F.col("pos") * (F.col("_below") + 0.5 * F.col("neg"))).alias("_u"),
        F.sum("pos").alias("_p"),
        F.sum("neg").alias("_n"),
        F.sum("_tp").alias("tp"),
        F.sum("_fp").alias("fp"),
    ).withColumns({"fn": F.col("_p") - F.col("tp"), "tn": F.col("_n") - F.col("fp")})
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    return m.select(
        *g,
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0)), 6).alias("f1"),
        F.round(F.when(F.col("_p") * F.col("_n") > 0, F.col("_u") / (F.col("_p") * F.col("_n"))), 6).alias("roc_auc"),
        F.round((tp + tn) / (tp + tn + fp + fn), 6).alias("accuracy"),
    )


METRICS = ("precision", "recall", "f1", "roc_auc", "accuracy")


def metric_summary(metrics: DataFrame, n_rows: DataFrame | None = None, features: Sequence[str] = ()) -> DataFrame:
    """M8 + S7 + O4: fold mean and sample std per (cutoff, model), ordered
    by cutoff day then model."""
    out = metrics.groupBy("cutoff", "model").agg(
        *[F.round(F.avg(m), 6).alias(f"{m}_mean") for m in METRICS],
        *[F.round(F.stddev_samp(m), 6).alias(f"{m}_std") for m in METRICS],
    )
    if n_rows is not None:
        out = out.join(n_rows, "cutoff")
    out = out.orderBy(day_of(), "cutoff", "model")
    return out.withColumns(
        {
            "strategy": F.lit("mean"),
            "positive_class": F.lit("at_risk"),
            "target": F.lit("target_at_risk"),
            "features": F.lit(",".join(features)),
        }
    )
