"""Validation and leakage guards.

Two forms: raising guards (run before training or writing; each is one
aggregate job with an early exit) and result tables (one row per cutoff or
per column, from a single grouped pass over the matrix).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.columns import target_from_map
from cohortflow.schemas import (
    ENTITY_KEY,
    EXCLUDED_PREDICTORS,
    FORBIDDEN_COLUMNS,
    REQUIRED_BASELINE_FEATURES,
    TARGET_MAP,
)

E = ENTITY_KEY
KEYS = ("cutoff", "cutoff_day")


class GuardError(ValueError):
    pass


# ---------------------------------------------------------------- raising guards


def require_columns(df: DataFrame, required: Iterable[str], what: str = "matrix") -> None:
    """V4."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise GuardError(f"{what} is missing required columns: {missing}")


def forbid_columns(df: DataFrame, forbidden: Iterable[str] = FORBIDDEN_COLUMNS, what: str = "matrix") -> None:
    """V2."""
    present = [c for c in forbidden if c in df.columns]
    if present:
        raise GuardError(f"{what} contains leakage columns: {present}")


def guard_predictors(features: Sequence[str], excluded: Iterable[str] = EXCLUDED_PREDICTORS) -> None:
    """V9: a predictor list must not contain keys, outcomes or targets."""
    leaked = sorted(set(features) & set(excluded))
    if leaked:
        raise GuardError(f"feature set includes excluded columns: {leaked}")


def guard_no_duplicate_keys(df: DataFrame, key: Sequence[str] = ("cutoff", *E), what: str = "matrix") -> None:
    """V1 (raising form)."""
    bad = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if bad:
        raise GuardError(f"{what} has duplicated base keys, e.g. {bad[0].asDict()}")


def guard_finite(df: DataFrame, columns: Sequence[str], what: str = "matrix") -> None:
    """V7: no missing or non-finite values in the predictor columns."""
    checks = []
    for c in columns:
        x = F.col(c)
        bad = x.isNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            bad = bad | F.isnan(x) | (F.abs(x) == float("inf"))
        checks.append(F.count_if(bad).alias(c))
    row = df.agg(*checks).first().asDict()
    offenders = {k: v for k, v in row.items() if v}
    if offenders:
        raise GuardError(f"{what} has missing or non-finite feature values: {offenders}")


def guard_labels(
    df: DataFrame, result: str = "final_result", target: str = "target_at_risk", mapping: Mapping[str, int] = TARGET_MAP
) -> None:
    """V6: label domain, no missing label, target equals the mapping, target
    binary. One aggregate."""
    row = label_domain(df, result, target, mapping).agg(
        *[F.sum(c).alias(c) for c in ("unknown_results", "missing_results", "target_mismatches", "non_binary_targets")]
    ).first()
    problems = {k: v for k, v in row.asDict().items() if v}
    if problems:
        raise GuardError(f"label checks failed: {problems}")


# ---------------------------------------------------------------- result tables


def label_domain(
    df: DataFrame, result: str = "final_result", target: str = "target_at_risk", mapping: Mapping[str, int] = TARGET_MAP
) -> DataFrame:
    """V6 + D4 + F4 per cutoff: values outside the label map, missing
    labels, rows where the target differs from the mapped label, non-binary
    targets."""
    mapped = target_from_map(result, mapping)
    r, y = F.col(result), F.col(target)
    return df.groupBy("cutoff").agg(
        F.count_if(r.isNotNull() & ~r.isin(*mapping)).cast("long").alias("unknown_results"),
        F.count_if(r.isNull()).cast("long").alias("missing_results"),
        F.count_if(~y.eqNullSafe(mapped)).cast("long").alias("target_mismatches"),
        F.count_if(y.isNull() | ~y.isin(0, 1)).cast("long").alias("non_binary_targets"),
    )


def flag_binary(df: DataFrame, suffix: str = "_missing") -> DataFrame:
    """V5: per cutoff and flag column, the count of values outside {0, 1}."""
    flags = [c for c in df.columns if c.endswith(suffix)]
    agg = df.groupBy("cutoff").agg(
        *[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(0, 1)).cast("long").alias(c) for c in flags]
    )
    return agg.unpivot("cutoff", flags, "column", "non_binary_count")


def late_registration(df: DataFrame, day: str = "date_registration") -> DataFrame:
    """Rows registered after the cutoff day (reported, not dropped)."""
    return df.groupBy("cutoff", "cutoff_day").agg(
        F.count_if(F.col(day) > F.col("cutoff_day")).cast("long").alias("registered_after_cutoff")
    )


def _after_cutoff(cols: Sequence[str]) -> Column:
    """Names of the date columns with any value after the cutoff, from the
    per-key maxima ``_max_<col>`` of the first aggregation level."""
    names = [F.when(F.count_if(F.col(f"_max_{c}") > F.col("cutoff_day")) > 0, F.lit(c)) for c in cols]
    return F.concat_ws(", ", *names)


_DATE_COLS = ["last_activity_date_until_cutoff", "first_activity_date_until_cutoff"]


def _per_key(df: DataFrame, extra: Sequence[Column]) -> DataFrame:
    """First level: one row per (cutoff, entity), the key the matrix is
    already partitioned by (no shuffle). Duplicate keys show up as n > 1."""
    return df.groupBy("cutoff", *E).agg(
        F.max("cutoff_day").alias("cutoff_day"),
        F.count(F.lit(1)).alias("_n"),
        *[F.max(c).alias(f"_max_{c}") for c in _DATE_COLS],
        *extra,
    )


def _dup_rows() -> Column:
    return F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("long").alias(
        "duplicated_base_key_rows"
    )


def validation_stage3(stage3: DataFrame, columns_per_cutoff: Mapping[str, int]) -> DataFrame:
    """V10 (Stage 3): one row per cutoff from a two-level aggregate (one read
    of the matrix). ``columns_per_cutoff`` is the schema width of each
    cutoff's matrix (observed activity types differ)."""
    data_cols = [c for c in stage3.columns if c not in KEYS]
    widths = F.create_map(*[x for k, v in columns_per_cutoff.items() for x in (F.lit(k), F.lit(v).cast("long"))])
    y = F.col("target_withdrawn")
    forbidden = ", ".join(c for c in FORBIDDEN_COLUMNS if c in stage3.columns)
    first = _per_key(
        stage3,
        [
            F.count_if(y == 0).alias("_y0"),
            F.count_if(y == 1).alias("_y1"),
            *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(data_cols)],
        ],
    )
    nonzero = [(F.sum(f"_null_{i}") > 0).cast("long") for i in range(len(data_cols))]
    out = first.groupBy("cutoff").agg(
        F.max("cutoff_day").alias("cutoff_day"),
        F.sum("_n").cast("long").alias("rows"),
        _dup_rows(),
        F.concat(F.lit("0: "), F.sum("_y0").cast("string"), F.lit(", 1: "), F.sum("_y1").cast("string")).alias(
            "target_distribution"
        ),
        sum(nonzero[1:], nonzero[0]).alias("missing_columns_nonzero"),
        _after_cutoff(_DATE_COLS).alias("after_cutoff_feature_violations"),
    )
    return out.select(
        *KEYS,
        "rows",
        widths[F.col("cutoff")].alias("columns"),
        "duplicated_base_key_rows",
        "target_distribution",
        "missing_columns_nonzero",
        F.lit(forbidden).alias("forbidden_columns_present"),
        "after_cutoff_feature_violations",
    )


def validation_baseline(baseline: DataFrame) -> DataFrame:
    """V10 (baseline) + V5 + V13: one row per cutoff from a two-level
    aggregate (one read of the matrix)."""
    data_cols = [c for c in baseline.columns if c not in KEYS]
    flags = [c for c in data_cols if c.endswith("_missing")]
    missing_final = ", ".join(c for c in REQUIRED_BASELINE_FEATURES if c not in baseline.columns)
    non_mean = ", ".join(
        c
        for c in data_cols
        if (c.startswith("clicks_activity_") or c.startswith("total_click_")) and not c.endswith("_mean_strategy")
    )
    nulls = [F.count_if(F.col(c).isNull()) for c in data_cols]
    first = _per_key(
        baseline,
        [
            F.sum("target_at_risk").alias("_y"),
            F.sum("is_retake").alias("_r"),
            sum(nulls[1:], nulls[0]).alias("_nulls"),
            *[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(0, 1)).alias(f"_nb_{i}") for i, c in enumerate(flags)],
        ],
    )
    non_binary = [F.when(F.sum(f"_nb_{i}") > 0, F.lit(c)) for i, c in enumerate(flags)]
    out = first.groupBy("cutoff").agg(
        F.max("cutoff_day").alias("cutoff_day"),
        F.sum("_n").cast("long").alias("rows"),
        _dup_rows(),
        F.round(F.sum("_y") / F.sum("_n"), 6).alias("target_at_risk_positive_rate"),
        F.concat_ws(", ", *non_binary).alias("non_binary_missing_flags"),
        _after_cutoff(_DATE_COLS).alias("after_cutoff_feature_violations"),
        F.round(F.sum("_r") / F.sum("_n"), 6).alias("is_retake_positive_rate"),
        F.sum("_nulls").cast("long").alias("remaining_missing_cells"),
    )
    return out.select(
        *KEYS,
        "rows",
        F.lit(len(data_cols)).cast("long").alias("columns"),
        F.lit("date_unregistration" in baseline.columns).alias("date_unregistration_present"),
        "duplicated_base_key_rows",
        "target_at_risk_positive_rate",
        F.lit(len(flags)).cast("long").alias("missing_flag_columns"),
        "non_binary_missing_flags",
        "after_cutoff_feature_violations",
        F.lit(missing_final).alias("missing_final_features"),
        F.lit(non_mean).alias("non_mean_strategy_click_columns"),
        "is_retake_positive_rate",
        "remaining_missing_cells",
    )


def missing_by_column(df: DataFrame) -> DataFrame:
    """V8: per cutoff and column, missing cells left (nonzero only)."""
    cols = [c for c in df.columns if c not in KEYS]
    agg = df.groupBy("cutoff").agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in cols])
    return agg.unpivot("cutoff", cols, "column", "missing_count").where("missing_count > 0")


def with_roles(df: DataFrame, predictors: Sequence[str], target: str = "target_at_risk") -> DataFrame:
    """V9: record each column's role in the schema metadata."""
    roles = {}
    for c in df.columns:
        if c in ("cutoff", "cutoff_day", *E):
            roles[c] = "key"
        elif c == target:
            roles[c] = "target"
        elif c in predictors:
            roles[c] = "predictor"
        else:
            roles[c] = "analysis_only"
    return df.select(*[F.col(c).alias(c, metadata={"role": roles[c]}) for c in df.columns])


# P9 lists the course codes as categorical predictors; only the student id,
# the outcome and the targets are excluded for it. The strict two-feature
# replication uses the full EXCLUDED_PREDICTORS list.
RECOMMENDED_EXCLUSIONS = ["id_student", "final_result", "target_withdrawn", "target_at_risk"]


def predictor_matrix(
    baseline: DataFrame,
    predictors: Sequence[str],
    target: str = "target_at_risk",
    excluded: Iterable[str] = EXCLUDED_PREDICTORS,
) -> DataFrame:
    """P8 + P9 + V9: keys, target and the guarded predictor columns."""
    guard_predictors(predictors, excluded)
    require_columns(baseline, [*predictors, target], "baseline matrix")
    forbid_columns(baseline)
    extra = [c for c in predictors if c not in (*KEYS, *E)]
    return with_roles(baseline.select(*KEYS, *E, target, *extra), predictors, target)
