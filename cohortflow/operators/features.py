"""Leakage-safe entity features as of several cutoff days, in one pass.

Click block: the event log is read once (``date <= max cutoff`` pushed to the
scan), collapsed to the event key (see ``collapse``), reduced to narrow rows per
(entity, band), and only those are expanded to the cutoffs, shuffled once more to
their (cutoff, entity), summed per activity and pivoted there.

Assessment block: submissions are joined to the assessment dimension once;
the "all rows" (Stage 3) and "known due date only" (baseline) rollups are
conditional aggregates over the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.columns import clean_name, false_if_null, safe_ratio
from cohortflow.operators.collapse import UNKNOWN_ACTIVITY, collapse_events, with_activity
from cohortflow.operators.joins import unique_in_plan
from cohortflow.operators.cutoffs import at_or_before, expand_by_cutoff
from cohortflow.schemas import COURSE_LOG, CUTOFFS, ENTITY_KEY, EntitySpec

E = ENTITY_KEY


# --------------------------------------------------------------------------
# activity type lists (schema-shaping; bounded by the dimension size)


def activity_type_names(vle: DataFrame, category: str = "activity_type") -> DataFrame:
    """Distinct clean names of the dimension's categories."""
    return vle.where(F.col(category).isNotNull()).select(clean_name(category).alias("activity_type")).distinct()


def dimension_activity_types(vle: DataFrame, category: str = "activity_type") -> list[str]:
    """Sorted A24 names on the driver: a schema-shaping list, one name per
    category of the dimension. Read anew on every call."""
    return sorted(r.activity_type for r in activity_type_names(vle, category).collect())


def observed_activity_types(
    log: DataFrame, vle: DataFrame, cutoffs: Mapping[str, int] = CUTOFFS, spec: EntitySpec = COURSE_LOG
) -> dict[str, list[str]]:
    """Clean activity names seen in the log by each cutoff (R1 schema).

    A second, two-column scan of the log that keeps the first day per item
    (partial aggregation, output bounded by the number of items)."""
    first_day = at_or_before(log, spec.time, cutoffs).groupBy(spec.item).agg(F.min(spec.time).alias("d"))
    rows = with_activity(first_day, vle, spec).groupBy("activity_clean").agg(F.min("d").alias("d")).collect()
    return {
        name: sorted(r.activity_clean for r in rows if r.d <= day) for name, day in cutoffs.items()
    }


def activity_column(t: str, suffix: str) -> str:
    """Pivot column of an (already clean) activity name."""
    return f"clicks_activity_{t}_{suffix}"


# --------------------------------------------------------------------------
# click block


def click_rollup(
    log: DataFrame,
    vle: DataFrame,
    cutoffs: Mapping[str, int] = CUTOFFS,
    stage3_types: Sequence[str] = (),
    baseline_types: Sequence[str] = (),
    spec: EntitySpec = COURSE_LOG,
    restrict: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per (cutoff, entity) with any event by the cutoff; ``restrict``
    leaves out (cutoff, entity) pairs before anything is counted for them.

    Columns: cutoff, cutoff_day, entity key, the Stage 3 block (sum/max
    strategies, with pivot columns for ``stage3_types``) and the baseline
    block (mean strategy, pivot columns for ``baseline_types``).

    One scan of the log. A collapsed event stands for three narrow facts: its
    clicks under (band, activity), its day, and its item with that day (a band
    is the first cutoff that sees the event). Facts are reduced per entity in
    one aggregate, so a day or an item of a busy entity is one row by then;
    only the reduced facts are expanded to the cutoffs, counted and pivoted. The
    pivot has two steps: sums per (cutoff, entity, activity), then columns. Both
    run after the last shuffle, which carries narrow rows however many activity
    types there are."""
    events = at_or_before(log.select(*spec.event_key, spec.measure), spec.time, cutoffs)
    k = with_activity(collapse_events(events, spec), vle, spec)
    t, day, item = F.col("activity_clean"), F.col(spec.time), F.col(spec.item)
    item_type, day_type = log.schema[spec.item].dataType, log.schema[spec.time].dataType

    def band(d: Column) -> Column:
        return F.least(*[F.when(d <= c, F.lit(c)) for c in cutoffs.values()], F.lit(None)).cast("long")

    def fact(kind: str, activity: Column, seen: Column, of_day: Column, of_item: Column, clicks: bool) -> Column:
        amounts = [(F.col(c) if clicks else F.lit(None).cast(k.schema[c].dataType)).alias(n) for c, n in (("clicks_sum", "_s"), ("clicks_max", "_x"), ("clicks_mean", "_m"))]
        return F.struct(
            F.lit(kind).alias("_kind"), activity.alias("activity_clean"), seen.alias("_band"),
            of_day.alias("_day"), of_item.alias("_item"), day.alias("_at"), *amounts,
        )

    no_type, no_band = F.lit(None).cast("string"), F.lit(None).cast("long")
    no_day, no_item = F.lit(None).cast(day_type), F.lit(None).cast(item_type)
    facts = k.select(
        *spec.key,
        F.inline(
            F.array(
                fact("clicks", t, band(day), no_day, no_item, True),
                fact("day", no_type, no_band, day, no_item, False),
                fact("item", no_type, no_band, no_day, item, False),
            )
        ),
    )
    reduced = facts.groupBy(*spec.key, "_kind", "activity_clean", "_band", "_day", "_item").agg(
        F.sum("_s").alias("_s"),
        F.sum("_x").alias("_x"),
        F.sum("_m").alias("_m"),
        F.min("_at").alias("_first"),
    )
    reduced = reduced.withColumn("_seen", F.coalesce("_band", band(F.col("_first"))))
    x = expand_by_cutoff(reduced, "_seen", cutoffs)
    # the key of every later join; the aggregates below need no other exchange
    x = x.repartition("cutoff", *spec.key)
    if restrict is not None:
        x = restrict(x)
    narrow = x.groupBy("cutoff", *spec.key, "activity_clean").agg(
        F.max("cutoff_day").alias("cutoff_day"),
        F.sum("_s").alias("_s"),
        F.sum("_x").alias("_x"),
        F.sum("_m").alias("_m"),
        F.count("_day").alias("_days"),
        F.count("_item").alias("_items"),
        F.min("_day").alias("_first"),
        F.max("_day").alias("_last"),
    )

    def pivot(types: Sequence[str], measure: str, suffix: str) -> list[Column]:
        return [
            F.coalesce(F.max(F.when(t == a, F.col(measure))), F.lit(0)).alias(activity_column(a, suffix))
            for a in types
        ]

    aggs = [
        F.sum("_s").alias("total_click_until_cutoff_sum_strategy"),
        F.sum("_x").alias("total_click_until_cutoff_max_strategy"),
        F.sum("_m").alias("total_click_until_cutoff_mean_strategy"),
        F.sum("_days").alias("active_days_until_cutoff"),
        F.sum("_items").alias("used_site_count_until_cutoff"),
        F.min("_first").alias("first_activity_date_until_cutoff"),
        F.max("_last").alias("last_activity_date_until_cutoff"),
        *pivot(stage3_types, "_s", "sum_strategy"),
        *pivot(stage3_types, "_x", "max_strategy"),
        *pivot(baseline_types, "_m", "until_cutoff_mean_strategy"),
    ]
    # cutoff_day is a function of cutoff: carry it as an aggregate so the
    # output is partitioned on (cutoff, entity), the key of every later join
    r = narrow.groupBy("cutoff", *spec.key).agg(F.max("cutoff_day").alias("cutoff_day"), *aggs)
    days = F.col("active_days_until_cutoff")
    return r.withColumns(
        {
            "avg_click_per_active_day_until_cutoff_sum_strategy": safe_ratio(
                "total_click_until_cutoff_sum_strategy", days
            ),
            "avg_click_per_active_day_until_cutoff_max_strategy": safe_ratio(
                "total_click_until_cutoff_max_strategy", days
            ),
            "avg_click_per_active_day_until_cutoff_mean_strategy": safe_ratio(
                "total_click_until_cutoff_mean_strategy", days
            ),
            "days_since_last_activity_at_cutoff": F.col("cutoff_day") - F.col("last_activity_date_until_cutoff"),
        }
    )


STAGE3_CLICK_COLUMNS = [
    "total_click_until_cutoff_sum_strategy",
    "total_click_until_cutoff_max_strategy",
    "active_days_until_cutoff",
    "used_site_count_until_cutoff",
    "first_activity_date_until_cutoff",
    "last_activity_date_until_cutoff",
    "avg_click_per_active_day_until_cutoff_sum_strategy",
    "avg_click_per_active_day_until_cutoff_max_strategy",
    "days_since_last_activity_at_cutoff",
]

BASELINE_CLICK_COLUMNS = [
    "total_click_until_cutoff_mean_strategy",
    "active_days_until_cutoff",
    "used_site_count_until_cutoff",
    "first_activity_date_until_cutoff",
    "last_activity_date_until_cutoff",
    "avg_click_per_active_day_until_cutoff_mean_strategy",
    "days_since_last_activity_at_cutoff",
]


def stage3_pivot_columns(types: Sequence[str]) -> list[str]:
    return [activity_column(t, "sum_strategy") for t in types] + [
        activity_column(t, "max_strategy") for t in types
    ]


def baseline_pivot_columns(types: Sequence[str]) -> list[str]:
    return [activity_column(t, "until_cutoff_mean_strategy") for t in types]


# --------------------------------------------------------------------------
# assessment block


def assessment_rollup(
    submissions: DataFrame,
    assessments: DataFrame,
    cutoffs: Mapping[str, int] = CUTOFFS,
) -> DataFrame:
    """One row per (cutoff, entity) with any submission by the cutoff.

    The entity's course comes from the assessment dimension, the student
    from the submission; unmatched submissions form a NULL-course group that
    never joins back. ``clean_*`` columns are the baseline variant: rows of
    assessments without a due date are removed before everything."""
    meta = unique_in_plan(assessments, ["id_assessment"], "assessments").select(
        "id_assessment",
        "code_module",
        "code_presentation",
        F.col("date").alias("due_date"),
        "weight",
        F.lit(True).alias("_matched"),
    )
    subs = at_or_before(
        submissions.select("id_assessment", "id_student", "date_submitted", "score"), "date_submitted", cutoffs
    )
    j = subs.join(meta, "id_assessment", "left")
    due, ds, score, weight = F.col("due_date"), F.col("date_submitted"), F.col("score"), F.col("weight")
    has_due = due.isNotNull()
    clean = F.col("_matched").isNull() | has_due  # not an assessment known to lack a due date
    scored_w = F.when(score.isNotNull(), weight)
    x = expand_by_cutoff(j, "date_submitted", cutoffs)

    def only(cond: Column, c: Column) -> Column:
        return F.when(cond, c)

    aggs = [
        # Stage 3: all rows, lateness NULL without a due date
        F.count("id_assessment").alias("assessment_count_until_cutoff"),
        F.avg(score).alias("mean_score_until_cutoff"),
        F.min(score).alias("min_score_until_cutoff"),
        F.max(score).alias("max_score_until_cutoff"),
        F.coalesce(F.sum(only(has_due, (ds > due).cast("long"))), F.lit(0)).alias(
            "submitted_late_count_until_cutoff"
        ),
        F.count_if(~has_due).cast("long").alias("assessment_rows_missing_due_date_until_cutoff"),
        F.count(score).alias("scored_assessment_count_until_cutoff"),
        F.coalesce(F.sum(score * weight), F.lit(0.0)).alias("_num"),
        F.coalesce(F.sum(scored_w), F.lit(0.0)).alias("_den"),
        # baseline: rows with a known due date (or no dimension match) only
        F.count(only(clean, F.col("id_assessment"))).alias("clean_assessment_count_until_cutoff"),
        F.avg(only(clean, score)).alias("clean_mean_score_until_cutoff"),
        F.min(only(clean, score)).alias("clean_min_score_until_cutoff"),
        F.max(only(clean, score)).alias("clean_max_score_until_cutoff"),
        F.coalesce(F.sum(only(clean, false_if_null(ds > due).cast("long"))), F.lit(0)).alias(
            "clean_submitted_late_count_until_cutoff"
        ),
        F.coalesce(F.sum(only(clean, false_if_null(ds <= due).cast("long"))), F.lit(0)).alias(
            "clean_on_time_submission_count_until_cutoff"
        ),
        F.avg(only(clean, due - ds)).alias("clean_avg_days_before_due_until_cutoff"),
        F.count(only(clean, score)).alias("clean_scored_assessment_count_until_cutoff"),
        F.coalesce(F.sum(only(clean, score * weight)), F.lit(0.0)).alias("_cnum"),
        F.coalesce(F.sum(only(clean, scored_w)), F.lit(0.0)).alias("_cden"),
        F.count(only(clean, F.lit(1))).alias("_clean_rows"),
    ]
    r = x.groupBy("cutoff", *E).agg(F.max("cutoff_day").alias("cutoff_day"), *aggs)
    return r.withColumns(
        {
            "weighted_score_until_cutoff": safe_ratio("_num", "_den"),
            "clean_weighted_score_until_cutoff": safe_ratio("_cnum", "_cden"),
        }
    ).drop("_num", "_den", "_cnum", "_cden")


STAGE3_ASSESSMENT_COLUMNS = [
    "assessment_count_until_cutoff",
    "mean_score_until_cutoff",
    "min_score_until_cutoff",
    "max_score_until_cutoff",
    "submitted_late_count_until_cutoff",
    "assessment_rows_missing_due_date_until_cutoff",
    "scored_assessment_count_until_cutoff",
    "weighted_score_until_cutoff",
]

BASELINE_ASSESSMENT_COLUMNS = [
    "assessment_count_until_cutoff",
    "mean_score_until_cutoff",
    "min_score_until_cutoff",
    "max_score_until_cutoff",
    "submitted_late_count_until_cutoff",
    "on_time_submission_count_until_cutoff",
    "avg_days_before_due_until_cutoff",
    "assessment_rows_missing_due_date_until_cutoff",
    "scored_assessment_count_until_cutoff",
    "weighted_score_until_cutoff",
]


def baseline_assessment_block(rollup: DataFrame) -> DataFrame:
    """Baseline assessment columns (renamed ``clean_*``). Entities whose only
    rows were dropped for a missing due date get no row, as in the
    reference, where those rows are removed before grouping."""
    cols = []
    for c in BASELINE_ASSESSMENT_COLUMNS:
        if c == "assessment_rows_missing_due_date_until_cutoff":
            cols.append(F.lit(0).cast("long").alias(c))
        else:
            cols.append(F.col(f"clean_{c}").alias(c))
    return rollup.where(F.col("_clean_rows") > 0).select("cutoff", *E, *cols)


def stage3_assessment_block(rollup: DataFrame) -> DataFrame:
    return rollup.select("cutoff", *E, *STAGE3_ASSESSMENT_COLUMNS)


__all__ = [
    "UNKNOWN_ACTIVITY",
    "click_rollup",
    "assessment_rollup",
    "dimension_activity_types",
    "observed_activity_types",
]
