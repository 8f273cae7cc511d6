"""Evidence tables behind the pipeline decisions: unmatched joins, rows
allowed per cutoff, zero-activity shares, behaviour by outcome, strategy
totals, on-time share, gaps between active days, inactivity ratio."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.operators.collapse import collapse_events, with_activity
from cohortflow.operators.cutoffs import at_or_before, expand_by_cutoff
from cohortflow.operators.joins import unique_in_plan
from cohortflow.schemas import COURSE_LOG, CUTOFFS, ENTITY_KEY, EntitySpec

E = ENTITY_KEY
LONG_GAP_DAYS = 7


def _day_histogram(df: DataFrame, day: str, cutoffs: Mapping[str, int]) -> DataFrame:
    """Rows per day (small: bounded by the number of distinct days), then
    replicated to every cutoff so allowed/future counts are cheap sums."""
    h = df.groupBy(F.col(day).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return expand_by_cutoff(h, None, cutoffs)


def cutoff_row_evidence(
    log: DataFrame, submissions: DataFrame, assessments: DataFrame, cutoffs: Mapping[str, int] = CUTOFFS
) -> DataFrame:
    """Per cutoff, rows allowed / in the future for clicks and
    submissions, and assessment due dates allowed / future / missing."""

    def counts(df: DataFrame, day: str, prefix: str, missing: bool = False) -> DataFrame:
        h = _day_histogram(df, day, cutoffs)
        d, n = F.col("d"), F.col("n")
        aggs = [
            F.coalesce(F.sum(F.when(d <= F.col("cutoff_day"), n)), F.lit(0)).cast("long").alias(f"{prefix}_allowed"),
            F.coalesce(F.sum(F.when(d > F.col("cutoff_day"), n)), F.lit(0)).cast("long").alias(f"{prefix}_future"),
        ]
        if missing:
            aggs.append(F.coalesce(F.sum(F.when(d.isNull(), n)), F.lit(0)).cast("long").alias(f"{prefix}_missing"))
        return h.groupBy("cutoff", "cutoff_day").agg(*aggs)

    vle = counts(log.select("date"), "date", "student_vle_rows")
    subs = counts(submissions.select("date_submitted"), "date_submitted", "student_assessment_rows")
    due = counts(assessments.select("date"), "date", "assessment_due_dates", missing=True)
    return vle.join(subs, ["cutoff", "cutoff_day"]).join(due, ["cutoff", "cutoff_day"])


def unmatched_rows(
    log: DataFrame,
    vle: DataFrame,
    submissions: DataFrame,
    assessments: DataFrame,
    cutoffs: Mapping[str, int] = CUTOFFS,
    spec: EntitySpec = COURSE_LOG,
) -> DataFrame:
    """Rows without a dimension match after the many-to-one joins:
    deduplicated click rows -> site dimension, and allowed submissions ->
    assessment dimension per cutoff."""
    k = with_activity(collapse_events(log.select(*spec.event_key, spec.measure), spec), vle, spec)
    clicks = k.agg(
        F.sum("dedup_rows").cast("long").alias("rows"),
        F.sum(F.when(~F.col("activity_matched"), F.col("dedup_rows"))).cast("long").alias("unmatched_rows"),
    ).select(
        F.lit("student_vle_to_vle").alias("join"),
        F.lit("all").alias("cutoff"),
        "rows",
        F.coalesce("unmatched_rows", F.lit(0).cast("long")).alias("unmatched_rows"),
    )
    meta = unique_in_plan(assessments.select("id_assessment"), ["id_assessment"], "assessments").withColumn("_m", F.lit(True))
    j = expand_by_cutoff(
        submissions.select("id_assessment", "date_submitted").join(meta, "id_assessment", "left"), "date_submitted", cutoffs
    )
    subs = j.groupBy("cutoff").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_m").isNull()).cast("long").alias("unmatched_rows")
    ).select(F.lit("student_assessment_to_assessments").alias("join"), "cutoff", "rows", "unmatched_rows")
    return clicks.unionByName(subs)


def zero_activity_share(features: DataFrame, registration: DataFrame, cutoffs: Mapping[str, int] = CUTOFFS) -> DataFrame:
    """Withdrawn share among students with no activity by the cutoff,
    over all students and over the active cohort. ``features`` has
    (cutoff, entity, active_days_until_cutoff, target_withdrawn)."""
    unreg = expand_by_cutoff(registration.select(*E, "date_unregistration"), "date_unregistration", cutoffs).select(
        "cutoff", *E, F.lit(True).alias("_gone")
    )
    x = features.join(unreg, ["cutoff", *E], "left").where(F.col("active_days_until_cutoff") == 0)
    in_cohort = F.col("_gone").isNull()
    w = F.col("target_withdrawn")
    return x.groupBy("cutoff").agg(
        F.count(F.lit(1)).alias("zero_activity_all"),
        F.round(F.avg(w), 6).alias("withdrawn_share_all"),
        F.count_if(in_cohort).cast("long").alias("zero_activity_cohort"),
        F.round(F.avg(F.when(in_cohort, w)), 6).alias("withdrawn_share_cohort"),
    )


def outcome_behaviour(cohort: DataFrame) -> DataFrame:
    """Mean clicks (sum strategy) and active days by outcome."""
    return cohort.groupBy("cutoff", "final_result").agg(
        F.count(F.lit(1)).alias("students"),
        F.round(F.avg("total_click_until_cutoff_sum_strategy"), 6).alias("mean_clicks"),
        F.round(F.avg("active_days_until_cutoff"), 6).alias("mean_active_days"),
    )


def strategy_totals(cohort_clicks: DataFrame) -> DataFrame:
    """Cohort click totals under the sum / mean / max strategies."""
    return cohort_clicks.groupBy("cutoff").agg(
        F.sum("total_click_until_cutoff_sum_strategy").cast("long").alias("total_clicks_sum_strategy"),
        F.round(F.sum("total_click_until_cutoff_mean_strategy"), 6).alias("total_clicks_mean_strategy"),
        F.sum("total_click_until_cutoff_max_strategy").cast("long").alias("total_clicks_max_strategy"),
    )


def on_time_share(submissions: DataFrame, assessments: DataFrame, cutoffs: Mapping[str, int] = CUTOFFS) -> DataFrame:
    """Share of submissions with a known due date that were on time."""
    meta = unique_in_plan(assessments.select("id_assessment", F.col("date").alias("due")), ["id_assessment"], "assessments")
    meta = meta.where(F.col("due").isNotNull())
    j = submissions.select("id_assessment", "date_submitted").join(meta, "id_assessment")
    x = expand_by_cutoff(j, "date_submitted", cutoffs)
    on_time = (F.col("date_submitted") <= F.col("due")).cast("long")
    return x.groupBy("cutoff").agg(
        F.count(F.lit(1)).alias("submissions"),
        F.sum(on_time).cast("long").alias("on_time"),
        F.round(F.avg(on_time), 6).alias("on_time_share"),
    )


def activity_gaps(log: DataFrame, cutoffs: Mapping[str, int] = CUTOFFS, spec: EntitySpec = COURSE_LOG) -> DataFrame:
    """Gaps between consecutive active days per (cutoff, entity).

    Active days are first made distinct per entity (partial aggregation; a
    busy entity has at most one row per day), then ``lag`` over the days of
    each (cutoff, entity)."""
    days = at_or_before(log.select(*spec.key, spec.time), spec.time, cutoffs).distinct()
    x = expand_by_cutoff(days, spec.time, cutoffs)
    w = Window.partitionBy("cutoff", *spec.key).orderBy(spec.time)
    gap = F.col(spec.time) - F.lag(spec.time).over(w)
    g = x.withColumn("gap", gap)
    return g.groupBy("cutoff", *spec.key).agg(
        F.count("gap").alias("gap_count"),
        F.max("gap").alias("max_gap"),
        F.round(F.avg("gap"), 6).alias("mean_gap"),
        F.count_if(F.col("gap") >= LONG_GAP_DAYS).cast("long").alias("long_gap_count"),
        F.round(F.avg((F.col("gap") >= LONG_GAP_DAYS).cast("double")), 6).alias("long_gap_rate"),
    )


def gap_by_target(gaps: DataFrame, cohort: DataFrame, target: str = "target_at_risk") -> DataFrame:
    """W2 summary: per cutoff and target, active students, mean max gap and
    the share with a gap of ``LONG_GAP_DAYS`` or more."""
    x = cohort.select("cutoff", *E, target).join(gaps, ["cutoff", *E])
    return x.groupBy("cutoff", target).agg(
        F.count(F.lit(1)).alias("students"),
        F.round(F.avg(F.coalesce("max_gap", F.lit(0))), 6).alias("mean_max_gap"),
        F.round(F.avg((F.col("long_gap_count") > 0).cast("double")), 6).alias("share_long_gap"),
    )


def inactivity_ratio(features: DataFrame) -> DataFrame:
    """1 - active_days / cutoff_day per (cutoff, entity)."""
    return features.select(
        "cutoff",
        *E,
        F.round(1 - F.col("active_days_until_cutoff") / F.col("cutoff_day"), 6).alias("inactivity_ratio"),
    )
