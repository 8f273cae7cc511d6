"""Active-at-cutoff cohort and target timing.

A student is excluded at a cutoff iff ``date_unregistration <= cutoff_day``;
an unknown unregistration day keeps the student. The exclusion set is an
entity-sized table expanded to the cutoffs it applies to and anti/semi
joined on (cutoff, entity), so NULL days can never drop a row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.operators.cutoffs import expand_by_cutoff
from cohortflow.schemas import CUTOFFS, ENTITY_KEY

E = ENTITY_KEY


def unregistered_by_cutoff(
    registration: DataFrame, cutoffs: Mapping[str, int] = CUTOFFS, day: str = "date_unregistration"
) -> DataFrame:
    """(cutoff, entity) pairs already unregistered at the cutoff."""
    return expand_by_cutoff(registration.select(*E, day), day, cutoffs).select("cutoff", *E)


def active_cohort(
    features: DataFrame, registration: DataFrame, cutoffs: Mapping[str, int] = CUTOFFS
) -> DataFrame:
    """Keep (cutoff, entity) rows not unregistered by the cutoff."""
    return features.join(unregistered_by_cutoff(registration, cutoffs), ["cutoff", *E], "left_anti")


def already_withdrawn(
    features: DataFrame, registration: DataFrame, cutoffs: Mapping[str, int] = CUTOFFS
) -> DataFrame:
    """The complement, reported separately (never a predictor)."""
    return features.join(unregistered_by_cutoff(registration, cutoffs), ["cutoff", *E], "left_semi")


def entity_timing(
    info: DataFrame, registration: DataFrame, cutoffs: Mapping[str, int] = CUTOFFS
) -> DataFrame:
    """Entity x cutoff rows with the outcome and unregistration timing."""
    reg = registration.select(*E, "date_unregistration")
    rows = info.select(*E, "final_result").join(reg, E, "left")
    x = expand_by_cutoff(rows, None, cutoffs)
    unreg, day = F.col("date_unregistration"), F.col("cutoff_day")
    withdrawn = F.col("final_result") == "Withdrawn"
    return x.withColumns(
        {
            "is_withdrawn": F.coalesce(withdrawn, F.lit(False)),
            "unregistered_by_cutoff": F.coalesce(unreg <= day, F.lit(False)),
            "unregistered_after_cutoff": F.coalesce(unreg > day, F.lit(False)),
            "undated": unreg.isNull(),
        }
    )


def target_timing(info: DataFrame, registration: DataFrame, cutoffs: Mapping[str, int] = CUTOFFS) -> DataFrame:
    """Per cutoff, withdrawn total / by cutoff / after / undated,
    non-withdrawn unregistered by the cutoff, and the active cohort size."""
    t = entity_timing(info, registration, cutoffs)
    w, by, after, undated = (F.col(c) for c in ("is_withdrawn", "unregistered_by_cutoff", "unregistered_after_cutoff", "undated"))
    return t.groupBy("cutoff", "cutoff_day").agg(
        F.count_if(w).cast("long").alias("withdrawn_total"),
        F.count_if(w & by).cast("long").alias("withdrawn_by_cutoff"),
        F.count_if(w & after).cast("long").alias("withdrawn_after_cutoff"),
        F.count_if(w & undated).cast("long").alias("withdrawn_undated"),
        F.count_if(~w & by).cast("long").alias("non_withdrawn_unregistered_by_cutoff"),
        F.count_if(~by).cast("long").alias("active_at_cutoff"),
    )


def strict_target(info: DataFrame, registration: DataFrame, cutoffs: Mapping[str, int] = CUTOFFS) -> DataFrame:
    """among the active cohort, withdrawn *after* the cutoff only;
    undated withdrawals are flagged separately rather than guessed."""
    t = entity_timing(info, registration, cutoffs).where(~F.col("unregistered_by_cutoff"))
    return t.select(
        "cutoff",
        "cutoff_day",
        *E,
        F.col("is_withdrawn").cast("long").alias("target_withdrawn"),
        (F.col("is_withdrawn") & F.col("unregistered_after_cutoff")).cast("long").alias("target_withdrawn_after_cutoff"),
        (F.col("is_withdrawn") & F.col("undated")).cast("long").alias("withdrawn_undated"),
    )


def cohort_counts(features: DataFrame, cohort: DataFrame, target: str = "target_at_risk") -> DataFrame:
    """Per cutoff original / excluded / kept rows, positives and rate.
    ``features`` is the all-entity table, ``cohort`` the kept rows with the
    target column."""
    orig = features.groupBy("cutoff").agg(F.count(F.lit(1)).alias("original_rows"))
    kept = cohort.groupBy("cutoff").agg(
        F.count(F.lit(1)).alias("cohort_rows"),
        F.sum(target).cast("long").alias("positives"),
        F.avg(target).alias("positive_rate"),
    )
    return orig.join(kept, "cutoff", "left").select(
        "cutoff",
        "original_rows",
        (F.col("original_rows") - F.coalesce("cohort_rows", F.lit(0))).alias("excluded_rows"),
        F.coalesce("cohort_rows", F.lit(0)).alias("cohort_rows"),
        F.coalesce("positives", F.lit(0)).cast("long").alias("positives"),
        F.round("positive_rate", 6).alias("positive_rate"),
    )
