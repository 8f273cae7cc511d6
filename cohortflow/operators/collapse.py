"""Duplicate handling of the event log.

Two policies exist and differ in their *input*, not only their function:
the sum/max strategies drop exact duplicate rows first, the mean strategy
averages the raw rows. For a log whose columns are exactly (event key,
measure) the exact-dedup sum is the sum of the key's distinct measure values,
so all three strategies come out of one pair of aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.columns import clean_name
from cohortflow.schemas import COURSE_LOG, EntitySpec

UNKNOWN_ACTIVITY = "unknown_activity_type"


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Remove exact duplicate rows (NULLs compare equal)."""
    return df.distinct()


def site_dimension(vle: DataFrame, spec: EntitySpec = COURSE_LOG) -> DataFrame:
    """(item, category, category_clean), one row per item; a repeated item
    keeps its smallest category."""
    dim = vle.groupBy(spec.item).agg(F.min(spec.category).alias(spec.category))
    return dim.withColumn("activity_clean", clean_name(spec.category))


def collapse_events(log: DataFrame, spec: EntitySpec = COURSE_LOG) -> DataFrame:
    """Event-key grain with all three duplicate strategies:

    * ``clicks_sum``  - sum after exact dedup (A7 + A13)
    * ``clicks_max``  - max (dedup does not change it)
    * ``clicks_mean`` - mean of the raw rows (A14)
    * ``clicks_raw``  - plain sum of the raw rows
    * ``raw_rows`` / ``dedup_rows`` - row counts under both policies (for a
      log of exactly (key, measure), rows left after exact dedup = distinct
      measure values, NULL counted once = ``distinct_values``)

    Two hash aggregates of fixed-width columns: rows per (key, measure), then
    per key. Both combine before their shuffle, so a key or an exact duplicate
    that holds a third of the log is a few rows by then."""
    m, n = F.col(spec.measure), F.col("_n")
    values = log.groupBy(*spec.event_key, spec.measure).agg(F.count(F.lit(1)).alias("_n"))
    g = values.groupBy(*spec.event_key).agg(
        F.sum(m).alias("clicks_sum"),
        F.max(m).alias("clicks_max"),
        F.sum(m * n).alias("clicks_raw"),
        F.sum(F.when(m.isNotNull(), n)).alias("_known"),
        F.sum(n).alias("raw_rows"),
        F.count(F.lit(1)).alias("distinct_values"),
    )
    return g.select(
        *spec.event_key,
        "clicks_sum",
        "clicks_max",
        (F.col("clicks_raw") / F.col("_known")).alias("clicks_mean"),
        "clicks_raw",
        "raw_rows",
        F.col("distinct_values").alias("dedup_rows"),
        "distinct_values",
    )


def with_activity(collapsed: DataFrame, vle: DataFrame, spec: EntitySpec = COURSE_LOG) -> DataFrame:
    """J2 + F13: attach the item's category (the planner picks the join from the
    dimension's size); unmatched items get ``unknown_activity_type``."""
    dim = site_dimension(vle, spec)
    return (
        collapsed.join(dim, spec.item, "left")
        .withColumn("activity_matched", F.col(spec.category).isNotNull())
        .withColumn("activity_type", F.coalesce(F.col(spec.category), F.lit(UNKNOWN_ACTIVITY)))
        .withColumn("activity_clean", F.coalesce(F.col("activity_clean"), F.lit(UNKNOWN_ACTIVITY)))
    )


def collapse_sum_max(log: DataFrame, vle: DataFrame, spec: EntitySpec = COURSE_LOG) -> DataFrame:
    """A13 as published: exact dedup, then per (key, activity) sum and max."""
    k = collapse_events(log.select(*spec.event_key, spec.measure), spec)
    return with_activity(k, vle, spec).select(
        *spec.event_key,
        "activity_type",
        F.col("clicks_sum").alias("sum_click_sum_strategy"),
        F.col("clicks_max").alias("sum_click_max_strategy"),
    )


def collapse_mean(log: DataFrame, vle: DataFrame, spec: EntitySpec = COURSE_LOG) -> DataFrame:
    """A14 as published: raw rows, per key mean, then activity by clean name."""
    k = log.groupBy(*spec.event_key).agg(F.avg(spec.measure).alias("sum_click_mean_strategy"))
    return with_activity(k, vle, spec).select(
        *spec.event_key, F.col("activity_clean").alias("activity_type"), "sum_click_mean_strategy"
    )
