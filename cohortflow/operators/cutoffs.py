"""Cutoff expansion: evaluate several "as of day d" snapshots in one pass.

A row dated ``t`` belongs to every cutoff with ``t <= cutoff_day`` (the
cutoff is inclusive). Instead of re-reading the log once per cutoff, each row
is exploded into the cutoffs it belongs to, and ``cutoff`` becomes a grouping
column. The cutoff list is a fixed literal array (no join, no broadcast), and
``time <= max(cutoff)`` is written out so Parquet can skip row groups.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.schemas import CUTOFFS


def _cutoff_array(cutoffs: Mapping[str, int]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(name).alias("cutoff"), F.lit(int(day)).cast("long").alias("cutoff_day"))
            for name, day in cutoffs.items()
        ]
    )


def day_of(cutoffs: Mapping[str, int] = CUTOFFS) -> Column:
    """The day of column ``cutoff``, to order results in time (by name,
    week10 would come before week5)."""
    return F.coalesce(*(F.when(F.col("cutoff") == name, F.lit(int(day))) for name, day in cutoffs.items()))


def at_or_before(df: DataFrame, time_col: str, cutoffs: Mapping[str, int] = CUTOFFS) -> DataFrame:
    """Rows dated on or before the latest cutoff (pushed to the scan).
    A NULL time is never "on or before" (pandas: NaN <= d is False)."""
    return df.where(F.col(time_col) <= F.lit(max(cutoffs.values())))


def expand_by_cutoff(
    df: DataFrame, time_col: str | None, cutoffs: Mapping[str, int] = CUTOFFS
) -> DataFrame:
    """Add ``cutoff``/``cutoff_day``; one output row per cutoff the row is
    visible at. ``time_col=None`` replicates every row to every cutoff (for
    entity tables)."""
    arr = _cutoff_array(cutoffs)
    if time_col is not None:
        df = at_or_before(df, time_col, cutoffs)
        t = F.col(time_col)
        arr = F.filter(arr, lambda c: c["cutoff_day"] >= t)
    return df.select("*", F.inline(arr))
