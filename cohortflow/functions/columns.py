"""Column expressions (built-in functions only, so they stay in codegen).

pandas semantics that differ from SQL are made explicit here: a comparison
with a missing value is False (not NULL), sums of all-missing groups are 0,
and division by zero never raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortflow.schemas import TARGET_MAP


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_name(c: str | Column) -> Column:
    """strip -> lower -> ' ', '-', '/' become '_' (feature-name normaliser)."""
    stripped = F.regexp_replace(col(c).cast("string"), r"^\s+|\s+$", "")
    return F.translate(F.lower(stripped), " -/", "___")


def false_if_null(predicate: Column) -> Column:
    """pandas comparison: missing compares False -> 0/1 integer."""
    return F.coalesce(predicate.cast("long"), F.lit(0).cast("long"))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL (never raises under ANSI)."""
    return F.when(col(den) > 0, col(num) / col(den))


def target_withdrawn(result: str = "final_result") -> Column:
    return false_if_null(F.col(result) == "Withdrawn")


def target_at_risk(result: str = "final_result") -> Column:
    return false_if_null(F.col(result).isin("Withdrawn", "Fail"))


def target_from_map(result: str = "final_result", mapping: dict[str, int] = TARGET_MAP) -> Column:
    """Label map lookup; NULL for values outside the map."""
    out = None
    for k, v in mapping.items():
        cond = F.col(result) == k
        out = F.when(cond, F.lit(v).cast("long")) if out is None else out.when(cond, F.lit(v).cast("long"))
    return out


def registered_before_start(day: str = "date_registration") -> Column:
    """NULL when the registration day is unknown, else day <= 0."""
    return (F.col(day) <= 0).cast("long")


def is_retake(prev: str = "num_of_prev_attempts") -> Column:
    return false_if_null(F.col(prev) > 0)


def numeric(c: str | Column) -> Column:
    """pd.to_numeric(errors='coerce'): unparsable -> NULL, never raises."""
    return F.expr(f"try_cast({c} as double)") if isinstance(c, str) else c.try_cast("double")
