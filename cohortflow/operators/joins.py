"""Join helpers: cardinality guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

class JoinCardinalityError(ValueError):
    pass


def duplicated_key_groups(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key groups with more than one row: (key..., n). NULL keys group
    together (pandas ``duplicated`` semantics)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, key: Sequence[str], what: str = "table") -> DataFrame:
    """Raise if ``key`` is not unique in ``df`` (the ``validate=`` check of a
    one-to-one / many-to-one merge). One aggregate job, early exit."""
    bad = duplicated_key_groups(df, key).limit(1).collect()
    if bad:
        raise JoinCardinalityError(f"{what}: key {list(key)} is not unique, e.g. {bad[0].asDict()}")
    return df


def unique_in_plan(df: DataFrame, key: Sequence[str], what: str = "table") -> DataFrame:
    """Lazy uniqueness guard: the query fails at run time if ``key`` repeats.

    One aggregate on the key, combined before its shuffle, so a key that
    repeats millions of times is one row by then; a following join on the same
    key reuses the shuffle."""
    rest = [c for c in df.columns if c not in key]
    one = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_key_n"), *[F.any_value(c).alias(c) for c in rest])
    msg = f"{what}: key {list(key)} is not unique"
    return one.where(F.assert_true(F.col("_key_n") == 1, msg).isNull()).select(*df.columns)


def join_validated(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    validate: str = "many_to_one",
    what: str = "join",
) -> DataFrame:
    """Equi join with a pandas-style ``validate`` check on the sides that
    must be unique ("one_to_one" checks both, "many_to_one" the right)."""
    if validate in ("one_to_one", "many_to_one"):
        assert_unique(right, on, f"{what} right side")
    if validate in ("one_to_one", "one_to_many"):
        assert_unique(left, on, f"{what} left side")
    return left.join(right, list(on), how)


def join_guard_report(checks: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per planned join: build-side name, key, rows, duplicated key
    groups, verdict. Each check is one aggregate over its side."""
    frames = []
    for name, (df, key) in checks.items():
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        frames.append(
            per_key.agg(
                F.sum("n").cast("long").alias("rows"),
                F.count_if(F.col("n") > 1).cast("long").alias("duplicated_key_groups"),
            ).select(
                F.lit(name).alias("join_side"),
                F.lit(", ".join(key)).alias("key"),
                F.coalesce("rows", F.lit(0)).alias("rows"),
                "duplicated_key_groups",
                F.when(F.col("duplicated_key_groups") == 0, "ok").otherwise("violation").alias("verdict"),
            )
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
