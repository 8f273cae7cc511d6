"""Integrity audit: shapes, missing values, keys, duplicates, referential
integrity, column profiles, range rules, outcome distributions.

Each check is one aggregate job per table; wide per-column checks compute all
columns in a single pass and unpivot the one-row result with ``stack``.
NULL keys are grouped together and NULL-safe joins are used where pandas
treats missing values as equal.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.functions.columns import numeric
from cohortflow.operators.collapse import collapse_events
from cohortflow.schemas import COURSE_LOG, ENTITY_KEY, RANGE_COLUMNS, TABLE_KEYS, EntitySpec
from cohortflow.session import materialize

PERCENTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
PROFILE_STATS = ["count", "mean", "std", "min", "p1", "p5", "p25", "p50", "p75", "p95", "p99", "max"]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _lit_str(s: str) -> Column:
    return F.lit(s).cast("string")


# ---------------------------------------------------------------- A1


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A1: (table, rows, columns)."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                _lit_str(name).alias("table"), "rows", F.lit(len(df.columns)).cast("long").alias("columns")
            )
            for name, df in tables.items()
        ]
    )


# ---------------------------------------------------------------- A2 / A3


def _missing_long(name: str, df: DataFrame) -> DataFrame:
    """All columns of one table: (table, column, missing_count, rows) from
    a single aggregate pass, unpivoted."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in df.columns],
    )
    return counts.unpivot("__rows", df.columns, "column", "missing_count").select(
        _lit_str(name).alias("table"), "column", "missing_count", F.col("__rows").alias("rows")
    )


def missing_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all([_missing_long(n, df) for n, df in tables.items()]).withColumn(
        "missing_ratio", F.when(F.col("rows") > 0, F.col("missing_count") / F.col("rows"))
    )


def missing_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A2: nonzero missing counts and ratios per (table, column)."""
    return missing_all(tables).where("missing_count > 0").select("table", "column", "missing_count", "missing_ratio")


def missing_top(tables: Mapping[str, DataFrame], k: int = 10) -> DataFrame:
    """A3: per table the ``k`` columns with the highest missing ratio
    (ties by column name)."""
    w = Window.partitionBy("table").orderBy(F.desc("missing_ratio"), F.asc("column"))
    return (
        missing_all(tables)
        .withColumn("rank", F.row_number().over(w).cast("long"))
        .where(F.col("rank") <= k)
        .select("table", "rank", "column", "missing_ratio")
    )


# ---------------------------------------------------------------- A4-A6


#: Rows whose keys one task counts.
ROWS_A_TASK = 1 << 19


def _key_stats(name: str, df: DataFrame, key: Sequence[str], rows: int = 0) -> DataFrame:
    """Counts per key; a table of ``rows`` over ``ROWS_A_TASK`` is dealt by key into as
    many pieces, where a join of few large tasks would count all its keys at once."""
    if rows > ROWS_A_TASK:
        df = df.select(*key).repartition(-(-rows // ROWS_A_TASK), *key)
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").cast("long").alias("rows"),
        F.sum(F.col("n") - 1).cast("long").alias("duplicated_rows_by_key"),
        F.count_if(F.col("n") > 1).cast("long").alias("duplicated_key_groups"),
        F.sum(F.when(F.col("n") > 1, F.col("n"))).cast("long").alias("duplicated_rows_full"),
    ).select(
        _lit_str(name).alias("table"),
        _lit_str(", ".join(key)).alias("key"),
        F.coalesce("rows", F.lit(0).cast("long")).alias("rows"),
        F.coalesce("duplicated_rows_by_key", F.lit(0).cast("long")).alias("duplicated_rows_by_key"),
        "duplicated_key_groups",
        F.coalesce("duplicated_rows_full", F.lit(0).cast("long")).alias("duplicated_rows_full"),
    )


def key_uniqueness(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = TABLE_KEYS
) -> DataFrame:
    """A4 + A5: rows, duplicated rows (n-1 per group), duplicated groups and
    rows in duplicated groups counted in full, per declared key."""
    return union_all([_key_stats(n, tables[n], k) for n, k in keys.items() if n in tables])


def exact_duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, distinct rows, exact duplicate rows per table. The rows are counted
    first: a task then groups a bounded number of them, however large the table."""
    rows = {r.table: r.rows for r in table_shapes(tables).collect()}
    return union_all(
        [
            _key_stats(n, df, df.columns, rows[n]).select(
                "table",
                "rows",
                (F.col("rows") - F.col("duplicated_rows_by_key")).alias("distinct_rows"),
                F.col("duplicated_rows_by_key").alias("exact_duplicate_rows"),
            )
            for n, df in tables.items()
        ]
    )


# ---------------------------------------------------------------- A9-A12


def event_key_groups(log: DataFrame, spec: EntitySpec = COURSE_LOG) -> DataFrame:
    """Event-key grain with row counts under both duplicate policies and
    click totals (one shuffle on the event key)."""
    return collapse_events(log.select(*spec.event_key, spec.measure), spec)


def dup_totals(log: DataFrame, spec: EntitySpec = COURSE_LOG) -> DataFrame:
    """Per number of rows that a key group has after exact dedup: groups, rows and
    click totals. A9 and A12 are sums of these few rows."""
    return event_key_groups(log, spec).groupBy("dedup_rows").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("raw_rows").alias("raw_rows"),
        F.sum("clicks_raw").alias("clicks_raw"), F.sum("clicks_sum").alias("clicks_sum"), F.sum("clicks_max").alias("clicks_max"),
    )


def dup_group_sizes(log: DataFrame, spec: EntitySpec = COURSE_LOG) -> DataFrame:
    """After exact dedup, how many key groups have each size > 1."""
    return _group_sizes(dup_totals(log, spec))


def _group_sizes(totals: DataFrame) -> DataFrame:
    # O2: by group size
    return (
        totals.where("dedup_rows > 1")
        .select(F.col("dedup_rows").alias("group_size"), F.col("groups").alias("group_count"))
        .orderBy("group_size")
    )


def dup_conflicts(log: DataFrame, spec: EntitySpec = COURSE_LOG) -> DataFrame:
    """A10 + J6: duplicated key groups (after exact dedup) whose measure
    takes more than one value (NULL counted as a value)."""
    g = event_key_groups(log, spec)
    return g.where("dedup_rows > 1").select(
        *spec.event_key,
        F.col("dedup_rows").alias("group_size"),
        F.col("dedup_rows").alias("distinct_values"),
    )


def dup_strategy_totals(log: DataFrame, spec: EntitySpec = COURSE_LOG) -> DataFrame:
    """Measure totals under raw / exact dedup / key sum / key max."""
    g = event_key_groups(log, spec)
    return g.agg(
        F.sum("clicks_raw").cast("long").alias("raw_total_clicks"),
        F.sum("clicks_sum").cast("long").alias("exact_dedup_total_clicks"),
        F.sum("clicks_sum").cast("long").alias("key_sum_total_clicks"),
        F.sum("clicks_max").cast("long").alias("key_max_total_clicks"),
    )


DUP_METRICS = [
    "total_rows",
    "exact_duplicate_rows",
    "key_duplicate_rows",
    "rows_after_exact_duplicate_removal",
    "remaining_key_duplicate_rows_after_exact_removal",
    "duplicated_key_groups_after_exact_removal",
    "all_key_groups_with_different_sum_click_after_exact_removal",
    "duplicated_key_groups_with_different_sum_click_after_exact_removal",
    "raw_total_clicks",
    "total_clicks_after_exact_duplicate_removal",
    "total_clicks_after_key_aggregation_sum",
    "total_clicks_after_key_aggregation_max",
]


def dup_summary(log: DataFrame, spec: EntitySpec = COURSE_LOG) -> DataFrame:
    """The 12 duplicate metrics as (metric, value) from one aggregate
    over the event-key grain."""
    return _summary(dup_totals(log, spec))


def _summary(totals: DataFrame) -> DataFrame:
    raw, dd, n = F.col("raw_rows"), F.col("dedup_rows"), F.col("groups")
    repeated = F.sum(F.when(dd > 1, n))
    one = totals.agg(
        F.sum(raw).alias("total_rows"),
        F.sum(raw - dd * n).alias("exact_duplicate_rows"),
        F.sum(raw - n).alias("key_duplicate_rows"),
        F.sum(dd * n).alias("rows_after_exact_duplicate_removal"),
        F.sum((dd - 1) * n).alias("remaining_key_duplicate_rows_after_exact_removal"),
        repeated.alias("duplicated_key_groups_after_exact_removal"),
        # rows of a key that differ after exact dedup differ in their clicks
        repeated.alias("all_key_groups_with_different_sum_click_after_exact_removal"),
        repeated.alias("duplicated_key_groups_with_different_sum_click_after_exact_removal"),
        F.sum("clicks_raw").alias("raw_total_clicks"),
        F.sum("clicks_sum").alias("total_clicks_after_exact_duplicate_removal"),
        F.sum("clicks_sum").alias("total_clicks_after_key_aggregation_sum"),
        F.sum("clicks_max").alias("total_clicks_after_key_aggregation_max"),
    ).select(*[F.coalesce(F.col(m).cast("long"), F.lit(0).cast("long")).alias(m) for m in DUP_METRICS])
    return one.unpivot([], DUP_METRICS, "metric", "value").withColumn(
        "position", F.array_position(F.array(*[F.lit(m) for m in DUP_METRICS]), F.col("metric")).cast("long")
    ).select("position", "metric", "value")


# ---------------------------------------------------------------- J5 / J10


def key_match_counts(name: str, left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys of both sides, full outer join with NULL-safe key
    equality, counts of both / left_only / right_only."""
    lk = left.select(*key).distinct().withColumn("_l", F.lit(1))
    rk = right.select(*[F.col(k).alias(f"_r_{k}") for k in key]).distinct().withColumn("_r", F.lit(1))
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in key])
    j = lk.join(rk, cond, "full_outer")
    return j.agg(
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).cast("long").alias("both"),
        F.count_if(F.col("_r").isNull()).cast("long").alias("left_only"),
        F.count_if(F.col("_l").isNull()).cast("long").alias("right_only"),
    ).select(_lit_str(name).alias("check"), _lit_str(", ".join(key)).alias("key"), "both", "left_only", "right_only")


REFERENTIAL_CHECKS = [
    ("student_info_to_student_registration", "student_info", "student_registration", ENTITY_KEY),
    ("student_vle_to_student_info", "student_vle", "student_info", ENTITY_KEY),
    ("student_assessment_to_assessments", "student_assessment", "assessments", ["id_assessment"]),
    ("student_vle_to_vle", "student_vle", "vle", ["id_site"]),
]


def referential_integrity(tables: Mapping[str, DataFrame], checks=REFERENTIAL_CHECKS) -> DataFrame:
    """The four published referential checks."""
    return union_all([key_match_counts(n, tables[l], tables[r], k) for n, l, r, k in checks])


def keyset_diff(a: Mapping[str, DataFrame], b: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per dataset, keys only in A / only in B / in both."""
    return union_all([key_match_counts(n, a[n], b[n], k) for n, k in keys.items()]).withColumnRenamed(
        "check", "dataset"
    )


# ---------------------------------------------------------------- S6


def table_facts(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] = RANGE_COLUMNS) -> DataFrame:
    """(table, rows, columns, missing, flags): what A1, A2 and A20 need of every
    table, from one aggregate, and so one scan, per table."""
    parts = []
    for t, df in tables.items():
        checks = [(c, issue, test) for c in columns.get(t, ()) for names, issue, test in RANGE_RULES if c in names]
        got = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)],
            *[F.count_if(test(numeric(c))).alias(f"f{i}") for i, (c, _, test) in enumerate(checks)],
        )
        missing = [F.struct(_lit_str(c).alias("column"), F.col(f"m{i}").alias("n")) for i, c in enumerate(df.columns)]
        flags = [F.struct(_lit_str(c).alias("column"), _lit_str(issue).alias("issue"), F.col(f"f{i}").alias("n")) for i, (c, issue, _) in enumerate(checks)]
        flag = "array<struct<column:string,issue:string,n:bigint>>"
        parts.append(got.select(
            _lit_str(t).alias("table"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"),
            F.array(*missing).alias("missing"), F.array(*flags).cast(flag).alias("flags"),
        ))
    return union_all(parts)


#: The evidence tables: key columns, then measures.
EVIDENCE = {
    "date_numeric_range_flags": (["table", "column", "issue"], ["count"]),
    "date_numeric_range_stats": (["table", "column"], ["count", "mean", "std", "min", *[f"p{int(p * 100)}" for p in PERCENTILES], "max"]),
    "key_duplicates": (["table", "key"], ["duplicated_rows_by_key", "duplicated_key_groups"]),
    "missing_values_nonzero": (["table", "column"], ["missing_count", "missing_ratio"]),
    "referential_integrity": (["check"], ["both", "left_only", "right_only"]),
    "student_vle_duplicate_group_size_distribution": (["group_size"], ["group_count"]),
    "student_vle_duplicate_summary": (["metric"], ["value"]),
    "table_shapes": (["table"], ["rows", "columns"]),
    "target_distribution_by_module": (["code_module", "final_result"], ["count", "ratio_within_group"]),
    "target_distribution_by_module_presentation": (["code_module", "code_presentation", "final_result"], ["count", "ratio_within_group"]),
    "target_distribution_by_presentation": (["code_presentation", "final_result"], ["count", "ratio_within_group"]),
    "target_distribution_overall": (["final_result"], ["count", "ratio_within_group"]),
}


def evidence_tables(tables: Mapping[str, DataFrame], log_name: str = "student_vle") -> dict[str, DataFrame]:
    """The audit's evidence, by name of ``EVIDENCE``. Shapes, missing cells
    and range flags come from one aggregate per table, the four outcome
    distributions from one grouping-sets aggregate; both are written first."""
    facts = materialize(table_facts(tables), "audit-facts")
    outcomes = materialize(target_grouping_sets(tables["student_info"]), "audit-outcomes")
    missing = facts.select("table", "rows", F.inline("missing")).where("n > 0")
    made = {
        "date_numeric_range_flags": facts.select("table", F.inline("flags")).where("n > 0").withColumnRenamed("n", "count"),
        "date_numeric_range_stats": column_profile(tables),
        "key_duplicates": key_uniqueness(tables),
        "missing_values_nonzero": missing.withColumns({"missing_count": F.col("n"), "missing_ratio": F.col("n") / F.col("rows")}),
        "referential_integrity": referential_integrity(tables),
        "student_vle_duplicate_group_size_distribution": dup_group_sizes(tables[log_name]),
        "student_vle_duplicate_summary": dup_summary(tables[log_name]),
        "table_shapes": facts,
        "target_distribution_by_module": outcomes.where("grouping = 'by_module'"),
        "target_distribution_by_module_presentation": outcomes.where("grouping = 'by_module_presentation'"),
        "target_distribution_by_presentation": outcomes.where("grouping = 'by_presentation'"),
        "target_distribution_overall": outcomes.where("grouping = 'overall'"),
    }
    return {name: made[name].select(*keys, *measures) for name, (keys, measures) in EVIDENCE.items()}


def evidence_long(evidence: Mapping[str, DataFrame]) -> DataFrame:
    """Evidence tables as (evidence, item, metric, value) rows."""
    parts = []
    for name, df in evidence.items():
        keys, measures = EVIDENCE[name]
        cells = F.array(*[F.struct(_lit_str(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in measures])
        item = F.concat_ws(".", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
        parts.append(df.select(_lit_str(name).alias("evidence"), item.alias("item"), F.inline(cells)))
    return union_all(parts)


# ---------------------------------------------------------------- D1


def table_equality(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag equality of two versions of a table. Rows of both sides are
    tagged, grouped by all columns (NULLs equal) and their multiplicities
    compared in one shuffle; the schemas are compared by name and type."""
    same_schema = [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]
    cols = a.columns
    b2 = b.select(*[F.col(f.name).cast(f.dataType) for f in a.schema])
    tagged = a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b2.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    per_row = tagged.groupBy(*cols).agg(F.sum("_a").alias("na"), F.sum("_b").alias("nb"))
    out = per_row.agg(
        F.sum("na").cast("long").alias("rows_a"),
        F.sum("nb").cast("long").alias("rows_b"),
        F.sum(F.greatest(F.col("na") - F.col("nb"), F.lit(0))).cast("long").alias("only_in_a"),
        F.sum(F.greatest(F.col("nb") - F.col("na"), F.lit(0))).cast("long").alias("only_in_b"),
    )
    z = F.lit(0).cast("long")
    return out.select(
        _lit_str(name).alias("table"),
        F.lit(same_schema).alias("same_schema"),
        *[F.coalesce(c, z).alias(c) for c in ("rows_a", "rows_b", "only_in_a", "only_in_b")],
    ).withColumn("equal", (F.col("only_in_a") == 0) & (F.col("only_in_b") == 0) & F.col("same_schema"))


def bucket_digests(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, rows, digest) of the rows by hash of ``key``: two sums of 64-bit
    row hashes, NULLs told apart by position. ``buckets`` rows; no row is
    shuffled, only a sum per bucket and task."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in df.columns])
    digest = [F.sum(F.xxhash64(F.lit(seed), nulls, *cells).cast("decimal(38,0)")) for seed in (1, 2)]
    return df.groupBy(F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.array(*digest).alias("digest")
    )


def bucketed_equality(name: str, a: DataFrame, b: DataFrame, key: Sequence[str], buckets: int = 1024) -> DataFrame:
    """D1 for large tables: rows are bucketed by ``key``, buckets with equal
    counts and digests are done, and only rows of the others are compared as
    bags. Equal tables are two scans without a shuffle of rows."""
    sides = [materialize(bucket_digests(x, key, buckets), "digests") for x in (a, b)]
    left, right = (x.select("bucket", F.col("rows").alias(f"rows_{s}"), F.col("digest").alias(f"digest_{s}")) for x, s in zip(sides, "ab"))
    both = left.join(right, "bucket", "full_outer")
    differ = [r.bucket for r in both.where(~(F.col("rows_a").eqNullSafe(F.col("rows_b")) & F.col("digest_a").eqNullSafe(F.col("digest_b")))).select("bucket").collect()]  # at most ``buckets``
    rows = [x.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] for x in sides]
    same = [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]
    of = lambda x: x.where(F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(buckets)).isin(differ))
    found = table_equality(name, of(a), of(b)) if differ else None
    one = a.sparkSession.createDataFrame([(name, same, *rows, len(differ))], "table string, same_schema boolean, rows_a long, rows_b long, unequal_buckets long")
    counts = found.select("table", "only_in_a", "only_in_b") if found is not None else one.select("table", F.lit(0).cast("long").alias("only_in_a"), F.lit(0).cast("long").alias("only_in_b"))
    out = one.join(counts, "table")
    return out.withColumn("equal", F.col("same_schema") & (F.col("unequal_buckets") == 0))


# ---------------------------------------------------------------- A19 / A20


def _value_histogram(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """(table, column, x, n): one scan per table; every column of a table is
    counted by value with map-side combining."""
    parts = []
    for t, cols in columns.items():
        cell = F.inline(F.array(*[F.struct(_lit_str(c).alias("column"), numeric(c).alias("x")) for c in cols]))
        parts.append(tables[t].select(_lit_str(t).alias("table"), cell).where("x is not null"))
    return union_all(parts).groupBy("table", "column", "x").agg(F.count(F.lit(1)).alias("n"))


def column_profile(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] = RANGE_COLUMNS) -> DataFrame:
    """A19 + F16: describe() of each configured column after numeric
    coercion: count, mean, std (ddof=1), min, exact linear-interpolated
    1/5/25/50/75/95/99 %, max.

    The value histogram is range-partitioned by (table, column, value) and
    written; a partition is a piece of the sorted values, so ranks are the
    piece's offset plus a running count inside the piece and no task holds all
    values of a column, however many distinct ones there are."""
    g = ["table", "column"]
    hist = _value_histogram(tables, columns).repartitionByRange(*g, "x")
    hist = materialize(hist.withColumn("_b", F.spark_partition_id()), "value-histogram")
    totals = hist.groupBy(*g).agg(
        F.sum("n").alias("count"),
        (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    # at most (columns x partitions) and (columns) rows: bounded broadcasts
    pieces = hist.groupBy(*g, "_b").agg(F.sum("n").alias("_n"))
    before = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(*g, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*g, "_b").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        hist.join(F.broadcast(offsets), [*g, "_b"])
        .join(F.broadcast(totals), g)
        .withColumn("_first", F.col("_off") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_first") <= rank) & (rank < F.col("_first") + F.col("n")), F.col("x")))

    low = [F.floor(F.lit(p) * (F.col("count") - 1)) for p in PERCENTILES]
    high = [F.ceil(F.lit(p) * (F.col("count") - 1)) for p in PERCENTILES]
    got = ranked.groupBy(*g, "count", "mean", "min", "max").agg(
        F.sum(F.col("n") * (F.col("x") - F.col("mean")) ** 2).alias("_ss"),
        *[at(k).alias(f"_l{i}") for i, k in enumerate(low)],
        *[at(k).alias(f"_h{i}") for i, k in enumerate(high)],
    )
    share = [F.lit(p) * (F.col("count") - 1) - k for p, k in zip(PERCENTILES, low, strict=True)]
    names = tables[next(iter(columns))].sparkSession.createDataFrame([(t, c) for t, cs in columns.items() for c in cs], "table string, column string")
    return names.join(F.broadcast(got), g, "left").select(
        *g,
        F.coalesce("count", F.lit(0)).cast("double").alias("count"),
        "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - 1))).alias("std"),
        "min",
        *[
            (F.col(f"_l{i}") + share[i] * (F.col(f"_h{i}") - F.col(f"_l{i}"))).alias(f"p{int(p * 100)}")
            for i, p in enumerate(PERCENTILES)
        ],
        "max",
    )


RANGE_RULES = [
    # (columns, issue, predicate on the numeric value)
    ({"score", "weight"}, "outside expected 0-100 range", lambda x: (x < 0) | (x > 100)),
    ({"date_registration", "date_unregistration", "date_submitted", "date"}, "date offset less than -365", lambda x: x < -365),
    ({"sum_click"}, "negative click count", lambda x: x < 0),
]


def range_flags(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] = RANGE_COLUMNS) -> DataFrame:
    """Count rule violations per (table, column, issue), nonzero only;
    all rules of a table in one pass."""
    frames = []
    for t, cols in columns.items():
        df = tables[t]
        checks = [
            (c, issue, pred)
            for c in cols
            for names, issue, pred in RANGE_RULES
            if c in names
        ]
        if not checks:
            continue
        agg = df.agg(
            *[F.count_if(pred(numeric(c))).cast("long").alias(f"v{i}") for i, (c, _, pred) in enumerate(checks)]
        )
        stack = F.array(
            *[
                F.struct(_lit_str(c).alias("column"), _lit_str(issue).alias("issue"), F.col(f"v{i}").alias("count"))
                for i, (c, issue, _) in enumerate(checks)
            ]
        )
        frames.append(agg.select(_lit_str(t).alias("table"), F.inline(stack)))
    return union_all(frames).where("count > 0")


# ---------------------------------------------------------------- C5


def audit_risks(
    key_stats: DataFrame, dup_metrics: DataFrame, referential: DataFrame, flags: DataFrame
) -> DataFrame:
    """The five risk rules over the audit tables as (rule, triggered)."""
    m = dup_metrics.groupBy().pivot("metric", DUP_METRICS).agg(F.first("value"))
    parts = [
        key_stats.agg(F.max(F.col("duplicated_rows_by_key") > 0).alias("t")).select(
            _lit_str("key_not_unique").alias("rule"), F.coalesce("t", F.lit(False)).alias("triggered")
        ),
        m.select(
            _lit_str("vle_key_duplicates_after_exact_removal").alias("rule"),
            (F.col("remaining_key_duplicate_rows_after_exact_removal") > 0).alias("triggered"),
        ),
        m.select(
            _lit_str("vle_duplicate_groups_with_different_clicks").alias("rule"),
            (F.col("duplicated_key_groups_with_different_sum_click_after_exact_removal") > 0).alias("triggered"),
        ),
        referential.agg(F.sum(F.col("left_only") + F.col("right_only")).alias("s")).select(
            _lit_str("referential_orphans").alias("rule"), F.coalesce(F.col("s") > 0, F.lit(False)).alias("triggered")
        ),
        flags.agg(F.count(F.lit(1)).alias("n")).select(
            _lit_str("range_rule_violations").alias("rule"), (F.col("n") > 0).alias("triggered")
        ),
    ]
    return union_all(parts)


# ---------------------------------------------------------------- A21 / A22


def target_overall(info: DataFrame, target: str = "final_result") -> DataFrame:
    """Value counts with ratio over all rows (NULL kept as a value)."""
    c = info.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    # O1: count descending, value as the tie-break (value_counts order)
    return c.withColumn("ratio", F.col("count") / F.sum("count").over(Window.partitionBy())).orderBy(
        F.desc("count"), F.asc_nulls_last(target)
    )


def target_within(info: DataFrame, groups: Sequence[str], target: str = "final_result") -> DataFrame:
    """Value counts within groups and the ratio within each group."""
    c = info.groupBy(*groups, target).agg(F.count(F.lit(1)).alias("count"))
    return c.withColumn("ratio_within_group", F.col("count") / F.sum("count").over(Window.partitionBy(*groups)))


def target_grouping_sets(info: DataFrame, target: str = "final_result") -> DataFrame:
    """A21 + A22 in one aggregate: GROUPING SETS over (), (module),
    (presentation), (module, presentation), each with the target."""
    agg = info.sparkSession.sql(
        f"""
        select code_module, code_presentation, {target},
               grouping(code_module) * 2 + grouping(code_presentation) as gid,
               count(*) as count
        from {{info}}
        group by grouping sets ((code_module, code_presentation, {target}),
                                (code_module, {target}),
                                (code_presentation, {target}),
                                ({target}))
        """,
        info=info,
    )
    gid = F.col("gid")
    level = (
        F.when(gid == 0, "by_module_presentation")
        .when(gid == 1, "by_module")
        .when(gid == 2, "by_presentation")
        .otherwise("overall")
    )
    w = Window.partitionBy("gid", "code_module", "code_presentation")
    return agg.select(
        level.alias("grouping"),
        "code_module",
        "code_presentation",
        target,
        "count",
        (F.col("count") / F.sum("count").over(w)).alias("ratio_within_group"),
    )


# ---------------------------------------------------------------- C1


def integrity_audit(tables: Mapping[str, DataFrame], log_name: str = "student_vle") -> DataFrame:
    """The audit as one long table (section, item, metric, value)."""

    def long(df: DataFrame, section: str, item: Column, metrics: Sequence[str]) -> DataFrame:
        arr = F.array(
            *[F.struct(_lit_str(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
        )
        return df.select(_lit_str(section).alias("section"), item.cast("string").alias("item"), F.inline(arr))

    # small results that both the sections and the risk rules read: each is
    # computed once and written
    keys = materialize(key_uniqueness(tables), "audit-keys")
    facts = materialize(table_facts(tables), "audit-facts")  # one scan a table for three sections
    totals = materialize(dup_totals(tables[log_name]), "audit-duplicates")
    dups = _summary(totals)
    refs = materialize(referential_integrity(tables), "audit-references")
    flags = facts.select("table", F.inline("flags")).where("n > 0").withColumnRenamed("n", "count")
    missing = facts.select("table", F.inline("missing")).where("n > 0").withColumnRenamed("n", "missing_count")
    outcomes = target_grouping_sets(tables["student_info"]).withColumn(
        "group", F.concat_ws(".", "grouping", "code_module", "code_presentation", "final_result")
    )
    profile = column_profile(tables)
    parts = [
        long(facts, "table_shapes", F.col("table"), ["rows", "columns"]),
        long(missing, "missing_values", F.concat_ws(".", "table", "column"), ["missing_count"]),
        long(keys, "key_uniqueness", F.col("table"), ["duplicated_rows_by_key", "duplicated_key_groups"]),
        dups.select(
            _lit_str("duplicate_summary").alias("section"),
            _lit_str(log_name).alias("item"),
            "metric",
            F.col("value").cast("double").alias("value"),
        ),
        long(_group_sizes(totals), "duplicate_group_sizes", F.col("group_size"), ["group_count"]),  # A9
        long(refs, "referential_integrity", F.col("check"), ["both", "left_only", "right_only"]),
        long(
            profile,
            "column_profile",  # A19
            F.concat_ws(".", "table", "column"),
            ["count", "mean", "std", "min", *[f"p{int(p * 100)}" for p in PERCENTILES], "max"],
        ),
        long(flags, "range_flags", F.concat_ws(".", "table", "column"), ["count"]),
        long(outcomes, "outcomes", F.col("group"), ["count", "ratio_within_group"]),  # A21, A22
        audit_risks(keys, dups, refs, flags).select(
            _lit_str("risks").alias("section"),
            F.col("rule").alias("item"),
            _lit_str("triggered").alias("metric"),
            F.col("triggered").cast("double").alias("value"),
        ),
    ]
    return union_all(parts)
