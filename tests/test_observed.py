"""Checks observed while a matrix is written, against the checks that read it."""

import collections

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import guards
from cohortflow.operators.observed import ObservedMatrix
from cohortflow.plans import stages
from cohortflow.session import materialize
from cohortflow.sources import tables as src
from cohortflow.sources.fixtures import course_tables

SF = "/root/testdata/sf0.001"


def bag(df):
    return collections.Counter(tuple(sorted(r.asDict().items())) for r in df.collect())


@pytest.fixture(scope="module")
def awkward(spark):
    """A Stage 5 matrix with repeated keys, nulls, flags beyond 0 and 1, days
    after the cutoff and unknown outcomes."""
    m = materialize(stages.baseline_stage5(course_tables(spark, SF)), "awkward")
    h = F.pmod(F.xxhash64("cutoff", *stages.E), F.lit(7))
    m = m.withColumns(
        {
            "imd_band_missing": F.when(h == 1, 2).otherwise(F.col("imd_band_missing")),
            "last_activity_date_until_cutoff": F.when((h == 2) & (F.col("cutoff") == "week5"), 99).otherwise(F.col("last_activity_date_until_cutoff")),
            "date_registration": F.when(h == 3, 60).otherwise(F.col("date_registration")),
            "final_result": F.when(h == 4, "Other").when(h == 5, None).otherwise(F.col("final_result")),
            "target_at_risk": F.when(h == 6, None).otherwise(F.col("target_at_risk")),
            "age_band": F.when(h == 1, None).otherwise(F.col("age_band")),
        }
    )
    return materialize(m.unionByName(m.where(h < 2)), "awkward")


def test_observed_checks_equal_the_checks_that_read(spark, awkward, tmp_path):
    made = ObservedMatrix(awkward)
    src.write_by_cutoff(made.rows, str(tmp_path / "m"))
    written = spark.read.schema(awkward.schema).parquet(str(tmp_path / "m"))
    assert set(written.columns) == set(awkward.columns) and bag(written.select(awkward.columns)) == bag(awkward)
    for name in ("validation_baseline", "label_domain", "flag_binary", "late_registration", "missing_by_column"):
        want = getattr(guards, name)(awkward)
        got = getattr(made, name)()
        assert got.columns == want.columns and bag(got) == bag(want), name
        assert [f.dataType.simpleString() for f in got.schema] == [f.dataType.simpleString() for f in want.schema], name
    widths = {c: 5 for c in stages.CUTOFFS}
    assert bag(made.validation_stage3(widths)) == bag(guards.validation_stage3(awkward, widths))
    first = made.validation_baseline().where("cutoff = 'week5'").first()
    assert first.duplicated_base_key_rows > 0 and first.non_binary_missing_flags == "imd_band_missing"
    assert first.after_cutoff_feature_violations == "last_activity_date_until_cutoff"
    order = [r.cutoff for r in made.all_checks().collect()]
    assert list(dict.fromkeys(order)) == ["week5", "week7", "week10"]


def test_cutoffs_without_rows_and_of_other_names(spark, awkward):
    made = ObservedMatrix(awkward.where("cutoff = 'week7'"))
    made.rows.write.format("noop").mode("overwrite").save()
    assert [r.cutoff for r in made.validation_baseline().collect()] == ["week7"]
    empty = ObservedMatrix(awkward.limit(0))
    empty.rows.write.format("noop").mode("overwrite").save()
    assert empty.validation_baseline().collect() == [] and empty.all_checks().collect() == []
    other = ObservedMatrix(awkward, {"week5": 35})
    other.rows.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="other than"):
        other.values()


def test_the_write_is_one_pass_and_needs_no_further_exchange(spark):
    """Counting rows of a key lies on the matrix' own partitioning."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        matrix = stages.baseline_stage5(course_tables(spark, SF))
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        plain, observed = plan(matrix), plan(ObservedMatrix(matrix).rows)
        assert observed.count("CollectMetrics") == 1
        assert observed.count("Exchange hashpartitioning") == plain.count("Exchange hashpartitioning")
        assert observed.count("events.parquet") == plain.count("events.parquet") == 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
