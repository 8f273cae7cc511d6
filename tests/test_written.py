"""Written tables: one cutoff rebuilt alone, the evidence folder and manifest."""

import os

from pyspark.sql import functions as F

from cohortflow.operators import audit
from cohortflow.sources import tables as src
from cohortflow.sources.fixtures import course_tables

SF = "/root/testdata/sf0.001"


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_one_cutoff_is_rebuilt_alone(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = spark.range(30).select(F.concat(F.lit("week"), (F.col("id") % 3).cast("string")).alias("cutoff"), "id")
    src.write_by_cutoff(rows, path)
    before = files(path)
    src.write_by_cutoff(rows.where("cutoff = 'week1'").withColumn("id", F.col("id") + 100), path)
    after = files(path)
    same = {f for f in before if "cutoff=week1" not in f}
    assert same and all(after.get(f) == before[f] for f in same)
    assert not {f for f in before if "cutoff=week1" in f} & set(after)
    assert {r.id for r in src.read_cutoff(spark, path, "week1").collect()} == {i + 100 for i in range(30) if i % 3 == 1}
    assert src.read_cutoff(spark, path, "week2").count() == 10


def test_evidence_folder_has_twelve_tables_and_a_manifest(spark, tmp_path):
    made = audit.evidence_tables(course_tables(spark, SF))
    src.write_evidence(made, str(tmp_path))
    assert len(made) == 12 and sorted(os.listdir(tmp_path)) == sorted([*(f"{n}.csv" for n in made), "manifest.csv"])
    back = src.read_evidence(spark, str(tmp_path), {n: df.schema for n, df in made.items()})
    manifest = {r.evidence: int(r.rows) for r in spark.read.option("header", True).csv(str(tmp_path / "manifest.csv")).collect()}
    assert manifest == {n: df.count() for n, df in back.items()} and manifest["table_shapes"] == 7


def test_facts_of_a_table_come_from_one_scan(spark):
    plan = audit.table_facts(course_tables(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") == 1


def test_only_unequal_buckets_are_compared(spark):
    rows = spark.range(500).select("id", (F.col("id") % 7).alias("v"), F.when(F.col("id") % 3 > 0, "x").alias("s"))
    same = audit.bucketed_equality("t", rows, rows.repartition(3).select("id", "v", "s"), ["id"], 16).first()
    assert same.equal and same.unequal_buckets == 0 and (same.rows_a, same.rows_b, same.only_in_a, same.only_in_b) == (500, 500, 0, 0)
    other = rows.withColumn("v", F.when(F.col("id") == 9, -1).otherwise(F.col("v")))
    got = audit.bucketed_equality("t", rows, other, ["id"], 16).first()
    assert not got.equal and got.unequal_buckets == 1 and (got.only_in_a, got.only_in_b) == (1, 1)
    # a NULL is not an empty string, a copy is not its original, an absent bucket counts
    null = audit.bucketed_equality("t", rows, rows.fillna("", ["s"]), ["id"], 16).first()
    assert null.only_in_a == null.only_in_b == 167
    twice = audit.bucketed_equality("t", rows, rows.union(rows.where("id = 4")), ["id"], 16).first()
    assert (twice.rows_b, twice.only_in_a, twice.only_in_b, twice.unequal_buckets) == (501, 0, 1, 1)
    none = audit.bucketed_equality("t", rows.limit(0), rows.where("id = 4"), ["id"], 16).first()
    assert (none.rows_a, none.only_in_b, none.equal) == (0, 1, False)


def test_a_bucketed_stage4_is_joined_without_an_exchange(spark, tmp_path):
    from cohortflow.plans import stages
    from cohortflow.session import materialize

    key = ["cutoff", "code_module", "code_presentation", "id_student"]
    t = course_tables(spark, SF)
    made = materialize(stages.cohort_stage4(t), "stage4")
    bucketed = src.write_bucketed(made, str(tmp_path / "s4"), key)
    assert len(files(str(tmp_path / "s4"))) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [stages.baseline_from_stage4(x, t)._jdf.queryExecution().executedPlan().toString() for x in (made, bucketed)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plain, kept = (p.count("Exchange hashpartitioning(cutoff") for p in plans)
    assert kept == plain - 1
    # Stage 3 columns are not read
    scan = next(line for line in plans[1].splitlines() if "bucketed_" in line or "/s4" in line)
    assert "clicks_activity_" not in scan and "weighted_score" not in scan


def test_no_wide_row_crosses_the_last_shuffle(spark):
    """The conditional sums per activity type stand above the last exchange."""
    import __spark_entry__ as entry

    plan = entry.queries()["features_stage3"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    wide = [k for k, line in enumerate(lines) if "max(CASE WHEN (activity_clean" in line]
    assert wide
    for k in wide:
        above = next(line for line in reversed(lines[:k]) if "WholeStageCodegen" not in line and "Project" not in line)
        assert "Exchange hashpartitioning" not in above or "partial_max" not in lines[k]
