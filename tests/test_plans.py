"""Plan checks: one scan of the click log for all cutoffs, no Python UDF,
filters reach the scan."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stage3_reads_event_log_once_for_all_cutoffs(spark):
    p = plan(entry.queries()["features_stage3"](spark, SF))
    assert p.count("events.parquet") == 1
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_click_features_push_cutoff_to_scan(spark):
    p = plan(entry.queries()["click_features_mean"](spark, SF))
    scan = [line for line in p.splitlines() if "events.parquet" in line][0]
    assert "<= 70" in scan


def test_baseline_has_no_python_udf(spark):
    p = plan(entry.queries()["baseline_stage5"](spark, SF))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_no_object_hash_aggregate_on_the_log(spark):
    for name in ("features_stage3", "baseline_stage5", "dup_summary"):
        p = plan(entry.queries()[name](spark, SF))
        assert "ObjectHashAggregate" not in p, name


def test_baseline_reads_the_log_once_in_all_its_jobs(spark):
    """Stage 5 needs no observed types: building it scans no log, running it one."""
    tracker = spark.sparkContext.statusTracker()
    from cohortflow.plans import stages
    from cohortflow.sources.fixtures import course_tables

    tables = course_tables(spark, SF)
    spark.sparkContext.setJobGroup("build", "build")
    df = stages.baseline_stage5(tables)
    spark.sparkContext.setJobGroup("other", "other")
    # only the dimension's category list runs while the plan is built
    assert len(tracker.getJobIdsForGroup("build")) <= 2
    assert plan(df).count("events.parquet") == 1
