"""Hand-made micro tables for the semantic traps (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import audit, features as feat, ml
from cohortflow.operators.cohort import active_cohort
from cohortflow.operators.cutoffs import expand_by_cutoff
from cohortflow.operators.guards import GuardError, guard_predictors
from cohortflow.operators.joins import JoinCardinalityError, join_validated
from cohortflow.plans import stages
from cohortflow.schemas import RAW_SCHEMAS

C35 = {"week5": 35}
STUDENT = ("AAA", "2013J", 1)


def info_row(sid=1, result="Pass"):
    return ("AAA", "2013J", sid, "M", "R1", "HE", "B1", "0-35", 0, 60, "N", result)


def make_tables(spark, vle_rows=(), subs=(), assess=(), reg=None, info=None, sites=((1, "resource"), (2, "quiz"))):
    info = info or [info_row()]
    reg = reg or [("AAA", "2013J", r[2], -10, None) for r in info]
    sv = [("AAA", "2013J", sid, site, day, clicks) for sid, site, day, clicks in vle_rows]
    return {
        "student_info": spark.createDataFrame(info, RAW_SCHEMAS["student_info"]),
        "student_registration": spark.createDataFrame(reg, RAW_SCHEMAS["student_registration"]),
        "vle": spark.createDataFrame([(s, "AAA", "2013J", t, None, None) for s, t in sites], RAW_SCHEMAS["vle"]),
        "student_vle": spark.createDataFrame(sv, RAW_SCHEMAS["student_vle"]),
        "assessments": spark.createDataFrame(
            [("AAA", "2013J", a, "TMA", due, w) for a, due, w in assess], RAW_SCHEMAS["assessments"]
        ),
        "student_assessment": spark.createDataFrame(
            [(a, sid, ds, 0, score) for a, sid, ds, score in subs], RAW_SCHEMAS["student_assessment"]
        ),
    }


def one(df, cutoff="week5"):
    rows = df.where(F.col("cutoff") == cutoff).collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_collapse_policies(spark):
    t = make_tables(spark, vle_rows=[(1, 1, 10, 3), (1, 1, 10, 3), (1, 1, 10, 9)])
    r = one(feat.click_rollup(t["student_vle"], t["vle"], C35))
    assert r["total_click_until_cutoff_sum_strategy"] == 12
    assert r["total_click_until_cutoff_max_strategy"] == 9
    assert r["total_click_until_cutoff_mean_strategy"] == pytest.approx(5.0)


def test_cutoff_is_inclusive(spark):
    t = make_tables(spark, vle_rows=[(1, 1, 34, 1), (1, 1, 35, 1), (1, 1, 36, 1)])
    r = one(feat.click_rollup(t["student_vle"], t["vle"], C35))
    assert r["active_days_until_cutoff"] == 2
    assert r["last_activity_date_until_cutoff"] == 35
    assert r["days_since_last_activity_at_cutoff"] == 0


def test_future_row_changes_nothing(spark):
    base = [(1, 1, 5, 2), (1, 2, 20, 4)]
    a = make_tables(spark, vle_rows=base)
    b = make_tables(spark, vle_rows=base + [(1, 2, 36, 100)])
    fa = stages.stage3_features(a, C35).drop("cutoff_day").collect()
    fb = stages.stage3_features(b, C35).drop("cutoff_day").collect()
    assert fa == fb


def test_all_due_dates_missing(spark):
    t = make_tables(spark, subs=[(10, 1, 5, 50.0), (10, 1, 6, 60.0)], assess=[(10, None, 10.0)])
    s3 = one(stages.stage3_features(t, C35))
    assert s3["submitted_late_count_until_cutoff"] == 0
    assert s3["assessment_rows_missing_due_date_until_cutoff"] == 2
    b5 = one(stages.baseline_stage5(t, C35))
    assert b5["assessment_count_until_cutoff"] == 0
    assert b5["scored_assessment_count_until_cutoff_missing"] == 1
    assert b5["mean_score_until_cutoff"] == 0 and b5["mean_score_until_cutoff_missing"] == 1


def test_weighted_score_zero_weight_and_unscored(spark):
    t = make_tables(spark, subs=[(10, 1, 5, 50.0), (11, 1, 5, 60.0)], assess=[(10, 20, 0.0), (11, 20, 0.0)])
    assert one(stages.stage3_features(t, C35))["weighted_score_until_cutoff"] is None
    b5 = one(stages.baseline_stage5(t, C35))
    assert b5["weighted_score_until_cutoff"] == 0 and b5["weighted_score_until_cutoff_missing"] == 1
    t = make_tables(spark, subs=[(10, 1, 5, 80.0), (11, 1, 5, None)], assess=[(10, 20, 10.0), (11, 20, 30.0)])
    assert one(stages.stage3_features(t, C35))["weighted_score_until_cutoff"] == pytest.approx(80.0)


def test_submitted_on_due_day(spark):
    t = make_tables(spark, subs=[(10, 1, 20, 70.0)], assess=[(10, 20, 10.0)])
    b5 = one(stages.baseline_stage5(t, C35))
    assert b5["submitted_late_count_until_cutoff"] == 0
    assert b5["on_time_submission_count_until_cutoff"] == 1
    assert b5["avg_days_before_due_until_cutoff"] == 0


def test_no_activity_and_first_day_zero(spark):
    t = make_tables(spark, info=[info_row(1), info_row(2)], vle_rows=[(2, 1, 0, 5)])
    s3 = {r.id_student: r.asDict() for r in stages.stage3_features(t, C35).collect()}
    assert s3[1]["total_click_until_cutoff_sum_strategy"] == 0 and s3[1]["active_days_until_cutoff"] == 0
    assert s3[1]["first_activity_date_until_cutoff"] is None
    b5 = {r.id_student: r.asDict() for r in stages.baseline_stage5(t, C35).collect()}
    assert b5[1]["first_activity_date_until_cutoff"] == 0 and b5[1]["first_activity_date_until_cutoff_missing"] == 1
    assert b5[2]["first_activity_date_until_cutoff"] == 0 and b5[2]["first_activity_date_until_cutoff_missing"] == 0


def test_cohort_keeps_later_and_undated(spark):
    info = [info_row(i, "Withdrawn") for i in (1, 2, 3, 4)]
    reg = [("AAA", "2013J", 1, 0, 34), ("AAA", "2013J", 2, 0, 35), ("AAA", "2013J", 3, 0, 36), ("AAA", "2013J", 4, 0, None)]
    t = make_tables(spark, info=info, reg=reg)
    base = expand_by_cutoff(stages.build_base(t["student_info"], t["student_registration"]), None, C35)
    kept = sorted(r.id_student for r in active_cohort(base, t["student_registration"], C35).collect())
    assert kept == [3, 4]


def test_unknown_site(spark):
    t = make_tables(spark, vle_rows=[(1, 1, 5, 2), (1, 99, 5, 3)])
    types = feat.observed_activity_types(t["student_vle"], t["vle"], C35)["week5"]
    assert "unknown_activity_type" in types
    s3 = one(stages.stage3_features(t, C35))
    assert s3["total_click_until_cutoff_sum_strategy"] == 5
    assert s3["clicks_activity_unknown_activity_type_sum_strategy"] == 3
    b5 = one(stages.baseline_stage5(t, C35))
    assert not any("unknown" in c for c in b5)
    assert b5["total_click_until_cutoff_mean_strategy"] == pytest.approx(5.0)


def test_duplicate_counting_with_null_key(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a long, b long")
    r = audit.key_uniqueness({"t": df}, {"t": ["a", "b"]}).first()
    assert (r.duplicated_rows_by_key, r.duplicated_key_groups) == (1, 1)


def test_referential_null_keys_match(spark):
    left = spark.createDataFrame([(None,), (1,)], "k long")
    right = spark.createDataFrame([(None,), (2,)], "k long")
    r = audit.key_match_counts("x", left, right, ["k"]).first()
    assert (r.both, r.left_only, r.right_only) == (1, 1, 1)


def test_join_guard_raises(spark):
    left = spark.createDataFrame([(1,)], "k long")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(JoinCardinalityError):
        join_validated(left, right, ["k"], validate="many_to_one")


def test_in_plan_uniqueness_guard_raises(spark):
    info = [info_row(1), info_row(1)]
    t = make_tables(spark, info=info, reg=[("AAA", "2013J", 1, 0, None)])
    with pytest.raises(Exception, match="not unique"):
        stages.build_base(t["student_info"], t["student_registration"]).collect()


def test_leak_guard_raises():
    with pytest.raises(GuardError):
        guard_predictors(["active_days_until_cutoff", "final_result"])


def test_percentiles_linear(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x long")
    r = audit.column_profile({"t": df}, {"t": ["x"]}).first()
    assert r.p25 == pytest.approx(1.75) and r.p50 == pytest.approx(2.5)
    assert r["std"] == pytest.approx(1.2909944487)


def test_auc_with_ties(spark):
    preds = spark.createDataFrame(
        [("c", "m", 0, 0, 0, 0.5), ("c", "m", 0, 1, 1, 0.5), ("c", "m", 0, 0, 0, 0.1), ("c", "m", 0, 1, 1, 0.9)],
        "cutoff string, model string, fold long, label long, prediction long, score double",
    )
    r = ml.classification_metrics(preds).first()
    assert r.roc_auc == pytest.approx(0.875)
    assert r.accuracy == pytest.approx(1.0)


def test_folds_are_stratified(spark):
    rows = [("w", "AAA", "P", i, i % 3 == 0) for i in range(1, 101)]
    df = spark.createDataFrame(rows, "cutoff string, code_module string, code_presentation string, id_student long, y boolean")
    df = df.withColumn("target_at_risk", F.col("y").cast("long"))
    f = ml.assign_folds(df)
    counts = {(r.target_at_risk, r.fold): r["count"] for r in f.groupBy("target_at_risk", "fold").count().collect()}
    for y in (0, 1):
        sizes = [counts.get((y, k), 0) for k in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_rewritten_dimension_is_read_anew(spark, tmp_path):
    path = str(tmp_path / "vle")
    site = lambda rows: spark.createDataFrame([(i, "AAA", "2013J", t, None, None) for i, t in rows], RAW_SCHEMAS["vle"])
    site([(1, "forum")]).write.mode("overwrite").parquet(path)
    assert feat.dimension_activity_types(spark.read.parquet(path)) == ["forum"]
    site([(1, "forum"), (2, "quiz")]).write.mode("overwrite").parquet(path)
    assert feat.dimension_activity_types(spark.read.parquet(path)) == ["forum", "quiz"]


def test_repeated_assessment_id_is_an_error(spark):
    t = make_tables(spark, subs=[(1, 1, 5, 50.0)], assess=[(1, 10, 10.0), (1, 12, 20.0)])
    with pytest.raises(Exception, match="not unique"):
        feat.assessment_rollup(t["student_assessment"], t["assessments"], C35).collect()


def test_rollup_of_one_busy_entity(spark):
    """One student with a third of the log, counted against plain sets."""
    busy = [(1, d % 40, d % 36, 1 + d % 3) for d in range(600)]
    rest = [(2 + i % 30, i % 7, i % 50, i % 5) for i in range(1200)]
    t = make_tables(spark, vle_rows=busy + rest, info=[info_row(i) for i in range(1, 32)])
    got = {r.id_student: r for r in feat.click_rollup(t["student_vle"], t["vle"], C35).collect()}
    for sid in (1, 2, 9):
        rows = {r for r in busy + rest if r[0] == sid and r[2] <= 35}
        assert got[sid].active_days_until_cutoff == len({r[2] for r in rows})
        assert got[sid].used_site_count_until_cutoff == len({r[1] for r in rows})
        assert got[sid].total_click_until_cutoff_sum_strategy == sum(r[3] for r in rows)


def test_knn_equals_all_pairs(spark):
    rng = __import__("random").Random(3)
    rows = []
    for i in range(160):
        v, r = (0.0, 0) if i % 3 == 0 else (round(rng.choice([1.0, 2.5, rng.uniform(0, 9)]), 3), rng.randrange(6))
        rows.append(("week5", i % 5, "AAA", "2013J", i, v, r, rng.randrange(2)))
    df = spark.createDataFrame(rows, "cutoff string, fold long, code_module string, code_presentation string, id_student long, v double, r long, target_at_risk long")
    got = {x.id_student: x.score for x in ml.knn_predictions(df, "v", "r").collect()}
    import statistics

    for _, fold, _, _, i, v, r, _ in rows:
        train = [x for x in rows if x[1] != fold]
        sv, sr = (statistics.pstdev(float(x[k]) for x in train) for k in (5, 6))
        best = sorted(train, key=lambda x: (((x[5] - v) / sv) ** 2 + ((x[6] - r) / sr) ** 2, x[4]))[:5]
        assert got[i] == pytest.approx(sum(x[7] for x in best) / 5), i


def test_knn_visits_only_lines_within_the_bound(spark, monkeypatch):
    """20 lines of 60 points in a fold, so far apart in scaled distance that a
    query's home line bounds most others. Values with too few points reach to
    further lines, sparse folds to all."""
    rng = __import__("random").Random(4)
    rows = [("week5", i % 2, "AAA", "2013J", i, rng.uniform(0, 1), i // 120 * 12, i % 2) for i in range(2400)]
    rows += [("week7", i % 2, "AAA", "2013J", i, float(i), 10 * i, i % 2) for i in range(6)]
    rows += [("week5", i % 2, "AAA", "2013J", 9000 + i, 0.5, 260 + i, i % 2) for i in range(8)]
    df = spark.createDataFrame(rows, "cutoff string, fold long, code_module string, code_presentation string, id_student long, v double, r long, target_at_risk long")
    placed, plain = [], ml._on_lines

    def counted(train, asked, g, k):
        placed.append(asked.count())
        return plain(train, asked, g, k)

    monkeypatch.setattr(ml, "_on_lines", counted)
    got = {(x.cutoff, x.id_student): x.score for x in ml.knn_predictions(df, "v", "r").collect()}
    assert len(got) == len(rows) and placed[0] < 1.1 * len(rows) and placed[1] < 2 * len(rows)  # of 20 a row
    import statistics

    for cutoff, fold, _, _, i, v, r, _ in rows[:40] + rows[2400:]:
        train = [x for x in rows if x[0] == cutoff and x[1] != fold]
        sv, sr = (statistics.pstdev(float(x[k]) for x in train) for k in (5, 6))
        best = sorted(train, key=lambda x: (((round(x[5], 6) - round(v, 6)) / sv) ** 2 + ((x[6] - r) / sr) ** 2, x[4]))[:5]
        assert got[cutoff, i] == pytest.approx(sum(x[7] for x in best) / len(best)), (cutoff, i)


def test_dropping_a_block_names_absent_columns(spark):
    from cohortflow.operators.baseline import without_blocks

    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert without_blocks(df, ["b"], ["c"]).columns == ["a"]
    with pytest.raises(ValueError, match="zz"):
        without_blocks(df, ["zz"])
