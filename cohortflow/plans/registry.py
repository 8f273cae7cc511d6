"""Named queries over the test tables: ``name -> f(spark, sf_dir)``.

Every query reads the course views built from the parquet tables under
``sf_dir`` and runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.plans import stages
from cohortflow.sources.fixtures import course_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _r6(df: DataFrame) -> DataFrame:
    """Round double columns to 6 places (float sums depend on row order)."""
    return df.withColumns({f.name: F.round(f.name, 6) for f in df.schema.fields if f.dataType.typeName() == "double"})


@query
def click_features_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(stages.click_features_mean(course_tables(spark, sf)))


# ---------------------------------------------------------------- audit
from cohortflow.operators import audit, collapse  # noqa: E402
from cohortflow.operators.features import activity_type_names  # noqa: E402


@query
def table_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return audit.table_shapes(course_tables(spark, sf))


@query
def missing_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(audit.missing_profile(course_tables(spark, sf)))


@query
def missing_top10(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(audit.missing_top(course_tables(spark, sf), 10))


@query
def key_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    return audit.key_uniqueness(course_tables(spark, sf))


@query
def exact_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return audit.exact_duplicates(course_tables(spark, sf))


@query
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return collapse.drop_exact_duplicates(course_tables(spark, sf)["student_vle"])


@query
def dup_group_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return audit.dup_group_sizes(course_tables(spark, sf)["student_vle"])


@query
def dup_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.dup_conflicts(course_tables(spark, sf)["student_vle"])


@query
def dup_strategy_totals(spark: SparkSession, sf: str) -> DataFrame:
    return audit.dup_strategy_totals(course_tables(spark, sf)["student_vle"])


@query
def dup_summary(spark: SparkSession, sf: str) -> DataFrame:
    return audit.dup_summary(course_tables(spark, sf)["student_vle"])


@query
def referential_integrity(spark: SparkSession, sf: str) -> DataFrame:
    return audit.referential_integrity(course_tables(spark, sf))


@query
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(audit.column_profile(course_tables(spark, sf)))


@query
def range_flags(spark: SparkSession, sf: str) -> DataFrame:
    return audit.range_flags(course_tables(spark, sf))


@query
def audit_risks(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    return audit.audit_risks(
        audit.key_uniqueness(t), audit.dup_summary(t["student_vle"]), audit.referential_integrity(t), audit.range_flags(t)
    )


@query
def target_overall(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(audit.target_overall(course_tables(spark, sf)["student_info"]))


@query
def target_by_pair(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(audit.target_within(course_tables(spark, sf)["student_info"], ["code_module", "code_presentation"]))


@query
def target_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(audit.target_grouping_sets(course_tables(spark, sf)["student_info"]))


@query
def collapse_sum_max(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    return collapse.collapse_sum_max(t["student_vle"], t["vle"])


@query
def collapse_mean(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    return _r6(collapse.collapse_mean(t["student_vle"], t["vle"]))


@query
def activity_types(spark: SparkSession, sf: str) -> DataFrame:
    return activity_type_names(course_tables(spark, sf)["vle"])


@query
def base_table(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    return stages.build_base(t["student_info"], t["student_registration"])


# ---------------------------------------------------------------- feature stages
from cohortflow.operators import features as feat  # noqa: E402

_E = ["code_module", "code_presentation", "id_student"]


@query
def click_features_sum_max(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    r = feat.click_rollup(t["student_vle"], t["vle"])
    return _r6(r.select("cutoff", "cutoff_day", *_E, *feat.STAGE3_CLICK_COLUMNS))


@query
def activity_pivot_observed(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    observed = feat.observed_activity_types(t["student_vle"], t["vle"])
    types = sorted({x for ts in observed.values() for x in ts})
    r = feat.click_rollup(t["student_vle"], t["vle"], stage3_types=types)
    return r.select("cutoff", *_E, *feat.stage3_pivot_columns(types))


@query
def activity_pivot_fixed(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    types = feat.dimension_activity_types(t["vle"])
    r = feat.click_rollup(t["student_vle"], t["vle"], baseline_types=types)
    return _r6(r.select("cutoff", *_E, *feat.baseline_pivot_columns(types)))


@query
def assessment_features(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    return _r6(feat.stage3_assessment_block(feat.assessment_rollup(t["student_assessment"], t["assessments"])))


@query
def assessment_features_clean(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    return _r6(feat.baseline_assessment_block(feat.assessment_rollup(t["student_assessment"], t["assessments"])))


@query
def features_stage3(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(stages.stage3_features(course_tables(spark, sf)))


@query
def stage3_without_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(stages.stage3_without_blocks(course_tables(spark, sf)))


@query
def cohort_stage4(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(stages.cohort_stage4(course_tables(spark, sf)))


@query
def already_withdrawn(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(stages.withdrawn_stage4(course_tables(spark, sf)))


@query
def baseline_stage5(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(stages.baseline_stage5(course_tables(spark, sf)))


# ---------------------------------------------------------------- cohort and evidence
from cohortflow.functions.columns import target_at_risk as _at_risk  # noqa: E402
from cohortflow.operators import cohort as coh  # noqa: E402
from cohortflow.operators import evidence as ev  # noqa: E402


def _base_cutoffs(t) -> DataFrame:
    return stages._base_by_cutoff(t, stages.CUTOFFS, True).withColumn("target_at_risk", _at_risk())


@query
def unmatched_rows(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    return ev.unmatched_rows(t["student_vle"], t["vle"], t["student_assessment"], t["assessments"])


@query
def cutoff_row_evidence(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    return ev.cutoff_row_evidence(t["student_vle"], t["student_assessment"], t["assessments"])


@query
def target_timing(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    return coh.target_timing(t["student_info"], t["student_registration"])


@query
def strict_target(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    return coh.strict_target(t["student_info"], t["student_registration"])


@query
def cohort_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    everyone = _base_cutoffs(t)
    return coh.cohort_counts(everyone, coh.active_cohort(everyone, t["student_registration"]))


@query
def zero_activity_share(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    clicks = stages.click_features_mean(t)
    base = stages._base_by_cutoff(t, stages.CUTOFFS, True).select("cutoff", *_E, "target_withdrawn")
    return ev.zero_activity_share(clicks.join(base, ["cutoff", *_E]), t["student_registration"])


@query
def outcome_behaviour(spark: SparkSession, sf: str) -> DataFrame:
    return ev.outcome_behaviour(stages.cohort_stage4(course_tables(spark, sf)))


@query
def strategy_totals_cohort(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    clicks = feat.click_rollup(t["student_vle"], t["vle"])
    return ev.strategy_totals(coh.active_cohort(clicks, t["student_registration"]))


@query
def on_time_share(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    return ev.on_time_share(t["student_assessment"], t["assessments"])


@query
def activity_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return ev.activity_gaps(course_tables(spark, sf)["student_vle"])


@query
def gap_by_target(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    cohort = coh.active_cohort(_base_cutoffs(t), t["student_registration"])
    return ev.gap_by_target(ev.activity_gaps(t["student_vle"]), cohort)


@query
def inactivity_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return ev.inactivity_ratio(stages.click_features_mean(course_tables(spark, sf)))


# ---------------------------------------------------------------- guards and validation
from cohortflow.operators import guards  # noqa: E402
from cohortflow.operators.observed import ObservedMatrix  # noqa: E402
from cohortflow.operators.joins import join_guard_report as _join_guard_report  # noqa: E402
from cohortflow.schemas import RECOMMENDED_PREDICTORS  # noqa: E402


@query
def join_guard_report(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    return _join_guard_report(
        {
            "student_registration": (t["student_registration"], _E),
            "student_info": (t["student_info"], _E),
            "vle": (t["vle"], ["id_site"]),
            "assessments": (t["assessments"], ["id_assessment"]),
        }
    )


@query
def validation_stage3(spark: SparkSession, sf: str) -> DataFrame:
    t = course_tables(spark, sf)
    blocks = stages.feature_blocks(t)
    s3 = stages.stage3_features(t, blocks=blocks)
    base_width = len(stages.BASE_COLUMNS) + len(feat.STAGE3_CLICK_COLUMNS) + len(feat.STAGE3_ASSESSMENT_COLUMNS)
    widths = {c: base_width + 2 * len(types) for c, types in blocks.stage3_types.items()}
    return guards.validation_stage3(s3, widths)


@query
def validation_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return guards.validation_baseline(stages.baseline_stage5(course_tables(spark, sf)))


@query
def label_domain(spark: SparkSession, sf: str) -> DataFrame:
    return guards.label_domain(stages.baseline_stage5(course_tables(spark, sf)))


@query
def flag_binary(spark: SparkSession, sf: str) -> DataFrame:
    return guards.flag_binary(stages.baseline_stage5(course_tables(spark, sf)))


@query
def late_registration(spark: SparkSession, sf: str) -> DataFrame:
    return guards.late_registration(stages.baseline_stage5(course_tables(spark, sf)))


@query
def missing_cells_stage3(spark: SparkSession, sf: str) -> DataFrame:
    return guards.missing_by_column(stages.stage3_features(course_tables(spark, sf)))


@query
def predictor_matrix(spark: SparkSession, sf: str) -> DataFrame:
    b = stages.baseline_stage5(course_tables(spark, sf))
    return _r6(guards.predictor_matrix(b, RECOMMENDED_PREDICTORS, excluded=guards.RECOMMENDED_EXCLUSIONS))


# ---------------------------------------------------------------- model evaluation
from cohortflow.operators import ml, svc, trees  # noqa: E402
from cohortflow.schemas import BASELINE_MODEL_FEATURES  # noqa: E402
from cohortflow.session import materialize  # noqa: E402


def _model_input(t) -> DataFrame:
    b = stages.baseline_stage5(t)
    guards.guard_predictors(BASELINE_MODEL_FEATURES)
    return b.select("cutoff", "cutoff_day", *_E, *BASELINE_MODEL_FEATURES, "target_at_risk")


def _folded(spark: SparkSession, sf: str) -> DataFrame:
    """The fold-assigned model input, written once under the checkpoint
    folder (every fit and metric reads it many times). The V4-V7 guards run
    on the written copy: required columns, no leakage column, labels
    consistent with the outcome, finite features."""
    b = stages.baseline_stage5(course_tables(spark, sf))
    guards.guard_predictors(BASELINE_MODEL_FEATURES)
    guards.require_columns(b, [*BASELINE_MODEL_FEATURES, "target_at_risk", "final_result", *_E])
    guards.forbid_columns(b)
    inp = b.select("cutoff", "cutoff_day", *_E, *BASELINE_MODEL_FEATURES, "target_at_risk", "final_result")
    folded = materialize(ml.assign_folds(inp), "model-input")
    guards.guard_no_duplicate_keys(folded, ["cutoff", *_E])
    guards.guard_labels(folded)
    guards.guard_finite(folded, BASELINE_MODEL_FEATURES)
    return folded.drop("final_result")


@query
def fold_assignment(spark: SparkSession, sf: str) -> DataFrame:
    return ml.assign_folds(_model_input(course_tables(spark, sf))).select("cutoff", *_E, "target_at_risk", "fold")


def _nb_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return ml.gaussian_nb_predictions(_folded(spark, sf), BASELINE_MODEL_FEATURES)


@query
def gaussian_nb(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(_nb_predictions(spark, sf))


@query
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return ml.classification_metrics(_nb_predictions(spark, sf))


@query
def metric_summary(spark: SparkSession, sf: str) -> DataFrame:
    folded = _folded(spark, sf)
    rows = folded.groupBy("cutoff").agg(F.count(F.lit(1)).alias("n_rows"))
    m = ml.classification_metrics(ml.gaussian_nb_predictions(folded, BASELINE_MODEL_FEATURES))
    return ml.metric_summary(m, rows, BASELINE_MODEL_FEATURES)


@query
def knn_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """M6 (+ M9 scaling): exact 5-NN on clicks and active days."""
    return _r6(ml.knn_predictions(_folded(spark, sf), *BASELINE_MODEL_FEATURES))


@query
def knn_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return ml.classification_metrics(ml.knn_predictions(_folded(spark, sf), *BASELINE_MODEL_FEATURES))


@query
def decision_tree(spark: SparkSession, sf: str) -> DataFrame:
    """M2: exact fully grown trees, one per cutoff and held-out fold."""
    return _r6(trees.decision_tree_predictions(_folded(spark, sf), BASELINE_MODEL_FEATURES))


@query
def decision_tree_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return ml.classification_metrics(trees.decision_tree_predictions(_folded(spark, sf), BASELINE_MODEL_FEATURES))


@query
def random_forest(spark: SparkSession, sf: str) -> DataFrame:
    """M4: 200 trees per cutoff and held-out fold."""
    return _r6(trees.random_forest_predictions(_folded(spark, sf), BASELINE_MODEL_FEATURES))


@query
def kernel_svc(spark: SparkSession, sf: str) -> DataFrame:
    """M5: the exact dual of the scaled RBF classifier."""
    return _r6(svc.svc_predictions(_folded(spark, sf), BASELINE_MODEL_FEATURES))


@query
def model_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """All five models of every cutoff and fold on the written
    two-feature matrix, each model one keyed fit, summarised like the reference."""
    folded = _folded(spark, sf)  # written: every fit reads the copy
    fits = [
        trees.decision_tree_predictions(folded, BASELINE_MODEL_FEATURES),
        trees.random_forest_predictions(folded, BASELINE_MODEL_FEATURES),
        svc.svc_predictions(folded, BASELINE_MODEL_FEATURES),
        ml.gaussian_nb_predictions(folded, BASELINE_MODEL_FEATURES),
        ml.knn_predictions(folded, *BASELINE_MODEL_FEATURES),
    ]
    preds = reduce(DataFrame.unionByName, fits)
    rows = folded.groupBy("cutoff").agg(F.count(F.lit(1)).alias("n_rows"))
    return ml.metric_summary(ml.classification_metrics(preds), rows, BASELINE_MODEL_FEATURES)


# ---------------------------------------------------------------- sources
import uuid as _uuid  # noqa: E402

from cohortflow.schemas import TABLE_FILES as _FILES  # noqa: E402
from cohortflow.session import ensure_checkpoint_dir  # noqa: E402
from cohortflow.sources import tables as _src  # noqa: E402


def _folder(spark: SparkSession, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{what}-{_uuid.uuid4().hex}"


@query
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S1-S3 + D1: write the seven tables as CSV with '?' for NULL under the
    shared checkpoint folder, read them back with fixed schemas, and compare
    each with its source as a bag of rows."""
    t = course_tables(spark, sf)
    back = _src.csv_roundtrip(t, _folder(spark, "csv"))
    return audit.union_all([audit.table_equality(n, t[n], back[n]) for n in t])


def _na_file(spark: SparkSession, sf: str) -> str:
    """student_registration as a CSV whose columns stand in another order and
    whose missing days are written with every NA token in turn."""
    t = course_tables(spark, sf)["student_registration"]
    tokens = F.array(*map(F.lit, ["?", *_src.NA_TOKENS]))
    token = F.get(tokens, F.pmod("id_student", F.lit(len(_src.NA_TOKENS) + 1)).cast("int"))
    day = lambda c: F.coalesce(F.col(c).cast("string"), token).alias(c)
    folder = _folder(spark, "na")
    t.select(day("date_unregistration"), "id_student", "code_presentation", day("date_registration"), "code_module").write.option(
        "header", True
    ).option("emptyValue", "").csv(f"{folder}/{_FILES['student_registration']}")
    return folder


@query
def csv_na(spark: SparkSession, sf: str) -> DataFrame:
    """S1 + S2: header order and NA tokens in numeric columns."""
    path = f"{_na_file(spark, sf)}/{_FILES['student_registration']}"
    return _src.read_csv_table(spark, path, "student_registration")


@query
def csv_equality(spark: SparkSession, sf: str) -> DataFrame:
    """D1 before and after NA normalisation: student_registration as two CSV
    copies, one with '?' and one with every NA token, compared as raw strings
    and as typed rows."""
    name = "student_registration"
    folder = _folder(spark, "csv-copy")
    _src.write_tables_csv({name: course_tables(spark, sf)[name]}, folder)
    paths = [f"{x}/{_FILES[name]}" for x in (folder, _na_file(spark, sf))]
    raw = [spark.read.option("header", True).csv(p) for p in paths]
    typed = [_src.read_csv_table(spark, p, name) for p in paths]
    cols = raw[0].columns
    return audit.union_all(
        [
            audit.bucketed_equality(stage, a.select(cols), b.select(cols), ["id_student"])
            for stage, (a, b) in (("before_na", raw), ("after_na", typed))
        ]
    ).drop("unequal_buckets")


@query
def csv_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Missing and mistyped cells per column of that file."""
    path = f"{_na_file(spark, sf)}/{_FILES['student_registration']}"
    return _src.bad_cells(spark, path, "student_registration")


@query
def derived_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S4 + S5: the flagship matrix written partitioned by cutoff and read back
    cutoff by cutoff, compared with its source as a bag of rows."""
    made = materialize(stages.click_features_mean(course_tables(spark, sf)), "click-features")
    path = _folder(spark, "by-cutoff")
    _src.write_by_cutoff(made, path)
    return audit.union_all(
        [
            audit.table_equality(c, made.where(F.col("cutoff") == c), _src.read_cutoff(spark, path, c).select(made.columns))
            for c in stages.CUTOFFS
        ]
    )


@query
def derived_rebuilt(spark: SparkSession, sf: str) -> DataFrame:
    """All cutoffs written with a wrong column first, then each rebuilt on its
    own, the others untouched; compared cutoff by cutoff."""
    made = materialize(stages.click_features_mean(course_tables(spark, sf)), "click-features")
    path = _folder(spark, "rebuilt")
    _src.write_by_cutoff(made.withColumn("active_days_until_cutoff", F.lit(-1).cast("long")), path)
    for c in stages.CUTOFFS:
        _src.write_by_cutoff(made.where(F.col("cutoff") == c), path)
    return audit.union_all(
        [
            audit.table_equality(c, made.where(F.col("cutoff") == c), _src.read_cutoff(spark, path, c).select(made.columns))
            for c in stages.CUTOFFS
        ]
    )


@query
def baseline_from_cohort(spark: SparkSession, sf: str) -> DataFrame:
    """C4 + S4: Stage 5 on top of a Stage 4 matrix written in buckets."""
    t = course_tables(spark, sf)
    stage4 = _src.write_bucketed(stages.cohort_stage4(t), _folder(spark, "stage4"), ["cutoff", *_E])
    return _r6(stages.baseline_from_stage4(stage4, t))


@query
def evidence_written(spark: SparkSession, sf: str) -> DataFrame:
    """The twelve evidence tables written as CSV with a manifest, and read
    back as (evidence, item, metric, value) rows, with the manifest's counts."""
    made = audit.evidence_tables(course_tables(spark, sf))
    path = _folder(spark, "evidence")
    manifest = _src.write_evidence(made, path)
    back = _src.read_evidence(spark, path, {n: df.schema for n, df in made.items()})
    counts = manifest.select("evidence", F.lit("manifest").alias("item"), F.lit("rows").alias("metric"), F.col("rows").cast("double").alias("value"))
    return _r6(audit.evidence_long(back).unionByName(counts))


@query
def baseline_written_validated(spark: SparkSession, sf: str) -> DataFrame:
    """S5 + V10: the Stage 5 matrix written by cutoff, its validation observed on
    the rows as they were written."""
    made = ObservedMatrix(stages.baseline_stage5(course_tables(spark, sf)))
    _src.write_by_cutoff(made.rows, _folder(spark, "baseline"))
    return made.validation_baseline()


@query
def stage3_written_missing(spark: SparkSession, sf: str) -> DataFrame:
    """S5 + V8: the Stage 3 matrix written by cutoff, its missing cells observed."""
    made = ObservedMatrix(stages.stage3_features(course_tables(spark, sf)))
    _src.write_by_cutoff(made.rows, _folder(spark, "stage3"))
    return made.missing_by_column()


@query
def model_results_written(spark: SparkSession, sf: str) -> DataFrame:
    """The model summary written as sorted CSV and read back."""
    made = metric_summary(spark, sf)
    path = _folder(spark, "model-results")
    _src.write_model_results(made, path)
    return spark.read.schema(made.schema).option("header", True).csv(path)


@query
def integrity_audit(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(audit.integrity_audit(course_tables(spark, sf)))


@query
def keyset_diff(spark: SparkSession, sf: str) -> DataFrame:
    """(cutoff, entity) keys of the Stage 3 matrix vs the Stage 4 cohort."""
    t = course_tables(spark, sf)
    s3 = stages.stage3_features(t)
    s4 = stages.cohort_stage4(t, stage3=s3)
    return audit.keyset_diff({"features_vs_cohort": s3}, {"features_vs_cohort": s4}, {"features_vs_cohort": ["cutoff", *_E]})


@query
def features_stage3_week5(spark: SparkSession, sf: str) -> DataFrame:
    """R1 schema drift: the day-35 matrix with only the activity types
    observed by day 35 (the long table carries the union)."""
    t = course_tables(spark, sf)
    blocks = stages.feature_blocks(t)
    return _r6(stages.stage3_for_cutoff(stages.stage3_features(t, blocks=blocks), blocks, "week5"))
