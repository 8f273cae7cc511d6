"""Sources (S1, S2, S4, S5) and raising guards (V2, V4, V6, V7)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import guards
from cohortflow.sources import tables as src
from cohortflow.schemas import RAW_SCHEMAS


def test_load_tables_raises_when_a_table_is_absent(spark):
    d = tempfile.mkdtemp(prefix="cohortflow-src-")
    with pytest.raises(src.MissingTableError):
        src.load_tables(spark, d)


def test_question_mark_and_na_tokens_read_as_null(spark):
    d = tempfile.mkdtemp(prefix="cohortflow-src-")
    path = os.path.join(d, "studentRegistration.csv")
    with open(path, "w") as fh:
        fh.write("code_module,code_presentation,id_student,date_registration,date_unregistration\n")
        fh.write("AAA,2013J,1,?,?\n")
        fh.write("NA,2013J,2,-10,\n")
    df = src.read_csv_table(spark, path, "student_registration")
    rows = sorted(df.collect(), key=lambda r: r.id_student)
    assert rows[0].date_registration is None and rows[0].date_unregistration is None
    assert rows[1].code_module is None and rows[1].date_registration == -10
    assert rows[1].date_unregistration is None


def test_fixed_schema_keeps_codes_as_strings(spark):
    d = tempfile.mkdtemp(prefix="cohortflow-src-")
    path = os.path.join(d, "courses.csv")
    with open(path, "w") as fh:
        fh.write("code_module,code_presentation,module_presentation_length\nAAA,2014,268\n")
    df = src.read_csv_table(spark, path, "courses")
    assert df.schema == RAW_SCHEMAS["courses"]
    assert df.first().code_presentation == "2014"


def test_write_and_read_one_cutoff(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="cohortflow-src-"), "m")
    df = spark.createDataFrame([("week5", 1), ("week7", 2)], "cutoff string, v long")
    src.write_by_cutoff(df, d)
    assert [r.v for r in src.read_cutoff(spark, d, "week7").collect()] == [2]


def test_column_guards(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "a long, b double, date_unregistration long")
    with pytest.raises(guards.GuardError):
        guards.require_columns(df, ["a", "z"])
    with pytest.raises(guards.GuardError):
        guards.forbid_columns(df)
    bad = spark.createDataFrame([(1.0,), (float("inf"),)], "x double")
    with pytest.raises(guards.GuardError):
        guards.guard_finite(bad, ["x"])


def test_label_guard(spark):
    df = spark.createDataFrame(
        [("c", "Pass", 0), ("c", "Fail", 0), ("c", "Unknown", 1)], "cutoff string, final_result string, target_at_risk long"
    )
    row = guards.label_domain(df).first()
    assert (row.unknown_results, row.target_mismatches) == (1, 2)
    with pytest.raises(guards.GuardError):
        guards.guard_labels(df)
    ok = df.where(F.col("final_result") == "Pass")
    guards.guard_labels(ok)


def test_columns_are_bound_by_header_name(spark, tmp_path):
    path = tmp_path / "studentRegistration.csv"
    path.write_text(
        "extra,date_unregistration,id_student,code_presentation,code_module,date_registration\n"
        "x,NaN,7,2013J,AAA,-5\ny,12,8,2014B,BBB,#N/A N/A\n"
    )
    rows = sorted(map(tuple, src.read_csv_table(spark, str(path), "student_registration").collect()))
    assert rows == [("AAA", "2013J", 7, -5, None), ("BBB", "2014B", 8, None, 12)]


def test_mistyped_cells_fail_and_are_counted(spark, tmp_path):
    path = tmp_path / "courses.csv"
    path.write_text("code_module,code_presentation,module_presentation_length\nAAA,2014J,long\nBBB,2014J,1.#IND\n")
    with pytest.raises(Exception, match="module_presentation_length"):
        src.read_csv_table(spark, str(path), "courses").collect()
    got = {r.column: (r.missing_cells, r.bad_cells) for r in src.bad_cells(spark, str(path), "courses").collect()}
    assert got == {"code_module": (0, 0), "code_presentation": (0, 0), "module_presentation_length": (1, 1)}


def test_missing_column_is_named(spark, tmp_path):
    path = tmp_path / "courses.csv"
    path.write_text("code_module,code_presentation\nAAA,2014J\n")
    with pytest.raises(src.MissingColumnError, match="module_presentation_length"):
        src.read_csv_table(spark, str(path), "courses")


def test_no_private_scratch_folder_off_a_local_master():
    from cohortflow.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_duplicate_keys_stop_the_model_input(spark):
    df = spark.createDataFrame([("c", "A", "P", 1), ("c", "A", "P", 1)], "cutoff string, code_module string, code_presentation string, id_student long")
    with pytest.raises(guards.GuardError):
        guards.guard_no_duplicate_keys(df)
