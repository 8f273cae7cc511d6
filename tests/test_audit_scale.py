"""The audit's counts in bounded pieces, and how often it reads a table."""

from collections import Counter

import pytest

from cohortflow.operators import audit
from cohortflow.schemas import RAW_SCHEMAS
from test_micro import info_row


def test_exact_duplicates_are_counted_in_pieces_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(audit, "ROWS_A_TASK", 50, raising=False)
    rows = [(i % 301 or None, str(i % 301)) for i in range(400)] + [(7, "7")] * 60
    df = spark.createDataFrame(rows, "a long, b string")
    small = spark.createDataFrame([(1,), (1,), (None,)], "a long")
    pieces = []
    monkeypatch.setattr(audit, "_key_stats", lambda n, x, *a, f=audit._key_stats: (pieces.append(n), f(n, x, *a))[1])
    got = audit.exact_duplicates({"t": df, "small": small})
    assert {r.table: tuple(r)[1:] for r in got.collect()} == {"t": (460, 301, 159), "small": (3, 2, 1)}
    assert pieces == ["t", "small"]
    # 460 rows in ten pieces, whatever the session's number of partitions
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "], 10" in plan


@pytest.fixture
def tables(spark):
    make = lambda name, rows: spark.createDataFrame(rows, RAW_SCHEMAS[name])
    log = [("AAA", "2013J", s, 5, d, c) for s in range(6) for d in range(3) for c in ([4, 4, 9] if d == 1 else [2])]
    return {
        "courses": make("courses", [("AAA", "2013J", 240)]),
        "assessments": make("assessments", [("AAA", "2013J", a, "TMA", 20, 120.0 if a == 2 else 10.0) for a in range(4)]),
        "vle": make("vle", [(5, "AAA", "2013J", "forum", None, None)]),
        "student_info": make("student_info", [info_row(s) for s in range(6)]),
        "student_registration": make("student_registration", [("AAA", "2013J", s, -400 if s == 1 else -20, None) for s in range(6)]),
        "student_assessment": make("student_assessment", [(a, s, 15, 0, None if s == 3 else 70.0) for a in range(4) for s in range(6)]),
        "student_vle": make("student_vle", log),
    }


def test_the_audit_reads_a_table_once_for_shapes_missing_cells_and_flags(spark, tables, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    marks = dict(tables, student_assessment=tables["student_assessment"].mapInArrow(counted, RAW_SCHEMAS["student_assessment"]))
    collapses, groups = [], audit.event_key_groups
    monkeypatch.setattr(audit, "event_key_groups", lambda *a: collapses.append(1) or groups(*a))
    long = Counter((r.section, r.item, r.metric, r.value) for r in audit.integrity_audit(marks).collect())
    assert len(collapses) == 1  # group sizes and summary
    assert seen.value <= 4 * 24  # facts, keys, references, profile
    want = [
        ("table_shapes", "student_assessment", "rows", 24.0), ("missing_values", "student_assessment.score", "missing_count", 4.0),
        ("range_flags", "assessments.weight", "count", 1.0), ("range_flags", "student_registration.date_registration", "count", 1.0),
        ("duplicate_group_sizes", "2", "group_count", 6.0), ("duplicate_summary", "student_vle", "exact_duplicate_rows", 6.0),
        ("duplicate_summary", "student_vle", "remaining_key_duplicate_rows_after_exact_removal", 6.0), ("duplicate_summary", "student_vle", "raw_total_clicks", 126.0),
    ]
    assert [w for w in want if long[w] != 1] == []


def test_summary_of_an_empty_log(spark):
    log = spark.createDataFrame([], RAW_SCHEMAS["student_vle"])
    assert {r.value for r in audit.dup_summary(log).collect()} == {0} and audit.dup_group_sizes(log).count() == 0
