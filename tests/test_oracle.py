"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from cohortflow.plans.registry import QUERIES  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}
CHECKED = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_but_iterative_fits_has_an_oracle():
    missing = set(QUERIES) - set(ORACLE)
    # checked by test_trees.py and test_svc.py
    assert missing <= {"model_sweep", "random_forest", "kernel_svc"}, missing


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    con.execute(f"create or replace view oracle_query as {ORACLE[name]}")  # as the driver does
    cur = con.execute("select * from oracle_query")
    drows = [tuple(r) for r in cur.fetchall()]
    dcols = [d[0] for d in cur.description]
    assert compare(rows, df.columns, drows, dcols) == []


@pytest.mark.parametrize("name", ["metric_summary", "model_results_written"])
def test_results_are_ordered_by_cutoff_day(spark, name):
    rows = [r.cutoff for r in entry.queries()[name](spark, SF).collect()]
    assert rows == ["week5", "week7", "week10"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["cutoff", "code_module"]
