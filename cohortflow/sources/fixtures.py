"""Course-shaped views over the driver's TPC-H-like parquet tables.

Each view is SQL text written once and rendered twice: for Spark (base tables
passed as DataFrame arguments of ``spark.sql``) and for DuckDB (a CTE prefix
for the oracle queries). The definitions are fixed test inputs; they give the
clean test tables the shape and the defects of the real course data
(NULL dates, duplicate click keys, unknown sites, scores above 100, ...).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("customer", "nation", "part", "events", "orders", "lineitem")

# Fixed view definitions (test-input contract shared with the DuckDB oracle).
# ``{t}`` names a base table or an earlier view; ``DAYS(a, b)`` is a day
# difference a - b.
VIEW_SQL: dict[str, str] = {
    "student_info": """
select c.c_mktsegment as code_module,
       'R' || cast(n.n_regionkey as varchar(4)) as code_presentation,
       c.c_custkey as id_student,
       case when c.c_custkey % 2 = 0 then 'F' else 'M' end as gender,
       n.n_name as region,
       case when c.c_acctbal < 0 then 'Lower' when c.c_acctbal < 5000 then 'A Level' else 'HE' end as highest_education,
       case when c.c_custkey % 29 = 0 then null else 'B' || cast(c.c_custkey % 10 as varchar(4)) end as imd_band,
       case when c.c_custkey % 3 = 0 then '35-55' else '0-35' end as age_band,
       case when c.c_custkey % 8 = 0 then c.c_custkey % 5 else 0 end as num_of_prev_attempts,
       60 + 30 * (c.c_custkey % 4) as studied_credits,
       case when c.c_custkey % 10 = 0 then 'Y' else 'N' end as disability,
       case when c.c_custkey % 10 < 4 then 'Pass' when c.c_custkey % 10 < 7 then 'Withdrawn'
            when c.c_custkey % 10 < 9 then 'Fail' else 'Distinction' end as final_result
from {customer} c join {nation} n on c.c_nationkey = n.n_nationkey""",
    "student_registration": """
select code_module, code_presentation, id_student,
       case when id_student % 70 = 1 then null else cast((id_student * 37) % 420 as bigint) - 380 end as date_registration,
       case when final_result = 'Withdrawn' and id_student % 100 <> 4 then cast((id_student * 7) % 260 as bigint) - 60
            when id_student % 250 = 3 then -5 else null end as date_unregistration
from {student_info}""",
    "courses": """
select code_module, code_presentation, 240 + 5 * (count(*) % 7) as module_presentation_length
from {student_info} group by code_module, code_presentation""",
    "vle": """
select p_partkey as id_site,
       case when p_partkey = 11 then ' Repeat Activity/New-Type' else p_type end as activity_type,
       case when p_partkey % 5 = 0 then p_size else null end as week_from,
       case when p_partkey % 5 = 0 then p_size + 1 else null end as week_to
from {part}""",
    "student_vle": """
select code_module, code_presentation, id_student,
       case when slot = 7 and date > 49 then 11 when id_site = 11 then 12 else id_site end as id_site, date, sum_click
from (select s.code_module, s.code_presentation, s.id_student, e.event_id % 10 as slot,
             case when e.event_id % 50 = 9 then (select max(p_partkey) from {part}) + 1
                  else (s.id_student * 13 + e.event_id % 10) % ((select max(p_partkey) from {part}) + 1) end as id_site,
             4 * cast(DAYS(e.ts, date '2024-01-08') as bigint) as date,
             1 + cast(floor(e.value / 25) as bigint) as sum_click
      from {events} e join {student_info} s on e.user_id = s.id_student) x""",
    "assessments": """
select s.code_module, s.code_presentation, o.o_orderkey as id_assessment,
       case when o.o_orderkey % 3 = 0 then 'Exam' else 'TMA' end as assessment_type,
       case when o.o_orderkey % 20 = 0 then null else cast(DAYS(o.o_orderdate, date '1998-01-01') as bigint) + 30 end as date,
       cast(10 * (o.o_orderkey % 4) as double) as weight
from {orders} o join {student_info} s on o.o_custkey = s.id_student""",
    "student_assessment": """
select l.l_orderkey as id_assessment, o.o_custkey as id_student,
       cast(DAYS(l.l_shipdate, date '1998-01-01') as bigint) as date_submitted,
       case when l.l_linenumber = 1 then 1 else 0 end as is_banked,
       case when l.l_linenumber = 7 then null else 2 * l.l_quantity + 1 end as score
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey""",
}

VIEW_ORDER = tuple(VIEW_SQL)

_DAYS = re.compile(r"DAYS\(([^,()]+),\s*([^()]+?)\)")
_REF = re.compile(r"\{(\w+)\}")


def _refs(name: str) -> list[str]:
    return _REF.findall(VIEW_SQL[name])


def render_spark(name: str) -> str:
    return _DAYS.sub(r"datediff(\1, \2)", VIEW_SQL[name])


def render_duckdb(name: str) -> str:
    text = _DAYS.sub(r"date_diff('day', \2, cast(\1 as date))", VIEW_SQL[name])
    return _REF.sub(r"\1", text)


def duckdb_views(*names: str) -> str:
    """``WITH`` prefix defining the named views and the views they use, in
    dependency order (DuckDB has the base tables registered already)."""
    needed: list[str] = []

    def visit(view: str) -> None:
        for ref in _refs(view):
            if ref in VIEW_SQL:
                visit(ref)
        if view not in needed:
            needed.append(view)

    for view in names:
        visit(view)
    ctes = ",\n".join(f"{v} as ({render_duckdb(v)}\n)" for v in needed)
    return f"with {ctes}\n"


def read_base_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE_TABLES}


def course_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seven course tables as lazy DataFrames over ``sf_dir``."""
    frames: dict[str, DataFrame] = dict(read_base_tables(spark, sf_dir))
    for view in VIEW_ORDER:
        args = {ref: frames[ref] for ref in _refs(view)}
        frames[view] = spark.sql(render_spark(view), **args)
    return {v: frames[v] for v in VIEW_ORDER}
