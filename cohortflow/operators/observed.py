"""Validation of a matrix while it is written.

The checks of :mod:`guards` (V1, V5, V6, V8, V10, V12) as metrics that Spark
observes on the rows on their way to the files: no second read of the matrix and
no job beside the write. Every metric is a plain sum, count or maximum under the
condition of one cutoff, so an observation holds (cutoffs x metrics) numbers
however many rows pass.

A key that stands twice cannot be told from one row. The rows of a matrix lie
hash-partitioned by (cutoff, entity) behind its joins, so a count over that key
needs no exchange there; it is observed and left out of the files.

The observation stands behind the last shuffle, in the tasks that write: of a
task that is run again after a lost executor, one attempt counts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from cohortflow.functions.columns import target_from_map
from cohortflow.operators.cutoffs import day_of
from cohortflow.operators.guards import _DATE_COLS, KEYS, E
from cohortflow.schemas import CUTOFFS, FORBIDDEN_COLUMNS, REQUIRED_BASELINE_FEATURES, TARGET_MAP

TIMES = "_rows_of_key"


class ObservedMatrix:
    """``rows`` is to be written (or read in full) once; then the reports give
    what the validation queries give on the written matrix.

    A cutoff without rows has no row in a report; rows of a cutoff that
    ``cutoffs`` does not name fail the reports (they would not be validated)."""

    def __init__(self, matrix: DataFrame, cutoffs: Mapping[str, int] = CUTOFFS) -> None:
        self.spark, self.cutoffs, self.columns = matrix.sparkSession, dict(cutoffs), matrix.columns
        self.data = [c for c in matrix.columns if c not in KEYS]
        self.flags = [c for c in self.data if c.endswith("_missing")]
        self._seen = Observation()
        self._values: dict | None = None
        metrics = [F.count_if(F.col("cutoff").isNull() | ~F.col("cutoff").isin(*self.cutoffs)).alias("elsewhere")]
        for i, cutoff in enumerate(self.cutoffs):
            here = F.col("cutoff") == cutoff
            metrics += [expr(here).alias(f"{i}:{name}") for name, expr in self._metrics().items()]
        key = Window.partitionBy("cutoff", *E)
        counted = matrix.withColumn(TIMES, F.count(F.lit(1)).over(key))
        self.rows = counted.observe(self._seen, *metrics).drop(TIMES)

    def _metrics(self) -> dict[str, Callable[[Column], Column]]:
        def count(cond: Column) -> Callable[[Column], Column]:
            return lambda here: F.count_if(here & cond)

        def total(c: str) -> Callable[[Column], Column]:
            return lambda here: F.sum(F.when(here, F.col(c)))

        out = {
            "rows": lambda here: F.count_if(here),
            "cutoff_day": lambda here: F.max(F.when(here, F.col("cutoff_day"))),
            "duplicates": count(F.col(TIMES) > 1),
            **{f"null:{c}": count(F.col(c).isNull()) for c in self.data},
            **{f"flag:{c}": count(F.col(c).isNotNull() & ~F.col(c).isin(0, 1)) for c in self.flags},
            **{f"after:{c}": count(F.col(c) > F.col("cutoff_day")) for c in _DATE_COLS if c in self.data},
        }
        if "target_withdrawn" in self.data:
            out |= {f"withdrawn:{k}": count(F.col("target_withdrawn") == k) for k in (0, 1)}
        if "date_registration" in self.data:
            out["late"] = count(F.col("date_registration") > F.col("cutoff_day"))
        if "is_retake" in self.data:
            out["retakes"] = total("is_retake")
        if "target_at_risk" in self.data:
            r, y = F.col("final_result"), F.col("target_at_risk")
            out |= {
                "positives": total("target_at_risk"),
                "unknown_results": count(r.isNotNull() & ~r.isin(*TARGET_MAP)),
                "missing_results": count(r.isNull()),
                "target_mismatches": count(~y.eqNullSafe(target_from_map("final_result", TARGET_MAP))),
                "non_binary_targets": count(y.isNull() | ~y.isin(0, 1)),
            }
        return out

    def values(self) -> dict[str, dict]:
        """Metric values by cutoff; waits until ``rows`` have been written."""
        if self._values is None:
            got = self._seen.get
            if got["elsewhere"]:
                raise ValueError(f"{got['elsewhere']} rows of cutoffs other than {sorted(self.cutoffs)}")
            by = {c: {n: got[f"{i}:{n}"] for n in self._metrics()} for i, c in enumerate(self.cutoffs)}
            self._values = {c: v for c, v in by.items() if v["rows"]}
        return self._values

    def _report(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    def _after(self, v: dict) -> str:
        return ", ".join(c for c in _DATE_COLS if v.get(f"after:{c}"))

    def validation_stage3(self, columns_per_cutoff: Mapping[str, int]) -> DataFrame:
        """V10 (Stage 3), as :func:`guards.validation_stage3`."""
        forbidden = ", ".join(c for c in FORBIDDEN_COLUMNS if c in self.columns)
        rows = [
            (
                c, v["cutoff_day"], v["rows"], columns_per_cutoff[c], v["duplicates"],
                f"0: {v['withdrawn:0']}, 1: {v['withdrawn:1']}",
                sum(1 for x in self.data if v[f"null:{x}"]), forbidden, self._after(v),
            )
            for c, v in self.values().items()
        ]
        return self._report(
            rows,
            "cutoff string, cutoff_day long, rows long, columns long, duplicated_base_key_rows long, target_distribution string, "
            "missing_columns_nonzero long, forbidden_columns_present string, after_cutoff_feature_violations string",
        )

    def validation_baseline(self) -> DataFrame:
        """V10 (baseline) + V5 + V13, as :func:`guards.validation_baseline`."""
        missing = ", ".join(c for c in REQUIRED_BASELINE_FEATURES if c not in self.columns)
        clicks = [c for c in self.data if c.startswith(("clicks_activity_", "total_click_"))]
        other = ", ".join(c for c in clicks if not c.endswith("_mean_strategy"))
        rows = [
            (
                c, v["cutoff_day"], v["rows"], len(self.data), "date_unregistration" in self.columns, v["duplicates"], v["positives"],
                len(self.flags), ", ".join(f for f in self.flags if v[f"flag:{f}"]), self._after(v), missing, other, v["retakes"],
                sum(v[f"null:{x}"] for x in self.data),
            )
            for c, v in self.values().items()
        ]
        out = self._report(
            rows,
            "cutoff string, cutoff_day long, rows long, columns long, date_unregistration_present boolean, duplicated_base_key_rows long, "
            "target_at_risk_positive_rate long, missing_flag_columns long, non_binary_missing_flags string, "
            "after_cutoff_feature_violations string, missing_final_features string, non_mean_strategy_click_columns string, "
            "is_retake_positive_rate long, remaining_missing_cells long",
        )
        rates = ("target_at_risk_positive_rate", "is_retake_positive_rate")
        return out.withColumns({r: F.round(F.col(r) / F.col("rows"), 6) for r in rates})

    def label_domain(self) -> DataFrame:
        """V6, as :func:`guards.label_domain`."""
        names = ["unknown_results", "missing_results", "target_mismatches", "non_binary_targets"]
        rows = [(c, *(v[n] for n in names)) for c, v in self.values().items()]
        return self._report(rows, "cutoff string, " + ", ".join(f"{n} long" for n in names))

    def flag_binary(self) -> DataFrame:
        """V5, as :func:`guards.flag_binary`."""
        rows = [(c, f, v[f"flag:{f}"]) for c, v in self.values().items() for f in self.flags]
        return self._report(rows, "cutoff string, column string, non_binary_count long")

    def missing_by_column(self) -> DataFrame:
        """V8, as :func:`guards.missing_by_column`."""
        rows = [(c, x, v[f"null:{x}"]) for c, v in self.values().items() for x in self.data if v[f"null:{x}"]]
        return self._report(rows, "cutoff string, column string, missing_count long")

    def late_registration(self) -> DataFrame:
        """V12, as :func:`guards.late_registration`."""
        rows = [(c, v["cutoff_day"], v["late"]) for c, v in self.values().items()]
        return self._report(rows, "cutoff string, cutoff_day long, registered_after_cutoff long")

    def all_checks(self) -> DataFrame:
        """Every observed number as (cutoff, check, column, value): one row a
        cutoff and check, zeros included."""
        rows = []
        for c, v in self.values().items():
            for name, value in v.items():
                check, _, column = name.partition(":")
                rows.append((c, check, column, 0 if value is None else int(value)))
        out = self._report(rows, "cutoff string, check string, column string, value long")
        return out.orderBy(day_of(self.cutoffs), "check", "column")
