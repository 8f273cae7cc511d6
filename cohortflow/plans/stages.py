"""Composite plans: Stage 3 features, Stage 4 cohort, Stage 5 baseline.

Every stage is long by cutoff (``cutoff`` is a column), so all three
cutoffs share one scan of each fact table, one collapse shuffle of the click
log, and one rollup shuffle per block. Stage boundaries are DataFrame
transforms; a caller that wants a hard boundary writes the result
(``cohortflow.session.materialize``) instead of handing CSV files over.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.columns import (
    is_retake,
    registered_before_start,
    target_at_risk,
    target_withdrawn,
)
from cohortflow.operators.baseline import (
    add_missing_flags_and_fill,
    fill_baseline_counts,
    fill_stage3_counts,
    without_blocks,
)
from cohortflow.operators.cohort import active_cohort, already_withdrawn
from cohortflow.operators.cutoffs import expand_by_cutoff
from cohortflow.operators.features import (
    BASELINE_CLICK_COLUMNS,
    STAGE3_ASSESSMENT_COLUMNS,
    STAGE3_CLICK_COLUMNS,
    assessment_rollup,
    baseline_assessment_block,
    baseline_pivot_columns,
    click_rollup,
    dimension_activity_types,
    observed_activity_types,
    stage3_assessment_block,
    stage3_pivot_columns,
)
from cohortflow.operators.joins import unique_in_plan
from cohortflow.schemas import CUTOFFS, ENTITY_KEY, STATIC_COLUMNS

E = ENTITY_KEY

BASE_COLUMNS = [
    *E,
    *STATIC_COLUMNS,
    "final_result",
    "target_withdrawn",
    "date_registration",
    "is_registered_before_start",
]


def build_base(info: DataFrame, registration: DataFrame, validate: bool = True) -> DataFrame:
    """P1 + P2 + F2 + F5 + J1: one row per entity with static columns, the
    withdrawn target and registration timing (no unregistration day)."""
    base = info.select(*E, *STATIC_COLUMNS, "final_result").withColumn("target_withdrawn", target_withdrawn())
    reg = registration.select(*E, "date_registration").withColumn(
        "is_registered_before_start", registered_before_start()
    )
    if validate:
        reg = unique_in_plan(reg, E, "student_registration")
        base = unique_in_plan(base, E, "student_info")
    return base.join(reg, E, "left").select(*BASE_COLUMNS)


class FeatureBlocks:
    """Click and assessment rollups of one set of tables, built when a stage
    asks for them. The types observed in the log cost a scan of their own, so
    only the Stage 3 block reads them."""

    def __init__(self, tables: Mapping[str, DataFrame], cutoffs: Mapping[str, int] = CUTOFFS) -> None:
        self.tables, self.cutoffs = tables, cutoffs

    @cached_property
    def stage3_types(self) -> dict[str, list[str]]:
        return observed_activity_types(self.tables["student_vle"], self.tables["vle"], self.cutoffs)

    @cached_property
    def union_types(self) -> list[str]:
        return sorted({t for ts in self.stage3_types.values() for t in ts})

    @cached_property
    def baseline_types(self) -> list[str]:
        return dimension_activity_types(self.tables["vle"])

    def clicks(self, stage3: bool = False, baseline: bool = False, active: bool = False) -> DataFrame:
        """``active``: of the pairs still registered at the cutoff only."""
        registration = self.tables["student_registration"]
        return click_rollup(
            self.tables["student_vle"],
            self.tables["vle"],
            self.cutoffs,
            stage3_types=self.union_types if stage3 else (),
            baseline_types=self.baseline_types if baseline else (),
            restrict=(lambda x: active_cohort(x, registration, self.cutoffs)) if active else None,
        )

    def assessments(self) -> DataFrame:
        return assessment_rollup(self.tables["student_assessment"], self.tables["assessments"], self.cutoffs)


def feature_blocks(tables: Mapping[str, DataFrame], cutoffs: Mapping[str, int] = CUTOFFS) -> FeatureBlocks:
    return FeatureBlocks(tables, cutoffs)


def _base_by_cutoff(tables: Mapping[str, DataFrame], cutoffs: Mapping[str, int], validate: bool) -> DataFrame:
    base = build_base(tables["student_info"], tables["student_registration"], validate)
    return expand_by_cutoff(base, None, cutoffs).select("cutoff", "cutoff_day", *BASE_COLUMNS)


def stage3_features(
    tables: Mapping[str, DataFrame],
    cutoffs: Mapping[str, int] = CUTOFFS,
    blocks: FeatureBlocks | None = None,
    validate: bool = True,
    active: bool = False,
) -> DataFrame:
    """Base x cutoffs, left-joined to the click and assessment blocks,
    count-like columns filled with 0. Pivot columns are the activity types
    observed by any cutoff (0 at a cutoff that has not seen the type);
    :func:`stage3_for_cutoff` gives the per-cutoff column set. ``active``
    restricts the base and the clicks to the cohort before they are joined."""
    blocks = blocks or feature_blocks(tables, cutoffs)
    click_cols = STAGE3_CLICK_COLUMNS + stage3_pivot_columns(blocks.union_types)
    clicks = blocks.clicks(stage3=True, active=active).select("cutoff", *E, *click_cols)
    assess = stage3_assessment_block(blocks.assessments())
    base = _base_by_cutoff(tables, cutoffs, validate)
    if active:
        base = active_cohort(base, tables["student_registration"], cutoffs)
    df = (
        base
        .join(clicks, ["cutoff", *E], "left")
        .join(assess, ["cutoff", *E], "left")
    )
    return fill_stage3_counts(df)


def stage3_for_cutoff(stage3: DataFrame, blocks: FeatureBlocks, cutoff: str) -> DataFrame:
    """One cutoff's Stage 3 matrix with only the types observed by then."""
    keep = set(stage3_pivot_columns(blocks.stage3_types[cutoff]))
    cols = [c for c in stage3.columns if not c.startswith("clicks_activity_") or c in keep]
    return stage3.where(F.col("cutoff") == cutoff).select(*cols)


def stage3_without_blocks(tables: Mapping[str, DataFrame], cutoffs: Mapping[str, int] = CUTOFFS) -> DataFrame:
    """The Stage 3 matrix with its click, pivot and assessment blocks
    removed (what a Stage 5 build on top of a written Stage 3 starts from)."""
    blocks = FeatureBlocks(tables, cutoffs)
    return without_blocks(
        stage3_features(tables, cutoffs, blocks),
        STAGE3_CLICK_COLUMNS,
        stage3_pivot_columns(blocks.union_types),
        STAGE3_ASSESSMENT_COLUMNS,
    )


def cohort_stage4(
    tables: Mapping[str, DataFrame],
    cutoffs: Mapping[str, int] = CUTOFFS,
    blocks: FeatureBlocks | None = None,
    stage3: DataFrame | None = None,
) -> DataFrame:
    """Stage 3 rows of students still registered at the cutoff; of a given
    ``stage3`` matrix, or built for these students only."""
    if stage3 is None:
        return stage3_features(tables, cutoffs, blocks, active=True)
    return active_cohort(stage3, tables["student_registration"], cutoffs)


def withdrawn_stage4(
    tables: Mapping[str, DataFrame],
    cutoffs: Mapping[str, int] = CUTOFFS,
    blocks: FeatureBlocks | None = None,
) -> DataFrame:
    """Stage 3 rows of students already unregistered at the cutoff."""
    return already_withdrawn(stage3_features(tables, cutoffs, blocks), tables["student_registration"], cutoffs)


def baseline_stage5(
    tables: Mapping[str, DataFrame],
    cutoffs: Mapping[str, int] = CUTOFFS,
    blocks: FeatureBlocks | None = None,
    validate: bool = True,
) -> DataFrame:
    """C4: cohort -> mean-strategy clicks with the
    dimension's activity types -> known-due-date assessments -> targets ->
    missing flags, then fills. 66 columns plus ``cutoff``/``cutoff_day``.

    Built straight from the base: Stage 3 columns are never computed, so there
    is nothing to drop."""
    blocks = blocks or feature_blocks(tables, cutoffs)
    cohort = active_cohort(_base_by_cutoff(tables, cutoffs, validate), tables["student_registration"], cutoffs)
    return _baseline(cohort, blocks)


def baseline_from_stage4(
    stage4: DataFrame,
    tables: Mapping[str, DataFrame],
    cutoffs: Mapping[str, int] = CUTOFFS,
    blocks: FeatureBlocks | None = None,
) -> DataFrame:
    """C4 + S4: the same matrix on top of a written Stage 4: its click, pivot and
    assessment columns go (they are not even read), the Stage 5 blocks are joined.
    Written in buckets of (cutoff, entity) (``write_bucketed``), Stage 4 is joined
    where it lies, without an exchange or a sort."""
    pivots = [c for c in stage4.columns if c.startswith("clicks_activity_")]
    cohort = without_blocks(stage4, STAGE3_CLICK_COLUMNS, pivots, STAGE3_ASSESSMENT_COLUMNS)
    return _baseline(cohort, blocks or feature_blocks(tables, cutoffs))


def _baseline(cohort: DataFrame, blocks: FeatureBlocks) -> DataFrame:
    clicks = blocks.clicks(baseline=True, active=True).select(
        "cutoff", *E, *BASELINE_CLICK_COLUMNS, *baseline_pivot_columns(blocks.baseline_types)
    )
    assess = baseline_assessment_block(blocks.assessments())
    df = (
        cohort.join(clicks, ["cutoff", *E], "left")
        .join(assess, ["cutoff", *E], "left")
        .withColumns({"target_at_risk": target_at_risk(), "is_retake": is_retake()})
    )
    return fill_baseline_counts(add_missing_flags_and_fill(df))


def click_features_mean(
    tables: Mapping[str, DataFrame], cutoffs: Mapping[str, int] = CUTOFFS, validate: bool = True
) -> DataFrame:
    """Minimum slice (flagship): mean-strategy click features for every
    entity at every cutoff, count-like columns filled with 0."""
    log, vle = tables["student_vle"], tables["vle"]
    clicks = click_rollup(log, vle, cutoffs).select("cutoff", *E, *BASELINE_CLICK_COLUMNS)
    base = _base_by_cutoff(tables, cutoffs, validate).select("cutoff", "cutoff_day", *E)
    return fill_baseline_counts(base.join(clicks, ["cutoff", *E], "left"))
