"""Table specs, keys, cutoffs and column roles of the course-data preset."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Names, keys and cutoffs that the outputs must reproduce.
ENTITY_KEY = ["code_module", "code_presentation", "id_student"]
CLICK_KEY = ENTITY_KEY + ["id_site", "date"]
CUTOFFS = {"week5": 35, "week7": 49, "week10": 70}

TABLE_KEYS = {
    "courses": ["code_module", "code_presentation"],
    "assessments": ["id_assessment"],
    "vle": ["id_site"],
    "student_info": ["code_module", "code_presentation", "id_student"],
    "student_registration": ["code_module", "code_presentation", "id_student"],
    "student_assessment": ["id_assessment", "id_student"],
    "student_vle": ["code_module", "code_presentation", "id_student", "id_site", "date"],
}

# Audit order of the tables (file names of the raw CSV distribution).
TABLE_FILES = {
    "courses": "courses.csv",
    "assessments": "assessments.csv",
    "vle": "vle.csv",
    "student_info": "studentInfo.csv",
    "student_registration": "studentRegistration.csv",
    "student_assessment": "studentAssessment.csv",
    "student_vle": "studentVle.csv",
}

RANGE_COLUMNS = {
    "student_registration": ["date_registration", "date_unregistration"],
    "student_assessment": ["date_submitted", "score"],
    "student_vle": ["date", "sum_click"],
    "assessments": ["date", "weight"],
}

STATIC_COLUMNS = [
    "gender",
    "region",
    "highest_education",
    "imd_band",
    "age_band",
    "num_of_prev_attempts",
    "studied_credits",
    "disability",
]

TARGET_MAP = {"Withdrawn": 1, "Fail": 1, "Pass": 0, "Distinction": 0}

EXCLUDED_PREDICTORS = [
    "code_module",
    "code_presentation",
    "id_student",
    "final_result",
    "target_withdrawn",
    "target_at_risk",
]
FORBIDDEN_COLUMNS = ["date_unregistration"]

BASELINE_MODEL_FEATURES = ["total_click_until_cutoff_mean_strategy", "active_days_until_cutoff"]

# Stage 3 count-like columns that are filled with 0 (prefixes, names).
STAGE3_FILL_PREFIXES = ("total_click_", "active_days_", "used_site_count_", "clicks_activity_")
STAGE3_FILL_NAMES = (
    "assessment_count_until_cutoff",
    "submitted_late_count_until_cutoff",
    "assessment_rows_missing_due_date_until_cutoff",
    "scored_assessment_count_until_cutoff",
)

# Stage 5 count-like columns that are filled with 0.
BASELINE_FILL_NAMES = (
    "active_days_until_cutoff",
    "used_site_count_until_cutoff",
    "assessment_count_until_cutoff",
    "submitted_late_count_until_cutoff",
    "on_time_submission_count_until_cutoff",
    "assessment_rows_missing_due_date_until_cutoff",
    "scored_assessment_count_until_cutoff",
)
BASELINE_FILL_PREFIXES = (
    "total_click_until_cutoff_",
    "avg_click_per_active_day_until_cutoff_",
    "clicks_activity_",
)

# Columns that get a missing flag before they are filled.
MISSING_FLAG_COLUMNS = [
    "imd_band",
    "date_registration",
    "is_registered_before_start",
    "mean_score_until_cutoff",
    "min_score_until_cutoff",
    "max_score_until_cutoff",
    "weighted_score_until_cutoff",
    "scored_assessment_count_until_cutoff",
    "avg_days_before_due_until_cutoff",
    "first_activity_date_until_cutoff",
    "last_activity_date_until_cutoff",
    "days_since_last_activity_at_cutoff",
]

# Features that a Stage 5 matrix must have.
REQUIRED_BASELINE_FEATURES = [
    "on_time_submission_count_until_cutoff",
    "avg_days_before_due_until_cutoff",
    "avg_days_before_due_until_cutoff_missing",
    "is_retake",
]

# The documented first predictor set, in its published order.
RECOMMENDED_PREDICTORS = [
    "code_module",
    "code_presentation",
    "gender",
    "region",
    "highest_education",
    "imd_band",
    "age_band",
    "num_of_prev_attempts",
    "studied_credits",
    "disability",
    "imd_band_missing",
    "is_retake",
    "is_registered_before_start",
    "is_registered_before_start_missing",
    "total_click_until_cutoff_mean_strategy",
    "active_days_until_cutoff",
    "days_since_last_activity_at_cutoff",
    "days_since_last_activity_at_cutoff_missing",
    "assessment_count_until_cutoff",
    "mean_score_until_cutoff",
    "mean_score_until_cutoff_missing",
    "on_time_submission_count_until_cutoff",
    "avg_days_before_due_until_cutoff",
    "avg_days_before_due_until_cutoff_missing",
]


@dataclass(frozen=True)
class EntitySpec:
    """Column names of an entity/event log, so operators stay generic."""

    key: tuple[str, ...] = tuple(ENTITY_KEY)
    time: str = "date"
    item: str = "id_site"
    measure: str = "sum_click"
    category: str = "activity_type"

    @property
    def event_key(self) -> list[str]:
        return [*self.key, self.item, self.time]


COURSE_LOG = EntitySpec()


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: list[str] = field(default_factory=list)


def _s(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()

# Raw schemas (never inferred: codes like 2013J must stay strings).
RAW_SCHEMAS: dict[str, T.StructType] = {
    "courses": _s(("code_module", S), ("code_presentation", S), ("module_presentation_length", L)),
    "assessments": _s(
        ("code_module", S), ("code_presentation", S), ("id_assessment", L),
        ("assessment_type", S), ("date", L), ("weight", D),
    ),
    "vle": _s(
        ("id_site", L), ("code_module", S), ("code_presentation", S),
        ("activity_type", S), ("week_from", L), ("week_to", L),
    ),
    "student_info": _s(
        ("code_module", S), ("code_presentation", S), ("id_student", L), ("gender", S),
        ("region", S), ("highest_education", S), ("imd_band", S), ("age_band", S),
        ("num_of_prev_attempts", L), ("studied_credits", L), ("disability", S), ("final_result", S),
    ),
    "student_registration": _s(
        ("code_module", S), ("code_presentation", S), ("id_student", L),
        ("date_registration", L), ("date_unregistration", L),
    ),
    "student_assessment": _s(
        ("id_assessment", L), ("id_student", L), ("date_submitted", L), ("is_banked", I), ("score", D),
    ),
    "student_vle": _s(
        ("code_module", S), ("code_presentation", S), ("id_student", L),
        ("id_site", L), ("date", L), ("sum_click", L),
    ),
}

TABLES = {name: TableSpec(name, RAW_SCHEMAS[name], TABLE_KEYS[name]) for name in TABLE_KEYS}
