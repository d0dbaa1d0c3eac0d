"""Report layer: ranked indicators and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardbook.operators import joined_distinct, rank_rate, rollup_ratios, select_as
from wardbook.operators.naming import SHARED_TITLE

# Columns of the same-title report to sort by; the first one runs backwards.
SAME_TITLE_ORDER = ("month", "hospital_id", "major_id", "activity_id")


def _ranked(overview: DataFrame, num: str, den: str, rate: str) -> DataFrame:
    return rank_rate(overview, num, den, "year", rate=rate, rank=f"{rate}_rank", tie=["hospital_id"])


def average_times(overview: DataFrame) -> DataFrame:
    return _ranked(overview, "total_person_times", "student_count", "avg_activity_times_per_student")


def sign_in(overview: DataFrame) -> DataFrame:
    return _ranked(overview, "sign_count", "total_sign_count", "sign_rate")


def evaluation(overview: DataFrame) -> DataFrame:
    return _ranked(overview, "evaluation_count", "total_evaluation_count", "evaluation_rate")


def missed_standards(counts: DataFrame) -> DataFrame:
    keys = ["hospital_id", "hospital_name", "major_id", "major_name"]
    return joined_distinct(counts.filter(F.col("is_standard") == 0), keys, "month", ";", "month_list")


def title_quality(irregular: DataFrame, *, tidy: bool = False) -> DataFrame:
    return rollup_ratios(
        irregular,
        ["month", "hospital_id", "hospital_name"],
        "activity_count",
        ["standard_count", "single_activity_same_type_name_count", "different_activity_same_name_count"],
        tidy=tidy,
    )


def same_title(titles: DataFrame) -> DataFrame:
    """Listed by month (latest first), site, specialty and activity when published."""
    same = ("activity_id", "activity_name", "activity_type_id", "activity_type_name")
    more = ("activity_office_name", "teacher_id", "teacher_name", "activity_start_time")
    return select_as(
        titles.filter(F.col("name_abnormal_type") == SHARED_TITLE),
        {
            "month": "activity_month",
            "hospital_id": "activity_hospital_id",
            "hospital_name": "activity_hospital_name",
            "major_id": "activity_major_id",
            "major_name": "activity_major_name",
            **{c: c for c in (*same, *more)},
        },
    )


def missed_specialty(rotation_counts: DataFrame) -> DataFrame:
    same = ("hospital_id", "hospital_name", "rotation_month", "student_id", "student_name", "student_admission_year")
    more = ("rotation_office_name", "rotation_teacher_name", "rotation_start_time", "rotation_end_time")
    return select_as(
        rotation_counts.filter(F.col("same_major_activity_count") == 0),
        {
            "rotation_major_id": "rotation_office_major_id",
            "rotation_major_name": "rotation_office_major_name",
            **{c: c for c in (*same, *more)},
        },
    )
