"""Summary layer: aggregates per site, specialty, month or year."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from wardbook.config import WarehouseConfig
from wardbook.functions import month_of, since_month, since_year
from wardbook.operators import (
    abnormal_headcount,
    class_counts,
    conditional_specialties,
    coverage,
    presence_matrix,
    same_vs_other,
    standard_counts,
)
from wardbook.operators.joins import left_join
from wardbook.operators.runs import month_spine, shortfall_runs
from wardbook.plans.detail import rotation_site

_SITE = ["hospital_id", "hospital_name"]


def activity_overview(cfg: WarehouseConfig, acts: DataFrame) -> DataFrame:
    """Distinct activities and summed participants per site and year."""
    return (
        acts.filter(since_year("activity_start_time", cfg.cutoff_year))
        .groupBy(
            F.col("activity_hospital_id").alias("hospital_id"),
            F.col("activity_hospital_name").alias("hospital_name"),
            F.year("activity_start_time").alias("year"),
        )
        .agg(
            F.count_distinct("activity_id").alias("activity_count"),
            F.sum("activity_participant_count").alias("total_person_times"),
        )
    )


def student_overview(cfg: WarehouseConfig, log: DataFrame) -> DataFrame:
    """Students (by name), sign-ins and evaluations per site and year."""
    return (
        log.filter(since_year("activity_start_time", cfg.cutoff_year))
        .groupBy("student_hospital_id", "student_hospital_name", F.year("activity_start_time").alias("log_year"))
        .agg(
            F.count_distinct("student_name").alias("student_count"),
            F.count_if(F.col("activity_is_signed") == cfg.signed_text).alias("sign_count"),
            F.count("activity_is_signed").alias("total_sign_count"),
            F.count("activity_evaluation_score_rate").alias("evaluation_count"),
            F.count("*").alias("total_evaluation_count"),
        )
    )


def overview(cfg: WarehouseConfig, acts: DataFrame, log: DataFrame) -> DataFrame:
    return left_join(
        activity_overview(cfg, acts),
        student_overview(cfg, log),
        [("hospital_id", "student_hospital_id"), ("hospital_name", "student_hospital_name"), ("year", "log_year")],
        ["student_count", "sign_count", "total_sign_count", "evaluation_count", "total_evaluation_count"],
    )


def counts_against_standards(cfg: WarehouseConfig, acts: DataFrame, standards: DataFrame) -> DataFrame:
    kind = {c: c for c in ("activity_type_id", "activity_type_name")}
    return standard_counts(
        acts.filter(since_year("activity_start_time", cfg.cutoff_year)),
        standards,
        keys={
            "hospital_id": "activity_hospital_id",
            "hospital_name": "activity_hospital_name",
            "major_id": "activity_major_id",
            "major_name": "activity_major_name",
            **kind,
        },
        on=[(c, c) for c in ("major_id", "major_name", *kind)],
        id_col="activity_id",
        time_col="activity_start_time",
        standard_col="standard_count",
    )


def unmatched_standards(acts: DataFrame, standards: DataFrame) -> DataFrame:
    """Standards that no activity was ever recorded under, such as types without an id.

    They can never be met or missed, so they belong in a report of their own.
    """
    named = ("major_id", "major_name", "activity_type_id", "activity_type_name")
    seen = acts.select(
        *[F.col(c).alias(f"_{i}") for i, c in enumerate(("activity_major_id", "activity_major_name", *named[2:]))]
    ).distinct()
    return standards.join(seen, reduce(and_, [F.col(c) == F.col(f"_{i}") for i, c in enumerate(named)]), "left_anti")


def missed_runs(cfg: WarehouseConfig, acts: DataFrame, standards: DataFrame, sites: Sequence[tuple[int, str]], last: str | None = None) -> DataFrame:
    """Runs of months in which a site stayed below a standard, months without any activity included.

    From the cut-off to ``last``, by default the last month with an activity. Standards
    without a type id can never be met; ``unmatched_standards`` lists them.
    """
    if last is None:
        last = acts.agg(F.max(month_of("activity_start_time")).alias("m")).first().m or cfg.cutoff_month
    kind = ["major_id", "major_name", "activity_type_id", "activity_type_name"]
    due = standards.filter(F.col("activity_type_id").isNotNull()).select(*kind, "standard_count")
    counts = counts_against_standards(cfg, acts, standards).select(*_SITE, *kind, "month", "activity_count")
    spine = month_spine(due, sites, cfg.cutoff_month, last, site=_SITE)
    return shortfall_runs(spine, counts, [*_SITE, *kind], count="activity_count", standard="standard_count")


def hospital_coverage(detail: DataFrame) -> DataFrame:
    return coverage(
        detail.withColumnRenamed("admission_year", "year"),
        ["year"],
        "admission_hospital_id",
        "activity_id",
        total="hospital_admitted_count",
        covered="hospital_education_count",
        rate="coverage_education",
    )


def specialty_coverage(detail: DataFrame) -> DataFrame:
    named = detail.withColumnsRenamed(
        {"admission_hospital_id": "hospital_id", "admission_hospital_name": "hospital_name", "admission_year": "year"}
    )
    return coverage(
        named,
        [*_SITE, "year"],
        "admission_major_id",
        "activity_id",
        total="major_admitted_count",
        covered="major_education_count",
        rate="coverage_education",
    )


def admitted_presence(cfg: WarehouseConfig, admissions: DataFrame, raw_rotations: DataFrame, log: DataFrame) -> DataFrame:
    site_id, site_name = rotation_site(cfg)
    keys = ["hospital_id", "hospital_name", "major_id", "major_name", "year", "student"]

    def keyed(df: DataFrame, *cols) -> DataFrame:
        named = df.select(*[(F.col(c) if isinstance(c, str) else c).alias(k) for k, c in zip(keys, cols)])
        return named.filter(since_year("year", cfg.cutoff_year, is_year=True))

    return presence_matrix(
        keyed(
            admissions,
            "training_base_id", "training_base", "specialty_base_id", "specialty_base", "admission_year", "student_name",
        ),
        keyed(raw_rotations, site_id, site_name, "spt_major_id", "spt_major_name", "gradeyear", "personname"),
        keyed(
            log,
            "student_hospital_id", "student_hospital_name", "student_major_id", "student_major_name",
            "student_admission_year", "student_name",
        ),
        keys,
        [*_SITE, "year"],
        "student",
        total="total_admitted_student_count",
        names={
            (True, None): "round_student_count",
            (False, None): "no_round_student_count",
            (None, True): "activity_student_count",
            (None, False): "no_activity_student_count",
            (True, False): "round_no_activity_student_count",
            (True, True): "round_activity_student_count",
            (False, False): "no_round_no_activity_student_count",
        },
    )


def rotation_counts(cfg: WarehouseConfig, detail: DataFrame) -> DataFrame:
    named = detail.filter(since_month("rotation_month", cfg.cutoff_month)).withColumnsRenamed(
        {
            "rotation_hospital_id": "hospital_id",
            "rotation_hospital_name": "hospital_name",
            "rotation_student_major_id": "student_major_id",
            "rotation_student_major_name": "student_major_name",
            "rotation_student_id": "student_id",
            "rotation_student_name": "student_name",
            "rotation_student_admission_year": "student_admission_year",
        }
    )
    group = [
        *_SITE,
        *("student_major_id", "student_major_name", "student_id", "student_name", "student_admission_year"),
        *("rotation_office_name", "rotation_office_major_id", "rotation_office_major_name", "rotation_teacher_name"),
        *("rotation_start_time", "rotation_end_time", "rotation_month"),
    ]
    return same_vs_other(
        named,
        group,
        "activity_id",
        [("rotation_office_major_id", "activity_major_id"), ("rotation_office_major_name", "activity_major_name")],
        total="activity_count",
        same="same_major_activity_count",
        other="different_major_activity_count",
        # A group is one month of one student's rotation.
        spread=False,
    )


def rotation_abnormal(cfg: WarehouseConfig, counts: DataFrame) -> DataFrame:
    return abnormal_headcount(
        counts.filter(since_month("rotation_month", cfg.cutoff_month)).withColumnRenamed("rotation_month", "month"),
        [*_SITE, "month"],
        "student_name",
        total="total_round_student_count",
        zero={
            "no_activity_student_count": "activity_count",
            "no_major_student_count": "same_major_activity_count",
        },
    )


def outpatient(cfg: WarehouseConfig, counts: DataFrame, *, corrected: bool = False) -> DataFrame:
    return conditional_specialties(
        counts.filter(since_month("month", cfg.cutoff_month)), [*_SITE, "month"], cfg, corrected=corrected
    )


def irregular_titles(cfg: WarehouseConfig, titles: DataFrame) -> DataFrame:
    named = titles.filter(since_month("activity_month", cfg.cutoff_month)).withColumnsRenamed(
        {
            "activity_hospital_id": "hospital_id",
            "activity_hospital_name": "hospital_name",
            "activity_major_id": "major_id",
            "activity_major_name": "major_name",
            "activity_month": "month",
        }
    )
    return class_counts(
        named,
        [*_SITE, "major_id", "major_name", "month"],
        "activity_id",
        "name_abnormal_type",
        total="activity_count",
        classes={
            "standard_count": 0,
            "single_activity_same_type_name_count": 1,
            "different_activity_same_name_count": 2,
        },
    )
