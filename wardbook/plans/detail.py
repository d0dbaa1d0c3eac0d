"""Detail layer: cleansed site data, people, participation logs and the wide tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wardbook.config import Site, WarehouseConfig
from wardbook.functions import (
    any_present,
    backfill,
    clean_text,
    is_kind,
    map_values,
    month_of,
    sentinel_fill,
    since_year,
    surrogate_key,
    valid_key,
)
from wardbook.functions.pseudonyms import pseudonym
from wardbook.operators import (
    attach,
    classify_names,
    dedupe_keys,
    dedupe_rows,
    distinct_per,
    federate,
    fill_id,
    lookup_join,
    month_bucket_join,
    month_walk,
    participation_log,
    population_events,
    registry_participants,
)
from wardbook.operators.joins import left_join
from wardbook.operators.linkage import one_person_per_rotation
from wardbook.operators.periods import match_in_period
from wardbook.sources.inputs import branches

_SITE = {"site_id": "activity_hospital_id", "site_name": "activity_hospital_name"}
_ACTIVITY_KEY = ["activity_id", "activity_hospital_id", "activity_hospital_name"]
_ACTIVITY_FACTS = [
    "activity_id",
    "activity_name",
    "activity_type_id",
    "activity_type_name",
    "activity_major_id",
    "activity_major_name",
    "activity_office_name",
    "activity_start_time",
    "activity_end_time",
]
_ACTIVITY_SIZES = ["activity_duration_minutes", "activity_participant_count"]


def _text(cfg: WarehouseConfig, column: str):
    return clean_text(column, cfg.unknown_text)


def _personal(cfg: WarehouseConfig, column: str):
    """Personal data: as it is, or as a pseudonym where the deployment has a key; unknown stays unknown."""
    if cfg.pseudonym_key is None:
        return _text(cfg, column)
    known = F.nullif(clean_text(column), F.lit(""))
    return F.coalesce(pseudonym(known, cfg.pseudonym_key, column), F.lit(cfg.unknown_text))


def _keyed(site: Site):
    """Rows need a usable activity key; a site may ask for more."""
    keep = valid_key("trainid")
    return keep & any_present(*site.require_any) if site.require_any else keep


# ---- cleansed site data ------------------------------------------------------


def activities(cfg: WarehouseConfig, source, standards: DataFrame) -> DataFrame:
    sheets = federate(
        branches(source, "sheet"),
        {
            "trainid": F.col("trainid"),
            "activity_name": clean_text("title", strip_quotes=False, trim=False),
            "activity_type_id": sentinel_fill("spt_traintype_id", cfg.unknown_id),
            "activity_type_name": _text(cfg, "spt_traintype_name"),
            "activity_major_id": sentinel_fill("spt_major_id", cfg.unknown_id),
            "activity_major_name": _text(cfg, "spt_major_name"),
            "activity_office_name": _text(cfg, "officename"),
            "activity_start_time": F.col("starttime"),
            "activity_end_time": F.col("endtime"),
            "activity_duration_minutes": F.col("teaching_activity_duration"),
            "activity_participant_count": F.col("participant_count"),
        },
        **_SITE,
        where=_keyed,
    )
    # The office often is named after its specialty; id and name are filled one by one.
    majors = dedupe_keys(standards, ["major_id", "major_name"])
    known = lookup_join(
        sheets,
        majors,
        [("activity_office_name", "major_name")],
        ["major_id", "major_name"],
    )
    filled = known.withColumns(
        {
            "activity_id": surrogate_key("activity_hospital_id", "trainid"),
            "activity_major_id": backfill("activity_major_id", "major_id", cfg.unknown_id),
            "activity_major_name": backfill("activity_major_name", "major_name", cfg.unknown_text),
        }
    )
    return dedupe_rows(filled.drop("trainid", "major_id", "major_name"))


def participation_rows(cfg: WarehouseConfig, source) -> DataFrame:
    """The rows of ``participation`` before repeated ones are dropped."""
    rows = federate(
        branches(source, "person"),
        {
            "trainid": F.col("trainid"),
            "person_id": sentinel_fill("personid", cfg.unknown_id),
            "person_name": _text(cfg, "personname"),
            "person_type": _text(cfg, "persontype"),
            "professional_title": _text(cfg, "professionaltitle"),
            "evaluation_score_rate": F.col("evalua_score_rate"),
            "is_signed": _text(cfg, "is_sign"),
        },
        **_SITE,
        where=lambda site: valid_key("trainid"),
    )
    return rows.withColumn("activity_id", surrogate_key("activity_hospital_id", "trainid")).drop("trainid")


def participation(cfg: WarehouseConfig, source) -> DataFrame:
    return dedupe_rows(participation_rows(cfg, source))


def attachments(cfg: WarehouseConfig, source) -> DataFrame:
    rows = federate(
        branches(source, "file"),
        {
            "trainid": F.col("trainid"),
            "file_type": _text(cfg, "filetype"),
            "file_url": clean_text("url"),
            "file_name": clean_text("reffilename"),
        },
        **_SITE,
        where=lambda site: valid_key("trainid"),
    )
    return dedupe_rows(rows.withColumn("activity_id", surrogate_key("activity_hospital_id", "trainid")).drop("trainid"))


# ---- people and their logs ---------------------------------------------------


def _person_on(who: str) -> list[tuple[str, str]]:
    return [
        (f"{who}_id", "person_id"),
        (f"{who}_name", "person_name"),
        (f"{who}_hospital_id", "activity_hospital_id"),
        (f"{who}_hospital_name", "activity_hospital_name"),
    ]


def students(cfg: WarehouseConfig, source, persons: DataFrame) -> DataFrame:
    registry = federate(
        branches(source, "student"),
        {
            "student_id": sentinel_fill("personid", cfg.unknown_id),
            "student_name": clean_text("personname"),
            "student_major_id": sentinel_fill("spt_major_id", cfg.unknown_id),
            "student_major_name": _text(cfg, "spt_major_name"),
            "student_admission_year": F.col("gradeyear"),
            "student_type": _text(cfg, "value"),
        },
        site_id="student_hospital_id",
        site_name="student_hospital_name",
    )
    return registry_participants(
        registry, persons, _person_on("student"), role_col="person_type", role=cfg.student_role
    )


def teachers(cfg: WarehouseConfig, source, persons: DataFrame) -> DataFrame:
    registry = federate(
        branches(source, "teacher"),
        {
            "teacher_id": sentinel_fill("personid", cfg.unknown_id),
            "teacher_name": clean_text("personname"),
            "teacher_major_name": _text(cfg, "spt_major_name"),
            "teacher_office_name": _text(cfg, "name"),
            "teacher_title": _text(cfg, "professionaltitle"),
            "teacher_degree": _text(cfg, "academicdegree"),
            "teacher_highest_degree": _text(cfg, "highestdegree"),
            "teacher_promotion_time": F.col("promotiontime"),
            "teacher_phone": _personal(cfg, "phoneno"),
            "teacher_id_card": _personal(cfg, "identificationcard"),
            "teacher_is_general_practice": _text(cfg, "isgeneralfillingdepartment"),
        },
        site_id="teacher_hospital_id",
        site_name="teacher_hospital_name",
    )
    return registry_participants(
        registry, persons, _person_on("teacher"), role_col="person_type", role=cfg.teacher_role
    )


def _log(
    people: DataFrame, who: str, persons: DataFrame, acts: DataFrame, signed: str, score: str, repeated: DataFrame | None
) -> DataFrame:
    return participation_log(
        people,
        persons if repeated is None else repeated,
        acts,
        person_on=_person_on(who),
        participation_cols={signed: "is_signed", score: "evaluation_score_rate"},
        activity_on=[(c, c) for c in _ACTIVITY_KEY],
        activity_cols=_ACTIVITY_FACTS,
        # People tables hold nobody without a participation.
        all_present=True,
        repeated=repeated is not None,
    )


def student_log(people: DataFrame, persons: DataFrame, acts: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """``repeated`` may give the participations before repeated ones are dropped; they are read instead."""
    return _log(people, "student", persons, acts, "activity_is_signed", "activity_evaluation_score_rate", repeated)


def teacher_log(people: DataFrame, persons: DataFrame, acts: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """See ``student_log``."""
    return _log(people, "teacher", persons, acts, "is_signed", "evaluation_score_rate", repeated)


# ---- admissions and their induction activities -------------------------------


def _admitted(cfg: WarehouseConfig, admissions: DataFrame, *, by_major: bool) -> DataFrame:
    names = {
        "admission_year": "admission_year",
        "admission_hospital_id": "training_base_id",
        "admission_hospital_name": "training_base",
    }
    if by_major:
        names |= {"admission_major_id": "specialty_base_id", "admission_major_name": "specialty_base"}
    rows = admissions.filter(since_year("admission_year", cfg.cutoff_year, is_year=True))
    rows = rows.select(*[F.col(old).alias(new) for new, old in names.items()], "student_id")
    return distinct_per(rows, list(names), "student_id", "admission_student_count")


def _inductions(cfg: WarehouseConfig, acts: DataFrame, kind) -> DataFrame:
    return acts.filter(
        since_year("activity_start_time", cfg.cutoff_year) & is_kind("activity_type_id", "activity_type_name", kind)
    ).withColumn("activity_year", F.year("activity_start_time"))


_ADMISSION_ON = [
    ("admission_hospital_id", "activity_hospital_id"),
    ("admission_hospital_name", "activity_hospital_name"),
    ("admission_year", "activity_year"),
]
_ADMISSION_MAJOR_ON = [
    ("admission_major_id", "activity_major_id"),
    ("admission_major_name", "activity_major_name"),
]


def hospital_inductions(cfg: WarehouseConfig, admissions: DataFrame, acts: DataFrame) -> DataFrame:
    return population_events(
        _admitted(cfg, admissions, by_major=False),
        _inductions(cfg, acts, cfg.hospital_induction),
        _ADMISSION_ON,
        _ACTIVITY_FACTS + _ACTIVITY_SIZES,
    )


def specialty_inductions(cfg: WarehouseConfig, admissions: DataFrame, acts: DataFrame) -> DataFrame:
    facts = [c for c in _ACTIVITY_FACTS if not c.startswith("activity_major")]
    return population_events(
        _admitted(cfg, admissions, by_major=True),
        _inductions(cfg, acts, cfg.specialty_induction),
        _ADMISSION_ON + _ADMISSION_MAJOR_ON,
        facts + _ACTIVITY_SIZES,
    )


# ---- rotations ---------------------------------------------------------------


def rotation_site(cfg: WarehouseConfig, alias: str = "hospital"):
    """(id, canonical name) of the site a rotation's hospital text stands for."""
    return (
        map_values(alias, {s.rotation_alias: s.id for s in cfg.sites}, cfg.other_site.id),
        map_values(alias, {s.rotation_alias: s.name for s in cfg.sites}, cfg.other_site.name),
    )


def rotations(cfg: WarehouseConfig, raw: DataFrame) -> DataFrame:
    site_id, site_name = rotation_site(cfg)
    return raw.select(
        site_id.alias("rotation_hospital_id"),
        site_name.alias("rotation_hospital_name"),
        F.col("spt_major_id").alias("rotation_student_major_id"),
        F.col("spt_major_name").alias("rotation_student_major_name"),
        F.col("personname").alias("rotation_student_name"),
        F.col("gradeyear").alias("rotation_student_admission_year"),
        F.col("officename").alias("rotation_office_name"),
        F.col("office_major_id").alias("rotation_office_major_id"),
        F.col("office_major_name").alias("rotation_office_major_name"),
        F.col("outlinename").alias("rotation_office_outline_name"),
        F.col("starttime").alias("rotation_start_time"),
        F.col("endtime").alias("rotation_end_time"),
        F.col("teachername").alias("rotation_teacher_name"),
        F.col("teacher_major_id").alias("rotation_teacher_major_id"),
        F.col("teacher_major_name").alias("rotation_teacher_major_name"),
        F.col("finishskillscore").alias("rotation_finish_skill_score"),
    )


_COHORT_ON = [
    ("rotation_student_name", "student_name"),
    ("rotation_hospital_id", "student_hospital_id"),
    ("rotation_hospital_name", "student_hospital_name"),
    ("rotation_student_major_id", "student_major_id"),
    ("rotation_student_major_name", "student_major_name"),
    ("rotation_student_admission_year", "student_admission_year"),
]


def rotation_activities(cfg: WarehouseConfig, raw: DataFrame, people: DataFrame, log: DataFrame) -> DataFrame:
    """Rotation months with the activities the student joined in that month.

    The student's id does not depend on the month, so it is looked up before a rotation
    is spread over its months. So are the months in which the student joined anything (a list
    as long as the calendar at most): the other months of a rotation are not shuffled.
    """
    heard = log.withColumn("activity_month", month_of("activity_start_time"))
    valid = rotations(cfg, raw).filter(F.col("rotation_start_time") <= F.col("rotation_end_time"))
    with_id = fill_id(valid, people, _COHORT_ON, "student_id", "rotation_student_id")
    busy = heard.groupBy(*[c for _, c in _COHORT_ON]).agg(F.collect_set("activity_month").alias("_busy"))
    months = month_walk(
        left_join(with_id, busy, _COHORT_ON, ["_busy"]),
        "rotation_start_time", "rotation_end_time", max_months=cfg.max_months, alias="rotation_month",
    )
    return month_bucket_join(
        months.withColumn("_busy", F.coalesce(F.array_contains("_busy", F.col("rotation_month")), F.lit(False))),
        heard,
        [*_COHORT_ON, ("rotation_month", "activity_month")],
        [*_ACTIVITY_FACTS, "activity_month", "activity_is_signed", "activity_evaluation_score_rate"],
        matched="_busy",
    )


def rotations_in_period(
    cfg: WarehouseConfig, raw: DataFrame, log: DataFrame, folder: str | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rotations with the activities that their students joined from their first to their last moment.

    Unlike ``rotation_activities`` this does not go by months: an activity of the first
    month before the rotation began is not listed. What is read repeatedly is written to
    ``folder``, if there is one. ``columns`` may name the only ones asked for, of both sides:
    no others are returned or written, but those by which rotations are matched.
    """
    rows = rotations(cfg, raw)
    keep = ["student_id", *_ACTIVITY_FACTS[:-2], "activity_start_time", "activity_is_signed"]
    if columns is not None:
        asked = {*columns, *[c for c, _ in _COHORT_ON], "rotation_start_time", "rotation_end_time"}
        rows, keep = rows.select(*[c for c in rows.columns if c in asked]), [c for c in keep if c in asked]
    return match_in_period(
        rows,
        log,
        _COHORT_ON,
        start="rotation_start_time",
        end="rotation_end_time",
        at="activity_start_time",
        keep=keep,
        sparse=True,
        folder=folder,
    )


def rotation_people(cfg: WarehouseConfig, raw: DataFrame, people: DataFrame, log: DataFrame, folder: str) -> DataFrame:
    """Every distinct rotation with one student's id or none; see ``one_person_per_rotation``."""
    return one_person_per_rotation(
        rotations(cfg, raw),
        people,
        log,
        on=_COHORT_ON,
        person="student_id",
        period=("rotation_start_time", "rotation_end_time"),
        log_on=_COHORT_ON,
        log_person="student_id",
        log_time="activity_start_time",
        folder=folder,
        alias="rotation_student_id",
    )


# ---- titles ------------------------------------------------------------------

_TITLE_GROUP = [
    "activity_hospital_id",
    "activity_hospital_name",
    "activity_major_id",
    "activity_major_name",
    "activity_month",
    "activity_name",
    "activity_type_id",
    "activity_type_name",
]


def title_classes(acts: DataFrame) -> DataFrame:
    return classify_names(
        acts.withColumn("activity_month", month_of("activity_start_time")),
        _TITLE_GROUP,
        id_col="activity_id",
        title="activity_name",
        type_name="activity_type_name",
        alias="name_abnormal_type",
    )


_TITLE_LOG_ON = [
    ("activity_hospital_id", "teacher_hospital_id"),
    ("activity_hospital_name", "teacher_hospital_name"),
    *[(c, c) for c in ("activity_major_id", "activity_major_name", "activity_id", "activity_name")],
]
_TITLE_LOG_KEEP = ["activity_office_name", "teacher_id", "teacher_name", "activity_start_time"]
# What ``titles_with_teachers`` reads of the teachers' log.
TITLE_LOG_COLUMNS = (*[c for _, c in _TITLE_LOG_ON], *_TITLE_LOG_KEEP)


def titles_with_teachers(acts: DataFrame, log: DataFrame) -> DataFrame:
    return attach(title_classes(acts), log, _TITLE_LOG_ON, _TITLE_LOG_KEEP)
