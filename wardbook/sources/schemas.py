"""Input columns and the 28 published tables. Ids of people and all counts are bigint."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

# Columns whose values are codes.
_CODES = {
    "name_abnormal_type": "title class: 0 = regular, 1 = title only repeats the activity type, "
    "2 = title shared by different activities",
    "is_standard": "1 = standard met, or none set; 0 = not met",
    "is_general_practice_outpatient": "1 = general practice held outpatient teaching in the month, 0 = it did not",
    "is_outpatient_teaching_specialties_valid": "1 = enough other specialties held outpatient teaching, 0 = too few",
    "activity_type_id": "identifier of activity type, -1 = unknown",
    "activity_major_id": "identifier of activity major, -1 = unknown",
    "rotation_hospital_id": "identifier of rotation hospital, -1 = another hospital",
    "standard_count": "activities a month that the standard asks for",
}

# Last word of a column name → what the column holds.
_MEASURES = {
    "id": "identifier of",
    "name": "name of",
    "count": "number of",
    "counts": "number of",
    "rate": "rate of",
    "rank": "rank by",
    "year": "year of",
    "month": "month of",
    "time": "time of",
    "times": "number of",
    "type": "type of",
    "minutes": "minutes of",
}


def describe(column: str) -> str:
    """Column comment derived from its name: ``student_major_id`` → "identifier of student major"."""
    if column in _CODES:
        return _CODES[column]
    *stem, last = column.split("_")
    if not stem:
        return last
    if stem[0] == "is":
        return "whether " + " ".join([*stem[1:], last])
    return f"{_MEASURES[last]} {' '.join(stem)}" if last in _MEASURES else " ".join([*stem, last])


def schema(columns: str) -> T.StructType:
    """Fields from ``name type, name type``, each with its comment."""
    pairs = [item.split() for item in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], True, {"comment": describe(name)}) for name, kind in pairs])


@dataclass(frozen=True)
class TableSpec:
    layer: str
    name: str
    schema: T.StructType
    comment: str

    @property
    def columns(self) -> list[str]:
        return self.schema.names


# Fixed public names: columns of the inputs.
INPUTS = {
    "sheet": schema(
        """
        trainid bigint, title string, spt_traintype_id int, spt_traintype_name string, spt_major_id int,
        spt_major_name string, officename string, starttime timestamp_ntz, endtime timestamp_ntz,
        teaching_activity_duration int, participant_count bigint
        """
    ),
    "person": schema(
        """
        trainid bigint, personid bigint, personname string, persontype string, professionaltitle string,
        evalua_score_rate double, is_sign string
        """
    ),
    "file": schema(
        """
        trainid bigint, filetype string, url string, reffilename string
        """
    ),
    "student": schema(
        """
        personid bigint, personname string, spt_major_id int, spt_major_name string, gradeyear int,
        value string
        """
    ),
    "teacher": schema(
        """
        personid bigint, personname string, spt_major_name string, name string, professionaltitle string,
        academicdegree string, highestdegree string, promotiontime timestamp_ntz, phoneno string,
        identificationcard string, isgeneralfillingdepartment string
        """
    ),
    "admissions": schema(
        """
        admission_year int, training_base_id int, training_base string, specialty_base_id int,
        specialty_base string, student_id bigint, student_name string
        """
    ),
    "rotations": schema(
        """
        personname string, hospital string, spt_major_id int, spt_major_name string, gradeyear int,
        officename string, office_major_id int, office_major_name string, outlinename string,
        starttime timestamp_ntz, endtime timestamp_ntz, teachername string, teacher_major_id int,
        teacher_major_name string, finishskillscore double
        """
    ),
}

# Fixed public names: the tables and their columns.
OUTPUTS = {
    "t01": TableSpec(
        "dim",
        "dim_teacher_activity_count_standard_by_hospital_major",
        schema(
            """
            major_id int, major_name string, activity_type_id int, activity_type_name string,
            standard_count int, remark string
            """
        ),
        "Monthly standard per specialty and activity type",
    ),
    "t02": TableSpec(
        "dwd",
        "dwd_teaching_activity_detail_df",
        schema(
            """
            activity_id string, activity_name string, activity_type_id int, activity_type_name string,
            activity_hospital_id int, activity_hospital_name string, activity_major_id int,
            activity_major_name string, activity_office_name string, activity_start_time timestamp_ntz,
            activity_end_time timestamp_ntz, activity_duration_minutes int,
            activity_participant_count bigint
            """
        ),
        "Cleansed activities of all sites",
    ),
    "t03": TableSpec(
        "dwd",
        "dwd_teaching_activity_person_detail_df",
        schema(
            """
            activity_id string, activity_hospital_id int, activity_hospital_name string, person_id bigint,
            person_name string, person_type string, professional_title string, evaluation_score_rate double,
            is_signed string
            """
        ),
        "Cleansed participation of all sites",
    ),
    "t04": TableSpec(
        "dwd",
        "dwd_teaching_activity_file_detail_df",
        schema(
            """
            activity_id string, activity_hospital_id int, activity_hospital_name string, file_type string,
            file_url string, file_name string
            """
        ),
        "Cleansed attachments of all sites",
    ),
    "t05": TableSpec(
        "dwd",
        "dwd_teaching_activity_student_detail_wide_df",
        schema(
            """
            student_id bigint, student_name string, student_hospital_id int, student_hospital_name string,
            student_major_id int, student_major_name string, student_admission_year int,
            student_type string
            """
        ),
        "Students who take part in activities",
    ),
    "t06": TableSpec(
        "dwd",
        "dwd_teaching_activity_student_log_wide_df",
        schema(
            """
            student_id bigint, student_name string, student_hospital_id int, student_hospital_name string,
            student_major_id int, student_major_name string, student_admission_year int,
            student_type string, activity_id string, activity_name string, activity_type_id int,
            activity_type_name string, activity_major_id int, activity_major_name string,
            activity_office_name string, activity_start_time timestamp_ntz, activity_end_time timestamp_ntz,
            activity_is_signed string, activity_evaluation_score_rate double
            """
        ),
        "Students with each participation and its activity",
    ),
    "t07": TableSpec(
        "dwd",
        "dwd_teaching_activity_teacher_detail_wide_df",
        schema(
            """
            teacher_id bigint, teacher_name string, teacher_hospital_id int, teacher_hospital_name string,
            teacher_major_name string, teacher_office_name string, teacher_title string,
            teacher_degree string, teacher_highest_degree string, teacher_promotion_time timestamp_ntz,
            teacher_phone string, teacher_id_card string, teacher_is_general_practice string
            """
        ),
        "Teachers who take part in activities",
    ),
    "t08": TableSpec(
        "dwd",
        "dwd_teaching_activity_teacher_log_wide_df",
        schema(
            """
            teacher_id bigint, teacher_name string, teacher_hospital_id int, teacher_hospital_name string,
            teacher_major_name string, teacher_office_name string, teacher_title string,
            teacher_degree string, teacher_highest_degree string, teacher_promotion_time timestamp_ntz,
            teacher_phone string, teacher_id_card string, teacher_is_general_practice string,
            activity_id string, activity_name string, activity_type_id int, activity_type_name string,
            activity_major_id int, activity_major_name string, activity_office_name string,
            activity_start_time timestamp_ntz, activity_end_time timestamp_ntz, is_signed string,
            evaluation_score_rate double
            """
        ),
        "Teachers with each participation and its activity",
    ),
    "t09": TableSpec(
        "dwd",
        "dwd_teaching_activity_admission_hospital_education_detail_wide_df",
        schema(
            """
            admission_year int, admission_hospital_id int, admission_hospital_name string,
            admission_student_count bigint, activity_id string, activity_name string, activity_type_id int,
            activity_type_name string, activity_major_id int, activity_major_name string,
            activity_office_name string, activity_start_time timestamp_ntz, activity_end_time timestamp_ntz,
            activity_duration_minutes int, activity_participant_count bigint
            """
        ),
        "Admitting hospitals per year with their induction activities",
    ),
    "t10": TableSpec(
        "dwd",
        "dwd_teaching_activity_admission_hospital_major_education_detail_wide_df",
        schema(
            """
            admission_year int, admission_hospital_id int, admission_hospital_name string,
            admission_major_id int, admission_major_name string, admission_student_count bigint,
            activity_id string, activity_name string, activity_type_id int, activity_type_name string,
            activity_office_name string, activity_start_time timestamp_ntz, activity_end_time timestamp_ntz,
            activity_duration_minutes int, activity_participant_count bigint
            """
        ),
        "Admitting specialties per hospital and year with their induction activities",
    ),
    "t11": TableSpec(
        "dwd",
        "dwd_teaching_activity_round_student_detail_wide_df",
        schema(
            """
            rotation_hospital_id int, rotation_hospital_name string, rotation_student_major_id int,
            rotation_student_major_name string, rotation_student_id bigint, rotation_student_name string,
            rotation_student_admission_year int, rotation_office_name string, rotation_office_major_id int,
            rotation_office_major_name string, rotation_office_outline_name string,
            rotation_start_time timestamp_ntz, rotation_end_time timestamp_ntz, rotation_month string,
            rotation_teacher_name string, rotation_teacher_major_id int, rotation_teacher_major_name string,
            rotation_finish_skill_score double, activity_id string, activity_name string,
            activity_type_id int, activity_type_name string, activity_major_id int,
            activity_major_name string, activity_office_name string, activity_start_time timestamp_ntz,
            activity_end_time timestamp_ntz, activity_month string, activity_is_signed string,
            activity_evaluation_score_rate double
            """
        ),
        "Rotation months with the student's activities",
    ),
    "t12": TableSpec(
        "dwd",
        "dwd_teaching_activity_name_abnormal_detail_wide_df",
        schema(
            """
            activity_hospital_id int, activity_hospital_name string, activity_major_id int,
            activity_major_name string, activity_month string, activity_id string, activity_name string,
            activity_type_id int, activity_type_name string, name_abnormal_type int,
            activity_office_name string, teacher_id bigint, teacher_name string,
            activity_start_time timestamp_ntz
            """
        ),
        "Activities with their title class and teachers",
    ),
    "t13": TableSpec(
        "dws",
        "dws_teaching_activity_data_overview_by_hospital_year",
        schema(
            """
            hospital_id int, hospital_name string, year int, activity_count bigint,
            total_person_times bigint, student_count bigint, sign_count bigint, total_sign_count bigint,
            evaluation_count bigint, total_evaluation_count bigint
            """
        ),
        "Yearly overview per hospital",
    ),
    "t14": TableSpec(
        "dws",
        "dws_teaching_activity_count_by_hospital_major_type_month",
        schema(
            """
            hospital_id int, hospital_name string, major_id int, major_name string, activity_type_id int,
            activity_type_name string, month string, activity_count bigint, standard_count int,
            is_standard int
            """
        ),
        "Monthly activity counts against standards",
    ),
    "t15": TableSpec(
        "dws",
        "dws_teaching_activity_hospital_education_coverage_by_year",
        schema(
            """
            year int, hospital_admitted_count bigint, hospital_education_count bigint,
            coverage_education string
            """
        ),
        "Hospital induction coverage per year",
    ),
    "t16": TableSpec(
        "dws",
        "dws_teaching_activity_major_education_coverage_by_hospital_year",
        schema(
            """
            hospital_id int, hospital_name string, year int, major_admitted_count bigint,
            major_education_count bigint, coverage_education string
            """
        ),
        "Specialty induction coverage per hospital and year",
    ),
    "t17": TableSpec(
        "dws",
        "dws_teaching_activity_admission_students_activity_round_count_by_hospital_year",
        schema(
            """
            hospital_id int, hospital_name string, year string, total_admitted_student_count bigint,
            round_student_count bigint, no_round_student_count bigint, activity_student_count bigint,
            no_activity_student_count bigint, round_no_activity_student_count bigint,
            round_activity_student_count bigint, no_round_no_activity_student_count bigint
            """
        ),
        "Admitted students by presence in rotations and activities",
    ),
    "t18": TableSpec(
        "dws",
        "dws_teaching_activity_round_student_activity_count_by_hospital_month",
        schema(
            """
            hospital_id int, hospital_name string, student_major_id int, student_major_name string,
            student_id bigint, student_name string, student_admission_year int, rotation_office_name string,
            rotation_office_major_id int, rotation_office_major_name string, rotation_teacher_name string,
            rotation_start_time timestamp_ntz, rotation_end_time timestamp_ntz, rotation_month string,
            activity_count bigint, same_major_activity_count bigint, different_major_activity_count bigint
            """
        ),
        "Activities per rotation month, in and outside the rotation's specialty",
    ),
    "t19": TableSpec(
        "dws",
        "dws_teaching_activity_round_abnormal_student_count_by_hospital_month",
        schema(
            """
            hospital_id int, hospital_name string, month string, total_round_student_count bigint,
            no_activity_student_count bigint, no_major_student_count bigint
            """
        ),
        "Rotating students without activities per month",
    ),
    "t20": TableSpec(
        "dws",
        "dws_teaching_activity_general_practice_outpatient_education_by_hospital_month",
        schema(
            """
            hospital_id int, hospital_name string, month string, general_practice_outpatient_count bigint,
            is_general_practice_outpatient int, outpatient_teaching_specialties bigint,
            is_outpatient_teaching_specialties_valid int
            """
        ),
        "Outpatient teaching indicators per month",
    ),
    "t21": TableSpec(
        "dws",
        "dws_teaching_activity_name_irregular_count_by_hospital_major_month",
        schema(
            """
            hospital_id int, hospital_name string, major_id int, major_name string, month string,
            activity_count bigint, standard_count bigint, single_activity_same_type_name_count bigint,
            different_activity_same_name_count bigint
            """
        ),
        "Title classes per specialty and month",
    ),
    "t22": TableSpec(
        "ads",
        "ads_teaching_activity_student_avg_times_by_year_hospital",
        schema(
            """
            year int, hospital_id int, hospital_name string, activity_count bigint,
            total_person_times bigint, student_count bigint, avg_activity_times_per_student double,
            avg_activity_times_per_student_rank int
            """
        ),
        "Activities per student, ranked per year",
    ),
    "t23": TableSpec(
        "ads",
        "ads_teaching_activity_student_sign_in_by_year_hospital",
        schema(
            """
            year int, hospital_id int, hospital_name string, total_sign_count bigint, sign_count bigint,
            sign_rate double, sign_rate_rank int
            """
        ),
        "Sign-in rate, ranked per year",
    ),
    "t24": TableSpec(
        "ads",
        "ads_teaching_activity_student_evaluation_by_year_hospital",
        schema(
            """
            year int, hospital_id int, hospital_name string, total_evaluation_count bigint,
            evaluation_count bigint, evaluation_rate double, evaluation_rate_rank int
            """
        ),
        "Evaluation rate, ranked per year",
    ),
    "t25": TableSpec(
        "ads",
        "ads_teaching_activity_count_not_standard_by_month_hospital_major_report",
        schema(
            """
            hospital_id int, hospital_name string, major_id int, major_name string, month_list string
            """
        ),
        "Months in which a specialty missed a standard",
    ),
    "t26": TableSpec(
        "ads",
        "ads_teaching_activity_name_not_standard_by_month_hospital",
        schema(
            """
            month string, hospital_id int, hospital_name string, activity_count bigint,
            standard_count bigint, standard_count_rate string, single_activity_same_type_name_count bigint,
            single_activity_same_type_name_count_rate string, different_activity_same_name_count bigint,
            different_activity_same_name_count_rate string
            """
        ),
        "Share of each title class per month",
    ),
    "t27": TableSpec(
        "ads",
        "ads_teaching_activity_different_name_same_report",
        schema(
            """
            month string, hospital_id int, hospital_name string, major_id int, major_name string,
            activity_id string, activity_name string, activity_type_id int, activity_type_name string,
            activity_office_name string, teacher_id bigint, teacher_name string, activity_start_time string
            """
        ),
        "Activities that share their title within a month",
    ),
    "t28": TableSpec(
        "ads",
        "ads_teaching_activity_round_student_not_major_activity_report",
        schema(
            """
            hospital_id int, hospital_name string, rotation_major_id int, rotation_major_name string,
            rotation_month string, student_id bigint, student_name string, student_admission_year int,
            rotation_office_name string, rotation_teacher_name string, rotation_start_time string,
            rotation_end_time string
            """
        ),
        "Rotation months without an activity of the rotation's specialty",
    ),
}
