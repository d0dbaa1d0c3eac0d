"""The jobs in plain SQL over the driver's tables, as an independent statement of their results.

One ``WITH`` chain holds the inputs (``in_*``, all sites together, ``k`` = site number)
and every job (``t01`` … ``t28``). Joins are plain outer joins and counts plain distinct
counts here, unlike in the DataFrame code.
"""

from __future__ import annotations

from wardbook.queries.adapter import CFG, PRIORITIES
from wardbook.sources import OUTPUTS

_S = CFG.sites
_CUT = CFG.cutoff_year
_UNK = CFG.unknown_text


def clean(x: str, default: bool = True) -> str:
    text = f"""trim(regexp_replace({x}, '[\\r\\n"]', ' ', 'g'), ' ')"""
    return f"coalesce(nullif({text}, ''), '{_UNK}')" if default else text


def half_up(x: str) -> str:
    """round(x, 2) on the shortest decimal form of a double, halves away from zero."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


def ratio(num: str, den: str) -> str:
    return half_up(f"(CAST({num} AS DOUBLE) / nullif({den}, 0))")


def month(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m')"


def whole_months(start: str, end: str) -> str:
    """floor(months_between(end, start)); two month ends count as whole months."""
    s, e = f"CAST({start} AS DATE)", f"CAST({end} AS DATE)"
    return (
        f"((year({e}) - year({s})) * 12 + month({e}) - month({s}) - CASE WHEN day({e}) < day({s}) "
        f"AND NOT ({e} = last_day({e}) AND {s} = last_day({s})) THEN 1 ELSE 0 END)"
    )


def site_id(k: str) -> str:
    return f"CASE {k} WHEN 0 THEN {_S[0].id} WHEN 1 THEN {_S[1].id} ELSE {_S[2].id} END"


def site_name(k: str) -> str:
    return f"CASE {k} WHEN 0 THEN '{_S[0].name}' WHEN 1 THEN '{_S[1].name}' ELSE '{_S[2].name}' END"


def _alias(k: str) -> str:
    a = [s.rotation_alias for s in _S]
    return f"CASE {k} WHEN 0 THEN '{a[0]}' WHEN 1 THEN '{a[1]}' ELSE '{a[2]}' END"


def _student(key: str) -> str:
    return f"'Student#' || CAST({key} // 150 AS VARCHAR)"


def _supplier(key: str) -> str:
    return f"'Supplier#' || lpad(CAST({key} AS VARCHAR), 9, '0')"


_LABEL = "substr(o_orderpriority, 3)"
_NO_TYPE = "(o_orderstatus = 'P' AND o_totalprice BETWEEN 20000 AND 30000)"

_INPUTS = {
    "in_sheet": f"""
SELECT CAST(o_orderkey % 3 AS INT) AS k,
  CASE WHEN o_totalprice < 2000 THEN NULL WHEN o_totalprice < 4000 THEN -o_orderkey ELSE o_orderkey END AS trainid,
  CASE WHEN o_orderstatus = 'O' AND o_totalprice < 60000 THEN {_LABEL} WHEN o_totalprice > 480000 THEN NULL
       WHEN o_orderstatus = 'F' THEN p_type ELSE p_name END AS title,
  CASE WHEN o_totalprice >= 498000 THEN 14 WHEN o_totalprice < 20000 THEN 15 WHEN {_NO_TYPE} THEN NULL
       ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END AS type_id,
  CASE WHEN o_totalprice >= 498000 THEN '{CFG.hospital_induction.name}'
       WHEN o_totalprice < 20000 THEN '{CFG.specialty_induction.name}' WHEN {_NO_TYPE} THEN NULL
       WHEN o_orderstatus = 'F' THEN '" ' || {_LABEL} || chr(13) || chr(10) ELSE {_LABEL} END AS type_name,
  CASE WHEN o_orderstatus <> 'P' THEN c_nationkey END AS major_id,
  CASE WHEN o_orderstatus <> 'P' AND NOT o_totalprice BETWEEN 300000 AND 310000 THEN n_name END AS major_name,
  CASE WHEN o_totalprice > 400000 THEN r_name ELSE n_name END AS office,
  o_orderdate AS t0, o_orderdate + INTERVAL 90 MINUTE AS t1, 90 AS minutes, lines
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey LEFT JOIN part ON o_custkey = p_partkey
LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
    "in_person": f"""
SELECT CAST(l_orderkey % 3 AS INT) AS k, l_orderkey AS trainid,
  CASE WHEN l_returnflag = 'R' THEN l_suppkey ELSE l_partkey END AS pid,
  CASE WHEN l_returnflag = 'R' THEN {_supplier('l_suppkey')} ELSE {_student('l_partkey')} END AS pname,
  CASE WHEN l_returnflag = 'R' THEN '{CFG.teacher_role}' ELSE '{CFG.student_role}' END AS role,
  l_linestatus AS title, CASE WHEN l_tax > 0.02 THEN 1 - l_discount END AS score,
  CASE WHEN l_discount = 0 THEN NULL WHEN l_linestatus = 'F' THEN '{CFG.signed_text}' ELSE '未签到' END AS signed
FROM lineitem""",
    "in_part": """
SELECT part.*, n_nationkey, n_name, CAST(p_partkey % 3 AS INT) AS k, CAST(1995 + p_size % 6 AS INT) AS grade
FROM part JOIN nation ON p_partkey % 25 = n_nationkey""",
    "in_round": f"""
SELECT {_student('l_partkey')} AS pname,
  CASE WHEN l_tax = 0.08 THEN 'elsewhere' ELSE {_alias('l_partkey % 3')} END AS hospital,
  a.n_nationkey AS major_id, a.n_name AS major_name, CAST(1995 + p_size % 6 AS INT) AS grade,
  'Office ' || b.n_name AS office, b.n_nationkey AS office_major_id, b.n_name AS office_major_name,
  l_linestatus AS outline, l_shipdate AS t0,
  l_shipdate + to_days(CASE WHEN l_discount = 0.1 THEN NULL WHEN l_discount = 0.09 THEN -8
                            WHEN l_quantity = 50 THEN 800 ELSE CAST(l_quantity AS INT) END) AS t1,
  {_supplier('l_suppkey')} AS teacher, l_quantity AS score
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN nation a ON l_partkey % 25 = a.n_nationkey
JOIN nation b ON l_suppkey % 25 = b.n_nationkey""",
    "in_round_site": "SELECT *, "
    + "CASE hospital "
    + " ".join(f"WHEN '{s.rotation_alias}' THEN {s.id}" for s in _S)
    + f" ELSE {CFG.other_site.id} END AS hid, CASE hospital "
    + " ".join(f"WHEN '{s.rotation_alias}' THEN '{s.name}'" for s in _S)
    + f" ELSE '{CFG.other_site.name}' END AS hname FROM in_round",
}

_KIND = "(VALUES " + ", ".join(f"('{p}')" for p in PRIORITIES) + ") AS v(p)"
_ACT = (
    "a.activity_id, a.activity_name, a.activity_type_id, a.activity_type_name, a.activity_major_id, "
    "a.activity_major_name, a.activity_office_name, a.activity_start_time, a.activity_end_time"
)
_PERSON_JOIN = (
    "p.person_id = x.{w}_id AND p.person_name = x.{w}_name AND p.activity_hospital_id = x.{w}_hospital_id "
    "AND p.activity_hospital_name = x.{w}_hospital_name"
)
_ACT_JOIN = (
    "a.activity_id = p.activity_id AND a.activity_hospital_id = p.activity_hospital_id "
    "AND a.activity_hospital_name = p.activity_hospital_name"
)
_COHORT = (
    "{s}.student_name = {r}.pname AND {s}.student_hospital_id = {r}.hid AND {s}.student_hospital_name = {r}.hname "
    "AND {s}.student_major_id = {r}.major_id AND {s}.student_major_name = {r}.major_name "
    "AND {s}.student_admission_year = {r}.grade"
)


def _log(who: str, people: str, signed: str, score: str) -> str:
    return f"""
SELECT x.*, {_ACT}, p.is_signed AS {signed}, p.evaluation_score_rate AS {score}
FROM {people} x LEFT JOIN t03 p ON {_PERSON_JOIN.format(w=who)} LEFT JOIN t02 a ON {_ACT_JOIN}"""


def _rank(rate: str, num: str, den: str) -> str:
    return f"""
SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY {rate} DESC NULLS LAST, hospital_id) AS INT) AS {rate}_rank
FROM (SELECT *, {ratio(num, den)} AS {rate} FROM t13)"""


def _share(c: str) -> str:
    return f"CAST({ratio(f'sum({c})', 'sum(activity_count)')} * 100 AS VARCHAR) || '%' AS {c}_rate"


def _covered(unit: str) -> str:
    return half_up(
        f"(count(DISTINCT {unit}) FILTER (activity_id IS NOT NULL) * 100.0::DOUBLE / nullif(count(DISTINCT {unit}), 0))"
    )


_JOBS = {
    "t01": f"""
SELECT n_nationkey AS major_id, n_name AS major_name,
  CASE WHEN n_nationkey % 6 <> 5 THEN CAST(substr(p, 1, 1) AS INT) END AS activity_type_id,
  substr(p, 3) AS activity_type_name, CAST(n_nationkey % 4 AS INT) AS standard_count,
  CASE WHEN n_nationkey = 0 THEN 'first' END AS remark
FROM (SELECT DISTINCT n_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey), {_KIND}""",
    "t02": f"""
SELECT DISTINCT {site_id('k')} || '_' || trainid AS activity_id,
  regexp_replace(title, '[\\r\\n]', ' ', 'g') AS activity_name,
  coalesce(type_id, -1) AS activity_type_id, {clean('type_name')} AS activity_type_name,
  {site_id('k')} AS activity_hospital_id, {site_name('k')} AS activity_hospital_name,
  CASE WHEN s.major_id IS NULL THEN coalesce(d.major_id, -1) ELSE s.major_id END AS activity_major_id,
  CASE WHEN {clean('s.major_name')} = '{_UNK}' THEN coalesce(d.major_name, '{_UNK}') ELSE {clean('s.major_name')} END
    AS activity_major_name,
  {clean('office')} AS activity_office_name, t0 AS activity_start_time, t1 AS activity_end_time,
  minutes AS activity_duration_minutes, lines AS activity_participant_count
FROM in_sheet s LEFT JOIN (SELECT DISTINCT major_id, major_name FROM t01) d ON {clean('office')} = d.major_name
WHERE trainid >= 0 AND (k <> 0 OR type_id IS NOT NULL OR s.major_id IS NOT NULL)""",
    "t03": f"""
SELECT DISTINCT {site_id('k')} || '_' || trainid AS activity_id, {site_id('k')} AS activity_hospital_id,
  {site_name('k')} AS activity_hospital_name, coalesce(pid, -1) AS person_id, {clean('pname')} AS person_name,
  {clean('role')} AS person_type, {clean('title')} AS professional_title, score AS evaluation_score_rate,
  {clean('signed')} AS is_signed
FROM in_person WHERE trainid >= 0""",
    "t04": f"""
SELECT DISTINCT {site_id('page_id % 3')} || '_' || page_id AS activity_id, {site_id('page_id % 3')} AS activity_hospital_id,
  {site_name('page_id % 3')} AS activity_hospital_name, {clean("split_part(url, '://', 1)")} AS file_type,
  {clean('url', False)} AS file_url, {clean("regexp_extract(url, '([^/]*)$', 1)", False)} AS file_name
FROM pages WHERE page_id >= 0""",
    "t05": f"""
SELECT DISTINCT x.* FROM (
  SELECT p_partkey AS student_id,
    {clean(f"CASE WHEN p_size <= 5 THEN p_name ELSE {_student('p_partkey')} END", False)} AS student_name,
    {site_id('k')} AS student_hospital_id, {site_name('k')} AS student_hospital_name,
    CASE WHEN p_size <= 45 THEN n_nationkey ELSE -1 END AS student_major_id,
    CASE WHEN p_size <= 45 THEN n_name ELSE '{_UNK}' END AS student_major_name,
    grade AS student_admission_year, {clean('p_brand')} AS student_type
  FROM in_part) x
JOIN t03 p ON {_PERSON_JOIN.format(w='student')} WHERE p.person_type = '{CFG.student_role}'""",
    "t06": _log("student", "t05", "activity_is_signed", "activity_evaluation_score_rate"),
    "t07": f"""
SELECT DISTINCT x.* FROM (
  SELECT s_suppkey AS teacher_id, {clean('s_name', False)} AS teacher_name, {site_id('k')} AS teacher_hospital_id,
    {site_name('k')} AS teacher_hospital_name, n_name AS teacher_major_name, 'Office ' || n_name AS teacher_office_name,
    {clean("CASE WHEN s_acctbal > 5000 THEN 'senior' ELSE ' ' END")} AS teacher_title,
    CASE WHEN s_acctbal > 0 THEN 'MD' ELSE '{_UNK}' END AS teacher_degree, '{_UNK}' AS teacher_highest_degree,
    CASE WHEN s_acctbal > 0 THEN TIMESTAMP '2010-05-01 00:00:00' END AS teacher_promotion_time,
    '555-' || s_suppkey AS teacher_phone, '{_UNK}' AS teacher_id_card,
    CASE WHEN n_nationkey = 18 THEN 'Y' ELSE '{_UNK}' END AS teacher_is_general_practice
  FROM supplier JOIN nation ON s_nationkey = n_nationkey, (VALUES (0), (1), (2)) AS v(k)) x
JOIN t03 p ON {_PERSON_JOIN.format(w='teacher')} WHERE p.person_type = '{CFG.teacher_role}'""",
    "t08": _log("teacher", "t07", "is_signed", "evaluation_score_rate"),
    "t09": f"""
SELECT d.*, {_ACT}, a.activity_duration_minutes, a.activity_participant_count
FROM (SELECT grade AS admission_year, {site_id('k')} AS admission_hospital_id, {site_name('k')} AS admission_hospital_name,
        count(DISTINCT p_partkey) AS admission_student_count FROM in_part WHERE grade >= {_CUT} GROUP BY ALL) d
LEFT JOIN t02 a ON a.activity_type_id = 14 AND a.activity_type_name = '{CFG.hospital_induction.name}'
  AND a.activity_hospital_id = d.admission_hospital_id AND a.activity_hospital_name = d.admission_hospital_name
  AND year(a.activity_start_time) = d.admission_year""",
    "t10": f"""
SELECT d.*, a.* EXCLUDE (activity_hospital_id, activity_hospital_name, activity_major_id, activity_major_name)
FROM (SELECT grade AS admission_year, {site_id('k')} AS admission_hospital_id, {site_name('k')} AS admission_hospital_name,
        n_nationkey AS admission_major_id, n_name AS admission_major_name,
        count(DISTINCT p_partkey) AS admission_student_count FROM in_part WHERE grade >= {_CUT} GROUP BY ALL) d
LEFT JOIN t02 a ON a.activity_type_id = 15 AND a.activity_type_name = '{CFG.specialty_induction.name}'
  AND a.activity_hospital_id = d.admission_hospital_id AND a.activity_hospital_name = d.admission_hospital_name
  AND a.activity_major_id = d.admission_major_id AND a.activity_major_name = d.admission_major_name
  AND year(a.activity_start_time) = d.admission_year""",
    "t11": f"""
SELECT r.hid AS rotation_hospital_id, r.hname AS rotation_hospital_name, r.major_id AS rotation_student_major_id,
  r.major_name AS rotation_student_major_name, sd.student_id AS rotation_student_id, r.pname AS rotation_student_name,
  r.grade AS rotation_student_admission_year, r.office AS rotation_office_name,
  r.office_major_id AS rotation_office_major_id, r.office_major_name AS rotation_office_major_name,
  r.outline AS rotation_office_outline_name, r.t0 AS rotation_start_time, r.t1 AS rotation_end_time,
  r.m AS rotation_month, r.teacher AS rotation_teacher_name, r.office_major_id AS rotation_teacher_major_id,
  r.office_major_name AS rotation_teacher_major_name, r.score AS rotation_finish_skill_score, {_ACT},
  {month('a.activity_start_time')} AS activity_month, a.activity_is_signed, a.activity_evaluation_score_rate
FROM (SELECT i.*, strftime(CAST(date_trunc('month', t0) AS DATE) + to_months(CAST(n AS INT)), '%Y-%m') AS m
      FROM in_round_site i, unnest(range({whole_months('t0', 't1')} + 1)) AS g(n)
      WHERE t0 <= t1) r
LEFT JOIN t06 a ON {_COHORT.format(s='a', r='r')} AND {month('a.activity_start_time')} = r.m
LEFT JOIN t05 sd ON {_COHORT.format(s='sd', r='r')}""",
    "t12": f"""
WITH rows AS (SELECT *, {month('activity_start_time')} AS activity_month FROM t02),
groups AS (
  SELECT activity_hospital_id, activity_hospital_name, activity_major_id, activity_major_name, activity_month,
    activity_name, activity_type_id, activity_type_name, activity_id,
    CASE WHEN activity_name = activity_type_name THEN 1 WHEN min(activity_id) OVER same <> max(activity_id) OVER same THEN 2
      ELSE 0 END AS name_abnormal_type
  FROM rows WHERE activity_id IS NOT NULL
  WINDOW same AS (PARTITION BY activity_hospital_id, activity_hospital_name, activity_major_id, activity_major_name,
    activity_month, activity_name, activity_type_id, activity_type_name))
SELECT g.*, t.activity_office_name, t.teacher_id, t.teacher_name, t.activity_start_time
FROM groups g LEFT JOIN t08 t
  ON t.teacher_hospital_id = g.activity_hospital_id AND t.teacher_hospital_name = g.activity_hospital_name
  AND t.activity_major_id = g.activity_major_id AND t.activity_major_name = g.activity_major_name
  AND t.activity_id = g.activity_id AND t.activity_name = g.activity_name""",
    "t13": f"""
SELECT hospital_id, hospital_name, year, activity_count, total_person_times, student_count, sign_count, total_sign_count,
  evaluation_count, total_evaluation_count
FROM (SELECT activity_hospital_id AS hospital_id, activity_hospital_name AS hospital_name, year(activity_start_time) AS year,
        count(DISTINCT activity_id) AS activity_count, sum(activity_participant_count) AS total_person_times
      FROM t02 WHERE year(activity_start_time) >= {_CUT} GROUP BY 1, 2, 3)
LEFT JOIN (SELECT student_hospital_id AS hospital_id, student_hospital_name AS hospital_name,
        year(activity_start_time) AS year, count(DISTINCT student_name) AS student_count,
        count(*) FILTER (activity_is_signed = '{CFG.signed_text}') AS sign_count,
        count(activity_is_signed) AS total_sign_count, count(activity_evaluation_score_rate) AS evaluation_count,
        count(*) AS total_evaluation_count
      FROM t06 WHERE year(activity_start_time) >= {_CUT} GROUP BY 1, 2, 3) USING (hospital_id, hospital_name, year)""",
    "t14": f"""
SELECT c.*, st.standard_count, CASE WHEN c.activity_count < st.standard_count THEN 0 ELSE 1 END AS is_standard
FROM (SELECT activity_hospital_id AS hospital_id, activity_hospital_name AS hospital_name, activity_major_id AS major_id,
        activity_major_name AS major_name, activity_type_id, activity_type_name, {month('activity_start_time')} AS month,
        count(DISTINCT activity_id) AS activity_count
      FROM t02 WHERE year(activity_start_time) >= {_CUT} GROUP BY ALL) c
LEFT JOIN t01 st USING (major_id, major_name, activity_type_id, activity_type_name)""",
    "t15": f"""
SELECT admission_year AS year, count(DISTINCT admission_hospital_id) AS hospital_admitted_count,
  count(DISTINCT admission_hospital_id) FILTER (activity_id IS NOT NULL) AS hospital_education_count,
  CAST({_covered('admission_hospital_id')} AS VARCHAR) || '%' AS coverage_education
FROM t09 GROUP BY 1""",
    "t16": f"""
SELECT admission_hospital_id AS hospital_id, admission_hospital_name AS hospital_name, admission_year AS year,
  count(DISTINCT admission_major_id) AS major_admitted_count,
  count(DISTINCT admission_major_id) FILTER (activity_id IS NOT NULL) AS major_education_count,
  CAST({_covered('admission_major_id')} AS VARCHAR) || '%' AS coverage_education
FROM t10 GROUP BY 1, 2, 3""",
    "t17": f"""
SELECT hid AS hospital_id, hname AS hospital_name, grade AS year, count(DISTINCT pname) AS total_admitted_student_count,
  count(DISTINCT pname) FILTER (rotates) AS round_student_count,
  count(DISTINCT pname) FILTER (NOT rotates) AS no_round_student_count,
  count(DISTINCT pname) FILTER (active) AS activity_student_count,
  count(DISTINCT pname) FILTER (NOT active) AS no_activity_student_count,
  count(DISTINCT pname) FILTER (rotates AND NOT active) AS round_no_activity_student_count,
  count(DISTINCT pname) FILTER (rotates AND active) AS round_activity_student_count,
  count(DISTINCT pname) FILTER (NOT rotates AND NOT active) AS no_round_no_activity_student_count
FROM (
  SELECT d.*,
    EXISTS (SELECT 1 FROM in_round_site r WHERE r.hid = d.hid AND r.hname = d.hname AND r.major_id = d.major_id
      AND r.major_name = d.major_name AND r.grade = d.grade AND r.pname = d.pname) AS rotates,
    EXISTS (SELECT 1 FROM t06 s WHERE {_COHORT.format(s='s', r='d')}) AS active
  FROM (SELECT {site_id('k')} AS hid, {site_name('k')} AS hname, n_nationkey AS major_id, n_name AS major_name,
          grade, {_student('p_partkey')} AS pname FROM in_part WHERE grade >= {_CUT}) d
) GROUP BY 1, 2, 3""",
    "t18": f"""
SELECT rotation_hospital_id AS hospital_id, rotation_hospital_name AS hospital_name,
  rotation_student_major_id AS student_major_id, rotation_student_major_name AS student_major_name,
  rotation_student_id AS student_id, rotation_student_name AS student_name,
  rotation_student_admission_year AS student_admission_year, rotation_office_name, rotation_office_major_id,
  rotation_office_major_name, rotation_teacher_name, rotation_start_time, rotation_end_time, rotation_month,
  count(DISTINCT activity_id) AS activity_count,
  count(DISTINCT activity_id) FILTER (rotation_office_major_id = activity_major_id
    AND rotation_office_major_name = activity_major_name) AS same_major_activity_count,
  count(DISTINCT activity_id) FILTER (rotation_office_major_id <> activity_major_id
    OR rotation_office_major_name <> activity_major_name) AS different_major_activity_count
FROM t11 WHERE rotation_month >= '{CFG.cutoff_month}' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14""",
    "t19": """
SELECT hospital_id, hospital_name, rotation_month AS month, count(DISTINCT student_name) AS total_round_student_count,
  count(DISTINCT student_name) FILTER (activity_count = 0) AS no_activity_student_count,
  count(DISTINCT student_name) FILTER (same_major_activity_count = 0) AS no_major_student_count
FROM t18 GROUP BY 1, 2, 3""",
    "t20": f"""
SELECT hospital_id, hospital_name, month, gp AS general_practice_outpatient_count,
  CAST(gp > 0 AS INT) AS is_general_practice_outpatient, other AS outpatient_teaching_specialties,
  CAST(other >= {CFG.min_outpatient_specialties} AS INT) AS is_outpatient_teaching_specialties_valid
FROM (
  SELECT hospital_id, hospital_name, month,
    coalesce(sum(activity_count) FILTER (outp AND major_id = {CFG.general_practice.id}
      AND major_name = '{CFG.general_practice.name}'), 0) AS gp,
    coalesce(sum(major_id) FILTER (outp AND major_id <> {CFG.general_practice.id}
      AND major_name <> '{CFG.general_practice.name}'), 0) AS other
  FROM (SELECT *, activity_type_id = {CFG.outpatient.id} AND activity_type_name = '{CFG.outpatient.name}' AS outp FROM t14)
  WHERE month >= '{CFG.cutoff_month}' GROUP BY 1, 2, 3)""",
    "t21": f"""
SELECT activity_hospital_id AS hospital_id, activity_hospital_name AS hospital_name, activity_major_id AS major_id,
  activity_major_name AS major_name, activity_month AS month, count(DISTINCT activity_id) AS activity_count,
  count(DISTINCT activity_id) FILTER (name_abnormal_type = 0) AS standard_count,
  count(DISTINCT activity_id) FILTER (name_abnormal_type = 1) AS single_activity_same_type_name_count,
  count(DISTINCT activity_id) FILTER (name_abnormal_type = 2) AS different_activity_same_name_count
FROM t12 WHERE activity_month >= '{CFG.cutoff_month}' GROUP BY 1, 2, 3, 4, 5""",
    "t22": _rank("avg_activity_times_per_student", "total_person_times", "student_count"),
    "t23": _rank("sign_rate", "sign_count", "total_sign_count"),
    "t24": _rank("evaluation_rate", "evaluation_count", "total_evaluation_count"),
    "t25": """
SELECT hospital_id, hospital_name, major_id, major_name, string_agg(DISTINCT month, ';' ORDER BY month) AS month_list
FROM t14 WHERE is_standard = 0 GROUP BY 1, 2, 3, 4""",
    "t26": f"""
SELECT month, hospital_id, hospital_name, sum(activity_count) AS activity_count, sum(standard_count) AS standard_count,
  {_share('standard_count')}, sum(single_activity_same_type_name_count) AS single_activity_same_type_name_count,
  {_share('single_activity_same_type_name_count')},
  sum(different_activity_same_name_count) AS different_activity_same_name_count,
  {_share('different_activity_same_name_count')}
FROM t21 GROUP BY 1, 2, 3""",
    "t27": """
SELECT activity_month AS month, activity_hospital_id AS hospital_id, activity_hospital_name AS hospital_name,
  activity_major_id AS major_id, activity_major_name AS major_name, activity_id, activity_name, activity_type_id,
  activity_type_name, activity_office_name, teacher_id, teacher_name, activity_start_time
FROM t12 WHERE name_abnormal_type = 2""",
    "t28": """
SELECT hospital_id, hospital_name, rotation_office_major_id AS rotation_major_id,
  rotation_office_major_name AS rotation_major_name, rotation_month, student_id, student_name, student_admission_year,
  rotation_office_name, rotation_teacher_name, rotation_start_time, rotation_end_time
FROM t18 WHERE same_major_activity_count = 0""",
}

# Which earlier relations a job's SQL names, so that a statement carries only what it needs.
_CHAIN = {**_INPUTS, **_JOBS}

_SQL_TYPES = {"int": "INT", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def _needed(name: str, seen: dict[str, None]) -> None:
    for other in _CHAIN:
        if other != name and f" {other} " in _CHAIN[name].replace("\n", " ").replace(")", " ") + " ":
            if other not in seen:
                _needed(other, seen)
                seen[other] = None


def with_chain(select: str, *names: str) -> str:
    """``select`` preceded by the named relations and all they rest on."""
    seen: dict[str, None] = {}
    for name in names:
        _needed(name, seen)
        seen[name] = None
    parts = ",\n".join(f"{n} AS ({_CHAIN[n].strip()})" for n in _CHAIN if n in seen)
    return f"WITH {parts}\n{select}"


def job_sql(key: str) -> str:
    fields = OUTPUTS[key].schema
    cols = ", ".join(f"CAST({f.name} AS {_SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}" for f in fields)
    return with_chain(f"SELECT {cols} FROM {key}", key)


JOB_KEYS = {
    "t01": "t01_standards",
    "t02": "t02_activity_detail",
    "t03": "t03_person_detail",
    "t04": "t04_file_detail",
    "t05": "t05_student_detail",
    "t06": "t06_student_log",
    "t07": "t07_teacher_detail",
    "t08": "t08_teacher_log",
    "t09": "t09_hospital_inductions",
    "t10": "t10_specialty_inductions",
    "t11": "t11_rotation_detail",
    "t12": "t12_name_abnormal",
    "t13": "t13_overview",
    "t14": "t14_counts_vs_standard",
    "t15": "t15_hospital_coverage",
    "t16": "t16_specialty_coverage",
    "t17": "t17_admitted_presence",
    "t18": "t18_rotation_counts",
    "t19": "t19_rotation_abnormal",
    "t20": "t20_outpatient",
    "t21": "t21_name_irregular",
    "t22": "t22_avg_times",
    "t23": "t23_sign_rate",
    "t24": "t24_evaluation_rate",
    "t25": "t25_missed_standards",
    "t26": "t26_name_quality",
    "t27": "t27_same_title_report",
    "t28": "t28_missed_specialty",
}
