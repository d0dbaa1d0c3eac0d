"""Queries that write tables on the way: linkage, periods, runs of months, stored bitmaps.

As in ``operator_queries`` each entry pairs a DataFrame expression with SQL for the same
result; expressions here get the session, the folder of inputs and a folder for tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import replace
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardbook.config import Site, WarehouseConfig
from wardbook.functions import any_present, month_of, valid_key
from wardbook.functions.pseudonyms import field_key
from wardbook.operators.bitmaps import count_bitmaps, dense_ids, id_bitmaps
from wardbook.operators.periods import match_in_period, overlapping
from wardbook.operators.titles import near_titles
from wardbook.plans import detail, summary
from wardbook.plans.incremental import refresh_years
from wardbook.queries import adapter
from wardbook.queries.adapter import CFG, Tables
from wardbook.queries.job_sql import _COHORT, month, with_chain
from wardbook.queries.operator_queries import _PLACED_SQL, _acts, _counts_sql, _placed
from wardbook.sources import OUTPUTS, TableSpec
from wardbook.sources.audit import audit
from wardbook.sources.drift import harmonise
from wardbook.sources.partitioned import by_year_name, publish_by_year, read_since, refresh_changed
from wardbook.sources.schemas import schema

Build = Callable[[SparkSession, str, str], DataFrame]
REPORTS: dict[str, tuple[Build, str]] = {}


def report(name: str, sql: str) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        REPORTS[name] = (build, sql)
        return build

    return register


def _tables(spark: SparkSession, sf_dir: str) -> Tables:
    return cache(lambda name: adapter.read(spark, sf_dir, name))


# ---- one person per rotation -------------------------------------------------

_ROUNDS = 3


def _linkage_sql() -> str:
    overlap = "y.t0 <= x.t1 AND x.t0 <= y.t1"
    rounds = "".join(
        f""", picks_{k} AS MATERIALIZED (SELECT id, p, t0, t1, e FROM (
    SELECT *, count(*) OVER (PARTITION BY id, e) AS ties, max(e) OVER (PARTITION BY id) AS top FROM claims_{k - 1}) WHERE e = top AND ties = 1),
given_{k} AS MATERIALIZED (SELECT * FROM picks_{k} x WHERE NOT EXISTS (
    SELECT 1 FROM picks_{k} y WHERE y.p = x.p AND y.id <> x.id AND y.e >= x.e AND {overlap})),
claims_{k} AS MATERIALIZED (SELECT * FROM claims_{k - 1} x WHERE NOT EXISTS (SELECT 1 FROM given_{k} y WHERE y.id = x.id)
    AND NOT EXISTS (SELECT 1 FROM given_{k} y WHERE y.p = x.p AND {overlap}))"""
        for k in range(1, _ROUNDS + 1)
    )
    given = " UNION ALL ".join(f"SELECT * FROM given_{k}" for k in range(1, _ROUNDS + 1))
    return with_chain(
        f""", rot AS MATERIALIZED (SELECT row_number() OVER () AS id, * FROM (SELECT DISTINCT * FROM in_round_site)),
cand AS MATERIALIZED (SELECT student_name, student_hospital_id, student_hospital_name, student_major_id, student_major_name,
    student_admission_year, count(DISTINCT student_id) AS n, min(student_id) AS sole FROM t05 GROUP BY 1, 2, 3, 4, 5, 6),
claims_0 AS MATERIALIZED (SELECT r.id, a.student_id AS p, r.t0, r.t1, count(*) AS e FROM rot r JOIN cand c ON {_COHORT.format(s="c", r="r")}
    JOIN t06 a ON {_COHORT.format(s="a", r="r")} AND a.activity_start_time BETWEEN r.t0 AND r.t1 WHERE c.n > 1 GROUP BY ALL)
{rounds}
SELECT r.pname AS name, r.hid AS site, r.major_id AS major, r.grade, r.office, r.teacher, r.t0 AS from_time, r.t1 AS to_time,
  CASE WHEN c.n = 1 THEN c.sole ELSE g.p END AS student_id, g.e AS evidence,
  CASE WHEN c.n IS NULL THEN 'unknown' WHEN c.n = 1 THEN 'only' WHEN g.id IS NOT NULL THEN 'evidence' ELSE 'ambiguous' END AS link
FROM rot r LEFT JOIN cand c ON {_COHORT.format(s="c", r="r")} LEFT JOIN ({given}) g ON g.id = r.id""",
        "in_round_site",
        "t05",
        "t06",
    )


@report("person_per_rotation", _linkage_sql())
def _person_per_rotation(spark, sf_dir, folder):
    w = adapter.warehouse(spark, sf_dir, folder)
    w.stage_reads({"t05": 1, "t06": 1}, folder)
    linked = detail.rotation_people(w.cfg, w.source.rotations(), w.table("t05"), w.table("t06"), f"{folder}/linkage")
    names = {
        "rotation_student_name": "name",
        "rotation_hospital_id": "site",
        "rotation_student_major_id": "major",
        "rotation_student_admission_year": "grade",
        "rotation_office_name": "office",
        "rotation_teacher_name": "teacher",
        "rotation_start_time": "from_time",
        "rotation_end_time": "to_time",
        "rotation_student_id": "student_id",
    }
    return linked.withColumnsRenamed(names).select(*names.values(), "evidence", "link")


# ---- periods -----------------------------------------------------------------


@report(
    "period_match",
    """SELECT s.*, e.o_orderkey AS hit, e.o_orderdate AS hit_at
FROM (SELECT o_custkey, o_orderkey, l_linenumber, o_orderdate, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey) s
LEFT JOIN orders e ON e.o_custkey = s.o_custkey AND e.o_orderstatus <> 'P' AND e.o_orderkey % 5 <> 0
  AND e.o_orderdate BETWEEN s.o_orderdate AND s.l_shipdate""",
)
def _period_match(spark, sf_dir, folder):
    """Lines from order to shipping, with the orders that their customer placed meanwhile."""
    t = _tables(spark, sf_dir)
    spans = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    placed = t("orders").filter("o_orderstatus <> 'P' AND o_orderkey % 5 <> 0")
    placed = placed.select(F.col("o_custkey").alias("cust"), F.col("o_orderkey").alias("hit"), F.col("o_orderdate").alias("hit_at"))
    return match_in_period(
        spans.select("o_custkey", "o_orderkey", "l_linenumber", "o_orderdate", "l_shipdate"),
        placed, [("o_custkey", "cust")], start="o_orderdate", end="l_shipdate", at="hit_at", keep=["hit", "hit_at"],
    )


@report(
    "period_overlap",
    """WITH spans AS (SELECT o_custkey AS who, o_orderkey AS id, min(o_orderdate) AS t0, max(l_shipdate) AS t1
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2 HAVING min(o_orderdate) <= max(l_shipdate))
SELECT a.id, b.id AS other_id FROM spans a JOIN spans b ON a.who = b.who AND a.t0 <= b.t1 AND b.t0 <= a.t1 WHERE a.id < b.id""",
)
def _period_overlap(spark, sf_dir, folder):
    """Orders of one customer that were under way at the same time."""
    t = _tables(spark, sf_dir)
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    spans = lines.groupBy(F.col("o_custkey").alias("who"), F.col("o_orderkey").alias("id")).agg(
        F.min("o_orderdate").alias("t0"), F.max("l_shipdate").alias("t1")
    )
    pairs = overlapping(spans, spans, [("who", "who")], left_period=("t0", "t1"), right_period=("t0", "t1"), keep=["id"])
    return pairs.filter("id < other_id").select("id", "other_id")


@report(
    "rotation_period_activities",
    with_chain(
        f"""SELECT r.pname AS name, r.teacher, r.t0 AS from_time, r.t1 AS to_time, a.student_id, a.activity_id, a.activity_start_time AS at
FROM in_round_site r LEFT JOIN t06 a ON {_COHORT.format(s="a", r="r")} AND a.activity_start_time BETWEEN r.t0 AND r.t1""",
        "in_round_site",
        "t06",
    ),
)
def _rotation_period_activities(spark, sf_dir, folder):
    w = adapter.warehouse(spark, sf_dir, folder)
    w.staged("t11", folder)
    names = {
        "rotation_student_name": "name",
        "rotation_teacher_name": "teacher",
        "rotation_start_time": "from_time",
        "rotation_end_time": "to_time",
        "activity_start_time": "at",
    }
    ids = ["student_id", "activity_id"]
    rows = detail.rotations_in_period(w.cfg, w.source.rotations(), w.table("t06"), f"{folder}/periods", [*names, *ids])
    return rows.withColumnsRenamed(names).select(*names.values(), *ids)


# ---- runs of months ----------------------------------------------------------

_REGIONS = ((0, "AFRICA"), (1, "AMERICA"), (2, "ASIA"), (3, "EUROPE"), (4, "MIDDLE EAST"))


@report(
    "missed_standard_runs",
    _counts_sql(
        f""", spine AS (
  SELECT r_regionkey AS hospital_id, r_name AS hospital_name, major_id, major_name, activity_type_id, activity_type_name, standard_count,
    strftime(m, '%Y-%m') AS month, year(m) * 12 + month(m) AS number
  FROM t01, region, generate_series(DATE '{CFG.cutoff_year}-01-01', (SELECT CAST(max(t) AS DATE) FROM acts), INTERVAL 1 MONTH) AS g(m)
  WHERE activity_type_id IS NOT NULL),
short AS (
  SELECT s.*, coalesce(n, 0) AS n, number - row_number() OVER (PARTITION BY s.hospital_id, s.hospital_name, major_id, major_name,
    activity_type_id, activity_type_name ORDER BY number) AS run
  FROM spine s LEFT JOIN (SELECT * EXCLUDE (standard_count) FROM counts) c
    USING (hospital_id, hospital_name, major_id, major_name, activity_type_id, activity_type_name, month)
  WHERE coalesce(n, 0) < s.standard_count)
SELECT hospital_id, hospital_name, major_id, major_name, activity_type_id, activity_type_name, min(month) AS first_month,
  max(month) AS last_month, count(*) AS months, count(*) FILTER (n = 0) AS empty_months, sum(standard_count - n)::BIGINT AS missing
FROM short GROUP BY 1, 2, 3, 4, 5, 6, run"""
    ),
)
def _missed_standard_runs(spark, sf_dir, folder):
    t = _tables(spark, sf_dir)
    return summary.missed_runs(CFG, _acts(t), adapter.standards(t), _REGIONS)


# ---- distinct counts that roll up --------------------------------------------


def _level_sql(level: str, region: str, period: str) -> str:
    return f"""SELECT '{level}' AS level, {region} AS region, {period} AS period, count(DISTINCT o_custkey) AS customers,
  count(DISTINCT o_custkey) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM placed GROUP BY ALL"""


_NONE = "CAST(NULL AS VARCHAR)"


@report(
    "distinct_rollups",
    f"""WITH {_PLACED_SQL} {_level_sql('month', 'r_name', month('o_orderdate'))}
UNION ALL {_level_sql('year', 'r_name', "strftime(o_orderdate, '%Y')")}
UNION ALL {_level_sql('region', 'r_name', _NONE)}
UNION ALL {_level_sql('all', _NONE, _NONE)}""",
)
def _distinct_rollups(spark, sf_dir, folder):
    """Customers per month, year, region and in all, from bitmaps stored per region and month."""
    t = _tables(spark, sf_dir)
    placed = _placed(t).select(F.col("r_name").alias("region"), month_of("o_orderdate").alias("month"), "o_custkey", "o_orderpriority")
    ids = dense_ids(t("customer"), "c_custkey", f"{folder}/ids")
    names = ["customers", "urgent"]
    conditions = {"customers": F.lit(True), "urgent": F.col("o_orderpriority") == "1-URGENT"}
    bitmaps = id_bitmaps(placed, ids, ["region", "month"], "o_custkey", conditions, f"{folder}/bitmaps")
    none = F.lit(None).cast("string")
    levels = {
        "month": [F.col("region"), F.col("month").alias("period")],
        "year": [F.col("region"), F.substring("month", 1, 4).alias("period")],
        "region": [F.col("region"), none.alias("period")],
        "all": [none.alias("region"), none.alias("period")],
    }
    out = None
    for level, keys in levels.items():
        counted = count_bitmaps(bitmaps, keys, names).withColumn("level", F.lit(level))
        out = counted if out is None else out.unionByName(counted)
    return out.select("level", "region", "period", *names)


# ---- tables by year ----------------------------------------------------------

_ORDER_SPEC = TableSpec(
    "dwd", "orders_kept", schema("o_orderkey bigint, o_orderdate timestamp_ntz, o_custkey bigint, o_totalprice double"), "Orders by year"
)


def _corrected(orders: DataFrame) -> DataFrame:
    """Orders after edits in one year and deletions in two, of which one loses all."""
    year, key = F.year("o_orderdate"), F.col("o_orderkey")
    price = F.when((year == 1995) & (key % 50 == 0), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    gone = (year == 1993) & (key % 9 == 0) | (year == 1998)
    return orders.filter(~gone).withColumn("o_totalprice", price)


_CORRECTED_SQL = """SELECT o_orderkey, o_orderdate, o_custkey,
  CASE WHEN year(o_orderdate) = 1995 AND o_orderkey % 50 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders WHERE NOT (year(o_orderdate) = 1993 AND o_orderkey % 9 = 0 OR year(o_orderdate) = 1998)"""


@report("refreshed_years", _CORRECTED_SQL)
def _refreshed_years(spark, sf_dir, folder):
    """Stored by year, then three years replaced, of which one has no rows any more."""
    orders = _tables(spark, sf_dir)("orders")
    spark.sql("DROP TABLE IF EXISTS wardbook_years.orders_kept__by_year")
    where = {"time_col": "o_orderdate", "location": folder}
    publish_by_year(orders, _ORDER_SPEC, "wardbook_years", **where)
    return spark.table(publish_by_year(_corrected(orders), _ORDER_SPEC, "wardbook_years", years=[1993, 1995, 1998], **where))


@report("incremental_refresh", _CORRECTED_SQL)
def _incremental_refresh(spark, sf_dir, folder):
    """Stored by year, then brought up to date: the years to write are found by their digests."""
    orders = _tables(spark, sf_dir)("orders")
    spark.sql("DROP TABLE IF EXISTS wardbook_changes.orders_kept__by_year")
    for rows in (orders, _corrected(orders)):
        refresh_changed(rows, _ORDER_SPEC, "wardbook_changes", time_col="o_orderdate", location=folder)
    return spark.table("wardbook_changes.orders_kept")


@report("pruned_years", "SELECT o_orderkey, o_orderdate, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) >= 1997")
def _pruned_years(spark, sf_dir, folder):
    orders = _tables(spark, sf_dir)("orders")
    spark.sql("DROP TABLE IF EXISTS wardbook_pruned.orders_kept__by_year")
    publish_by_year(orders, _ORDER_SPEC, "wardbook_pruned", time_col="o_orderdate", location=folder)
    return read_since(spark, _ORDER_SPEC, "wardbook_pruned", time_col="o_orderdate", year=1997)


_EDITED_SQL = """orders_edited AS (SELECT * REPLACE (CASE WHEN year(o_orderdate) = 1998 AND o_orderkey % 4 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus)
  FROM orders WHERE NOT (year(o_orderdate) = 1997 AND o_orderkey % 3 = 0))"""


def _edited_job(key: str, select: str) -> str:
    """A job's SQL over edited orders."""
    text = re.sub(r"\borders\b", "orders_edited", with_chain(select, key))
    return f"WITH {_EDITED_SQL}, {text.strip().removeprefix('WITH ')}"


def _refreshed(spark: SparkSession, sf_dir: str, folder: str, query: str) -> WarehouseConfig:
    """Jobs refreshed from the driver's orders, then again after some were edited and others deleted."""
    cfg = replace(CFG, databases={layer: f"wardbook_{query}_{layer}" for layer in CFG.databases}, location=f"{folder}/tables")
    for key in ("t02", "t13", "t14", "t20", "t22", "t23", "t24"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {cfg.db(OUTPUTS[key].layer)}")
        spark.sql(f"DROP TABLE IF EXISTS {by_year_name(OUTPUTS[key], cfg.db(OUTPUTS[key].layer))}")
    for step in range(2):
        w = adapter.warehouse(spark, sf_dir, f"{folder}/{step}", cfg)
        if step:
            given, year = w.source.tables, F.year("o_orderdate")
            status = F.when((year == 1998) & (F.col("o_orderkey") % 4 == 0), "F").otherwise(F.col("o_orderstatus"))
            kept = given("orders").filter(~((year == 1997) & (F.col("o_orderkey") % 3 == 0))).withColumn("o_orderstatus", status)
            w.source.tables = lambda name: kept if name == "orders" else given(name)
        refresh_years(w, folder=f"{folder}/{step}/read")
    return cfg


@report(
    "incremental_counts",
    _edited_job("t14", "SELECT hospital_id, major_id, major_name, activity_type_id, month, activity_count, is_standard FROM t14"),
)
def _incremental_counts(spark, sf_dir, folder):
    cfg = _refreshed(spark, sf_dir, folder, "inc_counts")
    spec = OUTPUTS["t14"]
    columns = ("hospital_id", "major_id", "major_name", "activity_type_id", "month", "activity_count", "is_standard")
    return spark.table(f"{cfg.db(spec.layer)}.{spec.name}").select(*columns)


@report("incremental_overview", _edited_job("t13", "SELECT hospital_id, year, activity_count, student_count, sign_count, evaluation_count FROM t13"))
def _incremental_overview(spark, sf_dir, folder):
    cfg = _refreshed(spark, sf_dir, folder, "inc_overview")
    spec = OUTPUTS["t13"]
    return spark.table(f"{cfg.db(spec.layer)}.{spec.name}").select("hospital_id", "year", "activity_count", "student_count", "sign_count", "evaluation_count")


# ---- rejected rows, drifting sites, personal data ----------------------------

_SHEET = schema("trainid bigint, type_id int, major_id int, starts timestamp_ntz, ends timestamp_ntz")
_RAW_SQL = """raw AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_totalprice < 50000 THEN -o_orderkey ELSE o_orderkey END AS trainid,
  CASE WHEN o_orderkey % 11 = 0 THEN 'type ' || o_orderkey WHEN o_orderkey % 7 > 0 THEN substr(o_orderpriority, 1, 1) END AS type_id,
  CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END AS major_id, o_orderdate AS starts,
  o_orderdate + CASE WHEN o_orderkey % 13 = 0 THEN -INTERVAL 1 DAY ELSE INTERVAL 1 DAY END AS ends FROM orders),
failed AS (SELECT unnest([CASE WHEN NOT coalesce(trainid >= 0, FALSE) THEN 'key' END,
    CASE WHEN type_id IS NULL AND major_id IS NULL THEN 'type or major' END, CASE WHEN NOT coalesce(starts <= ends, FALSE) THEN 'period' END,
    CASE WHEN type_id IS NOT NULL AND try_cast(type_id AS INT) IS NULL THEN 'type of type_id' END]) AS reason FROM raw)"""


@report("rejected_rows", f"WITH {_RAW_SQL} SELECT reason, count(*) AS rows FROM failed WHERE reason IS NOT NULL GROUP BY 1")
def _rejected_rows(spark, sf_dir, folder):
    key, day = F.col("o_orderkey"), F.expr("INTERVAL 1 DAY")
    raw = _tables(spark, sf_dir)("orders").select(
        F.when(F.col("o_orderstatus") == "P", None).when(F.col("o_totalprice") < 50000, -key).otherwise(key).alias("trainid"),
        F.when(key % 11 == 0, F.concat(F.lit("type "), key.cast("string")))
        .when(key % 7 > 0, F.substring("o_orderpriority", 1, 1))
        .alias("type_id"),
        F.when(key % 5 > 0, F.col("o_custkey")).alias("major_id"),
        F.col("o_orderdate").alias("starts"),
        F.when(key % 13 == 0, F.col("o_orderdate") - day).otherwise(F.col("o_orderdate") + day).alias("ends"),
    )
    rules = {"key": valid_key("trainid"), "type or major": any_present("type_id", "major_id"), "period": F.col("starts") <= F.col("ends")}
    rejected = audit(raw, _SHEET, rules, f"{folder}/audited").rejected
    return rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


_CLINICS = tuple(Site(no, f"clinic {no}", f"c{no}") for no in range(3))


@report(
    "drifting_sites",
    """SELECT CAST(o_orderkey % 3 AS INT) AS site_id, o_orderkey AS order_id, o_orderstatus AS state, CAST(NULL AS VARCHAR) AS remark,
  CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_custkey END AS customer_id FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT CAST(o_orderkey % 3 AS INT), o_orderkey, o_orderstatus, o_orderpriority, NULL FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT CAST(o_orderkey % 3 AS INT), o_orderkey, NULL, NULL, o_custkey FROM orders WHERE o_orderkey % 3 = 2""",
)
def _drifting_sites(spark, sf_dir, folder):
    """Three sites' orders: one names its columns otherwise and has wider ids, two lack columns."""
    orders = _tables(spark, sf_dir)("orders")
    own = [orders.filter(F.col("o_orderkey") % 3 == no) for no in range(3)]
    frames = [
        own[0].select("o_orderkey", F.col("o_orderstatus").alias("state"), F.col("o_custkey").cast("int").alias("customer_id")),
        own[1].select(F.col("o_orderkey").cast("int").alias("order_id"), F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("remark")),
        own[2].select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), "o_totalprice"),
    ]
    declared = schema("order_id int, state string, remark string, customer_id int")
    same, _ = harmonise(list(zip(_CLINICS, frames)), declared, renames={0: {"o_orderkey": "order_id"}}, required=["order_id"])
    out = None
    for site, rows in same:
        rows = rows.withColumn("site_id", F.lit(site.id))
        out = rows if out is None else out.unionByName(rows)
    return out


_KEY = b"key of the driver's tables"


def _hmac_sql(value: str, field: str) -> str:
    """HMAC-SHA256 spelled out, with the two padded keys as literals."""
    own = field_key(_KEY, field).ljust(64, b"\0")
    inner, outer = (bytes(b ^ pad for b in own).hex() for pad in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({value}))))"


@report(
    "pseudonymous_teachers",
    with_chain(
        f"""SELECT DISTINCT teacher_id, teacher_name, teacher_hospital_id, {_hmac_sql('teacher_phone', 'phoneno')} AS teacher_phone, teacher_id_card
FROM t07""",
        "t07",
    ),
)
def _pseudonymous_teachers(spark, sf_dir, folder):
    w = adapter.warehouse(spark, sf_dir, folder, replace(CFG, pseudonym_key=_KEY))
    people = w.staged("t07", folder)
    return people.select("teacher_id", "teacher_name", "teacher_hospital_id", "teacher_phone", "teacher_id_card")


# ---- titles that nearly agree ------------------------------------------------

_TITLE = "p_name || ' ' || p_type || ' size ' || p_size || ' of ' || p_brand"


@report(
    "near_titles",
    f"""WITH titled AS (SELECT DISTINCT p_size % 10 AS family, {_TITLE} AS title FROM part),
sets AS (SELECT *, list_distinct(string_split(lower(title), ' ')) AS words FROM titled)
SELECT a.family, a.title, b.title AS other_title, len(list_intersect(a.words, b.words)) AS shared,
  len(list_distinct(list_concat(a.words, b.words))) AS together
FROM sets a JOIN sets b ON a.family = b.family AND a.title < b.title
WHERE len(list_intersect(a.words, b.words)) * 100 >= 75 * len(list_distinct(list_concat(a.words, b.words)))""",
)
def _near_titles(spark, sf_dir, folder):
    part = _tables(spark, sf_dir)("part")
    title = F.concat_ws(" ", "p_name", "p_type", F.lit("size"), "p_size", F.lit("of"), "p_brand")
    return near_titles(part.select((F.col("p_size") % 10).alias("family"), title.alias("title")), ["family"], "title", percent=75)
