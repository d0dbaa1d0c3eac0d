"""One query per operator, on the driver's tables.

Each entry pairs a DataFrame expression with SQL for the same result. Where an operator
works on activities, orders play that part: a region is the site, a nation the
specialty, the order priority the activity type, and lineitems are participations.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardbook.config import Site
from wardbook.functions import (
    any_present,
    backfill,
    clean_text,
    differs_any,
    map_values,
    month_of,
    percent_text,
    safe_ratio,
    same_all,
    sentinel_fill,
    since_month,
    since_year,
    surrogate_key,
    valid_key,
)
from wardbook.operators import (
    abnormal_headcount,
    attach,
    class_counts,
    coverage,
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
    presence_matrix,
    registry_participants,
    same_vs_other,
    select_as,
)
from wardbook.operators.joins import left_join
from wardbook.plans import detail, report, summary
from wardbook.queries.adapter import CFG, Tables, admissions, persons, rotations, run_folder, standards
from wardbook.queries.job_sql import clean, half_up, job_sql, month, ratio, whole_months, with_chain
from wardbook.sources import OUTPUTS, CatalogSource, TableSpec, conform, ensure_database, publish, standards_dictionary
from wardbook.sources.schemas import schema
from wardbook.sources.standards import STANDARDS

Build = Callable[[Tables], DataFrame]
ENTRIES: dict[str, tuple[Build, str]] = {}


def entry(name: str, sql: str) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        ENTRIES[name] = (build, sql)
        return build

    return register


# ---- shared shapes -----------------------------------------------------------


def _placed(t: Tables) -> DataFrame:
    """Orders with their customer's nation and region."""
    where = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        t("orders")
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(where, F.col("c_nationkey") == F.col("n_nationkey"))
    )


def _acts(t: Tables) -> DataFrame:
    """Orders in the columns of the activity table."""
    label = F.substring("o_orderpriority", 3, 100)
    lines = t("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    placed = _placed(t).join(t("part"), F.col("o_custkey") == F.col("p_partkey"), "left")
    return select_as(
        left_join(placed, lines, [("o_orderkey", "l_orderkey")], ["lines"]),
        {
            "activity_id": F.col("o_orderkey").cast("string"),
            "activity_name": F.when(F.col("o_totalprice") < 40000, label)
            .when(F.col("o_totalprice") > 450000, F.lit(None))
            .otherwise(F.col("p_type")),
            "activity_type_id": F.substring("o_orderpriority", 1, 1).cast("int"),
            "activity_type_name": label,
            "activity_hospital_id": "r_regionkey",
            "activity_hospital_name": "r_name",
            "activity_major_id": "n_nationkey",
            "activity_major_name": "n_name",
            "activity_start_time": "o_orderdate",
            "activity_participant_count": "lines",
        },
    )


def _log(t: Tables) -> DataFrame:
    """Lineitems in the columns of the student log."""
    return select_as(
        left_join(t("lineitem"), _placed(t), [("l_orderkey", "o_orderkey")], ["r_regionkey", "r_name", "o_orderdate"]),
        {
            "student_hospital_id": "r_regionkey",
            "student_hospital_name": "r_name",
            "student_name": F.concat(F.lit("part "), F.col("l_partkey").cast("string")),
            "activity_start_time": "o_orderdate",
            "activity_is_signed": F.when(F.col("l_returnflag") == "A", CFG.signed_text).otherwise(F.col("l_returnflag")),
            "activity_evaluation_score_rate": F.when(F.col("l_tax") > 0.02, F.col("l_tax")),
        },
    )


_PLACED_SQL = """placed AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_ACTS_SQL = f"""{_PLACED_SQL}, acts AS (
  SELECT o_orderkey AS id, CASE WHEN o_totalprice < 40000 THEN substr(o_orderpriority, 3)
      WHEN o_totalprice <= 450000 THEN p_type END AS title,
    CAST(substr(o_orderpriority, 1, 1) AS INT) AS tid, substr(o_orderpriority, 3) AS tname,
    r_regionkey AS hid, r_name AS hname, n_nationkey AS mid, n_name AS mname, o_orderdate AS t, n AS lines
  FROM placed LEFT JOIN part ON o_custkey = p_partkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)"""
_OVERVIEW_SQL = f"""{_ACTS_SQL}, ov AS (
  SELECT a.*, student_count, sign_count, total_sign_count, evaluation_count, total_evaluation_count
  FROM (SELECT hid AS hospital_id, hname AS hospital_name, year(t)::INT AS year, count(DISTINCT id) AS activity_count,
          sum(lines)::BIGINT AS total_person_times FROM acts WHERE year(t) >= {CFG.cutoff_year} GROUP BY 1, 2, 3) a
  LEFT JOIN (SELECT r_regionkey AS hospital_id, year(o_orderdate)::INT AS year, count(DISTINCT l_partkey) AS student_count,
          count(*) FILTER (l_returnflag = 'A') AS sign_count, count(l_returnflag) AS total_sign_count,
          count(*) FILTER (l_tax > 0.02) AS evaluation_count, count(*) AS total_evaluation_count
        FROM lineitem JOIN placed ON l_orderkey = o_orderkey GROUP BY 1, 2) USING (hospital_id, year))"""
_TITLES_SQL = f"""{_ACTS_SQL}, titles AS (
  SELECT hid, hname, mid, mname, {month('t')} AS m, title, tid, tname, id,
    CASE WHEN title = tname THEN 1
         WHEN count(*) OVER (PARTITION BY hid, mid, {month('t')}, title, tid) > 1 THEN 2 ELSE 0 END AS klass
  FROM acts)"""


# ---- sources, sinks, projections ---------------------------------------------


@entry(
    "scan_project",
    "SELECT o_orderkey AS order_id, o_orderdate AS placed_at, o_orderstatus AS state FROM orders",
)
def _scan_project(t):
    return select_as(t("orders"), {"order_id": "o_orderkey", "placed_at": "o_orderdate", "state": "o_orderstatus"})


_DEPOTS = tuple(Site(no, f"depot {no}", f"d{no}") for no in range(3))


@entry(
    "federated_union",
    """SELECT (o_orderkey % 3) || '_' || o_orderkey AS order_ref, CAST(o_orderkey % 3 AS INT) AS depot_id,
  'depot ' || (o_orderkey % 3) AS depot_name, o_orderstatus AS state,
  CAST(o_totalprice * 0 + 1 AS INT) AS one FROM orders WHERE o_orderkey >= 0""",
)
def _federated_union(t):
    orders = t("orders")
    rows = federate(
        [(s, orders.filter(F.col("o_orderkey") % 3 == s.id)) for s in _DEPOTS],
        {"key": F.col("o_orderkey"), "state": clean_text("o_orderstatus", "?"), "one": F.lit(1)},
        site_id="depot_id",
        site_name="depot_name",
        where=lambda site: valid_key("o_orderkey"),
    )
    return rows.withColumn("order_ref", surrogate_key("depot_id", "key")).drop("key")


def _literal(value) -> str:
    return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)


_DICT_SQL = ", ".join("(" + ", ".join(_literal(v) for v in row[:5]) + ")" for row in STANDARDS)


@entry(
    "literal_dictionary",
    f"""SELECT major_name, kind, standard, count(*) AS orders, sum(coalesce(standard, 0))::BIGINT AS due
FROM (SELECT CAST(o_custkey % 92 AS INT) AS m, CAST(o_orderkey % 100 AS INT) AS k FROM orders)
LEFT JOIN (VALUES {_DICT_SQL}) AS d(major_id, major_name, kind_id, kind, standard) ON m = major_id AND k = kind_id
GROUP BY ALL""",
)
def _literal_dictionary(t):
    orders = t("orders").select((F.col("o_custkey") % 92).cast("int").alias("m"), (F.col("o_orderkey") % 100).cast("int").alias("k"))
    named = lookup_join(
        orders,
        standards_dictionary(orders.sparkSession),
        [("m", "major_id"), ("k", "activity_type_id")],
        ["major_name", "activity_type_name", "standard_count"],
    ).withColumnsRenamed({"activity_type_name": "kind", "standard_count": "standard"})
    return named.groupBy("major_name", "kind", "standard").agg(
        F.count("*").alias("orders"), F.sum(F.coalesce("standard", F.lit(0))).alias("due")
    )


# Fixed values, summed from the published dictionary's text: specialty, its name, rows, sum of
# standards, sum of type id (1000 without one) times standard, characters in type names and remarks.
_DICT_SUMS = """
  (1, '内科', 12, 9, 70, 71),
  (2, '外科', 12, 10, 169, 71),
  (3, '妇产科', 12, 9, 70, 71),
  (4, '儿科', 12, 10, 169, 71),
  (5, '急诊科', 12, 9, 70, 71),
  (6, '神经内科', 12, 9, 70, 71),
  (7, '皮肤科', 12, 9, 70, 71),
  (8, '眼科', 12, 9, 70, 71),
  (9, '耳鼻咽喉科', 12, 9, 70, 71),
  (10, '精神科', 12, 13, 466, 71),
  (12, '康复医学科', 12, 9, 70, 71),
  (13, '麻醉科', 12, 10, 1070, 71),
  (15, '检验医学科', 12, 11, 2068, 71),
  (16, '临床病理科', 12, 9, 68, 71),
  (17, '口腔全科', 12, 8, 62, 71),
  (22, '放射科', 12, 12, 93, 71),
  (23, '超声医学科', 12, 7, 62, 71),
  (24, '核医学科', 12, 10, 83, 143),
  (25, '骨科', 12, 9, 70, 71),
  (27, '放射肿瘤科', 12, 12, 1076, 71),
  (28, '重症医学科', 12, 9, 70, 71),
  (76, '口腔修复科', 12, 8, 62, 71),
  (77, '口腔颌面外科', 12, 9, 159, 71),
  (78, '口腔内科', 12, 8, 62, 71),
  (79, '口腔正畸科', 12, 8, 62, 71),
  (83, '口腔病理科', 12, 9, 159, 71),
  (84, '口腔颌面影像科', 12, 9, 159, 71),
  (91, '医学遗传科', 12, 9, 70, 71),
  (11, '小儿外科', 12, 9, 70, 71),
  (72, '外科(泌尿外科)', 12, 9, 70, 71),
  (73, '外科(胸心外科)', 12, 9, 70, 71),
  (74, '外科(神经外科)', 12, 9, 70, 71),
  (80, '外科(整形外科)', 12, 9, 70, 71)"""


@entry(
    "dictionary_by_specialty",
    f"""SELECT d.*, count(o_orderkey) AS orders FROM (VALUES {_DICT_SUMS}) AS d(major_id, major_name, n, due, weighed, letters)
LEFT JOIN orders ON o_custkey % 92 = major_id GROUP BY ALL""",
)
def _dictionary_by_specialty(t):
    """All rows of the dictionary, summed by specialty, with the orders that fall to each."""
    due, kind = F.col("standard_count"), F.coalesce("activity_type_id", F.lit(1000))
    letters = F.length("activity_type_name") + F.coalesce(F.length("remark"), F.lit(0))
    summed = standards_dictionary(t("orders").sparkSession).groupBy("major_id", "major_name").agg(
        F.count("*").alias("n"), F.sum(due).alias("due"), F.sum(kind * due).alias("weighed"), F.sum(letters).alias("letters")
    )
    placed = t("orders").groupBy((F.col("o_custkey") % 92).cast("int").alias("m")).agg(F.count("*").alias("orders"))
    return left_join(summed, placed, [("major_id", "m")], ["orders"]).fillna(0, ["orders"])


_ROUNDTRIP = TableSpec("dwd", "roundtrip_customer", schema("c_custkey bigint, c_name string, c_nationkey int"), "Published twice")


@entry("publish_roundtrip", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def _publish_roundtrip(t):
    customer = t("customer")
    spark = customer.sparkSession
    folder = run_folder(spark, "customer", "roundtrip")
    for _ in range(2):
        name = publish(customer, _ROUNDTRIP, "wardbook_roundtrip", location=folder)
    return spark.table(name)


_SHELF = TableSpec("ads", "shelf_parts", schema("p_brand string, p_size int, p_partkey bigint"), "Parts, largest first")


@entry("published_in_order", "SELECT p_brand, p_size, p_partkey FROM part")
def _published_in_order(t):
    part = t("part")
    spark = part.sparkSession
    order = [F.desc("p_size"), F.asc("p_partkey")]
    return spark.table(publish(part, _SHELF, "wardbook_shelf", order_by=order, location=run_folder(spark, "part", "shelf")))


def _catalog(t: Tables, query: str) -> CatalogSource:
    """Participations of three sites, admissions and rotations as tables of the catalog.

    Their files are in a folder of the application and the query: a catalog that forgets
    its tables with its session leaves no managed folders that a later one stumbles over.
    """
    spark = t("lineitem").sparkSession
    cfg = replace(CFG, databases={layer: f"wardbook_{query}_{layer}" for layer in ("ods", "dwd")})
    folder = run_folder(spark, query, "catalog")
    taken = persons(t)
    tables = {f"{cfg.db('ods')}.{s.tables['person']}": taken.filter(F.col("site_no") == no).drop("site_no") for no, s in enumerate(cfg.sites)}
    tables |= {f"{cfg.db('dwd')}.{cfg.admissions_table}": admissions(t), f"{cfg.db('dwd')}.{cfg.rotations_table}": rotations(t)}
    for db in cfg.databases.values():
        ensure_database(spark, db)
    for name, rows in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        rows.write.mode("overwrite").option("path", f"{folder}/{name}").saveAsTable(name)
    return CatalogSource(spark, cfg)


@entry("catalog_sites", job_sql("t03"))
def _catalog_sites(t):
    source = _catalog(t, "catalog_sites")
    return conform(detail.participation(source.cfg, source), OUTPUTS["t03"].schema)


@entry(
    "catalog_shared_inputs",
    """SELECT 'admissions' AS input, CAST(1995 + p_size % 6 AS INT) AS grade, count(*) AS n FROM part GROUP BY ALL
UNION ALL SELECT 'rotations', CAST(1995 + p_size % 6 AS INT), count(*) FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
)
def _catalog_shared_inputs(t):
    source = _catalog(t, "catalog_shared")

    def counted(rows: DataFrame, name: str, year: str) -> DataFrame:
        return rows.groupBy(F.lit(name).alias("input"), F.col(year).alias("grade")).agg(F.count("*").alias("n"))

    return counted(source.admissions(), "admissions", "admission_year").unionByName(counted(source.rotations(), "rotations", "gradeyear"))


_CONFORMED = schema("order_year string, placed_at string, o_orderkey string, order_month int")


@entry(
    "conform_cast",
    """SELECT CAST(year(o_orderdate) AS VARCHAR) AS order_year, CAST(o_orderdate AS VARCHAR) AS placed_at,
  CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(month(o_orderdate) AS INT) AS order_month FROM orders""",
)
def _conform_cast(t):
    orders = t("orders").withColumns(
        {
            "order_year": F.year("o_orderdate"),
            "placed_at": F.col("o_orderdate"),
            "order_month": F.month("o_orderdate").cast("bigint"),
        }
    )
    return conform(orders, _CONFORMED)


@entry(
    "clean_text",
    f"""SELECT doc_id, {clean('text')} AS cleaned, regexp_replace(text, '[\\r\\n]', ' ', 'g') AS titled,
  {clean("nullif(lang, 'en')")} AS tongue, {clean("' \"' || source || chr(10)", False)} AS origin FROM documents""",
)
def _clean_text(t):
    return select_as(
        t("documents"),
        {
            "doc_id": "doc_id",
            "cleaned": clean_text("text", CFG.unknown_text),
            "titled": clean_text("text", strip_quotes=False, trim=False),
            "tongue": clean_text(F.nullif("lang", F.lit("en")), CFG.unknown_text),
            "origin": clean_text(F.concat(F.lit(' "'), "source", F.lit("\n"))),
        },
    )


@entry("sentinel_fill", "SELECT event_id, coalesce(nullif(user_id % 7, 0), -1) AS slot FROM events")
def _sentinel_fill(t):
    return t("events").select("event_id", sentinel_fill(F.nullif(F.col("user_id") % 7, F.lit(0)), -1).alias("slot"))


@entry(
    "case_mapping",
    """SELECT c_custkey, CASE r_name WHEN 'AFRICA' THEN 1 WHEN 'ASIA' THEN 2 WHEN 'EUROPE' THEN 3 ELSE -1 END AS area_id,
  CASE r_name WHEN 'AFRICA' THEN 'South' WHEN 'ASIA' THEN 'East' WHEN 'EUROPE' THEN 'North' ELSE 'other' END AS area
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def _case_mapping(t):
    where = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return t("customer").join(where, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        map_values("r_name", {"AFRICA": 1, "ASIA": 2, "EUROPE": 3}, -1).alias("area_id"),
        map_values("r_name", {"AFRICA": "South", "ASIA": "East", "EUROPE": "North"}, "other").alias("area"),
    )


@entry(
    "dictionary_backfill",
    f"""SELECT c_custkey, CASE WHEN id = -1 THEN coalesce(n_nationkey, -1) ELSE id END AS nation_id,
  CASE WHEN name = '{CFG.unknown_text}' THEN coalesce(n_name, name) ELSE name END AS nation
FROM (SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN -1 ELSE c_nationkey END AS id,
        CASE WHEN c_acctbal < 0 THEN '{CFG.unknown_text}' ELSE 'N' || c_nationkey END AS name,
        CASE WHEN c_acctbal < 5000 THEN 'NATION_' || c_nationkey ELSE 'none' END AS office FROM customer)
LEFT JOIN nation ON office = n_name""",
)
def _dictionary_backfill(t):
    nation = F.col("c_nationkey").cast("string")
    rows = t("customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "MACHINERY", -1).otherwise(F.col("c_nationkey")).alias("nation_id"),
        F.when(F.col("c_acctbal") < 0, CFG.unknown_text).otherwise(F.concat(F.lit("N"), nation)).alias("nation"),
        F.when(F.col("c_acctbal") < 5000, F.concat(F.lit("NATION_"), nation)).otherwise("none").alias("office"),
    )
    names = dedupe_keys(t("nation"), ["n_nationkey", "n_name"])
    known = lookup_join(rows, names, [("office", "n_name")], ["n_nationkey", "n_name"])
    return known.select(
        "c_custkey",
        backfill("nation_id", "n_nationkey", -1).alias("nation_id"),
        backfill("nation", "n_name", CFG.unknown_text).alias("nation"),
    )


# ---- filters -----------------------------------------------------------------


@entry(
    "filter_valid_key",
    """SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_totalprice < 50000 THEN -o_orderkey
  ELSE o_orderkey END AS k FROM orders) WHERE k >= 0""",
)
def _filter_valid_key(t):
    k = F.when(F.col("o_orderstatus") == "P", None).when(F.col("o_totalprice") < 50000, -F.col("o_orderkey"))
    return t("orders").select("o_orderkey", k.otherwise(F.col("o_orderkey")).alias("k")).filter(valid_key("k"))


@entry(
    "filter_either",
    """SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS a,
  CASE WHEN o_totalprice > 250000 THEN o_custkey END AS b FROM orders) WHERE a IS NOT NULL OR b IS NOT NULL""",
)
def _filter_either(t):
    return (
        t("orders")
        .select(
            "o_orderkey",
            F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("a"),
            F.when(F.col("o_totalprice") > 250000, F.col("o_custkey")).alias("b"),
        )
        .filter(any_present("a", "b"))
    )


@entry(
    "year_cutoff",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y FROM orders WHERE year(o_orderdate) >= 1998",
)
def _year_cutoff(t):
    late = t("orders").filter(since_year("o_orderdate", 1998)).select("o_orderkey", F.year("o_orderdate").alias("y"))
    return late.filter(since_year("y", 1998, is_year=True))


@entry(
    "month_cutoff",
    f"SELECT o_orderkey, {month('o_orderdate')} AS m FROM orders WHERE {month('o_orderdate')} >= '1998-03'",
)
def _month_cutoff(t):
    return t("orders").select("o_orderkey", month_of("o_orderdate").alias("m")).filter(since_month("m", "1998-03"))


@entry(
    "pair_predicates",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, own IS NOT NULL AND own = office AS same, coalesce(own <> office, FALSE)
  OR own_region <> office_region AS other
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_partkey % 5 AS INT) END AS own,
        s_nationkey % 5 AS office, l_partkey % 2 AS own_region, s_nationkey % 2 AS office_region
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)""",
)
def _pair_predicates(t):
    rows = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
        *("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey") % 5).alias("own"),
        (F.col("s_nationkey") % 5).alias("office"),
        (F.col("l_partkey") % 2).alias("own_region"),
        (F.col("s_nationkey") % 2).alias("office_region"),
    )
    return rows.select(
        *("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        F.coalesce(same_all([("own", "office")]), F.lit(False)).alias("same"),
        F.coalesce(differs_any([("own", "office"), ("own_region", "office_region")]), F.lit(False)).alias("other"),
    )


# ---- joins -------------------------------------------------------------------


@entry(
    "semi_by_role",
    """SELECT 'part' AS kind, p_partkey AS id, p_name AS name FROM part
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R')
UNION SELECT 'supplier', s_suppkey, s_name FROM supplier
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_returnflag = 'R')""",
)
def _semi_by_role(t):
    def returned(registry: DataFrame, key: str, kind: str) -> DataFrame:
        people = registry.toDF("id", "name").withColumn("kind", F.lit(kind))
        return registry_participants(people, t("lineitem"), [("id", key)], role_col="l_returnflag", role="R")

    parts = returned(t("part").select("p_partkey", "p_name"), "l_partkey", "part")
    return parts.unionByName(returned(t("supplier").select("s_suppkey", "s_name"), "l_suppkey", "supplier"))


@entry(
    "participation_log",
    """SELECT p_partkey, p_name, l_quantity AS quantity, placed AS o_orderkey, o_orderdate
FROM part LEFT JOIN (SELECT *, CASE WHEN l_partkey % 10 <> 0 THEN l_partkey END AS taker FROM lineitem) ON p_partkey = taker
LEFT JOIN (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS placed FROM orders) ON l_orderkey = placed""",
)
def _participation_log(t):
    """Every tenth part's lines and all pending orders lack their key, so that both joins also miss."""
    return participation_log(
        t("part").select("p_partkey", "p_name"),
        t("lineitem").withColumn("taker", F.when(F.col("l_partkey") % 10 != 0, F.col("l_partkey"))),
        t("orders").withColumn("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))),
        person_on=[("p_partkey", "taker")],
        participation_cols={"quantity": "l_quantity"},
        activity_on=[("l_orderkey", "o_orderkey")],
        activity_cols=["o_orderkey", "o_orderdate"],
    )


@entry(
    "id_backfill_join",
    """SELECT o_orderkey, f.c_custkey AS filled_id
FROM (SELECT o_orderkey, c_name AS name, CASE WHEN o_orderstatus <> 'P' THEN c_nationkey END AS nation
      FROM orders JOIN customer ON o_custkey = c_custkey) o
LEFT JOIN customer f ON f.c_name = o.name AND f.c_nationkey = o.nation""",
)
def _id_backfill_join(t):
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.col("c_name").alias("name"),
        F.when(F.col("o_orderstatus") != "P", F.col("c_nationkey")).alias("nation"),
    )
    filled = fill_id(rows, t("customer"), [("name", "c_name"), ("nation", "c_nationkey")], "c_custkey", "filled_id")
    return filled.select("o_orderkey", "filled_id")


# ---- intervals ---------------------------------------------------------------

_INTERVAL_SQL = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_WALK_SQL = f"""SELECT o_custkey, o_orderkey, o_orderdate, l_shipdate,
  strftime(CAST(date_trunc('month', o_orderdate) AS DATE) + to_months(CAST(n AS INT)), '%Y-%m') AS month
{_INTERVAL_SQL}, unnest(range({whole_months('o_orderdate', 'l_shipdate')} + 1)) AS g(n) WHERE o_orderdate <= l_shipdate"""


def _walk(t: Tables, *together: str) -> DataFrame:
    """Lines from order to shipping by month; ``together`` are columns to shuffle the intervals by before.

    An interval becomes many rows after that shuffle, so run time is not left to merge its
    partitions by their bytes, and there are four times as many as usual.
    """
    spans = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    spans = spans.select("o_custkey", "o_orderkey", "o_orderdate", "l_shipdate")
    if together:
        spans = spans.repartition(4 * int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions")), *together)
    return month_walk(spans, "o_orderdate", "l_shipdate")


@entry("month_walk", f"SELECT o_orderkey, l_shipdate, month FROM ({_WALK_SQL})")
def _month_walk(t):
    return _walk(t).select("o_orderkey", "l_shipdate", "month")


@entry(
    "month_bucket_join",
    f"""SELECT w.o_custkey, month, count(*) AS rows, count(p.o_orderkey) AS hits, count(DISTINCT p.o_orderkey) AS orders
FROM ({_WALK_SQL}) w LEFT JOIN orders p ON p.o_custkey = w.o_custkey AND {month('p.o_orderdate')} = w.month
GROUP BY 1, 2""",
)
def _month_bucket_join(t):
    placed = t("orders").select(F.col("o_custkey").alias("cust"), F.col("o_orderkey").alias("hit"), month_of("o_orderdate").alias("m"))
    # A customer's intervals are brought together before they are spread over months, and equal months are counted.
    months = _walk(t, "o_custkey").groupBy("o_custkey", "month").agg(F.count("*").alias("times"))
    joined = month_bucket_join(months, placed, [("o_custkey", "cust"), ("month", "m")], ["hit"])
    return joined.groupBy("o_custkey", "month").agg(
        F.sum("times").alias("rows"),
        F.sum(F.when(F.col("hit").isNotNull(), F.col("times")).otherwise(0)).alias("hits"),
        F.count_distinct("hit").alias("orders"),
    )


# ---- aggregates --------------------------------------------------------------


@entry("row_dedupe", f"SELECT DISTINCT l_returnflag, l_linestatus, {month('l_shipdate')} AS m FROM lineitem")
def _row_dedupe(t):
    return dedupe_rows(t("lineitem").select("l_returnflag", "l_linestatus", month_of("l_shipdate").alias("m")))


@entry(
    "distinct_per_group",
    """SELECT CAST(year(o_orderdate) AS INT) AS y, c_nationkey, count(DISTINCT o_custkey) AS customers
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def _distinct_per_group(t):
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return distinct_per(rows.withColumn("y", F.year("o_orderdate")), ["y", "c_nationkey"], "o_custkey", "customers")


def _overview(t: Tables) -> DataFrame:
    return summary.overview(CFG, _acts(t), _log(t))


@entry("overview", f"WITH {_OVERVIEW_SQL} SELECT * FROM ov")
def _overview_query(t):
    return _overview(t)


@entry(
    "ratio_percent",
    f"""WITH {_OVERVIEW_SQL} SELECT hospital_id, year, {ratio('sign_count', 'total_sign_count')} AS rate,
  CAST({half_up('(sign_count * 100.0::DOUBLE / total_sign_count)')} AS VARCHAR) || '%' AS fine,
  CAST({ratio('sign_count', 'total_sign_count')} * 100 AS VARCHAR) || '%' AS coarse,
  CAST(NULL AS DOUBLE) AS undefined FROM ov""",
)
def _ratio_percent(t):
    return _overview(t).select(
        "hospital_id",
        "year",
        safe_ratio("sign_count", "total_sign_count").alias("rate"),
        percent_text("sign_count", "total_sign_count").alias("fine"),
        percent_text("sign_count", "total_sign_count", round_first=True).alias("coarse"),
        safe_ratio("sign_count", F.col("sign_count") * 0).alias("undefined"),
    )


def _rank_sql(num: str, den: str) -> str:
    return f"""WITH {_OVERVIEW_SQL}
SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY rate DESC NULLS LAST, hospital_id) AS INT) AS place
FROM (SELECT hospital_id, year, {ratio(num, den)} AS rate FROM ov)"""


def _ranked(df: DataFrame, rate: str) -> DataFrame:
    return df.select("hospital_id", "year", F.col(rate).alias("rate"), F.col(f"{rate}_rank").alias("place"))


@entry("rank_avg_times", _rank_sql("total_person_times", "student_count"))
def _rank_avg_times(t):
    return _ranked(report.average_times(_overview(t)), "avg_activity_times_per_student")


@entry("rank_sign_rate", _rank_sql("sign_count", "total_sign_count"))
def _rank_sign_rate(t):
    return _ranked(report.sign_in(_overview(t)), "sign_rate")


@entry("rank_eval_rate", _rank_sql("evaluation_count", "total_evaluation_count"))
def _rank_eval_rate(t):
    return _ranked(report.evaluation(_overview(t)), "evaluation_rate")


_COUNTS_SQL = f"""{_ACTS_SQL}, counts AS (
  SELECT c.*, standard_count, CASE WHEN n < standard_count THEN 0 ELSE 1 END AS is_standard
  FROM (SELECT hid AS hospital_id, hname AS hospital_name, mid AS major_id, mname AS major_name, tid AS activity_type_id,
          tname AS activity_type_name, {month('t')} AS month, count(DISTINCT id) AS n
        FROM acts WHERE year(t) >= {CFG.cutoff_year} GROUP BY ALL) c
  LEFT JOIN t01 USING (major_id, major_name, activity_type_id, activity_type_name))"""


def _counts_sql(select: str) -> str:
    """The counts next to the standards of the job SQL."""
    chain = with_chain("", "t01").strip().removeprefix("WITH ")
    return f"WITH {chain}, {_COUNTS_SQL} {select}"


def _counts(t: Tables) -> DataFrame:
    return summary.counts_against_standards(CFG, _acts(t), standards(t))


@entry(
    "standard_flag",
    _counts_sql(
        "SELECT hospital_id, major_id, activity_type_id, month, n AS activity_count, standard_count, is_standard FROM counts"
    ),
)
def _standard_flag(t):
    return _counts(t).select(
        *("hospital_id", "major_id", "activity_type_id", "month", "activity_count", "standard_count", "is_standard")
    )


@entry(
    "unmatched_standards",
    f"""{_counts_sql('')} SELECT major_id, major_name, activity_type_id, activity_type_name, standard_count, remark FROM t01 s
WHERE NOT EXISTS (SELECT 1 FROM acts WHERE mid = s.major_id AND mname = s.major_name AND tid = s.activity_type_id
  AND tname = s.activity_type_name)""",
)
def _unmatched_standards(t):
    return summary.unmatched_standards(_acts(t), standards(t))


@entry(
    "missed_standard_months",
    _counts_sql(
        "SELECT hospital_id, hospital_name, major_id, major_name, string_agg(DISTINCT month, ';' ORDER BY month) AS month_list "
        "FROM counts WHERE is_standard = 0 GROUP BY 1, 2, 3, 4"
    ),
)
def _missed_standard_months(t):
    return report.missed_standards(_counts(t))


def _sums_sql(spread: str) -> str:
    gp = CFG.general_practice
    return _counts_sql(
        f"""SELECT *, CAST(gp > 0 AS INT) AS has_gp, CAST(spread >= {CFG.min_outpatient_specialties} AS INT) AS spread_ok
FROM (SELECT hospital_id, month, coalesce(sum(n) FILTER (outp AND major_id = {gp.id}), 0)::BIGINT AS gp, {spread} AS spread
  FROM (SELECT *, activity_type_id = {CFG.outpatient.id} AS outp FROM counts) GROUP BY 1, 2)"""
    )


def _sums(t: Tables, corrected: bool) -> DataFrame:
    return select_as(
        summary.outpatient(CFG, _counts(t), corrected=corrected),
        {
            "hospital_id": "hospital_id",
            "month": "month",
            "gp": "general_practice_outpatient_count",
            "spread": "outpatient_teaching_specialties",
            "has_gp": "is_general_practice_outpatient",
            "spread_ok": "is_outpatient_teaching_specialties_valid",
        },
    )


@entry(
    "conditional_sums",
    _sums_sql(f"coalesce(sum(major_id) FILTER (outp AND major_id <> {CFG.general_practice.id}), 0)::BIGINT"),
)
def _conditional_sums(t):
    return _sums(t, corrected=False)


@entry(
    "conditional_sums_fixed",
    _sums_sql(f"count(DISTINCT major_id) FILTER (outp AND major_id <> {CFG.general_practice.id})"),
)
def _conditional_sums_fixed(t):
    return _sums(t, corrected=True)


def _induction_detail(t: Tables) -> DataFrame:
    """Nations with orders per year, with their urgent orders, of which some name no nation."""
    placed = _placed(t).withColumn("y", F.year("o_orderdate"))
    active = distinct_per(placed, ["y", "r_regionkey", "n_nationkey"], "o_custkey", "customers")
    named = F.when((F.col("n_nationkey") + F.col("y")) % 5 != 0, F.col("n_nationkey"))
    urgent = placed.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("y").alias("ey"), named.alias("en"), "o_orderkey")
    return population_events(active, urgent, [("y", "ey"), ("n_nationkey", "en")], ["o_orderkey"])


def _coverage_sql(keys: str) -> str:
    share = half_up("(covered * 100.0::DOUBLE / active)")
    return f"""WITH {_PLACED_SQL} SELECT *, CAST({share} AS VARCHAR) || '%' AS share
FROM (SELECT {keys}, count(DISTINCT n_nationkey) AS active,
        count(DISTINCT n_nationkey) FILTER ((n_nationkey + y) % 5 <> 0 AND o_orderpriority = '1-URGENT') AS covered
      FROM (SELECT *, CAST(year(o_orderdate) AS INT) AS y FROM placed) GROUP BY {keys})"""


@entry("coverage_by_year", _coverage_sql("y"))
def _coverage_by_year(t):
    return coverage(_induction_detail(t), ["y"], "n_nationkey", "o_orderkey", total="active", covered="covered", rate="share")


@entry("coverage_by_site_year", _coverage_sql("r_regionkey, y"))
def _coverage_by_site_year(t):
    keys = ["r_regionkey", "y"]
    return coverage(_induction_detail(t), keys, "n_nationkey", "o_orderkey", total="active", covered="covered", rate="share")


@entry(
    "population_events",
    f"""WITH {_PLACED_SQL} SELECT a.*, o_orderkey
FROM (SELECT CAST(year(o_orderdate) AS INT) AS y, r_regionkey, n_nationkey, count(DISTINCT o_custkey) AS customers
      FROM placed GROUP BY 1, 2, 3) a
LEFT JOIN placed p ON p.n_nationkey = a.n_nationkey AND year(p.o_orderdate) = a.y
  AND (a.n_nationkey + a.y) % 5 <> 0 AND p.o_orderpriority = '1-URGENT'""",
)
def _population_events(t):
    return _induction_detail(t)


def _supplied(t: Tables) -> DataFrame:
    """Orders with each line's supplier nation, or NULL for orders without lines."""
    lines = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    own = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return left_join(own, lines, [("o_orderkey", "l_orderkey")], ["l_partkey", "s_nationkey"])


_SUPPLIED_SQL = """supplied AS (SELECT o_orderkey, o_orderdate, c_name, c_nationkey, l_partkey, s_nationkey
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT l_orderkey, l_partkey, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
    ON l_orderkey = o_orderkey),
per_order AS (SELECT o_orderkey, o_orderdate, c_name, c_nationkey, count(DISTINCT l_partkey) AS parts,
    count(DISTINCT l_partkey) FILTER (c_nationkey = s_nationkey) AS same,
    count(DISTINCT l_partkey) FILTER (c_nationkey <> s_nationkey) AS other FROM supplied GROUP BY 1, 2, 3, 4)"""


def _per_order(t: Tables) -> DataFrame:
    return same_vs_other(
        _supplied(t),
        ["o_orderkey", "o_orderdate", "c_name", "c_nationkey"],
        "l_partkey",
        [("c_nationkey", "s_nationkey")],
        total="parts",
        same="same",
        other="other",
        # A group is one order's lines.
        spread=False,
    )


@entry("same_vs_other", f"WITH {_SUPPLIED_SQL} SELECT o_orderkey, c_nationkey, parts, same, other FROM per_order")
def _same_vs_other(t):
    return _per_order(t).select("o_orderkey", "c_nationkey", "parts", "same", "other")


@entry(
    "abnormal_headcount",
    f"""WITH {_SUPPLIED_SQL} SELECT c_nationkey, {month('o_orderdate')} AS m, count(DISTINCT c_name) AS heads,
  count(DISTINCT c_name) FILTER (parts = 0) AS empty, count(DISTINCT c_name) FILTER (same = 0) AS foreign_only
FROM per_order GROUP BY 1, 2""",
)
def _abnormal_headcount(t):
    return abnormal_headcount(
        _per_order(t).withColumn("m", month_of("o_orderdate")),
        ["c_nationkey", "m"],
        "c_name",
        total="heads",
        zero={"empty": "parts", "foreign_only": "same"},
    )


@entry(
    "presence_matrix",
    """SELECT p_brand, count(DISTINCT p_name) AS names,
  count(DISTINCT p_name) FILTER (r) AS returned, count(DISTINCT p_name) FILTER (NOT r) AS kept,
  count(DISTINCT p_name) FILTER (b) AS bulk, count(DISTINCT p_name) FILTER (r AND NOT b) AS returned_only,
  count(DISTINCT p_name) FILTER (r AND b) AS both, count(DISTINCT p_name) FILTER (NOT r AND NOT b) AS neither
FROM (SELECT p_brand, p_name,
    EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_partkey % 3 <> 0 AND l_returnflag = 'R') AS r,
    EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_partkey % 4 <> 0 AND l_quantity >= 20) AS b FROM part) GROUP BY 1""",
)
def _presence_matrix(t):
    """Parts by presence in returns and in large lines; lines of some parts lack their key."""
    lines = t("lineitem")
    brands = t("part").select("p_partkey", "p_brand", "p_name")

    def seen(condition: str) -> DataFrame:
        named = lines.select(F.when(F.expr(condition), F.col("l_partkey")).alias("key"))
        return left_join(named, brands, [("key", "p_partkey")], ["p_brand", "p_name"]).withColumnRenamed("key", "p_partkey")

    return presence_matrix(
        brands,
        seen("l_returnflag = 'R' AND l_partkey % 3 <> 0"),
        seen("l_quantity >= 20 AND l_partkey % 4 <> 0"),
        ["p_partkey", "p_brand", "p_name"],
        ["p_brand"],
        "p_name",
        total="names",
        names={
            (True, None): "returned",
            (False, None): "kept",
            (None, True): "bulk",
            (True, False): "returned_only",
            (True, True): "both",
            (False, False): "neither",
        },
    )


# ---- titles ------------------------------------------------------------------

_TITLE_COLUMNS = {"activity_id": "id", "activity_name": "title", "activity_type_name": "tname", "name_abnormal_type": "klass"}


@entry(
    "name_classification",
    f"""WITH {_TITLES_SQL} SELECT CAST(id AS VARCHAR) AS activity_id, title AS activity_name,
  tname AS activity_type_name, klass AS name_abnormal_type FROM titles""",
)
def _name_classification(t):
    return detail.title_classes(_acts(t)).select(*_TITLE_COLUMNS)


def _title_rows(t: Tables) -> DataFrame:
    """Titles with the suppliers of their lines."""
    lines = t("lineitem").select(F.col("l_orderkey").cast("string").alias("order_id"), "l_suppkey", "l_shipdate")
    return attach(detail.title_classes(_acts(t)), lines, [("activity_id", "order_id")], ["l_suppkey", "l_shipdate"])


@entry(
    "name_report",
    f"""WITH {_TITLES_SQL} SELECT CAST(id AS VARCHAR) AS activity_id, klass AS name_abnormal_type, l_suppkey, l_shipdate
FROM titles LEFT JOIN lineitem ON l_orderkey = id""",
)
def _name_report(t):
    return _title_rows(t).select("activity_id", "name_abnormal_type", "l_suppkey", "l_shipdate")


_IRREGULAR_SQL = f"""{_TITLES_SQL}, irregular AS (
  SELECT hid AS hospital_id, hname AS hospital_name, mid AS major_id, mname AS major_name, m AS month,
    count(DISTINCT id) AS activity_count, count(DISTINCT id) FILTER (klass = 0) AS standard_count,
    count(DISTINCT id) FILTER (klass = 1) AS single_activity_same_type_name_count,
    count(DISTINCT id) FILTER (klass = 2) AS different_activity_same_name_count
  FROM titles WHERE m >= '{CFG.cutoff_month}' GROUP BY 1, 2, 3, 4, 5)"""


def _irregular(t: Tables) -> DataFrame:
    return summary.irregular_titles(CFG, detail.title_classes(_acts(t)))


@entry("name_irregular_counts", f"WITH {_IRREGULAR_SQL} SELECT * FROM irregular")
def _name_irregular_counts(t):
    return _irregular(t)


@entry(
    "class_counts",
    f"""WITH {_TITLES_SQL} SELECT hid AS activity_hospital_id, count(DISTINCT id) AS ids,
  count(DISTINCT id) FILTER (klass = 0) AS regular, count(DISTINCT id) FILTER (klass = 2) AS shared
FROM titles GROUP BY 1""",
)
def _class_counts(t):
    rows = detail.title_classes(_acts(t))
    classes = {"regular": 0, "shared": 2}
    return class_counts(rows, ["activity_hospital_id"], "activity_id", "name_abnormal_type", total="ids", classes=classes)


_SHARES = ("standard_count", "single_activity_same_type_name_count", "different_activity_same_name_count")


@entry(
    "ratio_of_sums",
    f"WITH {_IRREGULAR_SQL} SELECT month, hospital_id, hospital_name, sum(activity_count)::BIGINT AS activity_count, "
    + ", ".join(
        f"sum({c})::BIGINT AS {c}, CAST({ratio(f'sum({c})', 'sum(activity_count)')} * 100 AS VARCHAR) || '%' AS {c}_rate"
        for c in _SHARES
    )
    + " FROM irregular GROUP BY 1, 2, 3",
)
def _ratio_of_sums(t):
    return report.title_quality(_irregular(t))


@entry(
    "ratio_of_sums_tidy",
    f"WITH {_IRREGULAR_SQL} SELECT month, hospital_id, hospital_name, sum(activity_count)::BIGINT AS activity_count, "
    + ", ".join(
        f"sum({c})::BIGINT AS {c}, CAST({ratio(f'(sum({c}) * 100)', 'sum(activity_count)')} AS VARCHAR) || '%' AS {c}_rate"
        for c in _SHARES
    )
    + " FROM irregular GROUP BY 1, 2, 3",
)
def _ratio_of_sums_tidy(t):
    return report.title_quality(_irregular(t), tidy=True)


@entry(
    "ordered_report",
    f"""WITH {_TITLES_SQL} SELECT m AS activity_month, hid AS activity_hospital_id, mid AS activity_major_id,
  CAST(id AS VARCHAR) AS activity_id, title AS activity_name FROM titles WHERE klass = 2
ORDER BY activity_month DESC, activity_hospital_id, activity_major_id, activity_id""",
)
def _ordered_report(t):
    shared = detail.title_classes(_acts(t)).filter("name_abnormal_type = 2")
    return shared.select(
        *("activity_month", "activity_hospital_id", "activity_major_id", "activity_id", "activity_name")
    ).orderBy(F.desc("activity_month"), "activity_hospital_id", "activity_major_id", "activity_id")
