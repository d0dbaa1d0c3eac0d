"""The driver's tables shaped as the warehouse's inputs.

Every row of ``orders`` becomes a sheet row, every ``lineitem`` row a participation and
a rotation, every ``part`` a student and an admission, every ``supplier`` a teacher at
each site, every ``page`` an attachment. Which values are missing, dirty or special is
decided by column values, so that all branches of the jobs are met.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace
from functools import cache
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardbook.config import Kind, Site, WarehouseConfig
from wardbook.operators.sites import Stacked
from wardbook.plans import Warehouse
from wardbook.sources.inputs import checked

Tables = Callable[[str], DataFrame]

CFG = replace(
    WarehouseConfig(),
    cutoff_year=1997,
    hospital_induction=Kind(14, "HOSPITAL INDUCTION"),
    specialty_induction=Kind(15, "SPECIALTY INDUCTION"),
    general_practice=Kind(18, "NATION_18"),
    outpatient=Kind(4, "NOT SPECIFIED"),
)

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


# Columns of the driver's tables; stating them spares a schema-inference job per read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The application's folder for intermediate tables of one query over one set of inputs.

    Below ``spark.checkpoint.dir``, or where that is unset below the warehouse folder,
    which is shared wherever the catalog is. A repeated query writes the same folder again,
    so folders do not pile up.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/wardbook/{spark.sparkContext.applicationId}/{name}-{crc32(sf_dir.encode()):08x}"


def _pick(site_no: Column, values: list) -> Column:
    """k-th value for k = 0, 1, 2."""
    return F.when(site_no == 0, values[0]).when(site_no == 1, values[1]).otherwise(values[2])


def _student_name(part_key: str) -> Column:
    return F.concat(F.lit("Student#"), F.floor(F.col(part_key) / 150).cast("string"))


def _supplier_name(key: str) -> Column:
    return F.concat(F.lit("Supplier#"), F.lpad(F.col(key).cast("string"), 9, "0"))


def sheets(tables: Tables) -> DataFrame:
    orders, customer, nation, region, part, lineitem = (
        tables(t) for t in ("orders", "customer", "nation", "region", "part", "lineitem")
    )
    lines = lineitem.groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    price, status, label = F.col("o_totalprice"), F.col("o_orderstatus"), F.substring("o_orderpriority", 3, 100)
    no_type = (status == "P") & price.between(20000, 30000)
    # Orders meet their lines while they are narrow, then customers and parts, both by one key.
    where = F.broadcast(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    placed = (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(part, F.col("o_custkey") == F.col("p_partkey"), "left")
        .join(where, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return placed.select(
        (F.col("o_orderkey") % 3).alias("site_no"),
        F.when(price < 2000, None).when(price < 4000, -F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("trainid"),
        F.when((status == "O") & (price < 60000), label)
        .when(price > 480000, None)
        .when(status == "F", F.col("p_type"))
        .otherwise(F.col("p_name"))
        .alias("title"),
        F.when(price >= 498000, 14)
        .when(price < 20000, 15)
        .when(no_type, None)
        .otherwise(F.substring("o_orderpriority", 1, 1).cast("int"))
        .alias("spt_traintype_id"),
        F.when(price >= 498000, CFG.hospital_induction.name)
        .when(price < 20000, CFG.specialty_induction.name)
        .when(no_type, None)
        .when(status == "F", F.concat(F.lit('" '), label, F.lit("\r\n")))
        .otherwise(label)
        .alias("spt_traintype_name"),
        F.when(status != "P", F.col("c_nationkey")).alias("spt_major_id"),
        F.when((status != "P") & ~price.between(300000, 310000), F.col("n_name")).alias("spt_major_name"),
        F.when(price > 400000, F.col("r_name")).otherwise(F.col("n_name")).alias("officename"),
        F.col("o_orderdate").alias("starttime"),
        (F.col("o_orderdate") + F.expr("INTERVAL 90 MINUTES")).alias("endtime"),
        F.lit(90).alias("teaching_activity_duration"),
        F.col("lines").alias("participant_count"),
    )


def persons(tables: Tables) -> DataFrame:
    teaches = F.col("l_returnflag") == "R"
    return tables("lineitem").select(
        (F.col("l_orderkey") % 3).alias("site_no"),
        F.col("l_orderkey").alias("trainid"),
        F.when(teaches, F.col("l_suppkey")).otherwise(F.col("l_partkey")).alias("personid"),
        F.when(teaches, _supplier_name("l_suppkey")).otherwise(_student_name("l_partkey")).alias("personname"),
        F.when(teaches, CFG.teacher_role).otherwise(CFG.student_role).alias("persontype"),
        F.col("l_linestatus").alias("professionaltitle"),
        F.when(F.col("l_tax") > 0.02, 1 - F.col("l_discount")).alias("evalua_score_rate"),
        F.when(F.col("l_discount") == 0, None)
        .when(F.col("l_linestatus") == "F", CFG.signed_text)
        .otherwise("未签到")
        .alias("is_sign"),
    )


def files(tables: Tables) -> DataFrame:
    return tables("pages").select(
        (F.col("page_id") % 3).alias("site_no"),
        F.col("page_id").alias("trainid"),
        F.substring_index("url", "://", 1).alias("filetype"),
        "url",
        F.substring_index("url", "/", -1).alias("reffilename"),
    )


def _parts(tables: Tables) -> DataFrame:
    part, nation = tables("part"), tables("nation")
    return part.join(nation, F.col("p_partkey") % 25 == F.col("n_nationkey")).withColumn(
        "site_no", F.col("p_partkey") % 3
    )


def _grade(size: str = "p_size") -> Column:
    return 1995 + F.col(size) % 6


def students(tables: Tables) -> DataFrame:
    known = F.col("p_size") <= 45
    return _parts(tables).select(
        "site_no",
        F.col("p_partkey").alias("personid"),
        F.when(F.col("p_size") <= 5, F.col("p_name")).otherwise(_student_name("p_partkey")).alias("personname"),
        F.when(known, F.col("n_nationkey")).alias("spt_major_id"),
        F.when(known, F.col("n_name")).alias("spt_major_name"),
        _grade().alias("gradeyear"),
        F.col("p_brand").alias("value"),
    )


def teachers(tables: Tables) -> DataFrame:
    supplier, nation = tables("supplier"), tables("nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("personid"),
        F.col("s_name").alias("personname"),
        F.col("n_name").alias("spt_major_name"),
        F.concat(F.lit("Office "), F.col("n_name")).alias("name"),
        F.when(F.col("s_acctbal") > 5000, "senior").otherwise(" ").alias("professionaltitle"),
        F.when(F.col("s_acctbal") > 0, "MD").alias("academicdegree"),
        F.lit(None).cast("string").alias("highestdegree"),
        F.when(F.col("s_acctbal") > 0, F.expr("TIMESTAMP_NTZ '2010-05-01 00:00:00'")).alias("promotiontime"),
        F.concat(F.lit("555-"), F.col("s_suppkey").cast("string")).alias("phoneno"),
        F.lit(None).cast("string").alias("identificationcard"),
        F.when(F.col("n_nationkey") == 18, "Y").alias("isgeneralfillingdepartment"),
    )


def admissions(tables: Tables) -> DataFrame:
    site = F.col("site_no")
    return _parts(tables).select(
        _grade().alias("admission_year"),
        _pick(site, [s.id for s in CFG.sites]).alias("training_base_id"),
        _pick(site, [s.name for s in CFG.sites]).alias("training_base"),
        F.col("n_nationkey").alias("specialty_base_id"),
        F.col("n_name").alias("specialty_base"),
        F.col("p_partkey").alias("student_id"),
        _student_name("p_partkey").alias("student_name"),
    )


def rotations(tables: Tables) -> DataFrame:
    lineitem, part = tables("lineitem"), tables("part").select("p_partkey", "p_size")
    nation = tables("nation")
    own = nation.select(F.col("n_nationkey").alias("own_id"), F.col("n_name").alias("own_name"))
    office = nation.select(F.col("n_nationkey").alias("office_id"), F.col("n_name").alias("office_name"))
    days = (
        F.when(F.col("l_discount") == 0.1, None)
        .when(F.col("l_discount") == 0.09, -8)
        .when(F.col("l_quantity") == 50, 800)
        .otherwise(F.col("l_quantity").cast("int"))
    )
    return (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(own, F.col("l_partkey") % 25 == F.col("own_id"))
        .join(office, F.col("l_suppkey") % 25 == F.col("office_id"))
        .withColumn("days", days)
        .select(
            _student_name("l_partkey").alias("personname"),
            F.when(F.col("l_tax") == 0.08, "elsewhere")
            .otherwise(_pick(F.col("l_partkey") % 3, [s.rotation_alias for s in CFG.sites]))
            .alias("hospital"),
            F.col("own_id").alias("spt_major_id"),
            F.col("own_name").alias("spt_major_name"),
            _grade().alias("gradeyear"),
            F.concat(F.lit("Office "), F.col("office_name")).alias("officename"),
            F.col("office_id").alias("office_major_id"),
            F.col("office_name").alias("office_major_name"),
            F.col("l_linestatus").alias("outlinename"),
            F.col("l_shipdate").alias("starttime"),
            F.expr("timestampadd(DAY, days, l_shipdate)").alias("endtime"),
            _supplier_name("l_suppkey").alias("teachername"),
            F.col("office_id").alias("teacher_major_id"),
            F.col("office_name").alias("teacher_major_name"),
            F.col("l_quantity").alias("finishskillscore"),
        )
    )


def standards(tables: Tables) -> DataFrame:
    """Nations with customers × order priorities, some without a type id."""
    customer, nation = tables("customer"), tables("nation")
    used = nation.join(customer, F.col("n_nationkey") == F.col("c_nationkey"), "left_semi")
    return used.withColumn("p", F.explode(F.array(*[F.lit(p) for p in PRIORITIES]))).select(
        F.col("n_nationkey").alias("major_id"),
        F.col("n_name").alias("major_name"),
        F.when(F.col("n_nationkey") % 6 != 5, F.substring("p", 1, 1).cast("int")).alias("activity_type_id"),
        F.substring("p", 3, 100).alias("activity_type_name"),
        (F.col("n_nationkey") % 4).alias("standard_count"),
        F.when(F.col("n_nationkey") == 0, "first").alias("remark"),
    )


_ENTITIES = {"sheet": sheets, "person": persons, "file": files, "student": students, "teacher": teachers}
# Shaped row by row from one table: read from there, not written anew.
_PLAIN = {"person", "file"}


class DriverSource:
    """Inputs made from the driver's tables, each only when a job asks for it.

    What is shaped by joins is written once below ``folder``, by site. Jobs read the sites'
    rows of an entity in one pass.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str, cfg: WarehouseConfig = CFG):
        self.cfg = cfg
        self.tables: Tables = cache(lambda name: read(spark, sf_dir, name))
        self.shaped = cache(lambda entity: self._shaped(entity, f"{folder}/in-{entity}"))

    def _shaped(self, entity: str, path: str) -> DataFrame:
        rows = _ENTITIES[entity](self.tables)
        return rows if entity in _PLAIN else self._stored(rows, path)

    def _stored(self, rows: DataFrame, path: str) -> DataFrame:
        if "site_no" in rows.columns:
            rows.write.mode("overwrite").partitionBy("site_no").parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def sites(self, entity: str) -> Iterator[tuple[Site, DataFrame]]:
        rows = self.shaped(entity)
        for no, site in enumerate(self.cfg.sites):
            yield site, checked(rows.filter(F.col("site_no") == no) if "site_no" in rows.columns else rows, entity)

    def stacked(self, entity: str) -> Stacked | None:
        """All sites' rows in one relation, where a row is of one site."""
        rows = self.shaped(entity)
        if "site_no" not in rows.columns:
            return None
        return Stacked(self.cfg.sites, checked(rows, entity, "site_no"), "site_no")

    def admissions(self) -> DataFrame:
        return admissions(self.tables)

    def rotations(self) -> DataFrame:
        return rotations(self.tables)

    def standards(self) -> DataFrame:
        return standards(self.tables)


def warehouse(spark: SparkSession, sf_dir: str, folder: str, cfg: WarehouseConfig = CFG) -> Warehouse:
    """A warehouse over the driver's tables; tables that other runs published are not its own."""
    return Warehouse(spark, cfg, DriverSource(spark, sf_dir, folder, cfg), from_catalog=False)
