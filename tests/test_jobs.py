"""All 28 jobs from catalog tables, against results worked out by hand."""

import inspect
import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import domain
from wardbook.config import WarehouseConfig
from wardbook.plans import JOBS, Warehouse, warehouse as warehouse_module
from wardbook.plans.detail import TITLE_LOG_COLUMNS
from wardbook.sources import INPUTS, OUTPUTS, CatalogSource, FrameSource, conform, publish, standards_dictionary
from wardbook.sources.schemas import schema

CFG = WarehouseConfig()
A, B, C = (s.name for s in CFG.sites)


@pytest.fixture(scope="module")
def published(spark):
    domain.write_inputs(spark, CFG)
    warehouse = Warehouse(spark, CFG, CatalogSource(spark, CFG))
    names = warehouse.publish()
    return lambda key: spark.table(names[key])


def picked(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_every_job_has_a_table_under_its_declared_schema(published):
    for key in JOBS:
        stored, spec = published(key), OUTPUTS[key]
        assert stored.columns == spec.columns
        assert [f.dataType for f in stored.schema] == [f.dataType for f in spec.schema]
        assert all(f.metadata["comment"] for f in stored.schema)


def test_table_and_column_comments_are_in_the_catalog(spark, published):
    db, name = CFG.db("dws"), OUTPUTS["t13"].name
    text = {r.col_name: r for r in spark.sql(f"DESCRIBE TABLE EXTENDED `{db}`.`{name}`").collect()}
    assert text["Comment"].data_type == OUTPUTS["t13"].comment
    assert text["student_count"].comment == "number of student"


def test_t01_dictionary(published):
    t = published("t01")
    assert t.count() == 396 and t.select("major_id").distinct().count() == 33
    assert t.filter("activity_type_id IS NULL").count() == 132
    assert t.filter("standard_count > 0").count() == 144
    assert t.filter("remark IS NOT NULL").count() == 1
    unenforced = t.filter("activity_type_id IS NULL AND standard_count > 0").count()
    assert unenforced == 3
    got = picked(t.filter("major_id = 77 AND standard_count > 0"), "activity_type_name", "standard_count")
    assert got == Counter({("入轮转科室教育", 1): 1, ("临床小讲课", 4): 1, ("教学病例讨论", 1): 1, ("教学阅片", 2): 1, ("其他", 1): 1})


def test_t02_activities(published):
    t = published("t02")
    ids = Counter(r[0] for r in t.select("activity_id").collect())
    kept = {f"130_{i}" for i in (0, *range(2, 8), 9, *range(10, 18))} | {"110_1", "110_20", "110_21", "111_1"}
    assert set(ids) == kept and ids["130_9"] == 2 and ids["130_4"] == 1
    cols = ["activity_name", "activity_type_id", "activity_type_name", "activity_major_id", "activity_major_name"]
    assert picked(t.filter("activity_id = '130_2'"), *cols) == Counter({(' a  b"c ', 4, "教学查房", 1, "内科"): 1})
    assert picked(t.filter("activity_id = '110_1'"), *cols) == Counter(
        {("neither type nor major", -1, "未知", 1, "内科"): 1}
    )
    # Id and name are filled one by one and may end up apart.
    assert picked(t.filter("activity_id = '130_16'"), *cols[3:]) == Counter({(1, "外科"): 1})


def test_t03_t04_cleansed(published):
    t = published("t03")
    assert t.count() == 12 and t.filter("person_id = 60").isEmpty()
    anon = t.filter("person_id = -1")
    assert picked(anon, "person_name", "is_signed", "professional_title") == Counter({("未知", "未知", "未知"): 1})
    files = published("t04")
    assert picked(files, "file_type", "file_url", "file_name") == Counter(
        {("pdf", "http://x/a.pdf", None): 1, ("未知", "", "a"): 1}
    )


def test_t05_t06_students(published):
    people = published("t05")
    assert picked(people, "student_id", "student_name", "student_hospital_id") == Counter(
        {(1, "张一", 130): 1, (2, "李同名", 130): 1, (3, "李同名", 130): 1, (4, "无活动", 130): 1, (7, "陈外", 110): 1}
    )
    log = published("t06")
    # Both roles count, two versions of 130_9 give two rows, an unknown activity gives NULLs.
    assert picked(log, "student_id", "activity_id") == Counter(
        {
            (1, "130_3"): 1,
            (1, "130_4"): 1,
            (1, "130_6"): 1,
            (1, "130_9"): 2,
            (2, "130_3"): 1,
            (3, "130_3"): 1,
            (4, None): 1,
            (7, "110_20"): 1,
        }
    )


def test_t07_t08_teachers(published):
    assert picked(published("t07"), "teacher_id", "teacher_highest_degree", "teacher_id_card") == Counter(
        {(50, "未知", "未知"): 1, (51, "未知", "未知"): 1}
    )
    assert picked(published("t08"), "teacher_id", "activity_id") == Counter(
        {(50, "130_3"): 1, (50, "130_4"): 1, (51, "130_4"): 1}
    )


def test_t09_t10_t15_t16_induction(published):
    assert picked(published("t09"), "admission_year", "admission_hospital_id", "admission_student_count", "activity_id") == (
        Counter({(2019, 130, 4, "130_13"): 1, (2019, 110, 1, None): 1})
    )
    assert picked(published("t10"), "admission_hospital_id", "admission_major_id", "admission_student_count", "activity_id") == (
        Counter({(130, 1, 2, "130_14"): 1, (130, 2, 2, None): 1, (110, 2, 1, None): 1})
    )
    assert picked(published("t15"), *published("t15").columns) == Counter({(2019, 2, 1, "50.0%"): 1})
    cols = ("hospital_id", "major_admitted_count", "major_education_count", "coverage_education")
    assert picked(published("t16"), *cols) == Counter({(130, 2, 1, "50.0%"): 1, (110, 1, 0, "0.0%"): 1})


def test_t11_rotation_months(published):
    t = published("t11")
    months = picked(
        t.select("rotation_student_name", "rotation_office_major_id", "rotation_month", "rotation_hospital_id").distinct(),
        *("rotation_student_name", "rotation_office_major_id", "rotation_month", "rotation_hospital_id"),
    )
    assert {m[2] for m in months if m[0] == "张一" and m[1] == 1} == {"2019-03", "2019-04"}
    assert {m[2] for m in months if m[0] == "张一" and m[1] == 3} == {"2019-01"}
    assert {m[2] for m in months if m[0] == "只轮转"} == {"2019-01", "2019-02"}
    assert len([m for m in months if m[0] == "陈外"]) == 25
    assert {m[3] for m in months if m[0] == "路人"} == {-1}
    # Namesakes: each of two ids meets each of two logs.
    twins = t.filter("rotation_student_name = '李同名'")
    assert picked(twins, "rotation_student_id", "activity_id") == Counter({(2, "130_3"): 2, (3, "130_3"): 2})
    # Activities belong to the month, wherever in it the rotation started.
    mine = t.filter("rotation_student_name = '张一' AND rotation_office_major_id = 1")
    assert picked(mine, "rotation_month", "activity_id", "activity_month") == Counter(
        {("2019-03", "130_3", "2019-03"): 1, ("2019-03", "130_4", "2019-03"): 1, ("2019-04", "130_6", "2019-04"): 1}
    )


def test_t12_titles(published):
    t = published("t12")
    classes = {(r.activity_id, r.activity_name): r.name_abnormal_type for r in t.collect()}
    assert classes[("130_3", "查房A")] == classes[("130_4", "查房A")] == 2
    assert classes[("130_5", "查房A")] == 0 and classes[("130_6", "教学查房")] == 1 and classes[("130_7", None)] == 0
    assert classes[("130_9", "t1")] == classes[("130_9", "t2")] == 0
    assert picked(t.filter("name_abnormal_type = 2"), "activity_id", "teacher_id") == Counter(
        {("130_3", 50): 1, ("130_4", 50): 1, ("130_4", 51): 1}
    )


def test_t13_overview_and_ranks(published):
    t = published("t13")
    cols = [c for c in t.columns if c not in ("hospital_name",)]
    got = {(r.hospital_id, r.year): tuple(r)[2:] for r in t.select(*cols).collect()}
    # 130 in 2019: ids 2-7, 9 (twice), 10-14, 16; 9 counts once as activity, twice in the sum.
    assert got[(130, 2019)] == (13, 140, 2, 5, 7, 1, 7)
    assert got[(110, 2019)] == (3, 18, 1, 0, 1, 1, 1)
    assert got[(111, 2019)] == (1, 3, None, None, None, None, None)
    assert got[(130, 2020)][0] == 1
    assert (130, 2018) not in got
    rank = {r.hospital_id: (r[6], r[7]) for r in published("t22").filter("year = 2019").collect()}
    assert rank == {130: (70.0, 1), 110: (18.0, 2), 111: (None, 3)}
    sign = {r.hospital_id: (r.sign_rate, r.sign_rate_rank) for r in published("t23").filter("year = 2019").collect()}
    assert sign == {130: (0.71, 1), 110: (0.0, 2), 111: (None, 3)}
    rated = {r.hospital_id: (r[5], r[6]) for r in published("t24").filter("year = 2019").collect()}
    assert rated == {110: (1.0, 1), 130: (0.14, 2), 111: (None, 3)}


def test_t14_t25_standards(published):
    t = published("t14")
    got = {
        (r.hospital_id, r.major_id, r.activity_type_id, r.month): (r.activity_count, r.standard_count, r.is_standard)
        for r in t.collect()
    }
    assert got[(130, 1, 4, "2019-03")] == (3, 2, 1)
    assert got[(130, 1, 4, "2019-05")] == (1, 2, 0)
    assert got[(110, 2, 9, "2019-03")] == (1, 4, 0)
    # A type without id has a standard that never applies.
    assert got[(110, 13, -1, "2019-03")] == (1, None, 1)
    assert got[(130, 18, 22, "2019-06")] == (1, None, 1)
    assert picked(published("t25"), "hospital_id", "major_id", "month_list") == Counter(
        {(130, 1, "2019-05"): 1, (110, 2, "2019-03"): 1, (111, 1, "2019-03"): 1}
    )


def test_t17_presence(published):
    cols = [c for c in published("t17").columns if c != "hospital_name"]
    assert picked(published("t17"), *cols) == Counter(
        {
            (130, "2019", 4, 3, 1, 2, 2, 1, 2, 1): 1,
            (110, "2019", 1, 1, 0, 1, 0, 0, 1, 0): 1,
        }
    )


def test_t18_t19_t28_rotation_counts(published):
    t = published("t18")
    got = {
        (r.student_name, r.rotation_office_major_id, r.rotation_month, r.student_id): (
            r.activity_count,
            r.same_major_activity_count,
            r.different_major_activity_count,
        )
        for r in t.collect()
    }
    assert got[("张一", 1, "2019-03", 1)] == (2, 2, 0)
    assert got[("李同名", 2, "2019-03", 2)] == got[("李同名", 2, "2019-03", 3)] == (1, 0, 1)
    assert got[("张一", 3, "2019-01", 1)] == (0, 0, 0)
    assert got[("路人", 1, "2019-03", None)] == (0, 0, 0)
    heads = {(r.hospital_id, r.month): tuple(r)[3:] for r in published("t19").collect()}
    assert heads[(130, "2019-03")] == (2, 0, 1)
    assert heads[(130, "2019-01")] == (2, 2, 2)
    report = published("t28")
    assert picked(report, "rotation_month", "student_name").keys().isdisjoint({("2019-03", "张一"), ("2019-04", "张一")})
    assert report.filter("student_name = '陈外'").count() == 24
    assert report.schema["rotation_start_time"].dataType.simpleString() == "string"


def test_t20_outpatient(published):
    got = {(r.hospital_id, r.month): tuple(r)[3:] for r in published("t20").collect()}
    assert got[(130, "2019-06")] == (1, 1, 8, 1)
    assert got[(130, "2019-03")] == (0, 0, 0, 0)


def test_t21_t26_t27_titles(published):
    t21 = {(r.hospital_id, r.major_id, r.major_name, r.month): tuple(r)[5:] for r in published("t21").collect()}
    assert t21[(130, 1, "内科", "2019-03")] == (3, 1, 0, 2)
    assert t21[(130, 1, "内科", "2019-04")] == (3, 2, 1, 0)
    t26 = {(r.month, r.hospital_id): tuple(r)[3:] for r in published("t26").collect()}
    assert t26[("2019-03", 130)] == (3, 1, "33.0%", 0, "0.0%", 2, "67.0%")
    assert picked(published("t27"), "activity_id", "activity_start_time") == Counter(
        {("130_3", "2019-03-06 00:00:00"): 1, ("130_4", "2019-03-20 00:00:00"): 2}
    )
    assert published("t27").schema["activity_id"].dataType.simpleString() == "string"


# ---- invariants, refresh, other inputs ---------------------------------------


def test_invariants(published):
    r = published("t17")
    bad = r.filter("round_activity_student_count + round_no_activity_student_count < round_student_count")
    assert bad.isEmpty()
    t = published("t21")
    classes = "standard_count + single_activity_same_type_name_count + different_activity_same_name_count"
    assert t.filter(f"{classes} < activity_count").isEmpty()
    c = published("t18")
    assert c.filter("same_major_activity_count + different_major_activity_count > activity_count").isEmpty()


def test_publishing_again_changes_nothing(spark, published):
    before = {k: Counter(map(tuple, published(k).collect())) for k in ("t02", "t06", "t13", "t27")}
    warehouse = Warehouse(spark, CFG, CatalogSource(spark, CFG))
    warehouse.publish(before)
    names = warehouse.publish(before)
    for key, rows in before.items():
        assert Counter(map(tuple, spark.table(names[key]).collect())) == rows


def test_ordered_report_is_stored_in_order(published):
    rows = [(r.month, r.hospital_id, r.major_id, r.activity_id) for r in published("t27").collect()]
    assert rows == sorted(sorted(rows, key=lambda r: r[1:]), key=lambda r: r[0], reverse=True)


def _frames(spark):
    make = lambda entity, data: spark.createDataFrame(data, INPUTS[entity])
    return FrameSource(
        CFG,
        {e: {s: make(e, data) for s, data in by_site.items()} for e, by_site in domain.SITE_ROWS.items()},
        make("admissions", domain.ADMISSIONS),
        make("rotations", domain.ROTATIONS),
        standards_dictionary(spark),
    )


@pytest.mark.parametrize("key", ["t12", "t13", "t18", "t17"])
def test_composed_and_staged_equal_published(spark, published, tmp_path, key):
    want = Counter(map(tuple, published(key).collect()))
    composed = Warehouse(spark, CFG, _frames(spark), from_catalog=False).table(key)
    staged = Warehouse(spark, CFG, _frames(spark), from_catalog=False).staged(key, str(tmp_path))
    assert Counter(map(tuple, composed.collect())) == want
    assert Counter(map(tuple, staged.collect())) == want


@pytest.mark.parametrize(("key", "written"), [("t13", {"t02"}), ("t12", {"t02", "t08"})])
def test_participations_are_not_grouped_and_stored_for_one_job(spark, tmp_path, key, written):
    """Repeated participations are dropped among the rows of the people in question; of t08 t12 stores what it reads."""
    Warehouse(spark, CFG, _frames(spark), from_catalog=False).staged(key, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir()} == {OUTPUTS[k].name for k in written}
    if key == "t12":
        assert set(spark.read.parquet(str(tmp_path / OUTPUTS["t08"].name)).columns) == set(TITLE_LOG_COLUMNS)


def test_reads_name_every_upstream_table():
    """What a job's build function asks for is what it declares to read (the dictionary aside)."""
    text = inspect.getsource(warehouse_module).split("JOBS = {")[1]
    for part in re.split(r"\bJob\(", text)[1:]:
        key, *asked = re.findall(r'^\s*"(t\d\d)"|w\.table\("(t\d\d)"\)', part)
        assert {t for _, t in asked} - {"t01"} == set(JOBS[key[0]].reads), key


def test_no_frame_widens_silently(spark):
    bad = spark.createDataFrame([(1, "x")], "trainid long, filetype string")
    frames = _frames(spark)
    broken = FrameSource(CFG, {**frames.site_frames, "file": {s.id: bad for s in CFG.sites}}, None, None, None)
    with pytest.raises(ValueError, match="url"):
        Warehouse(spark, CFG, broken, from_catalog=False).table("t04")


def test_conform_orders_casts_and_rejects_what_does_not_fit(spark):
    df = spark.range(1).select(F.lit(5).alias("b"), F.lit(2019).alias("a"), F.lit(1).alias("extra"))
    got = conform(df, schema("a string, b int"))
    assert got.columns == ["a", "b"] and tuple(got.first()) == ("2019", 5)
    with pytest.raises(Exception, match="(?i)overflow|CAST"):
        conform(spark.range(1).select(F.lit(2**40).alias("b")), schema("b int")).collect()


def test_a_layer_reads_the_tables_that_are_stored(spark, published, tmp_path):
    published("t13")
    again = Warehouse(spark, CFG, FrameSource(CFG, {}, None, None, None))  # nothing but the catalog to read
    assert set(again.publish(["t22"])) >= {"t22"}
    plan = again.table("t22")._jdf.queryExecution().optimizedPlan().toString()
    assert OUTPUTS["t22"].name in plan
    built = JOBS["t22"].build(again)._jdf.queryExecution().optimizedPlan().toString()
    assert OUTPUTS["t13"].name in built and OUTPUTS["t06"].name not in built


def test_a_failed_job_leaves_the_old_table(spark, tmp_path):
    spec = replace(OUTPUTS["t13"], name="kept_when_failing", schema=schema("a int"))
    for location in (None, str(tmp_path)):
        db = "wardbook_keep" + ("_external" if location else "")
        for n in (1, 2):
            name = publish(spark.range(n).select(F.col("id").cast("int").alias("a")), spec, db, location=location)
        with pytest.raises(Exception, match="(?i)overflow"):
            publish(spark.range(3).select((F.col("id") + 2**40).alias("a")), spec, db, location=location)
        assert spark.table(name).count() == 2
    versions = [p for p in (tmp_path / "wardbook_keep_external" / spec.name).iterdir()]
    assert len([p for p in versions if list(p.glob("_SUCCESS"))]) == 1


def test_coded_columns_say_what_their_codes_mean(spark, published):
    db, name = CFG.db("dwd"), OUTPUTS["t12"].name
    text = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE `{db}`.`{name}`").collect()}
    assert all(f"{code} =" in text["name_abnormal_type"] for code in (0, 1, 2))
