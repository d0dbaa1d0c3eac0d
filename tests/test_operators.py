"""Operators against brute force, NULL keys, hot keys and plan shape."""

import calendar
import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardbook.config import Site, WarehouseConfig
from wardbook.functions import valid_key
from wardbook.operators import (
    abnormal_headcount,
    class_counts,
    classify_names,
    conditional_specialties,
    coverage,
    federate,
    fill_id,
    join_keeping_left,
    joined_distinct,
    lookup_join,
    month_bucket_join,
    month_walk,
    participation_log,
    presence_matrix,
    rank_rate,
    registry_participants,
    rejected_intervals,
    rollup_ratios,
    same_vs_other,
)
from wardbook.operators.sites import Stacked


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- sites -------------------------------------------------------------------


def test_federate_is_insensitive_to_branch_order_and_prunes_by_site(spark):
    a = spark.createDataFrame([(1, "x"), (-1, "y"), (None, "z")], "k int, v string")
    b = spark.createDataFrame([("w", 2)], "v string, k int")
    sites = [(Site(1, "one", "1"), a), (Site(2, "two", "2"), b)]

    def stack(branches):
        return federate(
            branches,
            {"k": F.col("k"), "v": F.upper("v")},
            site_id="sid",
            site_name="sname",
            where=lambda s: valid_key("k"),
        )

    assert rows(stack(sites)) == rows(stack(sites[::-1])) == Counter({(1, "X", 1, "one"): 1, (2, "W", 2, "two"): 1})
    assert "Union" not in plan(stack(sites).filter("sid = 2"))


# ---- joins -------------------------------------------------------------------


def _random_sides(seed):
    rnd = random.Random(seed)
    key = lambda: rnd.choice([None, 1, 2, 3, 4, 5])
    left = [(i, key(), rnd.choice(["a", "b", None])) for i in range(60)]
    right = [(key(), rnd.choice(["a", "b", None]), i, rnd.choice([None, "v"])) for i in range(25)]
    return left, right


@pytest.mark.parametrize("seed", range(3))
def test_join_keeping_left_equals_a_left_join(spark, seed):
    left, right = _random_sides(seed)
    want = Counter()
    for i, k, n in left:
        hits = [(x, y) for rk, rn, x, y in right if rk is not None and rn is not None and (rk, rn) == (k, n)]
        want.update([(i, k, n, *h) for h in hits] or [(i, k, n, None, None)])
    got = join_keeping_left(
        spark.createDataFrame(left, "i int, k int, n string"),
        spark.createDataFrame(right, "rk int, rn string, x int, y string"),
        [("k", "rk"), ("n", "rn")],
        ["x", "y"],
    )
    assert got.columns == ["i", "k", "n", "x", "y"] and rows(got) == want


def test_join_keeping_left_shuffles_the_left_columns_alone_and_once(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.range(0, 400, 1, 4).selectExpr("CAST(id % 9 AS STRING) AS a", "id % 5 AS b", "id AS n")
    right = spark.range(0, 40, 1, 2).selectExpr("CAST(id % 7 AS STRING) AS x", "id % 3 AS y", "id AS m")
    got = join_keeping_left(left, right, [("a", "x"), ("b", "y")], ["m"])
    assert got.count() == left.join(right, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left").count()
    got.collect()
    logical = got._jdf.queryExecution().optimizedPlan().toString()
    assert all("Join" in line for line in logical.splitlines() if "struct(" in line)
    assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()


def test_join_keeping_left_on_one_frame_with_itself(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, None)], "id int, up int")
    got = join_keeping_left(df, df.withColumnRenamed("up", "parent"), [("up", "id")], ["parent"])
    assert rows(got) == Counter({(1, 1, 1): 1, (2, 1, 1): 1, (3, None, None): 1})


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_keys_of_different_types_are_refused(spark, kind):
    """Their hashes would differ although the values are equal."""
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1,)], "id int").select(F.col("id").cast(kind))
    with pytest.raises(TypeError, match="one exact type"):
        join_keeping_left(left, right, [("k", "id")], [])


@pytest.mark.parametrize("hot", ["left", "right"])
def test_hot_key_is_split_on_either_side(spark, conf, hot):
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    }.items():
        conf(key, value)
    big, small = spark.range(0, 60000, 1, 8), spark.range(0, 300, 1, 2)
    keyed = big.select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 4000).alias("k"), F.col("id").alias("v"))
    few = small.select(F.col("id").alias("j"), F.col("id").alias("w"))
    if hot == "left":
        got = join_keeping_left(keyed, few, [("k", "j")], ["w"])
        want = keyed.join(few, F.col("k") == F.col("j"), "left").select("k", "v", "w")
    else:
        got = join_keeping_left(few, keyed, [("j", "k")], ["v"])
        want = few.join(keyed, F.col("k") == F.col("j"), "left").select("j", "w", "v")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    got.collect()
    assert "skew=true" in plan(got).replace("(skew=true)", "skew=true")


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_lookup_join_keeps_rows_without_entry(spark, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    df = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "i int, n string")
    names = spark.createDataFrame([("a", 10), ("b", 20)], "name string, code int")
    got = lookup_join(df, names, [("n", "name")], ["code"])
    assert rows(got) == Counter({(1, "a", 10): 1, (2, "z", None): 1, (3, None, None): 1})


PEOPLE = [(1, "A"), (1, "A"), (1, "B"), (2, "C"), (None, "D")]
TAKES = [(1, "A", "s", 100), (1, "A", "t", 101), (2, "C", "t", 100), (2, "X", "s", 100), (None, "D", "s", 100)]


def test_registry_participants_is_a_distinct_existence_test(spark):
    people = spark.createDataFrame(PEOPLE, "id int, name string")
    takes = spark.createDataFrame(TAKES, "pid int, pname string, role string, act int")
    on = [("id", "pid"), ("name", "pname")]
    got = registry_participants(people, takes, on, role_col="role", role="s")
    naive = (
        people.join(takes, (people.id == takes.pid) & (people.name == takes.pname), "left")
        .filter("pid IS NOT NULL AND role = 's'")
        .select("id", "name")
        .distinct()
    )
    assert rows(got) == rows(naive) == Counter({(1, "A"): 1})


@pytest.mark.parametrize("all_present", [False, True])
def test_participation_log_keeps_both_roles_and_versions_of_an_activity(spark, all_present):
    people = spark.createDataFrame([(1, "A")] + ([] if all_present else [(9, "Z")]), "id int, name string")
    takes = spark.createDataFrame(TAKES, "pid int, pname string, role string, act int")
    acts = spark.createDataFrame([(100, "v1"), (100, "v2")], "act_id int, title string")
    got = participation_log(
        people,
        takes,
        acts,
        person_on=[("id", "pid"), ("name", "pname")],
        participation_cols={"as_role": "role"},
        activity_on=[("act", "act_id")],
        activity_cols=["title"],
        all_present=all_present,
    )
    want = {(1, "A", "s", "v1"): 1, (1, "A", "s", "v2"): 1, (1, "A", "t", None): 1}
    if not all_present:
        want[(9, "Z", None, None)] = 1
    assert rows(got.select("id", "name", "as_role", "title")) == Counter(want)


def test_participation_log_drops_repeated_rows_after_the_join(spark):
    """Equal participations count once, those that differ in a column nobody keeps count apart; NULL is a value."""
    people = spark.createDataFrame([(1, "A", "x"), (1, "A", "y"), (2, None, "x"), (3, "C", "x")], "id int, name string, major string")
    takes = [(1, "A", "s", 0.5, 100), (1, "A", "s", 0.5, 100), (1, "A", "t", 0.5, 100), (1, "A", "s", None, 100), (1, "A", "s", None, 100)]
    takes += [(2, None, "s", 0.5, 100), (8, "Z", "s", 0.5, 100), (3, "C", "s", 0.5, None), (3, "C", "s", 0.5, None)]
    takes = spark.createDataFrame(takes, "pid int, pname string, role string, rate double, act int")
    acts = spark.createDataFrame([(100, "v1"), (100, "v2")], "act_id int, title string")
    options = {
        "person_on": [("id", "pid"), ("name", "pname")],
        "participation_cols": {"score": "rate", "who": "pname"},
        "activity_on": [("act", "act_id")],
        "activity_cols": ["title"],
    }
    for all_present in (True, False):
        got = participation_log(people, takes, acts, repeated=True, all_present=all_present, **options)
        want = participation_log(people, takes.distinct(), acts, all_present=all_present, **options)
        assert got.columns == want.columns and rows(got) == rows(want)
        assert rows(got)[(1, "A", "x", 0.5, "A", "v1")] == 2


def test_fill_id_fans_out_on_namesakes(spark):
    visits = spark.createDataFrame([("Li", 1), ("Wu", 2)], "name string, visit int")
    people = spark.createDataFrame([(7, "Li"), (8, "Li")], "pid int, pname string")
    got = fill_id(visits, people, [("name", "pname")], "pid", "found")
    assert rows(got) == Counter({("Li", 1, 7): 1, ("Li", 1, 8): 1, ("Wu", 2, None): 1})


# ---- month walk --------------------------------------------------------------


def _months_by_stepping(start, end):
    """First month, then one more per whole month that fits, judged day by day."""
    if start is None or end is None or start > end:
        return []
    out, n = [], 0
    while True:
        y, m = divmod(start.month - 1 + n, 12)
        year, month = start.year + y, m + 1
        if n:
            last = calendar.monthrange(year, month)[1]
            start_is_last = start.day == calendar.monthrange(start.year, start.month)[1]
            if (year, month) > (end.year, end.month):
                break
            if (year, month) == (end.year, end.month):
                end_is_last = end.day == last
                if end.day < start.day and not (start_is_last and end_is_last):
                    break
        out.append(f"{year:04d}-{month:02d}")
        n += 1
    return out


CASES = {
    ("2019-01-20", "2019-02-10"): ["2019-01"],
    ("2019-01-31", "2019-02-28"): ["2019-01", "2019-02"],
    ("2019-05-05", "2019-05-05"): ["2019-05"],
    ("2019-01-30", "2019-02-28"): ["2019-01"],
    ("2019-03-02", "2019-03-01"): [],
    ("2019-03-02", None): [],
    (None, "2019-03-02"): [],
}


def test_month_walk_cases(spark):
    day = lambda s: s and dt.datetime.fromisoformat(s)
    spans = [(i, day(a), day(b)) for i, (a, b) in enumerate(CASES)] + [
        (99, dt.datetime(2019, 1, 1), dt.datetime(2021, 1, 1))
    ]
    df = month_walk(spark.createDataFrame(spans, "i int, a timestamp_ntz, b timestamp_ntz"), "a", "b")
    got = {}
    for r in df.collect():
        got.setdefault(r.i, []).append(r.month)
    for i, want in enumerate(CASES.values()):
        assert sorted(got.get(i, [])) == want
    assert len(got[99]) == 25 and max(got[99]) == "2021-01"


def test_month_walk_window_and_rejected_intervals(spark):
    day = lambda s: s and dt.datetime.fromisoformat(s)
    spans = [(1, day("2019-01-01"), day("2021-01-01")), (2, day("2019-05-01"), None), (3, day("2019-05-02"), day("2019-05-01")), (4, None, day("2019-05-01"))]
    df = spark.createDataFrame(spans, "i int, a timestamp_ntz, b timestamp_ntz")
    months = [r.month for r in month_walk(df, "a", "b", max_months=12).collect()]
    assert len(months) == 13 and max(months) == "2020-01"
    assert {r.i for r in rejected_intervals(df, "a", "b").collect()} == {2, 3, 4}


def test_month_walk_equals_stepping_through_the_calendar(spark):
    rnd = random.Random(5)
    base = dt.datetime(2018, 12, 25)
    spans = []
    for i in range(1500):
        start = base + dt.timedelta(days=rnd.randrange(500), hours=rnd.randrange(24))
        spans.append((i, start, start + dt.timedelta(days=rnd.randrange(-5, 430), hours=rnd.randrange(24))))
    df = month_walk(spark.createDataFrame(spans, "i int, a timestamp_ntz, b timestamp_ntz"), "a", "b")
    want = Counter((i, m) for i, a, b in spans for m in _months_by_stepping(a, b))
    assert rows(df.select("i", "month")) == want
    assert "Exchange" not in plan(df)


# ---- counts ------------------------------------------------------------------


def _random_counts(spark, seed):
    rnd = random.Random(seed)
    data = [
        (rnd.choice([1, 2, None]), rnd.choice([None, 1, 2, 3, 4]), rnd.choice([1, 2, None]), rnd.choice([1, 2, None]))
        for _ in range(80)
    ]
    return spark.createDataFrame(data, "g int, id int, a int, b int")


def test_small_groups_are_shuffled_once(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    df = spark.range(0, 300, 1, 4).selectExpr("id % 40 AS g", "CASE WHEN id % 7 > 0 THEN id % 11 END AS id", "id % 3 AS a", "id % 2 AS b")
    counted = {spread: same_vs_other(df, ["g"], "id", [("a", "b")], total="n", same="s", other="o", spread=spread) for spread in (True, False)}
    assert rows(counted[True]) == rows(counted[False])
    assert [plan(counted[s]).count("Exchange hashpartitioning") for s in (True, False)] == [2, 1]


def test_small_groups_keep_the_sessions_partitions(spark):
    """Merged by the bytes of its shuffle, a partition would fill a task's memory."""
    df = spark.range(0, 300, 1, 4).selectExpr("id % 40 AS g", "id % 11 AS id", "id % 3 AS a", "id % 2 AS b")
    got = same_vs_other(df, ["g"], "id", [("a", "b")], total="n", same="s", other="o", spread=False)
    got.collect()
    assert "REPARTITION_BY_NUM" in plan(got) and "REPARTITION_BY_COL" not in plan(got)


def test_month_bucket_join_of_rows_known_to_match(spark):
    rows_ = spark.createDataFrame([("a", "2024-01", 1), ("a", "2024-02", 2), ("a", "2024-01", 1), (None, "2024-01", 3), ("b", None, 4)], "who string, m string, n int")
    log = spark.createDataFrame([("a", "2024-01", 7), ("a", "2024-01", 8), (None, "2024-01", 9), ("b", "2024-01", 6)], "p string, month string, e int")
    on = [("who", "p"), ("m", "month")]
    told = rows_.withColumn("there", F.coalesce((F.col("who") == "a") & (F.col("m") == "2024-01"), F.lit(False)))
    assert rows(month_bucket_join(told, log, on, ["e"], matched="there")) == rows(month_bucket_join(rows_, log, on, ["e"]))


@pytest.mark.parametrize("seed", range(3))
def test_same_vs_other_equals_conditional_distinct_counts(spark, seed):
    df = _random_counts(spark, seed)
    got = same_vs_other(df, ["g"], "id", [("a", "b")], total="n", same="s", other="o")
    naive = df.groupBy("g").agg(
        F.count_distinct("id").alias("n"),
        F.count_distinct(F.when(F.col("a") == F.col("b"), F.col("id"))).alias("s"),
        F.count_distinct(F.when(F.col("a") != F.col("b"), F.col("id"))).alias("o"),
    )
    assert rows(got) == rows(naive)
    assert "Expand" in plan(naive) and "Expand" not in plan(got)


@pytest.mark.parametrize("seed", range(2))
def test_class_counts_and_headcounts(spark, seed):
    df = _random_counts(spark, seed)
    got = class_counts(df, ["g"], "id", "a", total="n", classes={"one": 1, "two": 2})
    heads = abnormal_headcount(df.fillna(0, ["b"]), ["g"], "id", total="n", zero={"none": "b"})
    when = lambda c: F.count_distinct(F.when(c, F.col("id")))
    assert rows(got) == rows(df.groupBy("g").agg(F.count_distinct("id"), when(F.col("a") == 1), when(F.col("a") == 2)))
    assert rows(heads) == rows(df.groupBy("g").agg(F.count_distinct("id"), when(F.col("b").isNull())))


@pytest.mark.parametrize("seed", range(3))
def test_presence_matrix_equals_two_left_joins(spark, seed):
    rnd = random.Random(seed)
    pick = lambda n: [(rnd.choice([1, 2]), rnd.choice([None, "a", "b", "c", "d"])) for _ in range(n)]
    pop = [(*p, rnd.choice([5, 6])) for p in pick(25)]
    first, second = [(*p, rnd.choice([5, 6])) for p in pick(12)], [(*p, rnd.choice([5, 6])) for p in pick(12)]
    make = lambda data: spark.createDataFrame(data, "g int, who string, y int")
    names = {
        (True, None): "ta",
        (False, None): "fa",
        (None, True): "tb",
        (None, False): "fb",
        (True, False): "tf",
        (True, True): "tt",
        (False, False): "ff",
    }
    got = presence_matrix(make(pop), make(first), make(second), ["g", "who", "y"], ["g"], "who", total="n", names=names)
    want = {}
    for g in {p[0] for p in pop}:
        mine = [p for p in set(pop) if p[0] == g]
        known = lambda cond: len({p[1] for p in mine if p[1] is not None and cond(p)})
        has = lambda p, rel: p[1] is not None and p in rel
        want[g] = [known(lambda p: True)] + [
            known(lambda p, a=a, b=b: a in (None, has(p, first)) and b in (None, has(p, second))) for a, b in names
        ]
    assert {r[0]: list(r)[1:] for r in got.collect()} == want
    assert "Join" not in plan(got)


def test_coverage_counts_units_with_an_event(spark):
    df = spark.createDataFrame([(1, "a", 9), (1, "a", None), (1, "b", None), (2, None, 1)], "y int, u string, e int")
    got = coverage(df, ["y"], "u", "e", total="n", covered="c", rate="r")
    assert rows(got) == Counter({(1, 2, 1, "50.0%"): 1, (2, 0, 0, None): 1})


def _outpatient_rows(majors):
    return [(1, "2019-01", m, n, 22, "门诊教学", 2) for m, n in majors]


@pytest.mark.parametrize(
    "majors, total, distinct, gp",
    [
        ([(3, "c"), (5, "e")], 8, 2, 0),
        ([(-1, "未知")], -1, 1, 0),
        ([(18, "全科医学科")], 0, 0, 2),
        ([(18, "other")], 0, 0, 0),
    ],
)
def test_outpatient_spread_as_id_sum_and_as_count(spark, majors, total, distinct, gp):
    schema = (
        "hospital_id int, month string, major_id int, major_name string, activity_type_id int, "
        "activity_type_name string, activity_count bigint"
    )
    df = spark.createDataFrame(_outpatient_rows(majors), schema)
    cfg = WarehouseConfig()
    for corrected, spread in ((False, total), (True, distinct)):
        r = conditional_specialties(df, ["hospital_id", "month"], cfg, corrected=corrected).first()
        assert (r.general_practice_outpatient_count, r.is_general_practice_outpatient) == (gp, int(gp > 0))
        assert r.outpatient_teaching_specialties == spread
        assert r.is_outpatient_teaching_specialties_valid == int(spread >= 2)


def test_joined_distinct_sorts_and_skips_null(spark):
    df = spark.createDataFrame([(1, "2019-03"), (1, "2019-01"), (1, "2019-03"), (1, None), (2, None)], "g int, m string")
    assert rows(joined_distinct(df, ["g"], "m", ";", "l")) == Counter({(1, "2019-01;2019-03"): 1, (2, ""): 1})


def test_rollup_ratios(spark):
    df = spark.createDataFrame([(1, 100, 57), (1, 100, 57), (2, 0, 0)], "g int, n int, x int")
    got = rollup_ratios(df, ["g"], "n", ["x"])
    assert rows(got) == Counter({(1, 200, 114, "56.99999999999999%"): 1, (2, 0, 0, None): 1})


# ---- titles and ranks --------------------------------------------------------

TITLES = [
    ("m1", "x", "t", "1"),
    ("m1", "x", "t", "2"),
    ("m1", "x", "t", "2"),
    ("m2", "x", "t", "3"),
    ("m1", "t", "t", "4"),
    ("m1", "t", "t", "5"),
    ("m1", None, "t", "6"),
    ("m2", None, "t", "7"),
    ("m2", None, "t", "8"),
    (None, "y", "t", "9"),
    (None, "y", "t", "10"),
    ("m3", "z", None, "11"),
    ("m3", "z", None, "11"),
    ("m3", "q", "t", None),
]


def test_classify_names(spark):
    df = spark.createDataFrame(TITLES, "m string, title string, type string, id string")
    got = classify_names(df, ["m", "title", "type"], id_col="id", title="title", type_name="type", alias="k")
    ids = {}
    for m, title, kind, i in TITLES:
        ids.setdefault((m, title, kind), []).append(i)
    want = Counter()
    for (m, title, kind), members in ids.items():
        members = [i for i in members if i is not None]
        klass = 1 if title is not None and title == kind else 2 if len(set(members)) > 1 else 0
        want.update((m, title, kind, i, klass) for i in members)
    assert rows(got) == want
    assert not re.search("collect_list|collect_set|Expand", plan(got))


@pytest.mark.parametrize("where", [None, lambda site: F.col("x") > site.id])
def test_federate_reads_stacked_sites_in_one_pass(spark, where):
    sites = WarehouseConfig().sites
    data = spark.createDataFrame([(n % 5 if n else None, n % 4 or None) for n in range(40)], "no int, x int")
    options = {"columns": {"y": F.col("x") * 10}, "site_id": "sid", "site_name": "sname", "where": where}
    apart = federate([(s, data.filter(F.col("no") == k)) for k, s in enumerate(sites)], **options)
    stacked = federate(Stacked(sites, data, "no"), **options)
    assert stacked.schema.names == apart.schema.names and rows(stacked) == rows(apart)
    assert "Union" in plan(apart) and "Union" not in plan(stacked)


def test_rank_is_best_first_unknown_last_ties_by_key(spark):
    df = spark.createDataFrame(
        [(2019, 1, 1, 2), (2019, 2, 50, 100), (2019, 3, 9, 10), (2019, 4, 1, 0), (2020, 9, 1, 9)],
        "year int, hospital_id int, a int, b int",
    )
    got = rank_rate(df, "a", "b", "year", rate="r", rank="p", tie=["hospital_id"])
    assert {(r.year, r.hospital_id): r.p for r in got.collect()} == {
        (2019, 3): 1,
        (2019, 1): 2,
        (2019, 2): 3,
        (2019, 4): 4,
        (2020, 9): 1,
    }
