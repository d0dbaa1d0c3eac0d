"""Tables by year, rejected rows, drifting sites, pseudonyms and near titles against plain Python."""

import hashlib
import hmac
import random
from collections import Counter
from dataclasses import replace
from datetime import datetime

import domain
import pytest
from pyspark.sql import functions as F, types as T

from wardbook.config import Site, WarehouseConfig
from wardbook.functions.pseudonyms import field_key, pseudonym
from wardbook.operators.titles import bigrams, near_titles, title_index, words
from wardbook.plans import Warehouse, detail, incremental
from wardbook.plans.incremental import refresh_years
from wardbook.sources import INPUTS, OUTPUTS, FrameSource, TableSpec, standards_dictionary
from wardbook.sources.audit import audit
from wardbook.sources.drift import harmonise, widest
from wardbook.sources.partitioned import YEAR, by_year_name, changed_years, digests, publish_by_year, read_since, refresh_changed
from wardbook.sources.schemas import schema

SPEC = TableSpec("dwd", "kept", schema("id bigint, at timestamp_ntz, note string"), "Notes by year")


def notes(spark, rows):
    made = [(i, None if y is None else datetime(y, 3, 1 + i % 20), n) for i, y, n in rows]
    return spark.createDataFrame(made, "id bigint, at timestamp_ntz, note string")


def files_by_year(df):
    found = df.select(F.col("_metadata.file_path").alias("f"), F.col(YEAR).alias("y")).distinct().collect()
    return {r.y: {x.f for x in found if x.y == r.y} for r in found}


ROWS = [(i, (2019, 2020, 2021, None)[i % 4], f"n{i % 3}") for i in range(40)] + [(0, 2019, "n0")]


@pytest.fixture
def kept(spark, tmp_path, request):
    db = "wardbook_" + "".join(c if c.isalnum() else "_" for c in request.node.name).strip("_").lower()
    where = {"time_col": "at", "location": str(tmp_path)}
    publish_by_year(notes(spark, ROWS), SPEC, db, **where)
    return db, where


def contents(df):
    return Counter((r.id, None if r.at is None else r.at.year, r.note) for r in df.collect())


def test_a_year_is_replaced_and_others_stay_untouched(spark, kept):
    db, where = kept
    before = files_by_year(spark.table(by_year_name(SPEC, db)))
    assert set(before) == {2019, 2020, 2021, None}
    changed = [(i, y, "new") for i, y, n in ROWS if y == 2020] + [(1000, 2022, "x"), (1001, None, "lost")]
    view = publish_by_year(notes(spark, changed), SPEC, db, years=[2020, 2021], **where)
    after = files_by_year(spark.table(by_year_name(SPEC, db)))
    assert set(after) == {2019, 2020, None}  # 2021 has no rows any more, 2022 was not asked for
    assert after[2019] == before[2019] and after[None] == before[None] and after[2020].isdisjoint(before[2020])
    want = Counter(r for r in ROWS if r[1] in (2019, None)) + Counter((i, y, n) for i, y, n in changed if y == 2020)
    assert contents(spark.table(view)) == want
    assert spark.table(view).columns == SPEC.schema.names
    publish_by_year(notes(spark, [(5, None, "only")]), SPEC, db, years=[None], **where)
    assert contents(spark.table(view).filter("at IS NULL")) == Counter([(5, None, "only")])


def test_earlier_years_are_not_read(spark, kept):
    db, where = kept
    since = read_since(spark, SPEC, db, time_col="at", year=2020)
    assert contents(since) == Counter(r for r in ROWS if r[1] in (2020, 2021))
    plan = since._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({YEAR}" in plan and "2020" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_only_changed_years_are_written(spark, kept):
    db, where = kept
    before = files_by_year(spark.table(by_year_name(SPEC, db)))
    assert refresh_changed(notes(spark, ROWS[::-1]), SPEC, db, **where) == []
    assert files_by_year(spark.table(by_year_name(SPEC, db))) == before
    edited = [(i, y, "edited" if i == 5 else n) for i, y, n in ROWS if y != 2021 and i != 8] + [(2000, 2025, "added")]
    assert sorted(changed_years(notes(spark, edited), SPEC, db, time_col="at")) == [2019, 2020, 2021, 2025]
    assert sorted(refresh_changed(notes(spark, edited), SPEC, db, **where)) == [2019, 2020, 2021, 2025]
    assert contents(spark.table(f"{db}.kept")) == Counter(edited)
    after = files_by_year(spark.table(by_year_name(SPEC, db)))
    assert after[None] == before[None] and set(after) == {2019, 2020, 2025, None}


def test_digests_tell_nulls_and_copies_apart(spark):
    def digest(rows):
        return {tuple(r)[1:] for r in digests(spark.createDataFrame(rows, "k int, a string, b string"), ["k"]).collect()}

    same = digest([(1, "x", None), (1, None, "x")])
    assert same == digest([(1, None, "x"), (1, "x", None)])
    for other in ([(1, "x", None)] * 2, [(1, "x", None)], [(1, "x", None), (1, None, "x"), (1, "x", None)], [(1, "x", "x"), (1, None, None)]):
        assert digest(other) != same


def test_first_refresh_creates_the_table(spark, tmp_path):
    db = "wardbook_first_refresh"
    assert sorted(refresh_changed(notes(spark, ROWS[:3]), SPEC, db, time_col="at", location=str(tmp_path))) == [2019, 2020, 2021]
    assert contents(spark.table(f"{db}.kept")) == Counter(ROWS[:3])
    assert refresh_changed(notes(spark, []), SPEC, db, time_col="at", location=str(tmp_path)) != []
    assert spark.table(f"{db}.kept").count() == 0


# ---- rejected rows ----


def test_audit_counts_in_the_pass_that_writes(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", "5", 2), ("-1", "5", 2), (None, "x", 2), ("3", None, None), ("9" * 30, "7", 1), ("4", "2", 0)], "id string, n string, m int"
    )
    seen = spark.sparkContext.accumulator(0)
    declared = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType())])
    rules = {"id": F.expr("try_cast(id AS BIGINT) >= 0"), "m": F.col("m") > 0}
    done = audit(raw, declared, rules, str(tmp_path / "audit"))
    assert done.counts == {"rows": 6, "rejected": 5, "id": 3, "m": 2, "type of id": 1, "type of n": 1}
    assert [tuple(r) for r in done.accepted.collect()] == [(1, 5)] and done.accepted.schema["n"].dataType == T.IntegerType()
    reasons = Counter(tuple(r.reasons) for r in done.rejected.collect())
    assert reasons == Counter({("id",): 1, ("id", "type of n"): 1, ("m",): 2, ("id", "type of id"): 1})
    assert any('"9999' in r.raw for r in done.rejected.collect())
    plan = done.rejected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in plan
    none = audit(raw.limit(0), declared, rules, str(tmp_path / "none"))
    assert none.counts["rows"] == 0 and none.accepted.count() == none.rejected.count() == 0
    assert seen.value == 0


# ---- sites whose schemas differ ----


def test_harmonise(spark):
    sites = [Site(n, f"site {n}", "") for n in (1, 2, 3)]
    frames = [
        spark.createDataFrame([(1, "a")], "id int, state string"),
        spark.createDataFrame([(2**40, 7, 1.5)], "nr bigint, state int, extra double"),
        spark.createDataFrame([(3, datetime(2024, 1, 1))], "id smallint, seen timestamp_ntz"),
    ]
    declared = schema("id int, state string, seen timestamp_ntz")
    same, report = harmonise(list(zip(sites, frames)), declared, renames={2: {"nr": "id"}}, required=["id"])
    assert {str(df.schema.simpleString()) for _, df in same} == {"struct<id:bigint,state:string,seen:timestamp_ntz>"}
    assert [tuple(r) for _, df in same for r in df.collect()] == [(1, "a", None), (2**40, "7", None), (3, None, datetime(2024, 1, 1))]
    assert Counter(map(tuple, report.collect())) == Counter(
        [
            (1, "seen", "missing", None, "timestamp_ntz"),
            (2, "id", "renamed", "nr", "id"),
            (2, "id", "widened", "bigint", "bigint"),
            (2, "state", "cast", "int", "string"),
            (2, "seen", "missing", None, "timestamp_ntz"),
            (2, "extra", "undeclared", "double", None),
            (3, "id", "widened", "smallint", "bigint"),
            (3, "state", "missing", None, "string"),
        ]
    )
    with pytest.raises(ValueError, match="site 3 lacks columns"):
        harmonise(list(zip(sites, frames)), declared, renames={2: {"nr": "id"}}, required=["id", "state"])


@pytest.mark.parametrize(
    "types,want",
    [("int bigint", "bigint"), ("int double", "double"), ("bigint double", "string"), ("float double", "double"), ("date timestamp_ntz", "timestamp_ntz"),
     ("boolean int", "string"), ("smallint tinyint", "smallint"), ("int string", "string"), ("bigint decimal(38,10)", "decimal(38,10)"), ("binary int", "string")],
)
def test_widest(spark, types, want):
    given = [T._parse_datatype_string(t) for t in types.split()]
    assert widest(given).simpleString() == widest(given[::-1]).simpleString() == want


# ---- personal data ----


def test_pseudonym_is_hmac(spark):
    key = b"k" * 80
    texts = ["", "555-1", "电话 123", "x" * 500, None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", pseudonym(F.col("t"), key, "phone").alias("p"), pseudonym(F.col("t"), key, "card").alias("c"))
    for r in rows.collect():
        want = None if r.t is None else hmac.new(field_key(key, "phone"), r.t.encode(), hashlib.sha256).hexdigest()
        assert r.p == want and (r.t is None or r.c != r.p)


def test_no_personal_data_in_tables_of_a_deployment_with_a_key(spark):
    make = lambda entity, data: spark.createDataFrame(data, INPUTS[entity])
    raw = {str(r[c]) for site in domain.SITE_ROWS["teacher"].values() for r in make("teacher", site).collect() for c in ("phoneno", "identificationcard") if r[c]}
    assert raw
    out = {}
    for key in (None, b"secret"):
        cfg = replace(WarehouseConfig(), pseudonym_key=key)
        source = FrameSource(cfg, {e: {s: make(e, d) for s, d in by.items()} for e, by in domain.SITE_ROWS.items()}, None, None, None)
        persons = detail.participation(cfg, source)
        out[key] = detail.teachers(cfg, source, persons).collect()
    plain, hidden = (sorted(rows, key=lambda r: (r.teacher_id, r.teacher_hospital_id)) for rows in out.values())
    personal = ("teacher_phone", "teacher_id_card")
    assert [[r[c] for c in r.__fields__ if c not in personal] for r in plain] == [[r[c] for c in r.__fields__ if c not in personal] for r in hidden]
    assert not {str(v).strip() for r in hidden for v in r} & {v.strip() for v in raw}
    for a, b in zip(plain, hidden):
        for c in personal:
            assert (a[c] == "未知") == (b[c] == "未知") and (a[c] == "未知" or len(b[c]) == 64)
    assert "secret" not in repr(replace(WarehouseConfig(), pseudonym_key=b"secret"))


# ---- near titles ----


def near_by_hand(rows, percent, tokens):
    found = Counter()
    known = sorted({(g, t) for g, t in rows if g is not None and t is not None})
    for g, a in known:
        for h, b in known:
            x, y = set(tokens(a)), set(tokens(b))
            if g == h and a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                found[g, a, b, len(x & y), len(x | y)] += 1
    return found


def py_bigrams(t):
    t = "".join(t.lower().split())
    return [t[i : i + 2] for i in range(len(t) - 1)] if len(t) > 1 else [t] if t else []


@pytest.mark.parametrize("percent", [30, 75, 100])
@pytest.mark.parametrize("kind", ["words", "bigrams"])
def test_near_titles_equal_brute_force(spark, percent, kind):
    rng = random.Random(percent)
    titles = [" ".join(rng.choice(["ward", "Round", "skin", "case", "the", "of", "查房", "教学"]) for _ in range(rng.randrange(0, 7))) for _ in range(90)]
    rows = [(rng.choice(["a", "b", None]), rng.choice([t, t.upper(), None])) for t in titles] + [("a", ""), ("a", "  "), ("a", "x"), ("a", "X")]
    df = spark.createDataFrame(rows + rows[:10], "g string, title string")
    own = {"words": lambda t: t.lower().split(), "bigrams": py_bigrams}[kind]
    got = near_titles(df, ["g"], "title", percent=percent, tokens={"words": words, "bigrams": bigrams}[kind])
    assert Counter(map(tuple, got.collect())) == near_by_hand(rows, percent, own)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_titles_that_share_a_hot_word(spark, conf):
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    }.items():
        conf(key, value)
    # A third of all titles share a word that is rarer than any other of theirs.
    n = F.col("id")
    title = F.when(n % 3 == 0, F.concat(F.lit("hot "), n.cast("string"))).otherwise(F.concat_ws(" ", (n % 4000).cast("string"), n.cast("string")))
    df = spark.range(0, 3000, 1, 8).select(F.lit("g").alias("g"), title.alias("title"))
    got = near_titles(df, ["g"], "title", percent=90)
    assert got.count() == 0
    loose = near_titles(df.filter("title LIKE 'hot%'"), ["g"], "title", percent=33)
    assert loose.count() == 1000 * 999 // 2


@pytest.mark.parametrize("percent", [60, 75, 80, 90])
def test_near_titles_of_all_lengths_equal_brute_force(spark, percent):
    rng = random.Random(percent)
    rows = []
    for size in range(1, 27):
        base = rng.sample(range(40), size)
        for _ in range(4):
            kept = [w for w in base if rng.random() > 0.1 - percent / 1000] + rng.sample(range(40, 44), rng.randrange(2))
            rows.append(("a", " ".join(f"w{w}" for w in kept)))
    got = near_titles(spark.createDataFrame(rows, "g string, title string"), ["g"], "title", percent=percent)
    want = near_by_hand(rows, percent, str.split)
    assert len(want) > 10 and Counter(map(tuple, got.collect())) == want


def test_titles_of_few_common_words_are_compared_with_near_ones_only(spark):
    """Every word is common, and hardly any pair that shares the rarest ones is near."""
    colour, kind, size, brand, place = (F.floor(F.col("id") / step) % of for step, of in ((1, 8), (8, 8), (64, 4), (256, 10), (2560, 2)))
    titles = spark.range(5120).select(F.lit("g").alias("g"), F.concat_ws(" ", *[F.concat(F.lit(w), c) for w, c in zip("abcde", (colour, kind, size, brand, place))], F.lit("of"), F.lit("size")).alias("title"))
    got = near_titles(titles, ["g"], "title", percent=75)
    assert got.count() == 5120 * (7 + 7 + 3 + 9 + 1) // 2
    index = title_index(titles, ["g"], "title", percent=75, tokens=words)
    assert index.groupBy("_depth", "_token").count().agg(F.max("count")).first()[0] <= 16


# ---- jobs year by year ----


def test_jobs_are_refreshed_for_changed_years_only(spark, tmp_path):
    make = lambda entity, data: spark.createDataFrame(data, INPUTS[entity])
    frames = {e: {s: make(e, d) for s, d in by.items()} for e, by in domain.SITE_ROWS.items()}
    databases = {layer: f"wardbook_yearly_{layer}" for layer in ("ods", "dim", "dwd", "dws", "ads")}
    cfg = replace(WarehouseConfig(), databases=databases, location=str(tmp_path))

    def warehouse(sheets):
        source = FrameSource(cfg, {**frames, "sheet": sheets}, make("admissions", domain.ADMISSIONS), make("rotations", domain.ROTATIONS), standards_dictionary(spark))
        return Warehouse(spark, cfg, source, from_catalog=False)

    first = sorted(refresh_years(warehouse(frames["sheet"])), key=str)
    assert 2019 in first and 2020 in first
    assert refresh_years(warehouse(frames["sheet"])) == []
    spec, db = OUTPUTS["t14"], databases["dws"]
    before = files_by_year(spark.table(by_year_name(spec, db)))
    gone = F.coalesce((F.year("starttime") == 2020) & (F.col("trainid") % 2 == 1), F.lit(False))
    edited = {s: df.filter(~gone) for s, df in frames["sheet"].items()}
    assert refresh_years(warehouse(edited)) == [2020]
    after = files_by_year(spark.table(by_year_name(spec, db)))
    assert before[2019] == after[2019]
    assert before.get(2020) != after.get(2020)
    full = warehouse(edited)
    for key in ("t13", "t14", "t20", "t22", "t23", "t24"):
        own = OUTPUTS[key]
        assert Counter(map(tuple, spark.table(f"{databases[own.layer]}.{own.name}").collect())) == Counter(map(tuple, full.table(key).collect())), key
    with pytest.raises(ValueError, match="t25"):
        refresh_years(full, ["t14", "t25"])


def test_jobs_of_a_refresh_read_what_it_has_stored(spark, tmp_path, monkeypatch):
    """t22 follows from t13: its years are read from there, the log is not composed anew for each of them."""
    make = lambda entity, data: spark.createDataFrame(data, INPUTS[entity])
    frames = {e: {s: make(e, d) for s, d in by.items()} for e, by in domain.SITE_ROWS.items()}
    databases = {layer: f"wardbook_reread_{layer}" for layer in ("ods", "dim", "dwd", "dws", "ads")}
    cfg = replace(WarehouseConfig(), databases=databases, location=f"{tmp_path}/tables")
    source = FrameSource(cfg, frames, make("admissions", domain.ADMISSIONS), make("rotations", domain.ROTATIONS), standards_dictionary(spark))
    read, real = {}, incremental.publish_by_year

    def publish(df, spec, *args, **options):
        read[spec.name] = df.inputFiles()
        return real(df, spec, *args, **options)

    monkeypatch.setattr(incremental, "publish_by_year", publish)
    assert refresh_years(Warehouse(spark, cfg, source, from_catalog=False), folder=f"{tmp_path}/read")
    for key, below in (("t20", "t14"), ("t22", "t13"), ("t23", "t13"), ("t24", "t13")):
        files = read[OUTPUTS[key].name]
        assert files and all(f"/{OUTPUTS[below].name}__by_year/" in f for f in files)
    assert {p.name for p in (tmp_path / "read").iterdir()} == {OUTPUTS[k].name for k in ("t02", "t03")}
    full = Warehouse(spark, cfg, source, from_catalog=False)
    for key in ("t13", "t14", "t20", "t22", "t23", "t24"):
        own = OUTPUTS[key]
        assert Counter(map(tuple, spark.table(f"{databases[own.layer]}.{own.name}").collect())) == Counter(map(tuple, full.table(key).collect())), key
