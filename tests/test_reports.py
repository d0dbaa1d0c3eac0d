"""Linkage, periods, runs of months and bitmaps against plain Python."""

from collections import Counter, defaultdict
from datetime import datetime, timedelta
import random
import re

import pytest
from pyspark.sql import functions as F

from wardbook.operators.bitmaps import PIECE, count_bitmaps, dense_ids, id_bitmaps
from wardbook.operators import linkage
from wardbook.operators.linkage import one_person_per_rotation
from wardbook.operators.periods import _by_width, _spread, events_in_period, match_in_period, overlapping
from wardbook.operators.runs import month_spine, shortfall_runs

DAY0 = datetime(2024, 1, 1)


def day(n):
    return None if n is None else DAY0 + timedelta(days=n, hours=n % 5)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- periods ----


def spans_and_events(seed=4, hot=0.4):
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < hot else rng.choice([None, "a", "b", "c"])
    spans = [(key(), n % 7, day(rng.randrange(400)), day(rng.choice([None, *range(0, 500, 3)]))) for n in range(150)]
    spans += spans[:20]
    events = [(key(), n, day(rng.choice([None, *range(420)]))) for n in range(200)]
    return spans, events


def test_match_in_period_is_a_left_join_on_between(spark):
    spans, events = spans_and_events()
    rows = spark.createDataFrame(spans, "who string, n int, t0 timestamp_ntz, t1 timestamp_ntz")
    log = spark.createDataFrame(events, "person string, event int, at timestamp_ntz")
    inside = lambda s, e: None not in (s[0], s[2], s[3], e[2]) and s[0] == e[0] and s[2] <= e[2] <= s[3]
    want = Counter()
    for s in spans:
        hits = [e[1] for e in events if inside(s, e)]
        want.update((*s, h) for h in hits or [None])
    for days in (1, 30, 10_000):
        options = {"start": "t0", "end": "t1", "at": "at", "keep": ["event"], "days": days}
        got = match_in_period(rows, log, [("who", "person")], **options)
        assert Counter(map(tuple, got.collect())) == want
        only = events_in_period(rows, log, [("who", "person")], **options)
        assert Counter(map(tuple, only.collect())) == Counter({k: n for k, n in want.items() if k[-1] is not None})
    for unwanted in ("NestedLoop", "Cartesian"):
        assert unwanted not in plan_of(got)


def test_overlapping_gives_every_pair_once(spark):
    spans, _ = spans_and_events(5)
    numbered = [(i, *s) for i, s in enumerate(spans)]
    rows = spark.createDataFrame(numbered, "id int, who string, n int, t0 timestamp_ntz, t1 timestamp_ntz")
    good = [s for s in numbered if s[1] is not None and s[4] is not None and s[3] <= s[4]]
    want = Counter((a[0], b[0]) for a in good for b in good if a[1] == b[1] and a[3] <= b[4] and b[3] <= a[4])
    for days in (1, 30, 10_000):
        got = overlapping(rows, rows, [("who", "who")], left_period=("t0", "t1"), right_period=("t0", "t1"), keep=["id"], days=days)
        assert Counter((r.id, r.other_id) for r in got.collect()) == want


def test_long_periods_are_listed_as_briefly_as_short_ones(spark):
    days = [0, 1, 29, 30, 31, 121, 500, 2000, 7000]
    spans = spark.createDataFrame([(n,) for n in days], "n int").selectExpr(
        "n", "TIMESTAMP_NTZ '1999-12-20 12:00:00' AS _from", "timestampadd(DAY, n, TIMESTAMP_NTZ '1999-12-20 12:00:00') AS _to"
    )
    listed = Counter(r.n for r in _spread(spans, 30).collect())
    assert sorted(listed) == days and max(listed.values()) <= 2


def test_overlapping_lists_long_periods_briefly(spark):
    rng = random.Random(8)
    lengths = [0, 1, 29, 30, 31, 121, 500, 2000, 7000, 9000]
    spans = [(n, rng.choice(["a", "b", None]), t0 := day(rng.randrange(9000)), t0 + timedelta(days=lengths[n % 10])) for n in range(80)]
    spans += [(80, "a", day(5), None), (81, "a", day(5), day(2)), *spans[:3]]
    rows = spark.createDataFrame(spans, "id int, who string, t0 timestamp_ntz, t1 timestamp_ntz")
    good = [s for s in spans if s[1] and s[3] and s[2] <= s[3]]
    want = Counter((a[0], b[0]) for a in good for b in good if a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3])
    got = overlapping(rows, rows, [("who", "who")], left_period=("t0", "t1"), right_period=("t0", "t1"), keep=["id"])
    assert Counter((r.id, r.other_id) for r in got.collect()) == want
    once = rows.filter("id < 80").dropDuplicates(["id"])
    for which in ("own", "from own", "above own"):
        assert max(Counter(r.id for r in _by_width(once, "t0", "t1", 30, which).collect()).values()) <= 10


def test_sparse_match_gives_the_same_rows(spark):
    """Rows without an event in a week of their period are not matched at all."""
    spans, events = spans_and_events(6)
    rows = spark.createDataFrame(spans, "who string, n int, t0 timestamp_ntz, t1 timestamp_ntz")
    log = spark.createDataFrame(events, "person string, event int, at timestamp_ntz")
    options = {"start": "t0", "end": "t1", "at": "at", "keep": ["event"]}
    for noted in (log, log.filter("event % 20 = 0"), log.limit(0)):
        got, want = (match_in_period(rows, noted, [("who", "person")], **options, sparse=s) for s in (True, False))
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


@pytest.mark.parametrize("stored", [False, True])
def test_sparse_match_brings_no_events_to_the_driver(spark, conf, tmp_path, stored):
    """Files of few bytes may hold many events, so none of the joins is a broadcast however small they look."""
    conf("spark.sql.autoBroadcastJoinThreshold", "10m")
    spark.range(3000).selectExpr("concat('who', id % 50) AS who", "timestampadd(DAY, int(id % 90), TIMESTAMP_NTZ '2024-01-01 00:00:00') AS at").write.parquet(f"{tmp_path}/in")
    events = spark.read.parquet(f"{tmp_path}/in")
    rows = events.selectExpr("who AS person", "at AS t0", "timestampadd(DAY, 1, at) AS t1")
    conf("spark.sql.adaptive.enabled", "false")
    folder = {"folder": str(tmp_path)} if stored else {}
    got = match_in_period(rows, events, [("person", "who")], start="t0", end="t1", at="at", keep=["at"], sparse=True, **folder)
    assert "Broadcast" not in plan_of(got) and "SortMergeJoin" in plan_of(got)


def test_sparse_match_composes_its_rows_once(spark, tmp_path):
    """The driver holds one small plan after another: what several branches read is in a folder."""
    spans, events = spans_and_events(7)
    rows = spark.createDataFrame(spans, "who string, n int, t0 timestamp_ntz, t1 timestamp_ntz")
    log = spark.createDataFrame(events, "person string, event int, at timestamp_ntz")
    options = {"start": "t0", "end": "t1", "at": "at", "keep": ["event"]}
    joins = lambda df: len(re.findall(r"\w+Join ", plan_of(df)))
    for noted in (log, log.filter("event % 20 = 0"), log.limit(0)):
        want = match_in_period(rows, noted, [("who", "person")], **options)
        lazy = match_in_period(rows, noted, [("who", "person")], **options, sparse=True)
        assert joins(lazy) <= 7
        apart = match_in_period(rows, noted, [("who", "person")], **options, sparse=True, folder=str(tmp_path))
        assert joins(apart) == 1
        assert Counter(map(tuple, lazy.collect())) == Counter(map(tuple, apart.collect())) == Counter(map(tuple, want.collect()))


@pytest.mark.parametrize("days", [1, 30])
def test_match_in_period_of_any_length_equals_brute_force(spark, days):
    rng = random.Random(days)
    day = lambda n: datetime(2000, 1, 1) + timedelta(days=n, hours=rng.randrange(24))
    log = [(rng.choice("ab"), day(rng.randrange(9000)), n) for n in range(60)] + [(None, day(3), 90), ("a", None, 91)]
    rows = []
    for length in (0, 1, 5, 40, 130, 500, 2000, 8000, -3):
        rows += [(rng.choice(["a", "b", "c", None]), t0 := day(rng.randrange(9000)), rng.choice([t0 + timedelta(days=length), t0 + timedelta(days=length), None])) for _ in range(8)]
    rows += rows[:9]
    want = Counter()
    for who, t0, t1 in rows:
        found = [e for p, at, e in log if p == who and who and at and t1 and t0 <= at <= t1]
        want.update([(who, t0, t1, e) for e in found] or [(who, t0, t1, None)])
    left = spark.createDataFrame(rows, "who string, t0 timestamp_ntz, t1 timestamp_ntz")
    right = spark.createDataFrame(log, "person string, at timestamp_ntz, event int")
    got = match_in_period(left, right, [("who", "person")], start="t0", end="t1", at="at", keep=["event"], days=days)
    assert Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("kinds", [("int", "bigint"), ("double", "double")])
def test_match_in_period_by_keys_of_other_or_inexact_types(spark, kinds):
    left = spark.sql(f"SELECT CAST(k AS {kinds[0]}) AS who, DATE '2020-01-01' AS t0, DATE '2020-03-01' AS t1 FROM VALUES (1), (2) AS v(k)")
    right = spark.sql(f"SELECT CAST(k AS {kinds[1]}) AS person, TIMESTAMP_NTZ '2020-02-01 10:00:00' AS at, 5 AS event FROM VALUES (1), (3) AS v(k)")
    if kinds[0] == "double":  # zeros of both signs are equal
        left, right = left.withColumn("who", F.col("who") * 0.0), right.withColumn("person", F.col("person") * -0.0)
    got = match_in_period(left, right, [("who", "person")], start="t0", end="t1", at="at", keep=["event"])
    want = [(0.0, 5)] * 4 if kinds[0] == "double" else [(1, 5), (2, None)]
    assert sorted((r.who, r.event) for r in got.collect()) == want


@pytest.mark.parametrize("hot_side", ["rows", "events"])
def test_hot_bins_are_split(spark, conf, hot_side):
    """One person holds a third of all rows, all in one month."""
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    }.items():
        conf(key, value)
    at = F.expr("TIMESTAMP_NTZ '2024-03-02 00:00:00'")
    big, small = spark.range(0, 60_000, 1, 8), spark.range(0, 300, 1, 2).withColumnRenamed("id", "k")
    keyed = big.select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 4000).alias("k"), "id")
    rows, log = (keyed, small.withColumn("id", F.col("k"))) if hot_side == "rows" else (small.withColumn("id", F.col("k")), keyed)
    rows = rows.select(F.col("k").alias("who"), at.alias("t0"), at.alias("t1"), F.col("id").alias("n"))
    log = log.select(F.col("k").alias("person"), at.alias("at"), F.col("id").alias("event"))
    got = events_in_period(rows, log, [("who", "person")], start="t0", end="t1", at="at", keep=["event"])
    assert len(got.collect()) > 20_000
    assert "skew=true" in plan_of(got)


# ---- one person per rotation ----


def linked_by_hand(rotations, people, log, rounds):
    named = defaultdict(set)
    for person, name in people:
        if name is not None:
            named[name].add(person)
    rotations = sorted(set(rotations), key=str)
    claims = {}
    for r, (name, office, t0, t1) in enumerate(rotations):
        if t1 is None or t0 > t1 or len(named[name]) < 2:
            continue
        for person, who, at in log:
            if who == name and at is not None and t0 <= at <= t1:
                claims[r, person] = claims.get((r, person), 0) + 1
    clash = lambda a, b: rotations[a][2] <= rotations[b][3] and rotations[b][2] <= rotations[a][3]
    given = {}
    for _ in range(rounds):
        picks = {}
        for r in {r for r, _ in claims}:
            own = sorted(((n, p) for (x, p), n in claims.items() if x == r), reverse=True)
            if len(own) == 1 or own[0][0] > own[1][0]:
                picks[r] = own[0][::-1]
        new = {
            r: (p, n) for r, (p, n) in picks.items()
            if not any(r != o and p == q and m >= n and clash(r, o) for o, (q, m) in picks.items())
        }
        given |= new
        claims = {
            (r, p): n for (r, p), n in claims.items()
            if r not in new and not any(p == q and clash(r, o) for o, (q, _) in new.items())
        }
    out = Counter()
    for r, rotation in enumerate(rotations):
        n = len(named[rotation[0]])
        if n == 0:
            out[(*rotation, None, "unknown", None)] += 1
        elif n == 1:
            out[(*rotation, next(iter(named[rotation[0]])), "only", None)] += 1
        elif r in given:
            out[(*rotation, given[r][0], "evidence", given[r][1])] += 1
        else:
            out[(*rotation, None, "ambiguous", None)] += 1
    return out


@pytest.mark.parametrize("rounds", [1, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_one_person_per_rotation_equals_brute_force(spark, tmp_path, seed, rounds):
    rng = random.Random(seed)
    people = [(n, "hot" if n % 3 == 0 else f"name {n % 9}") for n in range(30)] + [(99, None), (7, "name 7"), (50, "single")]
    names = ["hot", "stranger", None, *{n for _, n in people if n}]
    rotations = [
        (rng.choice(names), rng.choice("xy"), day(rng.randrange(200)), day(rng.choice([None, *range(0, 230, 4)]))) for _ in range(120)
    ]
    rotations += rotations[:15]
    log = [(p, name, day(rng.choice([None, *range(230)]))) for p, name in people for _ in range(rng.randrange(12)) if name]
    got = one_person_per_rotation(
        spark.createDataFrame(rotations, "name string, office string, t0 timestamp_ntz, t1 timestamp_ntz"),
        spark.createDataFrame(people, "person bigint, own string"),
        spark.createDataFrame(log, "who bigint, of string, at timestamp_ntz"),
        on=[("name", "own")], person="person", period=("t0", "t1"), log_on=[("name", "of")], log_person="who", log_time="at",
        folder=str(tmp_path), rounds=rounds,
    )
    want = linked_by_hand(rotations, people, log, rounds)
    assert {k[5] for k in want} == {"only", "evidence", "ambiguous", "unknown"}
    assert Counter(map(tuple, got.collect())) == want


def test_rotations_are_shuffled_once_for_their_candidates(spark, tmp_path, monkeypatch):
    plans, real = {}, linkage.stored

    def stored(df, path):
        plans[path.rpartition("/")[2]] = df._jdf.queryExecution().toString()
        return real(df, path)

    monkeypatch.setattr(linkage, "stored", stored)
    one_person_per_rotation(
        spark.createDataFrame([("a", "x", day(1), day(2))] * 2, "name string, office string, t0 timestamp_ntz, t1 timestamp_ntz"),
        spark.createDataFrame([(1, "a")], "person bigint, own string"),
        spark.createDataFrame([(1, "a", day(1))], "who bigint, of string, at timestamp_ntz"),
        on=[("name", "own")], person="person", period=("t0", "t1"), log_on=[("name", "of")], log_person="who", log_time="at",
        folder=str(tmp_path),
    )
    assert "Exchange hashpartitioning(name#" in plans["rotations"]
    assert not re.search(r"Exchange hashpartitioning\([^)]*office#", plans["rotations"])


def test_linkage_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "name string, t0 timestamp_ntz, t1 timestamp_ntz")
    people = spark.createDataFrame([], "person bigint, own string")
    log = spark.createDataFrame([], "who bigint, of string, at timestamp_ntz")
    options = {"on": [("name", "own")], "person": "person", "period": ("t0", "t1"), "log_on": [("name", "of")], "log_person": "who", "log_time": "at"}
    assert one_person_per_rotation(none, people, log, folder=str(tmp_path / "a"), **options).collect() == []
    one = spark.createDataFrame([("x", day(1), day(2))], none.schema)
    assert [tuple(r)[3:] for r in one_person_per_rotation(one, people, log, folder=str(tmp_path / "b"), **options).collect()] == [(None, "unknown", None)]


# ---- runs ----


def test_shortfall_runs(spark):
    groups = spark.createDataFrame([("a", 2), ("b", 0), ("c", 1)], "kind string, due int")
    spine = month_spine(groups, [(1, "one"), (2, "two")], "2023-11", "2024-04", site=("site", "site_name"))
    assert spine.count() == 2 * 3 * 6
    counts = spark.createDataFrame(
        [(1, "one", "a", "2023-12", 2), (1, "one", "a", "2024-01", 1), (1, "one", "a", "2024-04", 5), (1, "two", "c", "2024-01", 9), (2, "two", "c", "2024-02", 1)],
        "site int, site_name string, kind string, month string, n bigint",
    )
    keys = ["site", "site_name", "kind"]
    got = {(r.site, r.kind, r.first_month): tuple(r)[4:] for r in shortfall_runs(spine, counts, keys, count="n", standard="due").collect()}
    assert got == {
        (1, "a", "2023-11"): ("2023-11", 1, 1, 2),
        (1, "a", "2024-01"): ("2024-03", 3, 2, 5),
        (2, "a", "2023-11"): ("2024-04", 6, 6, 12),
        (1, "c", "2023-11"): ("2024-04", 6, 6, 6),
        (2, "c", "2023-11"): ("2024-01", 3, 3, 3),
        (2, "c", "2024-03"): ("2024-04", 2, 2, 2),
    }
    assert month_spine(groups, [(1, "one")], "2024-02", "2024-01", site=("site", "site_name")).count() == 0
    for unwanted in ("NestedLoop", "Cartesian"):
        assert unwanted not in plan_of(shortfall_runs(spine, counts, keys, count="n", standard="due"))


# ---- bitmaps ----


def test_bitmaps_roll_up(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), f"2024-{rng.randrange(1, 5):02d}", rng.choice([None, 3, 3, 3, *range(60)]), rng.random() < 0.3) for _ in range(600)]
    df = spark.createDataFrame(rows, "site string, month string, id bigint, flag boolean")
    ids = dense_ids(df, "id", f"{tmp_path}/ids", per_bucket=10)
    placed = ids.collect()
    assert len(placed) == len({r.id for r in placed}) == 60 and len({(r.bucket, r.place) for r in placed}) == 60
    assert max(r.place for r in placed) < 60 and len({r.bucket for r in placed}) > 1
    maps = id_bitmaps(df, ids, ["site", "month"], "id", {"all": F.lit(True), "flagged": F.col("flag")}, f"{tmp_path}/maps")

    def by_hand(key):
        groups = defaultdict(lambda: (set(), set()))
        for r in rows:
            if r[2] is not None:
                groups[key(r)][0].add(r[2])
                if r[3]:
                    groups[key(r)][1].add(r[2])
        return {k: (len(a), len(b)) for k, (a, b) in groups.items()}

    for keys, key in ((["site", "month"], lambda r: r[:2]), (["site"], lambda r: r[:1]), (["month"], lambda r: (r[1],)), ([], lambda r: ())):
        got = {tuple(r)[: len(keys)]: (r["all"], r["flagged"]) for r in count_bitmaps(maps, keys, ["all", "flagged"]).collect()}
        assert got == by_hand(key)


def test_bitmaps_of_more_ids_than_a_piece_holds(spark, tmp_path):
    n = PIECE + 1000
    df = spark.range(n).select(F.col("id"), (F.col("id") % 2).alias("half"))
    ids = dense_ids(df, "id", f"{tmp_path}/ids")
    maps = id_bitmaps(df, ids, ["half"], "id", {"n": F.lit(True)}, f"{tmp_path}/maps")
    assert maps.count() == 4  # two pieces for either half
    assert sorted(map(tuple, count_bitmaps(maps, ["half"], ["n"]).collect())) == [(0, n // 2), (1, n // 2)]
    assert count_bitmaps(maps, [], ["n"]).first().n == n
