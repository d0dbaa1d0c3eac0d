import hashlib

import duckdb
import pytest

from wardbook.llm import exact_dedup as xd
from pyspark.sql import functions as F

from wardbook.llm.exact_dedup import directory, exact_dedup, owned
from wardbook.llm.line_dedup import remove_repeated_lines

DOCS = "doc_id bigint, text string, id string, t string, n bigint, key bigint, place int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1, 2, 3) for r in rows], DOCS)


def test_exact_groups_with_odd_rows(spark):
    long = "x" * 3_000_000
    rows = [(1, "a"), (2, "a "), (3, "a"), (4, None), (5, ""), (6, long), (7, long), (7, long), (None, "a"), (None, "q")]
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs_of(spark, rows)).collect()}
    assert got == {
        (1, 3, 3, False), (3, 3, 3, True), (None, 3, 3, False), (2, 2, 1, True), (4, 5, 2, False), (5, 5, 2, True),
        (6, 7, 3, False), (7, 7, 3, True), (None, None, 1, True),
    }
    shas = {r.text_sha256 for r in exact_dedup(docs_of(spark, [(4, None), (5, "")])).collect()}
    assert shas == {hashlib.sha256(b"").hexdigest()}
    assert exact_dedup(docs_of(spark, [])).count() == 0


def test_colliding_keys_are_chained_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(xd, "_key", lambda c: xd.F.length(c).cast("bigint"))
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "cc"), (5, "c")]
    got = {r.doc_id: (r.keep_id, r.group_size, r.chain) for r in exact_dedup(docs_of(spark, rows)).collect()}
    assert {d: v[:2] for d, v in got.items()} == {1: (3, 2), 3: (3, 2), 2: (2, 1), 4: (4, 1), 5: (5, 1)}
    assert {got[d][2] for d in (2, 3, 4)} == {0, 1, 2} and got[5][2] == 0


@pytest.mark.parametrize("capacity", [1, 3, 50])
def test_directory_splits_only_what_overflows(spark, capacity):
    keys = [k << 56 for k in (0, 1, 2, 3, 64, 65, -128, -127, -1)]
    frame = spark.createDataFrame([(k,) for k in keys], "key bigint")
    slots = {r.slot: (r.depth, r.bucket) for r in directory(frame, capacity=capacity, max_depth=8).collect()}
    own = [(k >> 56) & 255 for k in keys]
    held = {}
    for slot in own:
        held.setdefault(slots[slot], []).append(slot)
    for (depth, bucket), inside in held.items():
        assert len(inside) <= capacity or depth == 8
        assert {s >> (8 - depth) for s in inside} == {bucket}
        if depth:  # the bucket one bit above was overfull
            assert sum(s >> (9 - depth) == bucket >> 1 for s in own) > capacity


def test_a_bucket_has_one_owner(spark, conf):
    """Owners' tasks hold whole buckets, none with more keys than its capacity, and chain by key."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    texts = spark.range(3000).select(F.col("id").alias("keep"), F.concat(F.lit("text "), (F.col("id") % 2900).cast("string"), F.lit(" "), F.col("id").cast("string")).alias("t"), (F.col("id") % 2900).alias("n"))
    texts = texts.withColumn("key", F.xxhash64("n")).drop("n")  # a hundred keys have two texts
    slots = directory(texts.select("key").distinct(), capacity=100, max_depth=9)
    rows = owned(texts, slots, max_depth=9).withColumn("task", F.spark_partition_id()).collect()
    assert len(rows) == 3000 and len({r.task for r in rows}) == 8
    by_bucket, by_key = {}, {}
    for r in rows:
        by_bucket.setdefault((r.depth, r.bucket), set()).add((r.task, r.key))
        by_key.setdefault(r.key, []).append((r.chain, -r.keep))
    assert len(by_bucket) > 20
    assert all(len({task for task, _ in own}) == 1 and len(own) <= 100 for own in by_bucket.values())
    assert all([c for c, _ in sorted(v)] == list(range(len(v))) and sorted(v) == sorted(v, key=lambda x: x[1]) for v in by_key.values())
    # No bucket is split between owners that have other buckets in between.
    order = sorted((b << (9 - d), next(iter(own))[0]) for (d, b), own in by_bucket.items())
    assert [task for _, task in order] == sorted(task for _, task in order)


def test_depth_follows_the_number_of_keys(spark, tmp_path):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    for capacity, least in ((4096, 1), (50, 20)):
        got = exact_dedup(docs, capacity=capacity, folder=str(tmp_path / str(capacity)))
        assert got.count() == 2000 and got.filter("kept").count() == 2000
        slots = spark.read.parquet(f"{tmp_path}/{capacity}/directory")
        assert slots.select("depth", "bucket").distinct().count() >= least
        held = spark.read.parquet(f"{tmp_path}/{capacity}/index").groupBy("depth", "bucket").count()
        assert held.filter(F.col("count") > capacity).count() == 0


def plain_lines(rows, size=3):
    first, out = {}, {}
    for d, text in sorted(rows, key=lambda r: r[0]):
        lines, gone = text.split("\n"), set()
        for i in range(len(lines) - size + 1):
            if first.setdefault(tuple(lines[i : i + size]), (d, i)) != (d, i):
                gone |= set(range(i, i + size))
        out[d] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def test_line_windows(spark):
    rows = [
        (1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb"), (4, "q\nq\nq\nq\nq"), (5, ""), (6, "\n\n\n"),
        (7, "b\nc\nd\na\nb\nc"), (8, "\n".join(f"l{i % 500}" for i in range(20_000))),
    ]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in remove_repeated_lines(docs_of(spark, rows)).collect()}
    assert got == plain_lines(rows)


def test_line_windows_with_odd_rows(spark):
    rows = [(None, "a\nb\nc"), (1, "a\nb\nc"), (2, None), (3, "a\nb\nc"), (3, "a\nb\nc")]
    out = remove_repeated_lines(docs_of(spark, rows))
    assert out.columns == [*docs_of(spark, []).columns, "n_lines", "n_removed"]
    assert sorted([(r.doc_id, r.text, r.n_removed) for r in out.collect()], key=str) == sorted(
        [(None, "a\nb\nc", 0), (1, "a\nb\nc", 0), (2, None, 0), (3, "", 3), (3, "", 3)], key=str
    )
    assert remove_repeated_lines(docs_of(spark, [])).count() == 0


def test_queries_equal_sql(spark):
    from wardbook.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    for name, sql in ORACLES.items():
        want = con.sql(sql).df()
        got = QUERIES[name](spark, "/root/testdata/sf0.001").toPandas()[list(want.columns)]
        order = lambda f: f.astype(str).sort_values(list(want.columns)).reset_index(drop=True)
        assert order(got).equals(order(want)), name
