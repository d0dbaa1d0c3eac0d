import base64
import gzip
import hashlib

from hypothesis import given, settings, strategies as st

from wardbook.llm.common import read, run_folder
from wardbook.llm.warc import CAPTURES, END, Reader, archive_captures, merge, merge_index, record, url_key

PAGES = "page_id bigint, url string, html string, key string, captured string, archive string"
NASTY = st.lists(st.sampled_from(["\r\n\r\n", "\r", "\n", "\r\n", "WARC/1.1", "é", "x", "", "\n\r\n\r"]), max_size=8).map("".join)


def plain(pages):
    """page_id -> what the record of it must say"""
    first = {}
    for p, _, html in sorted(pages, key=lambda p: p[0]):
        first.setdefault(html or "", p)
    out = {}
    for p, url, html in pages:
        payload = (html or "").encode()
        again = first[html or ""] != p
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out[p] = (len(payload), digest, "revisit" if again else "response", first[html or ""] if again else None)
    return out


def said(df):
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()}


def test_whole_table(spark):
    pages = read(spark, "/root/testdata/sf0.01", "pages")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    out = archive_captures(pages)
    assert said(out) == plain(rows)
    history = [(r.url_key, r.captured, r.page_id) for r in out.orderBy("history_position").collect()]
    assert history == sorted(history) and len({r.history_position for r in out.collect()}) == len(rows)


def test_archives_are_plain_warc_files(spark):
    folder = run_folder(spark, "warc-test")
    pages = spark.createDataFrame([(i, f"http://a.b/{i % 3}", "x" * i, *"kca") for i in range(20)], PAGES)
    rows = archive_captures(pages, folder=folder).collect()
    files = spark.read.format("binaryFile").load(f"{folder}/archives").filter("path LIKE '%.gz'").collect()
    data = {f.path.rsplit("/", 1)[1]: gzip.decompress(bytes(f.content)) for f in files}
    for r in rows:
        at = data[r.archive][r.position :]
        assert at.startswith(b"WARC/1.1\r\n") and f"<urn:capture:{r.page_id}>".encode() in at[:200]


@settings(max_examples=200, deadline=None)
@given(st.lists(NASTY, max_size=6))
def test_records_survive_any_payload(payloads):
    text = "".join(record(i, "2024-01-01T00:00:00Z", "http://x/\r\n", p, i - 1 if i % 3 == 2 else None) + END for i, p in enumerate(payloads))
    reader, found = Reader("f"), []
    stretches = text.encode().split(END.encode())
    for stretch in stretches if stretches[-1] else stretches[:-1]:  # as a text reader gives them
        found += reader.feed(stretch)
    assert reader.head is None and [r["payload_bytes"] for r in found] == [len(p.encode()) for p in payloads]


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "http://h/\r\nX: y", ""), (3, "no url", "\r\n\r\n"), (4, "http://a/", "a\r\n\r\r\n\r\n"), (5, "HTTP://www.A.b?q", "é" * 200_000)]
    rows += [(6, "http://a/", "é" * 200_000), (7, "http://[bad", "WARC/1.1\r\nContent-Length: 5\r\n\r\n"), (8, "http://a/", "\r")]
    pages = spark.createDataFrame([(*r, "k", "c", "a") for r in rows], PAGES)
    assert said(archive_captures(pages)) == plain(rows)
    more = pages.union(spark.createDataFrame([(None, None, "", "k", "c", "a"), (1, None, None, "k", "c", "a"), (None, None, "n", "k", "c", "a")], PAGES))
    kinds = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in archive_captures(more).collect() if r.payload_bytes < 2), key=str)
    assert kinds == sorted([(1, 0, "response", None)] * 2 + [(2, 0, "revisit", 1), (None, 0, "revisit", 1), (None, 1, "response", None), (8, 1, "response", None)], key=str)
    assert {r.record_type for r in archive_captures(pages, min_bytes=10**9).collect()} == {"response"}
    assert archive_captures(pages.limit(0)).count() == 0


def test_history_of_urls_with_white_space(spark):
    urls = [" http://b/", "http://a/ ", "http://a/\r\nx", "\thttp://c/", "http://a/!", "\n", "http://a/\xa0", "http://a/%0"] * 4
    pages = spark.createDataFrame([(k, u, "x", "k", "c", "a") for k, u in enumerate(urls)], PAGES).coalesce(2)
    out = archive_captures(pages).orderBy("history_position").collect()
    history = [(r.url_key, r.captured, r.page_id) for r in out]
    assert history == sorted(history) and len(history) == len(urls)


def test_ids_of_any_size(spark):
    ids = [0, -1, 2**62, 2**63 - 1, -(2**63), 250_000_000_000, -(2**40), 5]
    rows = [(i, f"http://h/{k % 2}", "same" if k % 3 else f"own {k}") for k, i in enumerate(ids)]
    out = archive_captures(spark.createDataFrame([(*r, "k", "c", "a") for r in rows], PAGES))
    assert said(out) == plain(rows)
    found = [(r.url_key, r.captured, r.page_id) for r in out.orderBy("history_position").collect()]
    assert found == sorted(found) and all(len(r[1]) == 20 for r in found)


def test_runs_are_merged_in_passes(spark, conf):
    """Far more runs than are merged at a time, in few tasks."""
    conf("spark.sql.shuffle.partitions", "2")
    found = [(i, 1, "d", "response", None, f"http://h/{i * 7919 % 11}", "2024-01-01T00:00:00Z", f"archive {i % 60:02d}") for i in range(900)]
    found.sort(key=lambda r: (r[7], f"h)/{r[5].rpartition('/')[2]}", r[0]))
    captures = spark.createDataFrame([(*r, at) for at, r in enumerate(found)], CAPTURES).repartition(5)
    want = None
    for options in ({"fan_in": 2, "block": 3}, {"fan_in": 7, "block": 64}, {}, {"task_rows": 100}):
        out = merge_index(captures, **options)
        found = [(r.url_key, r.captured, r.page_id) for r in out.orderBy("history_position").collect()]
        assert found == sorted(found) and len(found) == 900
        assert want is None or found == want
        want = found
    assert merge_index(captures, task_rows=100).rdd.getNumPartitions() == 9


def test_url_keys(spark):
    urls = ["http://www.A.example.com/X?y=1#z", "https://a.b", "nothing", None]
    got = [r.k for r in spark.createDataFrame([(u,) for u in urls], "u string").select(url_key(__import__("pyspark").sql.functions.col("u")).alias("k")).collect()]
    assert got == ["com,example,a)/x?y=1", "b,a)/", "nothing", ""]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 3))), max_size=9))
def test_loser_tree_merges(runs):
    runs = [sorted(r) for r in runs]
    assert list(merge(runs)) == sorted(x for r in runs for x in r)
