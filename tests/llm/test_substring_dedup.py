import hashlib

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wardbook.llm import induced_sort, substring_dedup as sd
from wardbook.llm.common import read
from wardbook.llm.substring_dedup import remove_repeats

DOCS = "doc_id bigint, text string, id string, t string, at bigint, h bigint, z string"


def plain(rows, size=200):
    """Row by row: (bytes, removed, stretches, SHA-256 of the rest)"""
    seen = {}
    texts = [(t or "").encode() for _, t in rows]
    for text in texts:
        for i in range(len(text) - size + 1):
            seen[text[i : i + size]] = seen.get(text[i : i + size], 0) + 1
    out = []
    for text in texts:
        gone = np.zeros(len(text) + 1, bool)
        for i in range(len(text) - size + 1):
            if seen[text[i : i + size]] > 1:
                gone[i : i + size] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((len(text), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return out


def found(df):
    return [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in df.collect()]


def test_whole_table(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = dict(zip([d for d, _ in rows], plain(rows)))
    got = dict(found(remove_repeats(docs, shard_bytes=1 << 16)))
    assert got == want and any(w[1] for w in want.values())


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    noise = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    shared, long = noise(250), noise(40_000)
    rows = [(0, None), (1, ""), (2, "x" * 199), (3, "y" * 200), (4, "y" * 199 + "z"), (5, "q" * 1000), (6, noise(30) + shared + noise(30)),
            (7, shared + noise(500) + shared[:220] + "é" * 300), (8, long), (9, long[:20_000] + "!" + long[20_000:]), (10, "ab" * 400), (11, "\x00" * 300 + "tail"),
            (12, shared), (13, shared)]
    docs = spark.createDataFrame([(*r, "a", "b", 1, 2, "c") for r in rows], DOCS)
    assert sorted(found(remove_repeats(docs, shard_bytes=5000))) == sorted(zip([d for d, _ in rows], plain(rows)))
    same = [(None, shared), (None, noise(300)), (3, long), (3, long)]
    again = spark.createDataFrame([(*r, "a", "b", 1, 2, "c") for r in same], DOCS)
    assert sorted(n for _, (_, n, _, _) in found(remove_repeats(again))) == [0, 0, 40_000, 40_000]
    assert remove_repeats(docs.limit(0)).count() == 0


def test_a_hot_anchor_is_dealt_again(spark, monkeypatch):
    rng = np.random.default_rng(8)
    noise = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    phrase, tail = noise(120), noise(260)
    rows = [(k, noise(300) + phrase + (tail if k % 3 == 0 else noise(260)) + "é") for k in range(200)]
    rows += [(200, rows[0][1]), (201, rows[1][1]), (202, phrase + noise(90)), (None, noise(20) + phrase + tail), (5, noise(300) + phrase + tail)]
    shards, repeats = [], sd._repeats

    def watched(contexts, size, kind):
        held = contexts.groupBy(F.spark_partition_id().alias("shard")).agg(F.sum(F.length("context")).alias("held")).collect()
        shards.extend(r.held for r in held)
        return repeats(contexts, size, kind)

    monkeypatch.setattr(sd, "_repeats", watched)
    docs = spark.createDataFrame([(*r, "a", "b", 1, 2, "c") for r in rows], DOCS)
    got = found(remove_repeats(docs, shard_bytes=8000))
    # Rows that share the id 5 share their removed stretches.
    want = sorted(w for w in zip([d for d, _ in rows], plain(rows)) if w[0] not in (5, None))
    assert sorted(g for g in got if g[0] not in (5, None)) == want and any(w[1][1] for w in want)
    assert [g[1] for g in got if g[0] is None] == [plain(rows)[203]]
    assert max(shards, default=0) <= 4 * 8000  # one shard held all surroundings of the phrase


def test_words_read_the_text_in_place():
    text = np.random.default_rng(3).integers(0, 256, 500).astype(np.uint8)
    words = induced_sort._Words(text, 200)
    assert np.shares_memory(words.rows, text)
    for n in (0, 1, 7, 8, 9, 500):
        padded = text[:n].tobytes() + bytes(300)
        got = induced_sort._Words(text[:n], 200).at(np.arange(n + 201))
        assert got.tolist() == [int.from_bytes(padded[k : k + 8]) for k in range(n + 201)]


def test_very_long_text_is_looked_at_in_pieces(monkeypatch):
    text = np.random.default_rng(2).integers(97, 101, 5000).astype(np.uint8).tobytes()
    whole = sd.anchored(text, 200)
    monkeypatch.setattr(sd, "PIECE", 777)
    parts = sd.anchored(text, 200)
    spread = lambda runs: [h for _, n, h in zip(*(x.tolist() for x in runs)) for _ in range(n)]
    assert spread(whole) == spread(parts) and len(spread(whole)) == 5000 - 199


TEXTS = st.builds(lambda part, times, rest: (part * times + rest)[:300], st.text("ab\x00é", max_size=12), st.integers(1, 30), st.text("abc", max_size=60))


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.sampled_from([8, 16, 200]), st.sampled_from([3, 1 << 19]), st.sampled_from([4, 1 << 21]))
def test_suffix_order_and_common_prefixes(text, cap, block, in_memory):
    data = text.encode() + b"\xfe"
    old, induced_sort.BLOCK = induced_sort.BLOCK, block
    try:
        blocks = list(induced_sort.sorted_suffixes(np.frombuffer(data, np.uint8), cap, in_memory=in_memory))
    finally:
        induced_sort.BLOCK = old
    order = [int(p) for b in blocks for p in b[0]]
    common = [int(c) for b in blocks for c in b[1]]
    assert sorted(order) == list(range(len(data)))
    for before, after, c in zip(order, order[1:], common[1:]):
        assert data[before : before + cap] >= data[after : after + cap]
        a, b = data[before : before + cap], data[after : after + cap]
        assert c == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@settings(max_examples=100, deadline=None)
@given(st.text("ab", min_size=1, max_size=400), st.integers(0, 2**32), st.sampled_from([2, 1 << 19]))
def test_owned_repeats(text, seed, block):
    data = np.frombuffer(text.encode() + b"\xfe", np.uint8)
    owned = np.random.default_rng(seed).random(len(data)) < 0.5
    owned[max(0, len(data) - 9) :] = False
    old, induced_sort.BLOCK = induced_sort.BLOCK, block
    try:
        got = sd.repeated_owned(data, owned, 8)
    finally:
        induced_sort.BLOCK = old
    starts = np.flatnonzero(owned).tolist()
    strings = [data[i : i + 8].tobytes() for i in starts]
    assert {i for i, s in zip(starts, strings) if strings.count(s) > 1} == set(np.flatnonzero(got).tolist())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "abc", "é", "x" * 50]), max_size=60).map("".join), st.integers(1, 40))
def test_collapsed_runs_say_what_all_runs_say(text, times):
    """The same groups of equal bytes with as many copies, and all bytes of groups with several covered."""
    raw = (text * times).encode()
    first, number, h = sd.anchored(raw, 200)
    every = {}
    for a, n, x in zip(first.tolist(), number.tolist(), h.tolist()):
        every.setdefault((x, raw[a : a + n + 199]), []).append((a, a + n + 199))
    rows = sd.collapsed(raw, 200).tolist()
    assert {(x, raw[a : a + n + 199]): m for a, n, x, _, m in rows if m} == {k: len(v) for k, v in every.items()}
    covered, said = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    for own in every.values():
        for a, b in own if len(own) > 1 else []:
            covered[a:b] = True
    for a, n, x, c, m in rows:
        if not m:
            said[a : a + n + 199] = True
            assert any(x == y and c == k for _, _, y, k, many in rows if many > 1)
    assert (covered == said).all()


def test_very_long_repetitive_texts(spark):
    """One repeated character, or passage, gives a few rows, not one for each byte."""
    passage = "".join(map(chr, np.random.default_rng(4).integers(97, 123, 777)))
    texts = {1: " " * 12_000_000, 2: "ab" * 2_000_000, 3: passage * 3000, 4: passage[:150]}
    for text in texts.values():
        assert len(sd.collapsed(text.encode(), 200)) < 100
    docs = spark.createDataFrame([(k, t, "a", "b", 1, 2, "c") for k, t in texts.items()], DOCS)
    got = dict(found(remove_repeats(docs)))
    assert {k: v[1] for k, v in got.items()} == {1: 12_000_000, 2: 4_000_000, 3: 3000 * 777, 4: 0}
