import numpy as np
import pytest
from brute import components, simhash_components
from hypothesis import given, settings, strategies as st

from wardbook.llm import simhash
from wardbook.llm.common import connected_components, read, run_folder
from wardbook.llm.simhash import near_duplicates

SCHEMA = "doc_id bigint, text string, id string, fp string, component_id string"


def found(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


def test_whole_table_equals_all_pairs(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    want = simhash_components([(r.doc_id, r.text) for r in docs.collect()])
    assert found(near_duplicates(docs, shard_size=16)) == want


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(70_000))
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "a b"), (6, long), (7, long + " x"), (8, "é É a")]
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    assert found(near_duplicates(docs)) == simhash_components(rows)


def test_null_ids_repeats_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d", *"xyz"), (3, "a b c d", *"xyz"), (3, "a b c d", *"xyz")], SCHEMA)
    assert [r.component_id for r in near_duplicates(docs).collect()] == [3, 3, 3]
    assert near_duplicates(docs.limit(0)).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2**32), st.integers(2, 400), st.integers(0, 5))
def test_shards_and_local_trees_lose_no_link(seed, n, flips):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**64, 1 + n // 8, dtype=np.uint64)
    values = rng.choice(centres, n)
    for _ in range(flips):
        values = values ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64))
    values = np.unique(values)
    tree = simhash.split_tree(values, 4)
    place = {int(v): i for i, v in enumerate(values)}
    got = [
        (place[int(x)], place[int(y)])
        for _, own in simhash.shards_of(values, tree, 2)
        for a, b in simhash.links(own, 2)
        for x, y in zip(a, b)
    ]
    near = np.argwhere(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2, 1))
    assert components(len(values), got) == components(len(values), near.tolist())


@pytest.mark.parametrize("dense", [64, 8192])
def test_dense_sets(dense, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 32)
    monkeypatch.setattr(simhash, "DENSE", dense)
    ball = np.unique(np.array([(1 << a) | (1 << b) | (1 << c) for a in range(12) for b in range(12) for c in range(12)], np.uint64))
    links = [(int(x), int(y)) for a, b in simhash.links(ball, 2) for x, y in zip(a, b)]
    place = {int(v): i for i, v in enumerate(ball)}
    assert set(components(len(ball), [(place[a], place[b]) for a, b in links])) == {0}


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 400)] + [(5, 5), (None, 1), (401, 400), (400, 401)]
    got = connected_components(spark.createDataFrame(pairs, "a bigint, b bigint"), run_folder(spark, "cc"))
    want = {i: 100 for i in range(100, 161)} | {7: 7} | {i: 7 for i in range(300, 400)} | {400: 400, 401: 400}
    rows = [tuple(r) for r in got.select("node", "root").collect()]
    assert len(rows) == len(want) and dict(rows) == want
