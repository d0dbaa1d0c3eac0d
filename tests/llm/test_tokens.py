import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer as Exact

from wardbook.llm.common import read, run_folder
from wardbook.llm.packing import Encoder, best_pattern, cutting_stock, pack
from wardbook.llm.token_counts import CACHE, Tokenizer, count_tokens

DOCS = "doc_id bigint, text string, id string, length bigint, width int, digest string"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
QUICK = Tokenizer(BYTES, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
BY_WORD = Encoder(WORDS, by_word=True, remember=50, lowered=True)
LATIN = st.characters(max_codepoint=0x24F)
LETTERS = st.text(st.sampled_from(list("aBsStTvVeErRmMlLdD'’\"0123.,<|>#$%ÀßÞþÿ×÷µª²\u00ad")), max_size=14)
PIECES = st.one_of(
    LETTERS, st.text(LATIN, max_size=12), st.text(max_size=8),
    st.sampled_from([" ", "\n", "  ", "\t", "\x1c", "\x85", "\xa0", " ", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "İ", "ΑΣ", "é", "́", "ﬁ", "x" * 300]),
)
TEXTS = st.lists(PIECES, max_size=10).map("".join)


@pytest.fixture(scope="module")
def exact():
    return {path: Exact.from_file(path) for path in (BYTES, WORDS)}


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4))
def test_quick_counts_equal_the_library(texts):
    want = [len(Exact.encode(_exact(BYTES), t, add_special_tokens=False).ids) for t in texts]
    assert QUICK.counts(texts) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4))
def test_ids_by_word_equal_the_library(texts):
    got = [np.frombuffer(b, "<u4").tolist() for b in BY_WORD.ids(texts)]
    assert got == [_exact(WORDS).encode(t, add_special_tokens=False).ids for t in texts]


_KEPT = {}


def _exact(path):
    return _KEPT.setdefault(path, Exact.from_file(path))


def test_every_latin_character(exact):
    texts = [f"a{chr(a)}b {chr(a)}{chr(b)} {chr(b)}" for a in range(0x250) for b in (9, 10, 13, 28, 32, 49, 65, 133, 160, 178, 233, a)]
    assert QUICK.counts(texts) == [len(e) for e in exact[BYTES].encode_batch_fast(texts, add_special_tokens=False)]
    got = BY_WORD.ids(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [e.ids for e in exact[WORDS].encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("blank", [" ", "\n", "\xa0", " \t\r\n"])
def test_long_white_space(exact, blank):
    runs = [(blank * n)[:n] for n in (99_999, 100_000, 1_200_000)]
    texts = [t for run in runs for t in (run, f"a{run}b", f"{run[:60_000]}a{run}")]
    assert QUICK.counts(texts) == [len(exact[BYTES].encode(t, add_special_tokens=False)) for t in texts]


def test_counts_of_a_table_with_long_white_space(spark, exact):
    texts = {1: "a" + " " * 1_200_000 + "b", 2: "\n" * 1_200_000, 3: "one two"}
    docs = spark.createDataFrame([(d, t, "x", 1, 2, "y") for d, t in texts.items()], DOCS)
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, QUICK).collect()}
    assert got == {d: len(exact[BYTES].encode(t, add_special_tokens=False)) for d, t in texts.items()}


def test_counts_of_the_whole_table(spark, exact):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    want = {r.doc_id: (len(r.text.encode()), len(exact[BYTES].encode(r.text, add_special_tokens=False))) for r in docs.collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in count_tokens(docs, QUICK).collect()}
    assert got == want


def test_cache_is_joined_and_only_misses_appended(spark):
    folder = run_folder(spark, "cache")
    rows = [(1, "one two"), (2, "one two"), (3, None), (4, ""), (None, "é" * 3000), (4, ""), (6, "<|endoftext|>")]
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], DOCS)
    first = sorted(map(tuple, count_tokens(docs, QUICK, cache_dir=folder, limit=1).collect()), key=str)
    assert [r[2] for r in first if r[0] in (1, 2)] == [2, 2] and [r[2] for r in first if r[0] == 6] == [1]
    assert all(over == (n > 1) for _, _, n, over in first)
    cached = spark.read.schema(CACHE).parquet(folder)
    assert cached.count() == 4  # distinct texts
    # Counts that are known are taken, not made.
    spark.createDataFrame([(r.digest, r.version, r.n_tokens + 100) for r in cached.collect()], CACHE).write.mode("overwrite").parquet(folder + "-b")
    more = docs.union(spark.createDataFrame([(9, "new", "x", 1, 2, "y")], DOCS))
    again = {r.doc_id: r.n_tokens for r in count_tokens(more, QUICK, cache_dir=folder + "-b").collect()}
    assert again[1] == 102 and again[9] == 1
    assert spark.read.parquet(folder + "-b").count() == 5
    assert {r.doc_id: r.n_tokens for r in count_tokens(docs, Tokenizer(WORDS), cache_dir=folder + "-b").collect()}[1] == 2
    assert count_tokens(docs.limit(0), QUICK).count() == 0


def valid(rows, texts, capacity=4096):
    """Every id in one piece, sequences gapless and not overfull; returns the padding's share."""
    held, sequences = {}, {}
    for r in rows:
        held.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert held.keys() == texts.keys()
    for d, pieces in held.items():
        ids = np.array(_exact(WORDS).encode(texts[d] or "", add_special_tokens=False).ids + [2], "<u4")
        end = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == end and p.length > 0 and p.doc_tokens == len(ids)
            end += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : end].tobytes())
        assert end == len(ids)
    padded = 0
    for pieces in sequences.values():
        end = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        assert end <= capacity
        size = end if end & (end - 1) == 0 else capacity
        assert {p.padded_length for p in pieces} == {size}
        padded += size
    return 1 - sum(r.length for r in rows) / max(padded, 1)


def test_packing_of_the_whole_table(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    rows = pack(docs, Encoder(WORDS, by_word=True)).collect()
    assert valid(rows, {r.doc_id: r.text for r in docs.collect()}) < 0.03


def test_packing_of_odd_rows(spark):
    texts = {1: None, 2: "", 3: "a " * 9000, 4: "a " * 4095, 5: "b", 6: "b"}
    docs = spark.createDataFrame([(d, t, "x", 1, 2, "y") for d, t in texts.items()], DOCS)
    valid(pack(docs, Encoder(WORDS, by_word=True)).collect(), texts)
    twice = pack(docs.union(docs).union(docs.selectExpr("null doc_id", "text", "id", "length", "width", "digest")), Encoder(WORDS, by_word=True)).collect()
    assert sum(r.length for r in twice) == 3 * (1 + 1 + 9001 + 4096 + 2 + 2)
    assert pack(docs.limit(0), Encoder(WORDS, by_word=True)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 60)), min_size=1, max_size=12, unique_by=lambda t: t[0]))
def test_patterns_use_up_the_demand(pieces):
    widths, demand = (np.array(v) for v in zip(*sorted(pieces)))
    patterns = cutting_stock(widths, demand.astype(float), 40)
    assert all((counts @ widths) <= 40 and times > 0 for counts, times in patterns)
    assert (sum(counts * times for counts, times in patterns) == demand).all()
    need = int(np.ceil((widths @ demand) / 40))
    assert need <= sum(times for _, times in patterns) <= 2 * need + 1


@pytest.mark.parametrize(
    "room,widths,demand,prices",
    [
        # Prices at which no pattern is worth more than one sequence: what they make of the demand is needed by any plan.
        (20, [2, 6, 7, 10, 11, 13], [91275, 50363, 60663, 97074, 72949, 63227], [0, 0, 0, 0.5, 1, 1]),
        (256, [5, 90, 130, 200], [10**7] * 4, [0, 0, 1, 1]),
        (10, [1, 2, 5, 7], [999_983, 500_001, 70_001, 123_457], [0.1, 0.2, 0.5, 0.7]),
        (12, [4, 5, 7], [30_000, 60_000, 60_000], [1 / 3, 1 / 3, 2 / 3]),
    ],
)
def test_patterns_are_optimal(room, widths, demand, prices):
    widths, demand, prices = np.array(widths), np.array(demand, float), np.array(prices)
    assert best_pattern(widths, prices, room)[0] <= 1 + 1e-9
    need, total = float(prices @ demand), sum(times for _, times in cutting_stock(widths, demand, room))
    assert need - 1e-6 <= total <= need * (1 + 1e-4) + len(widths) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(0, 1000).map(lambda n: n / 1000)), min_size=1, max_size=4, unique_by=lambda t: t[0]))
def test_knapsack_equals_exhaustive_search(items):
    widths, prices = (np.array(v) for v in zip(*sorted(items)))
    best = {0: 0.0}
    for u in range(1, 21):
        best[u] = max([best[u - 1], *(best[u - w] + p for w, p in zip(widths.tolist(), prices.tolist()) if w <= u)])
    worth, counts = best_pattern(widths, prices, 20)
    assert worth == pytest.approx(best[20]) and counts @ prices == pytest.approx(worth) and counts @ widths <= 20
