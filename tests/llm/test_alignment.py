import hashlib
from collections import Counter, defaultdict

import public_tokenizers
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer, decoders

from wardbook.llm.alignment import TokenizerPair, align_tokens, byte_characters
from wardbook.llm.common import read
from wardbook.llm.queries import op11_cross_tokenizer_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
EXACT = TokenizerPair(A, B)
QUICK = TokenizerPair(A, B, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def brute(rows):
    """Every column by comparing all ends, token by token."""
    a_of, b_of = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_of.encode_special_tokens = True
    letters = byte_characters()

    def b_bytes(i):
        piece = b_of.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_of.is_byte(i) else piece.replace("▁", " ").encode()

    found, counts = [], Counter()
    for doc_id, text in rows:
        raw = b" " + (text or "").encode()
        a = a_of.encode(raw.decode(), add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        a_raw = [bytes(letters[c] for c in a_of.id_to_token(i)) for i in a]
        b_raw = [b_bytes(i) for i in b]
        if b"".join(a_raw) != raw or b"".join(b_raw) != raw:
            a, b, a_raw, b_raw = [], [], [], []
        a_end = {len(b"".join(a_raw[: k + 1])): k for k in range(len(a))}
        b_end = {len(b"".join(b_raw[: k + 1])): k for k in range(len(b))}
        links = [(a[a_end[e]], b[b_end[e]]) for e in sorted(set(a_end) & set(b_end))]
        groups, i, j = [], 0, 0
        for e in sorted(set(a_end) & set(b_end)):
            groups.append(",".join(map(str, a[i : a_end[e] + 1])) + "|" + ",".join(map(str, b[j : b_end[e] + 1])))
            i, j = a_end[e] + 1, b_end[e] + 1
        counts.update(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        found.append((doc_id, len(a), len(b), len(groups), links, digest))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted(
        (d, n_a, n_b, n, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest)
        for d, n_a, n_b, n, links, digest in found
    )


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

ODD = [
    "", None, " ", "  ", "a", " a", "a  b", "a\tb\n\nc", "▁x", "a ▁b", "<|endoftext|> <s> <unk>", "日本語 テキスト", "ﬁ éé",
    "x" * 3000, "tail ", "\n", "\x00 \x7f", "a b　c", "don't DON'T 12,345.67", "\U0001f600 \U0001f469‍\U0001f467", "the cat sat on the mat " * 40,
]


def test_bytes_have_a_character_each():
    assert sorted(byte_characters().values()) == list(range(256))
    of = byte_characters()
    for text in ("plain ASCII\n\t", "äöü日本語", "\x00\x7f\xad "):
        written = [c for b in text.encode() for c in of if of[c] == b]
        assert decoders.ByteLevel().decode(["".join(written)]) == text


def test_equals_brute_force(spark):
    rows = list(enumerate(ODD)) + [(100 + k, t) for k, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = brute(rows)
    for pair, more in ((EXACT, {}), (QUICK, {}), (QUICK, {"bundle_chars": 50, "remember": 3})):
        got = align_tokens(docs, pair, **more).select(*NAMES)
        assert sorted(map(tuple, got.collect())) == want


def test_whole_table_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = op11_cross_tokenizer_alignment(spark, sf_dir).select(*NAMES)
    rows = [tuple(r) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    # Prefix sums of bytes make brute force quadratic in a text: whole texts, but not the longest.
    short = [r for r in rows if len(r[1] or "") <= 6000]
    by_id = {r[0]: tuple(r) for r in got.collect()}
    assert sorted(by_id) == sorted(d for d, _ in rows)
    columns = [0, 1, 2, 3, 4, 7]  # counts of links hold for the whole table only
    assert [[by_id[w[0]][k] for k in columns] for w in brute(short)] == [[w[k] for k in columns] for w in brute(short)]
    assert all(r[3] <= min(r[1], r[2]) and r[5] <= r[4] <= r[6] for r in by_id.values())


def test_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert align_tokens(none, QUICK).collect() == []
    rows = spark.createDataFrame(
        [(None, "a b", "x", 1), (1, "a b", "y", 2), (1, "a b", "y", 2), (2, None, None, None)],
        "doc_id bigint, text string, pairs string, bundle int",
    )
    got = sorted(map(tuple, align_tokens(rows, QUICK).select(*NAMES).collect()), key=str)
    assert [g[:7] for g in got] == [(1, 2, 2, 2, 2, 2, 6), (1, 2, 2, 2, 2, 2, 6), (2, 0, 0, 0, 0, 0, 0), (None, 2, 2, 2, 2, 2, 6)]
    assert got[2][7] == ""
    texts = spark.createDataFrame([(None, None)], "doc_id bigint, text string")
    assert [r[1:] for r in align_tokens(texts, QUICK).select(*NAMES).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_very_long_text_without_spaces(spark):
    rows = [(1, "ab日c" * 60_000), (2, "word " * 60_000)]
    got = {r.doc_id: r for r in align_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), QUICK).collect()}
    assert got[1].n_groups > 60_000 and got[2].n_groups >= 60_000
