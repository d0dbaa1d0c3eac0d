import zlib

import numpy as np

from wardbook.llm import language_id as li
from wardbook.llm.common import read

DOCS = "doc_id bigint, text string, lang string, id string, t string, name string, score double"


def test_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    true = {r.doc_id: r.lang for r in docs.collect()}
    rows = li.identify(docs, li.learn(docs)).collect()
    assert len(rows) == len(true) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == true[r.doc_id] for r in rows if r.held_out]) > 0.97


def test_held_out_labels_are_never_seen(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    from pyspark.sql import functions as F

    spoiled = docs.withColumn("lang", F.when(li.held_out("doc_id"), "xx").otherwise(F.col("lang")))
    a, b = li.learn(docs), li.learn(spoiled)
    assert a.names == b.names and np.allclose(a.vectors, b.vectors, atol=1e-5)


def test_trigrams_and_binding():
    runs, counts = li.trigrams("Ab,ab")
    assert dict(zip(runs.tolist(), counts.tolist())) == {
        (32 << 42) | (97 << 21) | 98: 2, (97 << 42) | (98 << 21) | 32: 2, (98 << 42) | (32 << 21) | 97: 1,
    }
    a, b, c = (li.letter_vector(ord(x), 64) for x in " ab")
    assert (li.bound(np.array([(32 << 42) | (97 << 21) | 98], np.uint64), 64)[0] == np.roll(a, 2) * np.roll(b, 1) * c).all()
    assert li.trigrams("1 2 ?") is None


def plain_vector(text, dims):
    """Sum over trigrams, letter by letter, of rotated letters' products; None without a letter."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not words:
        return None
    padded, counts = " " + " ".join(words) + " ", {}
    for k in range(len(padded) - 2):
        counts[padded[k : k + 3]] = counts.get(padded[k : k + 3], 0) + 1
    out = np.zeros(dims)
    for (a, b, c), n in counts.items():
        x, y, z = (li.letter_vector(ord(ch), dims).astype(float) for ch in (a, b, c))
        out += n**0.5 * np.concatenate([x[-2:], x[:-2]]) * np.concatenate([y[-1:], y[:-1]]) * z
    return out / np.linalg.norm(out)


def test_whole_table_equals_plain_code(spark):
    """Bundles, prototypes and cosines of every document, one by one."""
    dims = 1024
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    vectors = {d: plain_vector(t, dims) for d, t, _ in rows}
    by_lang = {}
    for d, t, lang in rows:
        if lang is not None and vectors[d] is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            by_lang.setdefault(lang, []).append(vectors[d])
    means = {lang: sum(v) / len(v) for lang, v in by_lang.items()}
    common = sum(means.values()) / len(means)
    prototypes = {lang: (m - common) / np.linalg.norm(m - common) for lang, m in sorted(means.items())}
    got = {r.doc_id: r for r in li.identify(docs, li.learn(docs, dims=dims)).collect()}
    assert len(prototypes) > 2 and len(got) == len(rows)
    for d, _, _ in rows:
        if vectors[d] is None:
            assert (got[d].lang_pred, got[d].score) == ("und", 0.0)
            continue
        own = vectors[d] - common
        cosines = {lang: float(own @ p) / np.linalg.norm(own) for lang, p in prototypes.items()}
        best = max(cosines.values())
        assert abs(got[d].score - min(max(best, 0), 1)) < 1e-4 and cosines[got[d].lang_pred] > best - 1e-4


def test_odd_rows(spark):
    rows = [(0, None, "en"), (1, "", "en"), (3, "12 --", None), (10, "the cat sat on the mat", "en"), (11, "le chat et la souris", "fr"), (None, "the cat", None)]
    rows += [(8, "the cat " * 100_000, None), (8, "the cat " * 100_000, None)]
    docs = spark.createDataFrame([(*r, "a", "b", "c", 0.5) for r in rows], DOCS)
    model = li.learn(docs)
    got = sorted((r.doc_id is None, r.doc_id, r.lang_pred) for r in li.identify(docs, model).collect() if r.doc_id is not None)
    assert [(d, p) for _, d, p in got] == [(0, "und"), (1, "und"), (3, "und"), (8, "en"), (8, "en"), (10, "en"), (11, "fr")]
    assert li.identify(docs.limit(0), model).count() == 0
    nothing = li.learn(docs.filter("lang IS NULL"))
    assert {r.lang_pred for r in li.identify(docs, nothing).collect()} == {"und"}
