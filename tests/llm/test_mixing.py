import numpy as np
import pytest
from pyspark.sql import functions as F

from wardbook.llm.mixing import mix

DOCS = "doc_id bigint, text string, lang string, source string, tokens bigint, value string, share double"


def raked(tokens, targets, rounds=16):
    """tokens: array over sides; targets: a vector per side"""
    w = tokens.astype(float).copy()
    for _ in range(rounds):
        for axis, target in enumerate(targets):
            shape = [-1 if a == axis else 1 for a in range(w.ndim)]
            held = w.sum(axis=tuple(a for a in range(w.ndim) if a != axis)).reshape(shape)
            w = w * np.divide(target.reshape(shape), held, out=np.zeros_like(held), where=held > 0)
    return w


def chances(tokens, weight, budget):
    order, whole = np.argsort(-(weight / tokens), axis=None), 0.0
    t, w = tokens.ravel()[order], weight.ravel()[order]
    for k in range(len(t)):
        scale = (budget - whole) / w[k:].sum()
        if scale * w[k] / t[k] < 1:
            break
        whole += t[k]
    return np.minimum(1, weight / tokens * scale)


def test_targets_and_probabilities(spark):
    rng = np.random.default_rng(3)
    rows = [
        (i, "w " * int(rng.integers(1, 30)), "ab"[int(rng.integers(2))], "xyz"[min(2, int(rng.integers(5)))], 0, "v", 0.0)
        for i in range(600)
    ]
    docs = spark.createDataFrame(rows, DOCS)
    sides = {"source": F.col("source"), "lang": F.col("lang")}
    targets = {"source": spark.createDataFrame([("x", 0.5), ("y", 0.3), ("z", 0.2)], "value string, share double"),
               "lang": spark.createDataFrame([("a", 0.9), ("b", 0.1)], "value string, share double")}
    got = mix(docs, sides=sides, targets=targets, budget_share=0.4, rounds=30).toPandas()
    tokens = np.zeros((3, 2))
    for _, t, lang, source, *_ in rows:
        tokens["xyz".index(source), "ab".index(lang)] += len(t.split())
    weight = raked(tokens, [np.array([0.5, 0.3, 0.2]), np.array([0.9, 0.1])], 30)
    assert weight.sum(axis=0) == pytest.approx([0.9, 0.1]) and weight.sum(axis=1) == pytest.approx([0.5, 0.3, 0.2])
    want = chances(tokens, weight, 0.4 * tokens.sum())
    for r in got.itertuples():
        assert r.probability == pytest.approx(want["xyz".index(r.source), "ab".index(r.lang)])
    assert (got.n_tokens * got.probability).sum() == pytest.approx(0.4 * got.n_tokens.sum())
    assert (got.n_tokens[got.sampled].sum() / got.n_tokens.sum()) == pytest.approx(0.4, abs=0.06)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, "a b", "en", "a"), (4, "a|b @", "en", "a"), (4, "a|b @", "en", "a"), (5, "x " * 200_000, None, "b")]
    docs = spark.createDataFrame([(*r, 7, "v", 0.5) for r in rows], DOCS)
    got = mix(docs)
    assert set(docs.columns) <= set(got.columns)
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == 5 and got.count() == 6
    assert (found[1].n_tokens, found[1].source, found[1].lang, found[1].sampled) == (0, "(none)", "(none)", True)
    assert found[5].n_tokens == 200_000 and found[4].topic == "table"
    assert mix(docs.filter("doc_id <= 2")).count() == 2
    assert mix(docs.limit(0)).count() == 0
    none = mix(docs, targets={"source": spark.createDataFrame([], "value string, share double")})
    assert none.count() == 6
