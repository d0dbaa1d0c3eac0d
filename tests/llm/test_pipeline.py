import hashlib
import zlib

import corpus_pipeline as pipeline
import numpy as np
import public_tokenizers
from brute import WORD, rule_stats, simhash_components
from test_dedup import plain_lines
from test_mixing import chances, raked
from test_quality_rules import plain_score
from tokenizers import Tokenizer

from wardbook.llm import quality_rules as qr
from wardbook.llm.common import read

SF = "/root/testdata/sf0.001"


def plain_sample(rows, budget_share, power=0.7, seed=17):
    """Ids that mixing keeps: weights raked over arrays, probabilities, and a draw by MD5."""
    cells = [(s or "(none)", lang or "(none)", "table" if "|" in t else "contact" if "@" in t else "prose") for _, t, s, lang in rows]
    words = [len(WORD.findall(t)) for _, t, _, _ in rows]
    names = [sorted(set(v)) for v in zip(*cells)]
    tokens = np.zeros([len(n) for n in names])
    for cell, n in zip(cells, words):
        tokens[tuple(own.index(v) for own, v in zip(names, cell))] += n
    targets = []
    for axis in range(3):
        held = tokens.sum(axis=tuple(a for a in range(3) if a != axis)) ** power
        targets.append(held / held.sum())
    with np.errstate(divide="ignore", invalid="ignore"):
        there = tokens > 0
        weight = raked(tokens, targets)
        chance = np.ones_like(tokens)
        chance[there] = chances(tokens[there], weight[there], budget_share * tokens.sum())
    kept = set()
    for (d, *_), cell in zip(rows, cells):
        draw = int(hashlib.md5(f"{d}:{seed}".encode()).hexdigest()[:13], 16) / 2**52
        if draw < chance[tuple(own.index(v) for own, v in zip(names, cell))]:
            kept.add(d)
    return kept


def test_every_stage_against_plain_code(spark):
    docs = read(spark, SF, "documents")
    labels = read(spark, SF, "labels")
    texts = {r.doc_id: r.text for r in docs.collect()}

    good = pipeline.quality_rules(spark, docs, SF).cache()
    assert good.columns == docs.columns
    model = qr.fit(qr.document_stats(docs), labels)
    passing = {}
    for d, t in texts.items():
        n, _, _, _, rep = rule_stats(t)
        score = plain_score(model.forest, qr.features(np.array([qr.rule_stats(t)]))[0])
        if n >= 10 and 100 * rep <= 20 * n and score <= model.highest:
            passing[d] = t
    assert {r.doc_id: r.text for r in good.collect()} == passing

    lines = pipeline.line_dedup(spark, good, SF).cache()
    want = {d: t for d, (t, _, _) in plain_lines(list(passing.items())).items()}
    assert {r.doc_id: r.text for r in lines.collect()} == want
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    unique = pipeline.simhash_near_dedup(spark, lines, SF).cache()
    stays = {d for d, (_, c) in simhash_components(list(want.items())).items() if c == d}
    assert {r.doc_id for r in unique.collect()} == stays and unique.columns == docs.columns

    mixed = pipeline.mixing(spark, unique, SF).cache()
    sampled = plain_sample([(r.doc_id, want[r.doc_id], r.source, r.lang) for r in unique.collect()], pipeline.MIX_SHARE)
    assert {r.doc_id for r in mixed.collect()} == sampled and mixed.columns == docs.columns
    assert dict(mixed.dtypes) == dict(docs.dtypes)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in pipeline.packing(spark, mixed, SF).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    assert pieces.keys() == sampled
    for d, own in pieces.items():
        ids = np.array([*tokenizer.encode(want[d], add_special_tokens=False).ids, 2], "<u4")
        for start, length, crc in sorted(own):
            assert crc == zlib.crc32(ids[start : start + length].tobytes())
        assert sum(n for _, n, _ in own) == len(ids)


def test_run_equals_its_stages(spark):
    docs = read(spark, SF, "documents")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    rows = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert rows(pipeline.run(spark, SF)) == rows(docs)


def test_stages_on_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    text = "one two three four five six seven eight nine ten\neleven\ntwelve"
    docs = spark.createDataFrame([(None, text, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, text, "en", None, 1), (3, text, "en", None, 1)], schema)
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert pipeline.STAGES[-1][1](spark, docs, SF).count() == 5


def test_near_copies_with_null_or_repeated_ids(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    a, b, c, d, e = map(words, range(5))
    docs = spark.createDataFrame(
        [(None, a, "en", "s", 1), (7, a, "en", "s", 1), (None, a, None, "s", 1),  # the group has an id
         (None, b, "en", None, 1), (None, b, None, "en", 1), (None, b, None, "en", 1),  # null ids only
         (3, c, "en", "s", 1), (3, c, "en", "s", 1), (3, c.upper(), "en", "s", 1),  # one id, near and equal copies
         (3, d, "en", "s", 1), (2, d, "en", "s", 1),  # shares the id of another group's smallest
         (3, e, "en", "s", 1)],  # one id, another text, alone
        schema,
    )
    kept = pipeline.simhash_near_dedup(spark, docs, SF)
    rows = [(r.doc_id, r.text.lower()) for r in kept.collect()]
    assert sorted(rows, key=str) == sorted([(7, a), (None, b), (3, c), (2, d), (3, e)], key=str)
    again = pipeline.simhash_near_dedup(spark, docs.repartition(3), SF)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, kept.collect()), key=str)


def test_repeated_lines_of_rows_without_id(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    lines = "one\ntwo\nthree"
    docs = spark.createDataFrame([(None, f"{lines}\nx", "en", "s", 0), (None, f"{lines}\ny", "en", "s", 0), (4, f"{lines}\nz", "en", "s", 0)], schema)
    got = sorted(r.text for r in pipeline.line_dedup(spark, docs, SF).collect())
    assert got == [f"{lines}\nz", "x", "y"]
    alone = sorted(r.text for r in pipeline.line_dedup(spark, docs.filter("doc_id IS NULL"), SF).collect())
    assert sorted(map(len, alone)) == [1, len(lines) + 2]
