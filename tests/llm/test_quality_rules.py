import numpy as np
from brute import rule_stats
from hypothesis import given, settings, strategies as st

from wardbook.llm import quality_rules as qr
from wardbook.llm.common import read

SF = "/root/testdata/sf0.01"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", "#x", " ", "\n", "\t", " ", "\x1c", "|"]), max_size=120).map(" ".join))
def test_stats_equal_plain_counts(text):
    assert qr.rule_stats(text)[:5] == rule_stats(text)


def test_whole_table(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    rows = {r.doc_id: r for r in qr.quality_rules(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert rows.keys() == texts.keys()
    for d, r in rows.items():
        want = rule_stats(texts[d])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)
    marks = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in rows}
    good = [rows[d].kept for d, q in marks.items() if q == 1 and not rows[d].base_failed]
    bad = [rows[d].kept for d, q in marks.items() if q == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.1
    kept = {r.doc_id for r in qr.keep_good(docs, labels).collect()}
    assert kept == {d for d, r in rows.items() if r.kept}


def test_forest_path_lengths():
    rng = np.random.default_rng(1)
    good = np.column_stack([rng.normal(0.1, 0.01, 500), np.zeros(500)])
    forest = qr.Forest.fit(good, np.zeros(2), np.ones(2), trees=50, sample=128, seed=1)
    far, near = forest.score(np.array([[0.1, 0.9], [0.9, 0.0]])), forest.score(good)
    assert far.min() > np.quantile(near, 0.99)


def plain_score(forest, row):
    """The anomaly of one row: every tree walked node by node, leaves found by pointing at themselves."""
    total = 0.0
    for t in range(len(forest.path)):
        node, depth = 0, 0
        while forest.left[t, node] != node:
            node = forest.left[t, node] if row[forest.feature[t, node]] <= forest.threshold[t, node] else forest.right[t, node]
            depth += 1
        assert depth <= forest.path[t, node] <= depth + forest.scale + 1
        total += forest.path[t, node]
    return 2.0 ** (-total / len(forest.path) / forest.scale)


def test_mean_paths_are_those_of_random_trees():
    """The expected depth of an unsuccessful search, by its recurrence over all first cuts."""
    exact = {0: 0.0, 1: 0.0}
    for n in range(2, 200):
        # A random cut leaves k of n on one side; a search goes to either in proportion.
        exact[n] = 1 + sum((k * exact[k] + (n - k) * exact[n - k]) / n for k in range(1, n)) / (n - 1)
    assert qr._mean_path(2) == exact[2] == 1
    for n in (10, 50, 199):  # the harmonic numbers in it are approximate
        assert abs(float(qr._mean_path(n)) - exact[n]) < 1.2 / n


def test_scores_and_threshold_equal_plain_code(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    stats = qr.document_stats(docs)
    model = qr.fit(stats, labels)
    rows = {r.doc_id: r for r in qr.judged(stats, model).collect()}
    score = {}
    for d, r in rows.items():
        words, chars, symbols, dup, rep, lines = (getattr(r, c) for c in qr.STATS)
        rates = [symbols / chars if chars else 0.0, symbols / words if words else 0.0, dup / lines if lines else 0.0, rep / words if words else 0.0]
        score[d] = plain_score(model.forest, rates)
        assert abs(r.anomaly - score[d]) < 1e-9
    worst = {}
    for r in labels.collect():
        if r.quality is not None and r.doc_id in rows and not rows[r.doc_id].base_failed:
            worst[r.doc_id] = min(r.quality, worst.get(r.doc_id, 1))
    good = sorted(score[d] for d, q in worst.items() if q > 0)
    bad = sorted(score[d] for d, q in worst.items() if q == 0)

    def gain(cut):
        lost, caught = sum(s > cut for s in good) / len(good), sum(s > cut for s in bad) / len(bad)
        return caught - lost if lost <= 0.005 else -1.0

    best = max(gain(k / qr.BINS) for k in range(qr.BINS + 1))
    assert abs(gain(model.highest) - best) < 1e-9 and best > 0
    for d, r in rows.items():
        assert r.kept == (not r.base_failed and score[d] <= model.highest)


def test_odd_rows(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame(
        [(0, None, 1), (1, "", 2), (2, text, 3), (2, text, 3), (None, text, 4), (5, "x " * 300_000, 5)],
        "doc_id bigint, text string, quality int",
    )
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    odd = spark.createDataFrame([(2, None), (None, 1), (2, 1), (2, 0)], "doc_id bigint, quality int")
    for labels in (none, odd):
        got = sorted([(r.doc_id is None, r.doc_id, r.kept) for r in qr.quality_rules(docs, labels).collect()], key=str)
        assert [k for *_, k in got].count(True) == 3 and len(got) == 6
        kept = qr.keep_good(docs, labels)
        assert kept.columns == docs.columns and kept.count() == 3
    assert qr.quality_rules(docs.limit(0), odd).count() == 0
