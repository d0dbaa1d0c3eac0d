import itertools
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardbook.llm.common import read
from wardbook.llm.neighbours import _units, balanced_partition, best_of, build_index, inner_neighbours, search
from wardbook.llm.queries import op12_embedding_whitening, op13_nearest_neighbours
from wardbook.llm.whitening import Whitening, bit_planes, cross_products, whiten

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id bigint, embedding array<double>, label int, x string, n string, ids string, score int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "n", "i", 0) for i, v in rows], VECTORS)


def vectors_of(spark):
    rows = read(spark, SF, "embeddings").collect()
    return [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)


# --- whitening -------------------------------------------------------------------------


@pytest.mark.parametrize("bits,rows", [([1, 9, 4, 0], 1), ([9, 9, 9, 3], 130), ([64, 63, 2, 40], 77), ([12, 5, 33, 1], 64)])
def test_cross_products_are_exact(bits, rows):
    rng = np.random.default_rng(rows)
    columns = [[int(rng.integers(0, 1 << 32)) << 32 | int(rng.integers(0, 1 << 32)) for _ in range(rows)] for _ in bits]
    columns = [[v & ((1 << b) - 1) for v in c] for c, b in zip(columns, bits)]
    limbs = cross_products(bit_planes(np.array(columns, np.uint64).T, bits), bits)
    for i, j in itertools.combinations_with_replacement(range(len(bits)), 2):
        assert sum(int(v) << (32 * k) for k, v in enumerate(limbs[i, j])) == sum(a * b for a, b in zip(columns[i], columns[j]))


def whitening_by_fractions(rows, scale=256, components=4):
    """Covariance by rational numbers; only eigenvectors are in doubles."""
    x = {i: [math.floor(scale * Fraction(c)) for c in v] for i, v in rows}
    fit = sorted({tuple(v) for v in x.values()})
    n, dims = len(fit), len(fit[0])
    s = [sum(v[d] for v in fit) for d in range(dims)]
    cov = [[sum((v[i] - Fraction(s[i], n)) * (v[j] - Fraction(s[j], n)) for v in fit) / n for j in range(dims)] for i in range(dims)]
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    out = {}
    for i, v in x.items():
        centred = np.array([float(v[d] - Fraction(s[d], n)) for d in range(dims)])
        whole = sum((n * v[d] - s[d]) ** 2 for d in range(dims))
        for k in range(min(components, dims)):
            e = values[-1 - k]
            out[i, k + 1] = (n, whole, float(centred @ vectors[:, -1 - k] / math.sqrt(e)), e / float(sum(cov[d][d] for d in range(dims))))
    return out


def same_whitening(got, want):
    by_key = {(r.vec_id, r.component): r for r in got}
    assert set(by_key) == set(want)
    for c in {k for _, k in want}:
        pairs = [(by_key[key].whitened, w[2]) for key, w in want.items() if key[1] == c]
        assert min(max(abs(a - b) for a, b in pairs), max(abs(a + b) for a, b in pairs)) < 1e-9
    for key, (n, deviation, _, explained) in want.items():
        r = by_key[key]
        assert (r.n, r.deviation) == (n, deviation) and abs(r.explained - explained) < 1e-9 and r.identity_error < 1e-9


def test_whitening_equals_rational_arithmetic(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * [9, 5, 3, 1, 0.5, 0.2] + [0, 1e6, -3, 0, 0, 0]).tolist()) for i in range(200)]
    rows += [(1000 + i, v) for i, v in rows[:40]] + [(2000 + i, rows[0][1]) for i in range(300)]
    same_whitening(whiten(table(spark, rows).repartition(5)).collect(), whitening_by_fractions(rows))


def test_whitening_of_whole_table(spark):
    ids, v = vectors_of(spark)
    got = op12_embedding_whitening(spark, SF).collect()
    assert len(got) == 4 * len(ids)
    same_whitening(got, whitening_by_fractions(list(zip(ids, v.tolist()))))


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    assert whiten(table(spark, [])).collect() == []
    assert whiten(table(spark, [(1, [1.0, 2.0])] * 5 + [(2, None), (3, [nan, 1.0]), (4, [1.0, None]), (5, [inf, 0.0]), (6, [-inf, 0.0])])).collect() == []
    assert whiten(table(spark, [(1, []), (2, [])])).collect() == []
    # A shorter vector is ended by zeros, an id may be null or repeated, minus zero is zero.
    rows = [(None, [1.0]), (1, [-0.0, 3.0]), (1, [-0.0, 3.0]), (2, [2.0, 1.0, 0.5]), (3, [0.0, 3.0])]
    got = whiten(table(spark, rows)).collect()
    assert sorted({(r.component, r.n) for r in got}) == [(1, 3), (2, 3)]
    assert len(got) == 10 and len({r.whitened for r in got if r.component == 1 and r.vec_id in (1, 3)}) == 1


def test_whitening_of_huge_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [5e15, 2.0])]
    got = {(r.vec_id, r.component): r for r in whiten(table(spark, rows)).collect()}
    assert got[1, 1].deviation is None and got[1, 1].n == 3 and got[1, 1].identity_error < 1e-9
    by = Whitening(3, [0], [10], [12], np.ones((1, 1)), [1.0])
    assert by.deviation(by.centred(np.array([[10], [0]]))) == [18 * 18, 12 * 12]


# --- neighbours ------------------------------------------------------------------------


def nearest_by_hand(queries, rows, k=20):
    """The k nearest of each query among rows that don't share its id."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = []
    for q, w in {(i, tuple(v)) for i, v in queries if (i, v) in usable}:
        scored = {(-math.fsum(a * b for a, b in zip(w, v)), i) for i, v in usable if i != q}
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_parts_are_balanced_and_better_than_chance():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(16, 24))[rng.integers(0, 16, 1600)] + 0.3 * rng.normal(size=(1600, 24))
    graph = inner_neighbours(points, 10)
    part = balanced_partition(points, graph, 8)
    assert np.bincount(part, minlength=8).max() <= math.ceil(1600 / 8 * 1.05)
    assert (part[graph] == part[:, None]).mean() > 0.5 > 1 / 8


def test_inner_neighbours():
    points = np.random.default_rng(1).normal(size=(60, 5))
    scores = points @ points.T - np.diag(np.full(60, np.inf))
    want = [set(np.argsort(-s)[:4].tolist()) for s in scores]
    assert [set(r.tolist()) for r in inner_neighbours(points, 4, block=17)] == want


def test_best_of_keeps_ties():
    points = np.array([[1.0, 0], [0, 1], [1, 0.0], [0.5, 0.5]])
    every = np.ones((1, 4), bool)
    assert list(best_of(np.array([[1.0, 1.0]]), points, 2, every)) == [(0, [0, 1, 2, 3], [1.0] * 4)]
    some = np.array([[False, True, False, True]])
    assert list(best_of(np.array([[2.0, 1.0]]), points, 3, some)) == [(0, [1, 3], [1.0, 1.5])]
    assert list(best_of(np.array([[2.0, 1.0]]), points, 3, ~every)) == [(0, [], [])]


def test_units_hold_neighbouring_cells():
    assert _units(np.array([3, 4, 2, 9, 1, 1]), 8).tolist() == [0, 0, 1, 2, 3, 3]


@pytest.mark.parametrize("block_rows", [40, 200])
def test_recall_of_whole_table_in_cells(spark, block_rows):
    ids, v = vectors_of(spark)
    rows = read(spark, SF, "embeddings")
    asked = F.col("vec_id") % 20 == 0
    index = build_index(rows, queries=asked, cell_rows=60, block_rows=block_rows)
    assert index.routing.router is not None and len(index.units) == 8 and index.recall >= 0.95
    got = search(index, rows.filter(asked), query_rows=10).collect()
    want = nearest_by_hand([(i, w) for i, w in zip(ids, v.tolist()) if i % 20 == 0], list(zip(ids, v.tolist())))
    pairs = {(r.query_id, r.vec_id): r.score for r in got}
    assert len(pairs) == len(got) == len(want)
    assert sum((q, i) in pairs for q, _, i, _ in want) / len(want) >= 0.9
    place = {i: k for k, i in enumerate(ids)}
    assert all(s == math.fsum(v[place[q]] * v[place[i]]) for (q, i), s in pairs.items())


def test_query_of_whole_table(spark):
    ids, v = vectors_of(spark)
    rows = list(zip(ids, v.tolist()))
    got = sorted(map(tuple, op13_nearest_neighbours(spark, SF).collect()))
    assert got == nearest_by_hand([r for r in rows if r[0] % 20 == 0], rows)  # one cell: exact


def test_copies_ties_and_unusable_vectors(spark):
    nan = float("nan")
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(100 + i, [0.0, 1.0]) for i in range(5)] + [(7, [1.0, 0.0])]
    rows += [(200, [0.0, 0.0]), (220, None), (240, [nan, 1.0]), (260, [1.0, None]), (280, []), (300, [0.5, 0.5])]
    asked = F.col("vec_id") % 20 == 0
    got = search(build_index(table(spark, rows), queries=asked), table(spark, rows).filter(asked))
    queries = [r for r in rows if r[0] % 20 == 0]
    assert sorted(map(tuple, got.collect())) == nearest_by_hand(queries, rows)


def test_few_or_no_vectors(spark):
    asked = F.col("vec_id") % 20 == 0
    for rows in ([], [(20, [1.0])], [(20, None)], [(1, [1.0]), (2, [2.0])], [(0, [1.0, 2.0]), (3, [4.0]), (None, [1.0, 1.0])]):
        got = search(build_index(table(spark, rows), queries=asked), table(spark, rows).filter(asked)).collect()
        assert [tuple(r) for r in got] == ([(0, 1, 3, 4.0), (0, 2, None, 3.0)] if len(rows) == 3 else [])
