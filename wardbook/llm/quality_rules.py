"""Quality rules: rule statistics per document, judged by an isolation forest."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardbook.llm.common import drawn, run_folder, stored

BLANKS = " \t\n\x0b\x0c\r"  # the characters that separate words
SYMBOLS = b"#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
BINS = 10_000


def repeat_words(words: list[bytes], size: int = 5) -> int:
    """Words inside windows of ``size`` words that occur twice or more, first ones included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    order = np.argsort(rolled)
    equal = rolled[order[1:]] == rolled[order[:-1]]
    if not equal.any():
        return 0
    # Equal hashes are candidates; the words themselves decide.
    maybe = order[np.append(equal, False) | np.insert(equal, 0, False)].tolist()
    windows = [tuple(words[i : i + size]) for i in maybe]
    seen = Counter(windows)
    covered = np.zeros(len(words), bool)
    starts = np.array([i for i, w in zip(maybe, windows) if seen[w] > 1], np.int64)
    for k in range(size):
        covered[starts + k] = True
    return int(covered.sum())


def rule_stats(text: str | None) -> tuple[int, ...]:
    """The values named in ``STATS``; a null text has no words and no lines."""
    if not text:
        return (0,) * len(STATS)
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    lines = text.split("\n")
    worded = [line for line in lines if line.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(raw.count(c) for c in SYMBOLS),
        len(worded) - len(set(worded)),
        repeat_words(words),
        len(worded),
    )


def features(stats: np.ndarray) -> np.ndarray:
    """Rates from columns in the order of ``STATS``; what has no words has rate 0."""
    words, chars, symbols, dup, rep, lines = stats.astype(np.float64).T
    share = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=b > 0)
    return np.column_stack([share(symbols, chars), share(symbols, words), share(dup, lines), share(rep, words)])


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Expected path length of an unsuccessful search among ``n`` values."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), (n == 2) * 1.0)


@dataclass(frozen=True)
class Forest:
    """Trees as arrays of shape (trees, nodes); a leaf points at itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    height: int
    scale: float

    @classmethod
    def fit(cls, x: np.ndarray, low: np.ndarray, high: np.ndarray, *, trees: int, sample: int, seed: int) -> Forest:
        """Grown on ``x``, with cuts drawn over the box from ``low`` to ``high``.

        The box spans bad documents too, so a rate that no good document has still gets
        cuts; what lies on their empty side ends there, after a short path.
        """
        rng = np.random.default_rng(seed)
        sample = min(sample, len(x))
        height = max(1, int(np.ceil(np.log2(max(sample, 2)))))
        size = 2 ** (height + 1)
        feature, left, right = (np.zeros((trees, size), np.int32) for _ in range(3))
        threshold, path = np.zeros((trees, size)), np.zeros((trees, size))
        for t in range(trees):
            stack, used = [(0, rng.choice(len(x), sample, replace=False), 0, low, high)], 1
            while stack:
                node, rows, depth, least, most = stack.pop()
                able = np.flatnonzero(most > least)
                left[t, node] = right[t, node] = node
                path[t, node] = depth + _mean_path(len(rows))
                if depth == height or len(able) == 0 or len(rows) == 0:
                    continue
                f = rng.choice(able)
                cut = rng.uniform(least[f], most[f])
                feature[t, node], threshold[t, node] = f, cut
                below = x[rows, f] <= cut
                left[t, node], right[t, node] = used, used + 1
                under, over = most.copy(), least.copy()
                under[f] = over[f] = cut
                stack += [(used, rows[below], depth + 1, least, under), (used + 1, rows[~below], depth + 1, over, most)]
                used += 2
        return cls(feature, threshold, left, right, path, height, float(max(_mean_path(sample), 1.0)))

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the shorter the mean path, the closer to 1."""
        total, row = np.zeros(len(x)), np.arange(len(x))
        for t in range(len(self.path)):
            node = np.zeros(len(x), np.int32)
            for _ in range(self.height):
                goes = x[row, self.feature[t, node]] <= self.threshold[t, node]
                node = np.where(goes, self.left[t, node], self.right[t, node])
            total += self.path[t, node]
        return 2.0 ** (-total / max(len(self.path), 1) / self.scale)


@dataclass(frozen=True)
class Model:
    """A forest and the highest score that passes; without a forest only the base rules judge."""

    forest: Forest | None
    highest: float = 1.0


def _judge(stats: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base_failed, score, kept)"""
    words, rep = stats[:, 0], stats[:, 4]
    failed = (words < 10) | (100 * rep > 20 * words)
    score = model.forest.score(features(stats)) if model.forest is not None else np.zeros(len(stats))
    return failed, score, ~failed & (score <= model.highest)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATS]).astype(np.int64).reshape(-1, len(STATS))


def document_stats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``STATS`` of every row; further columns are ignored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [rule_stats(v.as_py()) for v in part.column(1)]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(STATS)
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], [id_col, *STATS])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(count, ", ".join([f"`{id_col}` {kind}", *(f"{c} bigint" for c in STATS)]))


def fit(
    stats: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    quality_col: str = "quality",
    fit_rows: int = 8192,
    trees: int = 100,
    sample: int = 256,
    max_good_loss: float = 0.005,
    seed: int = 42,
) -> Model:
    """A forest grown on good documents, and the score above which documents are rejected.

    The forest is fitted on about ``fit_rows`` labelled documents that pass the base rules,
    drawn by a hash of their ids at a rate that follows from their number: it grows on the good ones, in the box that
    all of them span. This bounded sample is all that reaches the driver besides a histogram. The threshold counts all labelled documents: their scores
    are binned (at most 2 x 10,001 rows) and the cut is taken where most bad documents
    above it stand against good ones, with at most ``max_good_loss`` of the good ones
    above; among equally good cuts the middle one. Several labels of a document count as
    the lowest; null labels do not count. Without good labels there is no forest; without
    bad ones nothing is rejected by it.
    """
    marks = labels.select(F.col(id_col).alias("_id"), F.col(quality_col).alias("_q")).dropna()
    marks = marks.groupBy("_id").agg((F.min("_q") > 0).alias("good"))
    known = stats.join(marks, F.col(id_col) == F.col("_id")).filter("n_words >= 10 AND 100 * n_repeat_words <= 20 * n_words")
    chosen = drawn(known, id_col, fit_rows).select(*STATS, "good").toPandas()
    rates, good = features(chosen[list(STATS)].to_numpy(np.int64)), chosen["good"].to_numpy(bool)
    if not good.any():
        return Model(None)
    forest = Forest.fit(rates[good], rates.min(0), rates.max(0), trees=trees, sample=sample, seed=seed)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = forest.score(features(_matrix(batch)))
            bins = pa.array(np.ceil(score * BINS).astype(np.int32))
            yield pa.RecordBatch.from_arrays([bins, batch.column(len(STATS))], ["bin", "good"])

    counted = known.select(*STATS, "good").mapInArrow(binned, "bin int, good boolean").groupBy("bin", "good").count().collect()
    good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
    for row in counted:
        (good if row["good"] else bad)[row["bin"]] += row["count"]
    lost = good.sum() - np.cumsum(good)  # good documents above each bin
    caught = bad.sum() - np.cumsum(bad)
    if not bad.sum():
        return Model(forest, 1.0)
    gain = np.where(lost <= max_good_loss * good.sum(), caught / bad.sum() - lost / good.sum(), -1.0)
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    run = best[best < best[0] + len(best)] if best[-1] - best[0] + 1 == len(best) else best[:1]
    return Model(forest, float((run[0] + run[-1]) // 2) / BINS)


def judged(stats: DataFrame, model: Model, *, id_col: str = "doc_id") -> DataFrame:
    """The statistics with ``base_failed``, ``anomaly`` (the forest's score) and ``kept``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdict = [pa.array(v) for v in _judge(_matrix(batch), model)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *verdict], [*batch.schema.names, "base_failed", "anomaly", "kept"])

    kind = stats.schema[id_col].dataType.simpleString()
    columns = [f"`{id_col}` {kind}", *(f"{c} bigint" for c in STATS), "base_failed boolean", "anomaly double", "kept boolean"]
    return stats.select(id_col, *STATS).mapInArrow(judge, ", ".join(columns))


def quality_rules(docs: DataFrame, labels: DataFrame, *, folder: str | None = None, **options) -> DataFrame:
    """Every document with its rule statistics and whether it is kept.

    Statistics are counted once, where the documents are read, and stored; the forest and
    its threshold come from them (see ``fit`` for ``options``). Null and empty texts have
    no words and fail the base rules. Equal rows are judged alike; rows with null id are
    judged but never used to fit. Further columns are ignored, an empty table gives no rows.
    """
    stats = stored(document_stats(docs), f"{folder or run_folder(docs.sparkSession, 'quality')}/stats")
    return judged(stats, fit(stats, labels, **options))


def keep_good(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", folder: str | None = None, **options) -> DataFrame:
    """The documents that ``quality_rules`` keeps, with all their columns.

    The second reading counts a document's statistics again next to its text, so no text
    is ever shuffled and repeated or null ids need no join.
    """
    stats = stored(document_stats(docs, text_col=text_col), f"{folder or run_folder(docs.sparkSession, 'quality')}/stats")
    model = fit(stats, labels, **options)
    place = docs.columns.index(text_col)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = np.array([rule_stats(v.as_py()) for v in part.column(place)], np.int64).reshape(-1, len(STATS))
                yield part.filter(pa.array(_judge(rows, model)[2]))

    return docs.mapInArrow(passing, docs.schema)
