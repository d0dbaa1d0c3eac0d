"""Approximate nearest neighbours by learned partitions of a neighbour graph."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wardbook.llm.common import drawn, run_folder, stored


def inner_neighbours(points: np.ndarray, k: int, block: int = 1024) -> np.ndarray:
    """For every point the ``k`` others with the largest inner products."""
    found = np.empty((len(points), k), np.int64)
    for at in range(0, len(points), block):
        scores = points[at : at + block] @ points.T
        scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
        found[at : at + block] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return found


def balanced_partition(points: np.ndarray, graph: np.ndarray, parts: int, *, slack: float = 0.05, rounds: int = 20, seed: int = 7) -> np.ndarray:
    """A part for every node of a neighbour graph: few edges between parts, all of about one size.

    Points are halved at medians along random directions until there are enough parts; then
    nodes move, those with most to gain first, to the part that holds most of their
    neighbours, as long as no part exceeds its share by more than ``slack``.
    """
    rng, n = np.random.default_rng(seed), len(points)
    part = np.zeros(n, np.int64)
    todo = [(np.arange(n), 0, parts)]
    while todo:
        nodes, first, count = todo.pop()
        if count == 1:
            part[nodes] = first
            continue
        half = count // 2
        order = nodes[np.argsort(points[nodes] @ rng.normal(size=points.shape[1]), kind="stable")]
        cut = len(nodes) * half // count
        todo += [(order[:cut], first, half), (order[cut:], first + half, count - half)]
    most = math.ceil(n / parts * (1 + slack))
    held = np.bincount(part, minlength=parts)
    # Neighbours count in both directions.
    a = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])
    b = np.concatenate([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])
    for _ in range(rounds):
        near = np.bincount(a * parts + part[b], minlength=n * parts).reshape(n, parts)
        better, gain = near.argmax(axis=1), near.max(axis=1) - near[np.arange(n), part]
        moved = 0
        for node in np.argsort(-gain, kind="stable"):
            if gain[node] <= 0:
                break
            to = better[node]
            if held[to] < most and rng.random() < 0.7:  # not all at once, or neighbours swap places for ever
                held[part[node]] -= 1
                held[to] += 1
                part[node] = to
                moved += 1
        if moved < n / 500:
            break
    return part


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer: the probability that a vector's neighbours are in each part."""

    hidden: tuple[np.ndarray, np.ndarray]
    out: tuple[np.ndarray, np.ndarray]

    def __call__(self, points: np.ndarray) -> np.ndarray:
        z = np.maximum(points @ self.hidden[0] + self.hidden[1], 0) @ self.out[0] + self.out[1]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train_router(points: np.ndarray, targets: np.ndarray, *, width: int = 128, epochs: int = 30, rate: float = 2e-3, seed: int = 7) -> Router:
    """Cross-entropy against ``targets`` (a distribution a row), by Adam over batches of 256."""
    rng = np.random.default_rng(seed)
    (n, d), parts = points.shape, targets.shape[1]
    size = np.sqrt((points**2).mean()) or 1.0
    w = [rng.normal(size=(d, width)) / (size * np.sqrt(d)), np.zeros(width), rng.normal(size=(width, parts)) * 0.1 / np.sqrt(width), np.zeros(parts)]
    # Weights of the first layer are as large as the entries are small, and so are their steps.
    steps = [rate / size, rate, rate, rate]
    mean, spread, t = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            x, y = points[order[at : at + 256]], targets[order[at : at + 256]]
            h = np.maximum(x @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            g = (p / p.sum(axis=1, keepdims=True) - y) / len(x)
            back = (g @ w[2].T) * (h > 0)
            t += 1
            for k, grad in enumerate((x.T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0))):
                mean[k] = 0.9 * mean[k] + 0.1 * grad
                spread[k] = 0.999 * spread[k] + 0.001 * grad**2
                w[k] = w[k] - steps[k] * (mean[k] / (1 - 0.9**t)) / (np.sqrt(spread[k] / (1 - 0.999**t)) + 1e-8)
    return Router((w[0], w[1]), (w[2], w[3]))


def fit_router(sample: np.ndarray, parts: int, *, links: int = 10) -> Router:
    """Partition the sample's neighbour graph and learn where a vector's neighbours lie."""
    graph = inner_neighbours(sample, min(links, len(sample) - 1))
    part = balanced_partition(sample, graph, parts)
    targets = np.zeros((len(sample), parts))
    np.add.at(targets, (np.arange(len(sample)), part), 1.0)
    for column in graph.T:
        np.add.at(targets, (np.arange(len(sample)), part[column]), 1.0)
    return train_router(sample, targets / targets.sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy().reshape(-1, dims)


def _exact(q: np.ndarray, c: np.ndarray) -> float:
    """The inner product, rounded once; a plain sum where it exceeds doubles."""
    products = (q * c).tolist()
    try:
        return math.fsum(products)
    except (OverflowError, ValueError):
        return float(np.sum(products))


def best_of(queries: np.ndarray, points: np.ndarray, k: int, visits: np.ndarray) -> Iterator[tuple[int, list[int], list[float]]]:
    """For every query the points that can be among its ``k`` nearest, with exact products.

    ``visits`` says which points a query looks at.
    """
    scores = np.where(visits, queries @ points.T, -np.inf)
    k = min(k, len(points))
    least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    # A matrix product is off by less than this; points as near as the last one are all kept.
    margin = 1e-13 * (1 + points.shape[1]) * np.abs(queries).max(axis=1) * np.abs(points).max() * points.shape[1]
    for i in range(len(queries)):
        at = np.flatnonzero(visits[i] & ~(scores[i] < least[i] - margin[i]))
        exact = [_exact(queries[i], points[j]) for j in at]
        last = sorted(exact, reverse=True)[: k][-1] if exact else 0.0
        keep = [(j, s) for j, s in zip(at.tolist(), exact) if s >= last]
        yield i, [j for j, _ in keep], [s for _, s in keep]


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str, also: Column | None = None) -> tuple[DataFrame, int]:
    """(id, v) of vectors that take part, as doubles, ended by zeros to one length; and the length.

    ``also`` is a condition on the table that becomes the column ``asked``.
    """
    fine = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.filter(F.col(vector_col).isNotNull() & fine & F.exists(vector_col, lambda c: c != 0))
    more = [] if also is None else [also.alias("asked")]
    rows = rows.select(F.col(id_col).alias("id"), F.transform(vector_col, lambda c: c.cast("double")).alias("v"), *more)
    dims = rows.agg(F.max(F.size("v")).alias("d")).first().d or 0
    return rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("v")))), dims


@dataclass(frozen=True)
class Routing:
    """Which cells a query visits: by falling probability until the cells before hold ``mass``
    of it, and at least as many as it takes to hold more than ``k`` vectors."""

    router: Router | None
    sizes: np.ndarray
    k: int
    mass: float = 1.0

    def __call__(self, queries: np.ndarray) -> np.ndarray:
        if self.router is None:
            return np.ones((len(queries), 1), bool)
        p = self.router(queries)
        order = np.argsort(-p, axis=1, kind="stable")
        sorted_p, sorted_sizes = np.take_along_axis(p, order, 1), self.sizes[order]
        before, held = np.cumsum(sorted_p, axis=1) - sorted_p, np.cumsum(sorted_sizes, axis=1) - sorted_sizes
        visits = np.zeros(p.shape, bool)
        np.put_along_axis(visits, order, (before <= self.mass) | (held <= self.k), 1)
        return visits & (self.sizes > 0)


@dataclass(frozen=True)
class Index:
    """Distinct vectors by cell: (``v``, ``ids``, ``cell``, ``unit``, ``block``), and how queries find them.

    ``ids`` are the smallest of a vector's ids, one more than neighbours are asked for.
    Small cells share a unit, named by ``units`` for each cell; ``blocks`` is the number of
    blocks of each unit. ``recall`` is the share of the calibrating queries' neighbours,
    found by brute force, that the routing reaches.
    """

    table: DataFrame
    dims: int
    routing: Routing
    units: np.ndarray
    blocks: np.ndarray
    recall: float


def _assigned(points: DataFrame, router: Router | None, dims: int) -> DataFrame:
    """With the most probable cell of every vector."""
    if router is None:
        return points.withColumn("cell", F.lit(0))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = router(_matrix(batch.column("v"), dims)).argmax(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    return points.mapInArrow(assign, T.StructType([*points.schema, T.StructField("cell", T.IntegerType())]))


def _calibrated(table: DataFrame, asked: np.ndarray, router: Router, dims: int, k: int, recall: float) -> tuple[float, float]:
    """The least probability mass that finds ``recall`` of the queries' true neighbours, and what it finds.

    Brute force over all vectors for a bounded number of queries, the nearest of each batch
    combined by query.
    """

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = asked @ _matrix(batch.column("v"), dims).T
            top = np.argpartition(-scores, min(k, scores.shape[1] - 1), axis=1)[:, : k + 1]
            q = np.repeat(np.arange(len(asked), dtype=np.int32), top.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(q), pa.array(np.take_along_axis(scores, top, 1).ravel()), batch.column("cell").take(pa.array(top.ravel()))],
                ["q", "score", "cell"],
            )

    found = table.select("v", "cell").mapInArrow(nearest, "q int, score double, cell int")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "cell"))
    # The query's own vector comes first where it is the nearest; it is left out there, else the last one.
    true = found.withColumn("rank", rank).filter(F.col("rank") <= k + 1).select("q", "score", "cell").collect()
    by_query: dict[int, list] = {}
    for r in true:
        by_query.setdefault(r.q, []).append((r.score, r.cell))
    p = router(asked)
    mass = []
    for q, near in by_query.items():
        near, own = sorted(near, reverse=True), float(asked[q] @ asked[q])
        mine = next((n for n in near if abs(n[0] - own) <= 1e-9 * max(own, 1e-300)), None)
        if mine:
            near.remove(mine)
        mass += [float(p[q][p[q] > p[q][cell]].sum()) for _, cell in near[:k]]
    if not mass:
        return 1.0, 1.0
    least = float(np.quantile(mass, recall, method="higher"))
    return least, float((np.array(mass) <= least).mean())


def build_index(
    vectors: DataFrame,
    *,
    queries: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    recall: float = 0.95,
    fit_rows: int = 16_384,
    calibrating: int = 256,
    cell_rows: int = 2048,
    max_cells: int = 256,
    block_rows: int = 8192,
    folder: str | None = None,
) -> Index:
    """Index every usable vector by learned cells.

    Fitted on about ``fit_rows`` distinct vectors, drawn by a hash: their neighbour graph is
    cut into balanced parts, one for ``cell_rows`` vectors of the table and ``max_cells`` at
    most, and a small network learns in which parts a vector's neighbours are. All vectors
    are then assigned to cells. How many cells a query visits is calibrated on about
    ``calibrating`` queries (vectors for which ``queries`` holds), whose true neighbours
    among all vectors are found by brute force: the index reaches ``recall`` on them.

    Equal vectors are one row of the index with their smallest ids; copies meet before their
    shuffle. Small cells meet queries together, up to ``block_rows`` vectors, so that a query
    gets one list of nearest from all of them; a larger cell is split into blocks of about
    that many, so its size is no task's size. Null vectors, zero vectors and vectors with null or non-finite entries take
    no part; a shorter vector counts as ended by zeros; further columns are ignored.
    """
    spark = vectors.sparkSession
    folder = folder or run_folder(spark, "neighbours")
    rows, dims = usable_vectors(vectors, id_col, vector_col, also=F.lit(True) if queries is None else queries)
    rows = rows.withColumn("h", F.xxhash64("v"))
    # The k + 1 smallest ids of a vector are all that k neighbours can need. Ranked before and after the shuffle.
    rank = F.row_number().over(Window.partitionBy("h", "v").orderBy(F.col("id").asc_nulls_last()))
    few = rows.select("h", "v", "id").distinct().withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    ids = F.transform(F.sort_array(F.collect_list(F.struct("rank", "id"))), lambda x: x["id"]).alias("ids")
    points = stored(few.groupBy("h", "v").agg(ids), f"{folder}/points")
    n = points.count()
    parts = max(1, min(max_cells, n // cell_rows))
    router = None
    if parts > 1:
        sample = np.array([r.v for r in drawn(points.select("h", "v"), "h", fit_rows).select("v").collect()])
        router = fit_router(sample, parts)
    placed = stored(_assigned(points, router, dims), f"{folder}/cells")
    sizes = np.zeros(parts, np.int64)
    for r in placed.groupBy("cell").count().collect():  # at most max_cells rows
        sizes[r.cell] = r["count"]
    units = _units(sizes, block_rows)
    blocks = np.maximum(1, -(-np.bincount(units, weights=sizes).astype(np.int64) // block_rows))
    mass, reached = 1.0, 1.0
    if router is not None:
        asked = np.array([r.v for r in drawn(rows.filter("asked").select("h", "v").distinct(), "h", calibrating, seed=29).select("v").collect()])
        if len(asked):
            mass, reached = _calibrated(placed, asked, router, dims, k, recall)
    block = F.pmod(F.xxhash64("h", F.lit(3)), _of(blocks, "unit")).cast("int")
    table = placed.withColumn("unit", _of(units, "cell")).withColumn("block", block)
    return Index(table, dims, Routing(router, sizes, k, mass), units, blocks, reached)


def _units(sizes: np.ndarray, rows: int) -> np.ndarray:
    """Neighbouring cells together up to ``rows`` vectors; a cell with more is a unit of its own."""
    units, held = np.zeros(len(sizes), np.int64), 0
    for cell in range(1, len(sizes)):
        held += sizes[cell - 1]
        fresh = held + sizes[cell] > rows
        units[cell] = units[cell - 1] + fresh
        held = 0 if fresh else held
    return units


def _of(values: np.ndarray, number: str) -> Column:
    """Entry of a small array (one a cell or unit)."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col(number) + 1)


def search(
    index: Index, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", query_rows: int = 2048, folder: str | None = None
) -> DataFrame:
    """The ``k`` nearest of every query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    ``queries`` have ids and vectors; a row of the index with a query's id is not its
    neighbour. Nearest is the largest inner product of the vectors as given, in doubles and
    rounded once; equal products are ordered by id, null ids last. Where there are fewer
    others, a query gets all of them; equal query rows count once, and so do equal rows of
    the index. An empty table on either side gives no rows.

    Distinct query vectors are routed to cells and meet each block of these in blocks of
    ``query_rows``; a task sees one block of either. A block's best are combined by query.
    """
    spark = queries.sparkSession
    folder = folder or run_folder(spark, "neighbours")
    dims, routing, k = index.dims, index.routing, index.routing.k
    index_units, index_blocks = index.units, index.blocks  # tasks cannot carry the table
    rows, width = usable_vectors(queries, id_col, vector_col)
    if width > dims:
        raise ValueError(f"queries have {width} dimensions, the index {dims}")
    rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), dims - width))).withColumn("h", F.xxhash64("v"))
    kind = rows.schema["id"].dataType.simpleString()
    result = f"query_id {kind}, rank int, vec_id {kind}, score double"
    if not dims:
        return spark.createDataFrame([], result)
    asked = stored(
        rows.select("h", "v").distinct().withColumn("q", F.monotonically_increasing_id()), f"{folder}/asked"
    )  # numbers are fixed when written

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                visits = routing(_matrix(batch.column("v"), dims))
                at, unit, cells = [], [], []
                for u in range(len(index_blocks)):
                    own = np.flatnonzero(index_units == u)
                    for i in np.flatnonzero(visits[:, own].any(axis=1)):
                        at.append(i)
                        unit.append(u)
                        cells.append(own[visits[i, own]])
                rows = batch.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("q"), rows.column("v"), pa.array(unit, pa.int32()), pa.array(cells, pa.list_(pa.int32()))], ["q", "v", "unit", "cells"]
                )

    made = "q bigint, v array<double>, unit int, cells array<int>"
    routed = stored(asked.select("q", "v").mapInArrow(route, made), f"{folder}/routed")
    visits = np.zeros(len(index.blocks), np.int64)
    for r in routed.groupBy("unit").count().collect():  # at most max_cells rows
        visits[r.unit] = r["count"]
    slices = np.maximum(1, -(-visits // query_rows))
    in_slice = F.pmod(F.xxhash64("q"), _of(slices, "unit")).cast("int")
    each = lambda counts, name: F.explode(F.sequence(F.lit(0), _of(counts, "unit") - 1)).alias(name)
    left = routed.withColumn("slice", in_slice).select("q", "v", "cells", "unit", "slice", each(index.blocks, "block"))
    right = index.table.select(F.col("v").alias("c"), "ids", "cell", "unit", "block", each(slices, "slice"))

    def meet(_, a: pa.Table, b: pa.Table) -> pa.Table:
        out_q, out_id, out_score = [], [], []
        if a.num_rows and b.num_rows:
            q, ids, cell = a.column("q").to_pylist(), b.column("ids").to_pylist(), b.column("cell").to_numpy()
            visits = np.zeros((len(q), len(index_units)), bool)
            for i, cells in enumerate(a.column("cells").to_pylist()):
                visits[i, cells] = True
            for i, near, scores in best_of(_matrix(a.column("v"), dims), _matrix(b.column("c"), dims), k + 1, visits[:, cell]):
                own = sorted(((-s, x is None, x) for j, s in zip(near, scores) for x in ids[j]), key=lambda y: (y[0], y[1], y[2] or 0))[: k + 1]
                out_q += [q[i]] * len(own)
                out_id += [x for _, _, x in own]
                out_score += [-s for s, _, _ in own]
        return pa.table({"q": pa.array(out_q, pa.int64()), "id": pa.array(out_id, b.schema.field("ids").type.value_type), "score": pa.array(out_score, pa.float64())})

    keys = ["unit", "block", "slice"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, f"q bigint, id {kind}, score double")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    top = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k + 1)
    near = top.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("near"))
    # Stored, so that the joins read plain shuffles and split a hot query vector.
    near = stored(
        near.withColumnRenamed("q", "_q").join(asked.hint("merge"), F.col("_q") == F.col("q")).select(F.col("h").alias("_h"), F.col("v").alias("_v"), "near"),
        f"{folder}/near",
    )
    answered = rows.distinct().join(near.hint("merge"), (F.col("h") == F.col("_h")) & (F.col("v") == F.col("_v")))
    others = F.slice(F.filter("near", lambda x: ~x["id"].eqNullSafe(F.col("id"))), 1, k)
    return answered.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "n")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("n.id").alias("vec_id"), F.col("n.score").alias("score")
    )
