"""Whitening of vectors by exact cross-products of bit planes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardbook.llm.common import run_folder, stored

LIMB = 32  # bits of a limb of an exact sum
BLOCK = 1 << 16  # rows whose planes are in memory at once


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def bit_planes(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """Planes of unsigned columns, lowest bit first, packed across rows into 64-bit words.

    A column of ``bits[d]`` bits has as many planes; rows past the last are zero.
    """
    planes = np.zeros((sum(bits), -(-len(values) // 64) * 8), np.uint8)
    k = 0
    for d, width in enumerate(bits):
        for bit in range(width):
            plane = np.packbits((values[:, d] >> np.uint64(bit)).astype(np.uint8) & 1, bitorder="little")
            planes[k, : len(plane)] = plane
            k += 1
    return planes.view(np.uint64)


def cross_products(planes: np.ndarray, bits: list[int]) -> np.ndarray:
    """Sums over rows of column i times column j, i <= j, in limbs of ``LIMB`` bits, lowest first.

    The product of planes a and b is the number of bits that both have, times ``2**(a+b)``:
    an AND and a popcount of words. Limbs are carried, so blocks of rows can be added.
    """
    first = np.cumsum([0, *bits])
    owner, power = np.repeat(np.arange(len(bits)), bits), np.arange(len(planes)) - np.repeat(first[:-1], bits)
    limbs = np.zeros((len(bits), len(bits), 2 * max(bits, default=0) // LIMB + 4), np.int64)
    for p, plane in enumerate(planes):
        at = first[owner[p]]  # columns before this one have been paired with it
        counts = np.bitwise_count(planes[at:] & plane).sum(axis=1, dtype=np.int64)
        shift = power[p] + power[at:]
        # At most 2**16 rows and 2**12 pairs of planes of less than 2**LIMB each.
        np.add.at(limbs[owner[p]], (owner[at:], shift // LIMB), counts << (shift % LIMB))
    return carried(limbs)


def carried(limbs: np.ndarray) -> np.ndarray:
    for k in range(limbs.shape[-1] - 1):
        limbs[..., k + 1] += limbs[..., k] >> LIMB
        limbs[..., k] &= (1 << LIMB) - 1
    return limbs


@dataclass(frozen=True)
class Whitening:
    """What maps a vector to its whitened components.

    ``n`` distinct vectors, their least entries, the sums of entries above these, columns
    that map centred entries, and the share of the trace that each explains.
    """

    n: int
    low: list[int]
    high: list[int]
    above: list[int]
    columns: np.ndarray
    explained: list[float]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n times each entry less the sum of its dimension: whole numbers, exact."""
        low = np.array(self.low, np.int64)
        if self.n * max([h - k for h, k in zip(self.high, self.low)], default=0) < 1 << 62:
            return self.n * (x - low) - np.array(self.above, np.int64)
        return self.n * (x.astype(object) - low.astype(object)) - np.array(self.above, object)

    def deviation(self, centred: np.ndarray) -> list[int | None]:
        """Sums of squares; None beyond what 64 bits hold."""
        most = self.n * max([h - k for h, k in zip(self.high, self.low)], default=0)
        if centred.shape[1] * most * most < 1 << 63:
            return (centred * centred).sum(axis=1).tolist()
        exact = centred.astype(object)
        return [int(v) if v < 1 << 63 else None for v in (exact * exact).sum(axis=1)]

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.columns


def scaled(vectors: DataFrame, *, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, x): entries as floors of ``scale`` times their value, of all but unusable vectors.

    Null vectors and vectors with null or non-finite entries go. Floors beyond 64 bits are
    the nearest 64-bit number.
    """
    usable = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    entry = lambda c: F.floor(c.cast("double") * float(scale)).cast("bigint")
    kept = vectors.filter(F.col(vector_col).isNotNull() & usable)
    return kept.select(F.col(id_col).alias("id"), F.transform(vector_col, entry).alias("x"))


def fit_whitening(fit: DataFrame, dims: int, components: int) -> Whitening:
    """Exact covariance of the distinct vectors ``x`` (all of ``dims`` entries), then its eigenvectors."""

    def extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch.column(0), dims)
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(low), pa.array(high)], ["d", "low", "high"])

    ends = fit.mapInArrow(extent, "d int, low bigint, high bigint").groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    ends = sorted(ends.collect())  # a row for each dimension
    if not ends:
        return Whitening(0, [], [], [], np.zeros((dims, 0)), [])
    low, high = [r.low for r in ends], [r.high for r in ends]
    # The last column is one in every row: its products are sums and the number of rows.
    bits = [(h - k).bit_length() for h, k in zip(high, low)] + [1]

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, total = np.array(low, np.int64), None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = _rows(batch.column(0).slice(at, BLOCK), dims)
                above = x.view(np.uint64) - least.view(np.uint64)  # wraps, and so is exact for any two 64-bit numbers
                part = cross_products(bit_planes(np.column_stack([above, np.ones(len(x), np.uint64)]), bits), bits)
                total = part if total is None else carried(total + part)
        if total is not None:
            i, j = np.triu_indices(dims + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(total[i, j, k]) for k in range(total.shape[2])]],
                ["i", "j", *[f"l{k}" for k in range(total.shape[2])]],
            )

    limbs = [f"l{k}" for k in range(2 * max(bits) // LIMB + 4)]
    sums = fit.mapInArrow(scatter, "i int, j int, " + ", ".join(f"{k} bigint" for k in limbs)).groupBy("i", "j")
    sums = sums.agg(*[F.sum(k).alias(k) for k in limbs]).collect()  # a row for each two dimensions
    exact = {(r.i, r.j): sum(r[k] << (LIMB * at) for at, k in enumerate(limbs)) for r in sums}
    n, above = exact[dims, dims], [exact[i, dims] for i in range(dims)]
    # Centred as whole numbers; only the quotient is rounded, once.
    top = [[n * exact[min(i, j), max(i, j)] - above[i] * above[j] for j in range(dims)] for i in range(dims)]
    trace = sum(top[i][i] for i in range(dims))
    values, vectors = np.linalg.eigh(np.array([[v / (n * n) for v in row] for row in top]))
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > dims * np.finfo(float).eps * max(values.max(), 0)]
    columns = vectors[:, order] * np.sign(vectors[np.abs(vectors[:, order]).argmax(axis=0), order])
    return Whitening(n, low, high, above, columns / np.sqrt(values[order]), (values[order] / (trace / (n * n) or 1)).tolist())


def identity_error(fit: DataFrame, dims: int, by: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, from the vectors themselves."""
    k = len(by.explained)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                w = by.project(by.centred(_rows(batch.column(0), dims)))
                part = np.concatenate([w.sum(axis=0), ((w - w.mean(axis=0)).T @ (w - w.mean(axis=0)) + len(w) * np.outer(w.mean(axis=0), w.mean(axis=0))).ravel()])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["at", "v"])

    found = fit.mapInArrow(moments, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    sums = np.array([r.v for r in sorted(found)]) / by.n
    return float(np.abs(sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)).max())


def whiten(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = 4,
    scale: int = 256,
    folder: str | None = None,
) -> DataFrame:
    """Vectors on their principal components, each with variance one.

    Entries count as whole numbers, the floors of ``scale`` times their value. Returns for
    every usable vector and component the id, ``component`` (from 1, by falling variance),
    ``n`` distinct vectors, the vector's ``deviation`` (sum over dimensions of the square of
    n times its entry less the sum of entries; exact, null beyond 64 bits), its ``whitened``
    value, the share of variance that the component has (``explained``), and
    ``identity_error``: how far the whitened distinct vectors' covariance is from the
    identity.

    1. Distinct vectors are stored; copies meet before their shuffle, so a hot vector is
       one row of a task.
    2. Tasks slice entries, less the least of their dimension, into bit planes across rows
       and sum weighted popcounts of ANDed planes: exact cross-products. To the driver go a
       row for each two dimensions, however many vectors there are.
    3. The driver centres them as whole numbers and takes eigenvectors; tasks project.

    Null vectors and vectors with null or non-finite entries are dropped, null ids and equal
    rows kept. A vector that is shorter than the longest counts as ended by zeros.
    Components without variance are left out, so equal vectors, one vector or an empty table
    give no rows. Further columns are ignored.
    """
    spark = vectors.sparkSession
    folder = folder or run_folder(spark, "whitening")
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = scaled(vectors, id_col=id_col, vector_col=vector_col, scale=scale)
    dims = rows.agg(F.max(F.size("x")).alias("d")).first().d or 0
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("x"))))
    fit = stored(rows.select("x").distinct(), f"{folder}/fit")
    by = fit_whitening(fit, dims, components) if dims else Whitening(0, [], [], [], np.zeros((0, 0)), [])
    k = len(by.explained)
    error = identity_error(fit, dims, by) if k else 0.0
    out = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not k:
        return spark.createDataFrame([], out).withColumnRenamed("id", id_col)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            centred = by.centred(_rows(batch.column(1), dims))
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, by.n, np.int64)),
                pa.array([v for v in by.deviation(centred) for _ in range(k)], pa.int64()),
                pa.array(by.project(centred).ravel()),
                pa.array(np.tile(by.explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(projected, out).withColumnRenamed("id", id_col)
