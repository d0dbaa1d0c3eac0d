"""SimHash near-duplicates: fingerprints in vantage-point shards, linked by Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wardbook.llm.common import connected_components, drawn, run_folder, stored

BLOCK = 65_536  # shingles whose bits are counted at a time
LEAF = 512  # fingerprints that are compared pair by pair
DENSE = 8192  # a set that no vantage point can part is compared in flips from here on


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits; a bit is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    runs = [words[k:] for k in range(shingle)]
    shingles = list(map(b" ".join, zip(*runs))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, len(shingles))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        octets = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, id_col: str, text_col: str, shingle: int) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                values = np.array([fingerprint(v.as_py(), shingle) for v in part.column(1)], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(compute, f"id {kind}, fp bigint")


def _distance(values: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ point)


def split_tree(sample: np.ndarray, levels: int) -> dict[int, tuple[np.uint64, int]]:
    """Vantage point and radius per inner node; node k has children 2k (near) and 2k+1 (far).

    Each node takes, of a few points of its sample, the one whose median radius has the
    fewest fingerprints just outside, since these go to both children.
    """
    tree, todo = {}, [(1, sample)]
    while todo:
        node, own = todo.pop()
        if node >= 1 << levels or len(own) < 8:
            continue
        choices = []
        for point in own[:: max(1, len(own) // 16)]:
            d = _distance(own, point)
            radius = int(np.median(d))
            choices.append((int(((d > radius) & (d <= radius + 2)).sum()) + abs(int((d <= radius).sum()) * 2 - len(own)), int(point), radius))
        _, point, radius = min(choices)
        d = _distance(own, np.uint64(point))
        tree[node] = (np.uint64(point), radius)
        todo += [(2 * node, own[d <= radius]), (2 * node + 1, own[d > radius])]
    return tree


def shards_of(values: np.ndarray, tree: dict[int, tuple[np.uint64, int]], reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, fingerprints) so that any two within ``reach`` meet in a shard.

    By the triangle inequality a partner of a fingerprint within radius r of the vantage
    point lies within r + reach. Near sets hold all up to r + reach, far sets all beyond
    r, so two fingerprints beyond r meet far out and any others meet near.
    """
    todo = [(1, values)]
    while todo:
        node, own = todo.pop()
        if not len(own):
            continue
        if node not in tree:
            yield node, own
            continue
        point, radius = tree[node]
        d = _distance(own, point)
        todo += [(2 * node, own[d <= radius + reach]), (2 * node + 1, own[d > radius])]


def _by_pairs(own: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within ``reach``, as a link from every fingerprint to the smallest joined one."""
    label, lower = np.arange(len(own)), np.empty(len(own), np.int64)
    while True:
        for at in range(0, len(own), LEAF):
            near = np.bitwise_count(own[at : at + LEAF, None] ^ own[None, :]) <= reach
            lower[at : at + LEAF] = np.where(near, label[None, :], len(own)).min(axis=1)
        lower = lower[lower]
        if (lower == label).all():
            return own, own[label]
        label = lower.copy()


def _by_flips(own: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a dense set: every fingerprint is looked up with up to ``reach`` bits flipped."""
    own = np.sort(own)
    for k in range(1, reach + 1):
        for bits in combinations(range(64), k):
            other = own ^ np.uint64(sum(1 << b for b in bits))
            at = np.minimum(np.searchsorted(own, other), len(own) - 1)
            hit = (own[at] == other) & (other < own)
            if hit.any():
                yield own[hit], other[hit]


def links(values: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join all of ``values`` within ``reach``: a local vantage-point tree.

    Sets of at most ``LEAF`` are compared pair by pair and give one link per fingerprint.
    A set that no tried vantage point parts is compared whole in blocks, beyond ``DENSE``
    by flips.
    """
    rng = np.random.default_rng(7)
    todo = [np.unique(values)]
    while todo:
        own = todo.pop()
        if len(own) < 2:
            continue
        if len(own) <= LEAF:
            yield _by_pairs(own, reach)
            continue
        best = None
        for point in rng.choice(own, 8):
            d = _distance(own, point)
            for radius in {int(np.quantile(d, q)) for q in (0.25, 0.5, 0.75)}:
                near, far = int((d <= radius + reach).sum()), int((d > radius).sum())
                if max(near, far) <= 0.9 * len(own) and (best is None or near + far < best[0]):
                    best = (near + far, point, radius)
        if best is not None and best[0] <= 1.7 * len(own):
            d = _distance(own, best[1])
            todo += [own[d <= best[2] + reach], own[d > best[2]]]
        elif len(own) <= DENSE:
            yield _by_pairs(own, reach)
        else:
            yield from _by_flips(own, reach)


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    shard_size: int = 1024,
    max_levels: int = 12,
    sample_per_shard: int = 16,
    folder: str | None = None,
) -> DataFrame:
    """Every row with its ``fingerprint`` (16 hex digits) and ``component_id``.

    Words are runs without the characters 9 to 13 and 32, A-Z in lower case; shingles of
    ``shingle`` words are hashed with XXH64, seed 42. Fingerprints that differ in at most
    ``max_bits`` bits are linked; a component's id is its smallest document id.

    1. Fingerprints are counted where documents are read, and stored. From here on only
       distinct ones travel, so a text that a third of the rows share is one fingerprint.
    2. The upper vantage-point tree is fitted on a bounded sample of distinct fingerprints
       (about ``sample_per_shard << levels``, at most 65,536 by default); every fingerprint is
       dealt to its shard, and to a neighbour where it lies within ``max_bits`` of the
       boundary. Shards grow only beyond ``shard_size << max_levels`` fingerprints, at
       eight bytes each; inside, the tree goes on. Near copies are no exception, as few
       distinct fingerprints lie close to one another.
    3. Shards give links, at most about one per fingerprint from a leaf; components come
       from distributed star contraction.

    Null text counts as empty: no words, fingerprint zero, linked like any other. Null ids
    are never a component's id unless it has no other. Equal rows get equal results;
    further columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "simhash")
    rows = stored(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), f"{folder}/fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("id").alias("first_id")), f"{folder}/distinct")
    count = distinct.count()
    levels = min(max_levels, max(0, int(np.ceil(np.log2(max(count, 1) / shard_size)))))
    bound = sample_per_shard << levels
    sample = drawn(distinct.select("fp"), "fp", bound).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    tree = split_tree(sample, levels)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, own in shards_of(values, tree, max_bits):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), shard, np.int32)), pa.array(own.view(np.int64))], ["shard", "fp"])

    def link(shard: pd.DataFrame) -> pd.DataFrame:
        found = [np.array([a, b]) for a, b in links(shard["fp"].to_numpy(np.int64).view(np.uint64), max_bits)]
        a, b = np.concatenate(found, axis=1).view(np.int64) if found else np.empty((2, 0), np.int64)
        return pd.DataFrame({"a": a[a != b], "b": b[a != b]})

    dealt = distinct.select("fp").mapInArrow(deal, "shard int, fp bigint")
    edges = stored(dealt.groupBy("shard").applyInPandas(link, "a bigint, b bigint"), f"{folder}/links")
    roots = connected_components(edges, folder)
    of_root = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first_id"
    )
    smallest = of_root.groupBy(F.col("root").alias("_root")).agg(F.min("first_id").alias("component_id"))
    smallest = stored(smallest, f"{folder}/smallest")
    component = of_root.join(smallest, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(component, F.col("fp") == F.col("_fp")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
