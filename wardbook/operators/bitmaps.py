"""Distinct counts that roll up: exact bitmaps of ids, stored for the finest groups.

A distinct count cannot be added up over months, a bitmap can. Ids are numbered densely
once; a group's ids are bits at these numbers, kept in pieces of 32,768 bits, and coarser
groups are the union of their pieces.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardbook.operators.storage import stored

PIECE = 8 * 4096  # bits of a piece


def dense_ids(rows: DataFrame, id_col: str, path: str, *, per_bucket: int = 8 * PIECE) -> DataFrame:
    """Every distinct non-NULL id with its place: (``id``, ``bucket``, ``place``), places from 0 in each bucket.

    Ids are dealt to buckets of about ``per_bucket`` by a hash and numbered in their
    bucket, so that no task numbers them all. Stored at ``path``, since numbers must not
    change between uses.
    """
    ids = rows.select(F.col(id_col).alias("id")).filter("id IS NOT NULL").distinct()
    buckets = -(-max(ids.count(), 1) // per_bucket)
    dealt = ids.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    return stored(dealt.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy("id")) - 1), path)


def id_bitmaps(
    rows: DataFrame, ids: DataFrame, keys: Sequence[str], id_col: str, conditions: Mapping[str, Column], path: str
) -> DataFrame:
    """Bitmaps of the ids of every group of ``keys``, one column per condition, stored at ``path``.

    A bit is set where a row of the id meets the condition. ``rows`` is read once; it
    shrinks to one row for each group and id before ids are looked up, so neither a hot
    group nor a hot id weighs more.
    """
    flagged = rows.filter(F.col(id_col).isNotNull()).groupBy(*keys, F.col(id_col).alias("_id"))
    flagged = flagged.agg(*[F.bool_or(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in conditions.items()])
    placed = flagged.join(ids, F.col("_id") == F.col("id"))
    bit = F.bitmap_bit_position(F.col("place") + 1)
    pieces = placed.groupBy(*keys, "bucket", F.floor(F.col("place") / PIECE).alias("piece")).agg(
        *[F.bitmap_construct_agg(F.when(F.col(name), bit)).alias(name) for name in conditions]
    )
    return stored(pieces, path)


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str | Column], names: Sequence[str]) -> DataFrame:
    """Distinct ids per group of ``keys``, which may be any coarser grouping; no keys give one row."""
    grouped = [F.col(k) if isinstance(k, str) else k for k in keys]
    merged = bitmaps.groupBy(*grouped, "bucket", "piece").agg(*[F.bitmap_or_agg(n).alias(n) for n in names])
    labels = [c for c in merged.columns if c not in {"bucket", "piece", *names}]
    return merged.groupBy(*labels).agg(*[F.coalesce(F.sum(F.bitmap_count(n)), F.lit(0)).alias(n) for n in names])
