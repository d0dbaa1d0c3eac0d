"""Intervals as months, and joins in month buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wardbook.operators.joins import Keys, found_pairs, join_keeping_left, left_join


def month_walk(df: DataFrame, start: str, end: str, *, max_months: int | None = None, alias: str = "month") -> DataFrame:
    """One row per month of a valid interval: its first month plus each whole month elapsed.

    Elapsed months count, not calendar months: 20 January to 10 February gives January
    alone. ``max_months`` is an option for reports that want a window: at most that many
    months then follow the first, and later ones are left out on purpose. Intervals with
    a missing end or running backwards give nothing (``rejected_intervals`` lists them);
    they are dropped before the sequence is built, since a sequence from 0 down to -1
    would not be empty.
    """
    elapsed = F.floor(F.months_between(end, start))
    steps = (elapsed if max_months is None else F.least(F.lit(max_months), elapsed)).cast("int")
    return (
        df.filter(F.col(start) <= F.col(end))
        .withColumn("_n", F.explode(F.sequence(F.lit(0), steps)))
        .withColumn(alias, F.date_format(F.add_months(F.trunc(start, "MM"), F.col("_n")), "yyyy-MM"))
        .drop("_n")
    )


def rejected_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    """The rows that ``month_walk`` has no months for: an end is missing or lies before the start."""
    return df.filter(~F.coalesce(F.col(start) <= F.col(end), F.lit(False)))


def month_bucket_join(rows: DataFrame, log: DataFrame, on: Keys, keep: Sequence[str], *, matched: str | None = None) -> DataFrame:
    """Left join on entity keys plus month; a person's month may be hot on either side.

    ``matched`` names a column of the rows that says whether the log has their keys, where
    that is known before: other rows are not shuffled. The result does not have it.
    """
    if matched is None:
        return join_keeping_left(rows, log, on, keep)
    partners, alone = rows.filter(F.col(matched)).drop(matched), rows.filter(~F.col(matched)).drop(matched)
    nulls = [F.lit(None).cast(log.schema[c].dataType).alias(c) for c in keep]
    return found_pairs(partners, log, on, keep).unionByName(alone.select("*", *nulls))


def fill_id(rows: DataFrame, registry: DataFrame, on: Keys, id_col: str, alias: str) -> DataFrame:
    """Look an id up by natural key; namesakes fan out, strangers get NULL.

    A registry is nearly unique by key, so only the rows can be hot, and a plain left join
    splits those.
    """
    return left_join(rows, registry.withColumn(alias, F.col(id_col)), on, [alias])
