"""Runs of months in which something fell short, months without any activity included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardbook.operators.joins import left_join


def _number(month: str | Column) -> Column:
    """Months since year 0 of a text such as 2024-05."""
    return F.split_part(month, F.lit("-"), F.lit(1)).cast("int") * 12 + F.split_part(month, F.lit("-"), F.lit(2)).cast("int") - 1


def _month(number: Column) -> Column:
    return F.concat_ws("-", F.lpad(F.floor(number / 12).cast("string"), 4, "0"), F.lpad((number % 12 + 1).cast("string"), 2, "0"))


def month_spine(groups: DataFrame, sites: Sequence[tuple[int, str]], first: str, last: str, *, site: Sequence[str]) -> DataFrame:
    """Every group at every site in every month from ``first`` to ``last``, whether anything happened or not.

    ``sites`` are the few sites of a deployment; ``site`` names their two columns. The rows
    come from sequences, not from a join. A last month before the first gives no rows.
    """
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(n).alias("n")) for i, n in sites]))
    low, high = _number(F.lit(first)), _number(F.lit(last))
    months = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    spread = groups.withColumn("_site", at).withColumn("_number", F.explode(months))
    return spread.select(
        *[F.col(f"_site.{f}").alias(c) for f, c in zip("in", site)], *groups.columns, _month(F.col("_number")).alias("month"), "_number"
    )


def shortfall_runs(spine: DataFrame, counts: DataFrame, keys: Sequence[str], *, count: str, standard: str) -> DataFrame:
    """Uninterrupted runs of months of a group that stayed below its standard.

    ``spine`` has ``keys``, ``standard``, ``month`` and its number; ``counts`` has ``keys``,
    ``month`` and ``count`` where anything was counted, elsewhere the count is zero. Returns
    for every run its ``first_month``, ``last_month``, ``months``, those of them without any
    activity (``empty_months``) and what was ``missing`` to the standard in total.

    Months of one run are as far from their rank among the group's short months, so the
    distance names the run. A group has as many rows as the spine has months.
    """
    dense = left_join(spine, counts, [(c, c) for c in (*keys, "month")], [count])
    short = dense.withColumn(count, F.coalesce(F.col(count), F.lit(0))).filter(F.col(count) < F.col(standard))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_number"))
    return (
        short.withColumn("_run", F.col("_number") - rank)
        .groupBy(*keys, "_run")
        .agg(
            F.min("month").alias("first_month"),
            F.max("month").alias("last_month"),
            F.count("*").alias("months"),
            F.count_if(F.col(count) == 0).alias("empty_months"),
            F.sum(F.col(standard) - F.col(count)).alias("missing"),
        )
        .drop("_run")
    )
