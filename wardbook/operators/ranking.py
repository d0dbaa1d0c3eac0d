"""Ranking groups by a rounded rate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from wardbook.functions import safe_ratio


def rank_rate(
    df: DataFrame, num: str, den: str, partition: str, *, rate: str, rank: str, tie: Sequence[str]
) -> DataFrame:
    """Rounded ratio and its position within the partition, best first, unknown last.

    Meant for aggregated input (one row per site in a year). Rounding makes ties
    common; ``tie`` makes their order repeatable.
    """
    best_first = Window.partitionBy(partition).orderBy(F.col(rate).desc_nulls_last(), *tie)
    return df.withColumn(rate, safe_ratio(num, den)).withColumn(rank, F.row_number().over(best_first))
