"""Naming quality: titles that only repeat the type, titles used by several activities."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from wardbook.operators.joins import Keys, join_keeping_left

REGULAR, TITLE_IS_TYPE, SHARED_TITLE = 0, 1, 2


def classify_names(
    activities: DataFrame, keys: Sequence[str], *, id_col: str, title: str, type_name: str, alias: str
) -> DataFrame:
    """One row per input row with an id: ``keys``, the id and the class of its title.

    A title is shared if the group given by ``keys`` (title and type among them) holds
    two different ids: distinct (group, id) pairs are counted, which spreads a hot title
    over its ids, aggregates by hash and never lists ids. Only the shared groups are
    joined back, by hash, NULL keys matching NULL keys.
    """
    rows = activities.select(*keys, id_col).filter(F.col(id_col).isNotNull())
    repeats_type = F.coalesce(F.col(title) == F.col(type_name), F.lit(False))
    shared = (
        rows.filter(~repeats_type)
        .distinct()
        .groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)])
        .agg(F.count("*").alias("_ids"))
        .filter("_ids > 1")
        .select(*[f"_g{i}" for i in range(len(keys))], F.lit(True).alias("_shared"))
    )
    cond = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)])
    klass = (
        F.when(repeats_type, TITLE_IS_TYPE).when(F.col("_shared"), SHARED_TITLE).otherwise(REGULAR).alias(alias)
    )
    return rows.join(shared.hint("shuffle_hash"), cond, "left").select(*keys, id_col, klass)


def attach(rows: DataFrame, log: DataFrame, on: Keys, keep: Sequence[str]) -> DataFrame:
    """Left join to a participation log; one activity may own a large part of the log."""
    return join_keeping_left(rows, log, on, keep)
