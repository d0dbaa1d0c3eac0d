"""Counts, flags and rates per group.

Several distinct counts in one ``groupBy`` make Spark replicate every row once per
count. Here rows shrink to one per (group, counted id) carrying one flag per condition,
and the flags are summed; both steps combine before they shuffle, and the first spreads
a hot group over its ids.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardbook.config import WarehouseConfig
from wardbook.functions import differs_any, is_kind, meets, month_of, percent_text, same_all
from wardbook.operators.joins import Keys, lookup_join, present


def distinct_per(df: DataFrame, keys: Sequence[str], id_col: str, alias: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(id_col).alias(alias))


def conditional_distinct(
    df: DataFrame, keys: Sequence[str], id_col: str, total: str, conditions: Mapping[str, Column], *, spread: bool = True
) -> DataFrame:
    """Distinct non-NULL ids per group: all of them, and those with a row meeting each condition.

    ``spread=False`` is for groups that are many and small by nature: their rows are
    shuffled once, by group, instead of once by group and id and again by group. They keep
    the session's number of shuffle partitions, since a row takes far more memory in the
    hash tables than bytes in the shuffle that run time would merge partitions by.
    """
    flags = {f"_f{i}": cond for i, cond in enumerate(conditions.values())}
    if not spread:
        df = df.select(*keys, id_col, *[cond.alias(flag) for flag, cond in flags.items()])
        df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
        flags = {flag: F.col(flag) for flag in flags}
    per_id = df.groupBy(*keys, F.col(id_col).alias("_id")).agg(
        *[F.bool_or(cond).alias(flag) for flag, cond in flags.items()]
    )
    known = F.col("_id").isNotNull()
    return per_id.groupBy(*keys).agg(
        F.count("_id").alias(total),
        *[F.count_if(F.col(flag) & known).alias(name) for flag, name in zip(flags, conditions)],
    )


def coverage(detail: DataFrame, keys: Sequence[str], unit: str, event: str, *, total: str, covered: str, rate: str) -> DataFrame:
    """How many units of a group have at least one event, and that share as percent text."""
    out = conditional_distinct(detail, keys, unit, total, {covered: F.col(event).isNotNull()})
    return out.withColumn(rate, percent_text(covered, total))


def same_vs_other(
    df: DataFrame, group: Sequence[str], id_col: str, pairs: Keys, *, total: str, same: str, other: str, spread: bool = True
) -> DataFrame:
    """Distinct ids per group, split by whether the column pairs agree or differ.

    A NULL in a pair is neither agreement nor difference, so same + other ≤ total does
    not have to be an equality; an id with rows of both kinds counts in both. For
    ``spread`` see ``conditional_distinct``.
    """
    return conditional_distinct(df, group, id_col, total, {same: same_all(pairs), other: differs_any(pairs)}, spread=spread)


def abnormal_headcount(
    counts: DataFrame, keys: Sequence[str], who: str, *, total: str, zero: Mapping[str, str]
) -> DataFrame:
    """Heads per group, and heads with a zero in each of the given count columns."""
    return conditional_distinct(counts, keys, who, total, {name: F.col(c) == 0 for name, c in zero.items()})


def class_counts(
    df: DataFrame, keys: Sequence[str], id_col: str, class_col: str, *, total: str, classes: Mapping[str, int]
) -> DataFrame:
    return conditional_distinct(df, keys, id_col, total, {name: F.col(class_col) == k for name, k in classes.items()})


def presence_matrix(
    population: DataFrame,
    first: DataFrame,
    second: DataFrame,
    keys: Sequence[str],
    group: Sequence[str],
    who: str,
    *,
    total: str,
    names: Mapping[tuple[bool | None, bool | None], str],
) -> DataFrame:
    """Heads of a population by presence in two other relations.

    ``names`` maps (in first, in second) to an output column, ``None`` meaning either.
    All three relations carry ``keys``. They are stacked and grouped once instead of
    being joined twice, so a key repeated very often only ever adds one row per map
    task. A NULL in a key never matches, hence such rows of ``first``/``second`` go.
    """

    def tagged(df: DataFrame, tag: str) -> DataFrame:
        rows = df.select(*keys)
        if tag != "_pop":
            rows = rows.filter(present(keys))
        return rows.select(*keys, *[F.lit(tag == t).alias(t) for t in ("_pop", "_a", "_b")])

    stacked = tagged(population, "_pop").unionByName(tagged(first, "_a")).unionByName(tagged(second, "_b"))
    members = (
        stacked.groupBy(*keys).agg(*[F.bool_or(t).alias(t) for t in ("_pop", "_a", "_b")]).filter("_pop")
    )
    conditions = {}
    for (in_a, in_b), name in names.items():
        cond = F.lit(True)
        for wanted, col in ((in_a, "_a"), (in_b, "_b")):
            if wanted is not None:
                cond = cond & (F.col(col) if wanted else ~F.col(col))
        conditions[name] = cond
    return conditional_distinct(members, group, who, total, conditions)


def standard_counts(
    activities: DataFrame,
    standards: DataFrame,
    *,
    keys: Mapping[str, str],
    on: Keys,
    id_col: str,
    time_col: str,
    standard_col: str,
) -> DataFrame:
    """Distinct activities per group and month against the standard for that group.

    ``keys`` maps output names to activity columns. Groups without a standard comply.
    """
    counted = activities.select(
        *[F.col(c).alias(name) for name, c in keys.items()], month_of(time_col).alias("month"), F.col(id_col).alias("_id")
    )
    counts = distinct_per(counted, [*keys, "month"], "_id", "activity_count")
    return lookup_join(counts, standards, on, [standard_col]).withColumn(
        "is_standard", meets("activity_count", standard_col)
    )


def conditional_specialties(
    counts: DataFrame, keys: Sequence[str], cfg: WarehouseConfig, *, corrected: bool = False
) -> DataFrame:
    """Outpatient teaching per group: volume in general practice, and spread over other specialties.

    By default the spread is the sum of specialty ids, the figure existing reports use;
    ``corrected`` counts the distinct specialties instead.
    """
    gp, kind = cfg.general_practice, cfg.outpatient
    outpatient = is_kind("activity_type_id", "activity_type_name", kind)
    in_gp = outpatient & is_kind("major_id", "major_name", gp)
    elsewhere = outpatient & (F.col("major_id") != gp.id) & (F.col("major_name") != gp.name)
    spread = (
        F.count_distinct(F.when(elsewhere, F.col("major_id")))
        if corrected
        else F.sum(F.when(elsewhere, F.col("major_id")).otherwise(0))
    )
    out = counts.groupBy(*keys).agg(
        F.sum(F.when(in_gp, F.col("activity_count")).otherwise(0)).alias("general_practice_outpatient_count"),
        spread.alias("outpatient_teaching_specialties"),
    )
    return out.withColumns(
        {
            "is_general_practice_outpatient": F.when(F.col("general_practice_outpatient_count") > 0, 1).otherwise(0),
            "is_outpatient_teaching_specialties_valid": F.when(
                F.col("outpatient_teaching_specialties") >= cfg.min_outpatient_specialties, 1
            ).otherwise(0),
        }
    )


def joined_distinct(df: DataFrame, keys: Sequence[str], col: str, sep: str, alias: str) -> DataFrame:
    """Sorted distinct values per group as one text.

    Values are made distinct before they are collected, so the list of a group is as
    long as its set of values (months here), however many rows the group has.
    """
    return (
        df.select(*keys, col)
        .distinct()
        .groupBy(*keys)
        .agg(F.concat_ws(sep, F.sort_array(F.collect_list(col))).alias(alias))
    )


def rollup_ratios(
    df: DataFrame, keys: Sequence[str], den: str, nums: Sequence[str], *, suffix: str = "_rate", tidy: bool = False
) -> DataFrame:
    """Second-level sums with each numerator's share of the denominator as percent text.

    By default ratios are rounded before they are scaled, as existing reports do, which
    gives whole percents with the odd tail of a double; ``tidy`` scales first, to two digits.
    """
    out = df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (den, *nums)])
    return out.withColumns({c + suffix: percent_text(c, den, round_first=not tidy) for c in nums})
