"""Joins and the de-duplication that keeps them N:1.

Every join here is an outer equi-join in meaning. What differs is which side may hold a
hot key. Adaptive execution can split a hot partition on the preserved side of an outer
join but never on the other one, so joins whose *right* side can be hot are written as
"inner join plus the left rows without a partner".
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

Keys = Sequence[tuple[str, str]]  # (left column, right column)


def dedupe_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedupe_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def _right_side(right: DataFrame, on: Keys, keep: Sequence[str]) -> tuple[DataFrame, Column]:
    """Right side with private key names, so that no column name is ever ambiguous."""
    keys = [F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(on)]
    cond = reduce(and_, [F.col(left) == F.col(f"_k{i}") for i, (left, _) in enumerate(on)])
    return right.select(*keys, *keep), cond


def _key_names(on: Keys) -> list[str]:
    return [f"_k{i}" for i in range(len(on))]


def lookup_join(df: DataFrame, dictionary: DataFrame, on: Keys, keep: Sequence[str]) -> DataFrame:
    """Left join to a dictionary; whether it is small enough to broadcast is for its bytes to say.

    Stored and literal dictionaries have known sizes before the query runs, others are
    measured when their shuffle is written.
    """
    side, cond = _right_side(dictionary, on, keep)
    return df.join(side, cond, "left").drop(*_key_names(on))


def left_join(left: DataFrame, right: DataFrame, on: Keys, keep: Sequence[str]) -> DataFrame:
    """Left join for a right side unique by key, such as an aggregate; a hot left side is split at run time."""
    side, cond = _right_side(right, on, keep)
    return left.join(side, cond, "left").drop(*_key_names(on))


def _one_exact_type(mine: T.DataType, theirs: T.DataType) -> bool:
    return mine == theirs and not isinstance(mine, T.FractionalType)


def _check_types(left: DataFrame, right: DataFrame, on: Keys) -> None:
    """Hashes of equal values are equal only within one type, so both sides must agree on it."""
    for name, other in on:
        mine, theirs = left.schema[name].dataType, right.schema[other].dataType
        if not _one_exact_type(mine, theirs):
            raise TypeError(f"join keys {name} ({mine.simpleString()}) and {other} ({theirs.simpleString()}) need one exact type")


def _as_key(cols: Sequence[Column]) -> list[Column]:
    """A key as its hash and a struct of its columns.

    Sorting for a merge join compares the hash first, which is a plain number, and
    reaches for the struct only between equal hashes. Both are computed where they are
    compared: rows are shuffled with their columns alone, not with a second copy of them.
    """
    return [F.xxhash64(*cols), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)])]


def match_key(left: Sequence[str], right: Sequence[str]) -> Column:
    """All pairs of columns agree, compared in the form of ``_as_key``."""
    return reduce(and_, [a == b for a, b in zip(_as_key([F.col(c) for c in left]), _as_key([F.col(c) for c in right]))])


def same_keys(left: DataFrame, right: DataFrame, on: Keys) -> Column:
    """``match_key`` where it can tell, plain equality for keys of other or inexact types."""
    if all(_one_exact_type(left.schema[a].dataType, right.schema[b].dataType) for a, b in on):
        return match_key([a for a, _ in on], [b for _, b in on])
    return reduce(and_, [F.col(a) == F.col(b) for a, b in on])


def present(cols: Sequence[str]) -> Column:
    """No NULL key, in the form that reaches the reader."""
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def _distinct_keys(df: DataFrame, on: Keys) -> DataFrame:
    """Distinct non-NULL keys of the right side under private names.

    They are compared in the form of ``_as_key``, which is made after the grouping, so a
    shuffled join on it has a shuffle of its own on this side, which is what lets the run
    time split a hot key on the other side.
    """
    keys = [r for _, r in on]
    return df.filter(present(keys)).select(*[F.col(c).alias(name) for c, name in zip(keys, _key_names(on))]).distinct()


def _on(on: Keys) -> Column:
    return match_key([left for left, _ in on], _key_names(on))


def join_keeping_left(left: DataFrame, right: DataFrame, on: Keys, keep: Sequence[str]) -> DataFrame:
    """Left outer join whose hot keys can be split on either side.

    Matches come from an inner join, where both sides may be split, or either broadcast if
    its bytes allow. Left rows without a partner are found against the distinct right
    keys, which shrink before the shuffle.

    Keys are compared as one struct whose NULLs were removed on the right, so NULL keys
    find no partner. Unlike single columns a struct adds no filter to the left side, and
    both branches read one and the same shuffled left side.
    """
    _check_types(left, right, on)
    found = found_pairs(left, right, on, keep).select(*left.columns, *keep)
    return found.union(_alone(left, right, on).select(*left.columns, *_nulls(right, keep)))


def found_pairs(left: DataFrame, right: DataFrame, on: Keys, keep: Sequence[str]) -> DataFrame:
    """Inner join whose hot keys can be split on either side; NULL keys match nothing."""
    _check_types(left, right, on)
    keys = [r for _, r in on]
    own = [F.col(c).alias(name) for c, name in zip(keys, _key_names(on))]
    values = [F.col(c).alias(f"_v{i}") for i, c in enumerate(keep)]
    renamed = [F.col(f"_v{i}").alias(c) for i, c in enumerate(keep)]
    return left.join(right.filter(present(keys)).select(*own, *values), _on(on), "inner").select(*left.columns, *renamed)


def _alone(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    return left.join(_distinct_keys(right, on), _on(on), "left_anti")


def _nulls(right: DataFrame, keep: Sequence[str]) -> list[Column]:
    return [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in keep]


def registry_participants(
    registry: DataFrame,
    participation: DataFrame,
    on: Keys,
    *,
    role_col: str,
    role: str,
) -> DataFrame:
    """Distinct registry rows that take part in something in the given role.

    Both sides shrink to distinct rows before they are shuffled for the semi join, so
    neither a person with very many participations nor a person copied very often
    weighs more than one row per map task.
    """
    _check_types(registry, participation, on)
    present = _distinct_keys(participation.filter(F.col(role_col) == role), on)
    return dedupe_rows(registry).join(present, _on(on), "left_semi")


def participation_log(
    people: DataFrame,
    participation: DataFrame,
    activities: DataFrame,
    *,
    person_on: Keys,
    participation_cols: Mapping[str, str],
    activity_on: Keys,
    activity_cols: Sequence[str],
    all_present: bool = False,
    repeated: bool = False,
) -> DataFrame:
    """People ⟕ participation (any role) ⟕ activities.

    ``activity_on`` pairs participation columns with activity columns. ``all_present``
    states that every person has at least one participation (true for the output of
    ``registry_participants``); the first join is then an inner join. ``repeated`` says that
    participation holds equal rows that count once, and that people are distinct: equal rows
    are dropped where the person's rows lie after the first join, so participations of other
    people are neither grouped nor shuffled for it.
    """
    link = {f"_p{i}": c for i, (c, _) in enumerate(activity_on)}
    extra = {**link, **participation_cols}
    takes = participation.select(
        *[F.col(r).alias(f"_r{i}") for i, (_, r) in enumerate(person_on)],
        *[F.col(old).alias(new) for new, old in extra.items()],
    )
    on = [(left, f"_r{i}") for i, (left, _) in enumerate(person_on)]
    _check_types(people, takes, on)
    if repeated:
        taken = _taken_once(people, participation, person_on, extra)
    else:
        taken = found_pairs(people, takes, on, list(extra))
    chain = [(f"_p{i}", r) for i, (_, r) in enumerate(activity_on)]
    # Activities are nearly unique by id: only the participations can be hot, and a left join splits those.
    log = left_join(taken, activities, chain, activity_cols).drop(*link)
    if all_present:
        return log
    # Nobody without a participation needs to be looked up among the activities.
    missing = [*_nulls(takes, list(participation_cols)), *_nulls(activities, activity_cols)]
    return log.union(_alone(people, takes, on).select(*people.columns, *missing))


def _taken_once(people: DataFrame, participation: DataFrame, person_on: Keys, extra: Mapping[str, str]) -> DataFrame:
    """Distinct people with the ``extra`` columns of each different participation of theirs.

    Keys are compared column by column, so rows stay where the join put them and equal ones
    are dropped there. Of the two columns that a key pair is, one travels on. People are far
    fewer than participations, so they are what is looked up in, and nothing is sorted.
    """
    keys = {r: f"_r{i}" for i, (_, r) in enumerate(person_on)}
    own = {r: left for left, r in person_on}
    others = {c: f"_x{i}" for i, c in enumerate(participation.columns) if c not in keys}
    takes = participation.select(*[F.col(c).alias(name) for c, name in {**keys, **others}.items()])
    same = reduce(and_, [F.col(left) == F.col(keys[r]) for left, r in person_on])
    once = dedupe_rows(people.hint("shuffle_hash").join(takes, same).select(*people.columns, *others.values()))
    return once.select(*people.columns, *[F.col(own.get(c) or others[c]).alias(new) for new, c in extra.items()])


def population_events(population: DataFrame, events: DataFrame, on: Keys, keep: Sequence[str]) -> DataFrame:
    """Each population group with its events, or alone with NULLs.

    There are few groups and many events, and groups are as hot as can be (a site-year
    holds all its events). Where the measured groups are small enough they travel to the
    events, otherwise hot groups are split.
    """
    return join_keeping_left(population, events, on, keep)
