"""Joins on periods: events that fall into them, and periods that overlap.

Both are equi-joins on keys and time bins, with the exact times checked on top, so they
are shuffled by key and bin and a hot key or bin is split at run time. Bins are as wide as
the periods in them where periods may be long; an event has one bin of a width, and two
periods are compared in the first bin they share, so every pair comes once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from wardbook.operators.joins import Keys, left_join, present, same_keys
from wardbook.operators.storage import stored

BIN_DAYS = 30


def _bin(at: Column, days: int | Column) -> Column:
    return F.floor(F.unix_date(at.cast("date")) / days).cast("int")


def _valid(start: str, end: str) -> Column:
    return F.col(start) <= F.col(end)


def _binned(rows: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """Valid periods, once for each bin."""
    bins = F.sequence(_bin(F.col(start), days), _bin(F.col(end), days))
    return rows.filter(_valid(start, end)).withColumn("_bin", F.explode(bins))


def _events(events: DataFrame, on: Keys, at: str, days: int, keep: Sequence[str]) -> DataFrame:
    keys = [F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(on)]
    known = present([*[r for _, r in on], at])
    values = [F.col(c).alias(f"_v{i}") for i, c in enumerate(keep)]
    return events.filter(known).select(*keys, F.col(at).alias("_at"), _bin(F.col(at), days).alias("_event_bin"), *values)


def _falls_in(on: Keys, start: str, end: str) -> Column:
    same = [F.col(left) == F.col(f"_k{i}") for i, (left, _) in enumerate(on)]
    within = [F.col("_bin") == F.col("_event_bin"), F.col("_at") >= F.col(start), F.col("_at") <= F.col(end)]
    return reduce(and_, [*same, *within])


def events_in_period(
    rows: DataFrame, events: DataFrame, on: Keys, *, start: str, end: str, at: str, keep: Sequence[str], days: int = BIN_DAYS
) -> DataFrame:
    """Rows with every event of their keys at a time from ``start`` to ``end``, both included.

    Rows without an event, without keys, or with a missing or backward period give nothing.
    """
    found = _binned(rows, start, end, days).join(_events(events, on, at, days, keep), _falls_in(on, start, end))
    return found.select(*rows.columns, *[F.col(f"_v{i}").alias(c) for i, c in enumerate(keep)])


def match_in_period(
    rows: DataFrame, events: DataFrame, on: Keys, *, start: str, end: str, at: str, keep: Sequence[str], days: int = BIN_DAYS,
    sparse: bool = False, folder: str | None = None,
) -> DataFrame:
    """``events_in_period``, and rows without an event alone with NULLs: SQL's left join on ``BETWEEN``.

    Which events fall into a row's period is a matter of its keys and period alone, so times
    are looked up for distinct keys and periods, and travel without the values to keep. A
    period is listed in the one or two bins of the narrowest width that is no shorter than
    itself, a time in one bin of every width, so a long period costs no more rows than a
    short one. Rows that can match nothing do not travel at all; the others travel by keys
    and period to the times found, in joins whose hot keys can be split on either side.

    ``sparse`` is for rows of which few have an event. They travel once, by their keys, to
    the weeks in which these have events at all (a list as long as the calendar at most); only
    rows with such a week in their period go on to the exact match, with events that carry
    their values. With ``folder`` what is read by several branches is written there: rows are
    composed and looked up once, and the driver holds three small plans one after another,
    not one in which every branch has all of them. Its joins are shuffled at every size: events
    grow with the data, and the bytes of their files tell neither how large their keys are in
    memory nor that they are listed once for each width, so what looks small may fill the driver.
    """
    if sparse:
        return _sparse_match(rows, events, on, start=start, end=end, at=at, keep=keep, days=days, folder=folder)
    lefts, names = [left for left, _ in on], [*[f"_s{i}" for i in range(len(on))], "_from", "_to"]
    usable = F.coalesce(present(lefts) & _valid(start, end), F.lit(False))
    valid = rows.filter(usable)
    spans = valid.select(*[F.col(c).alias(name) for c, name in zip([*lefts, start, end], names)]).distinct()
    times = _events(events, on, at, days, []).distinct()
    placed = [(f"_s{i}", f"_k{i}") for i in range(len(on))]
    hits = _spread(spans, days).join(_times_by_width(times, len(on), days), _inside(placed)).select(*names, "_at")
    same = same_keys(valid, hits, list(zip([*lefts, start, end], names)))
    heard = valid.join(hits, same).select(*rows.columns, F.col("_at").alias("_heard"))
    noted = _events(events, on, at, days, keep)
    found = heard.join(noted, same_keys(heard, noted, [*((left, f"_k{i}") for i, left in enumerate(lefts)), ("_heard", "_at")]))
    found = found.select(*rows.columns, *[F.col(f"_v{i}").alias(c) for i, c in enumerate(keep)])
    alone = valid.join(hits.select(*names).distinct(), same, "left_anti").unionByName(rows.filter(~usable))
    nulls = [F.lit(None).cast(events.schema[c].dataType).alias(c) for c in keep]
    return found.unionByName(alone.select(*rows.columns, *nulls))


def _sparse_match(
    rows: DataFrame, events: DataFrame, on: Keys, *, start: str, end: str, at: str, keep: Sequence[str], days: int, folder: str | None
) -> DataFrame:
    lefts, rights = [left for left, _ in on], [r for _, r in on]
    by_key = events.filter(present([*rights, at])).groupBy(*rights).agg(F.collect_set(_bin(F.col(at), 7)).alias("_weeks"))
    first, last = _bin(F.col(start), 7), _bin(F.col(end), 7)
    # Unknown counts as no. As one expression that takes NULLs it lets the branches below share one shuffle of the rows.
    maybe = F.coalesce(F.exists("_weeks", lambda week: (week >= first) & (week <= last)), F.lit(False))
    usable = F.coalesce(present(lefts) & _valid(start, end), F.lit(False))
    told = left_join(rows.filter(usable), by_key.hint("merge"), on, ["_weeks"]).withColumn("_maybe", maybe).drop("_weeks")
    told = told if folder is None else stored(told, f"{folder}/told")
    likely = told.filter("_maybe").drop("_maybe")
    found = _found(likely, events, on, start=start, end=end, at=at, keep=keep, days=days)
    found = found if folder is None else stored(found, f"{folder}/found")
    matched = [(c, f"_s{i}") for i, c in enumerate([*lefts, start, end])]
    hits = found.select(*[F.col(c).alias(name) for c, name in matched]).distinct()
    alone = likely.join(hits.hint("merge"), same_keys(likely, hits, matched), "left_anti")
    alone = alone.unionByName(told.filter("NOT _maybe").drop("_maybe")).unionByName(rows.filter(~usable))
    nulls = [F.lit(None).cast(events.schema[c].dataType).alias(c) for c in keep]
    return found.unionByName(alone.select(*rows.columns, *nulls))


def _found(
    rows: DataFrame, events: DataFrame, on: Keys, *, start: str, end: str, at: str, keep: Sequence[str], days: int
) -> DataFrame:
    """Rows with usable keys and periods with every event in them, joined in bins of the row's width."""
    values = [f"_v{i}" for i in range(len(keep))]
    spans = _spread(rows.withColumns({"_from": F.col(start), "_to": F.col(end)}), days)
    noted = _times_by_width(_events(events, on, at, days, keep), len(on), days, values)
    pairs = spans.join(noted.hint("merge"), _inside([(left, f"_k{i}") for i, (left, _) in enumerate(on)]))
    return pairs.select(*rows.columns, *[F.col(v).alias(c) for v, c in zip(values, keep)])


def _widths(days: int) -> list[int]:
    return [days * 4**k for k in range(5)]


def _spread(spans: DataFrame, days: int) -> DataFrame:
    """Periods once for each bin of the narrowest width that holds their length; the widest, for all longer ones."""
    bins = F.sequence(_bin(F.col("_from"), F.col("_width")), _bin(F.col("_to"), F.col("_width")))
    return spans.withColumn("_width", _width("_from", "_to", days)).withColumn("_bin", F.explode(bins))


def _width(start: str, end: str, days: int) -> Column:
    """The narrowest width that holds a period's length; the widest, for all longer ones."""
    length = F.datediff(F.col(end).cast("date"), F.col(start).cast("date"))
    *narrow, widest = _widths(days)
    width = F.lit(widest)
    for own in reversed(narrow):
        width = F.when(length <= own, own).otherwise(width)
    return width


def _times_by_width(times: DataFrame, keys: int, days: int, values: Sequence[str] = ()) -> DataFrame:
    width = F.explode(F.array(*[F.lit(w) for w in _widths(days)]))
    listed = times.select(*[f"_k{i}" for i in range(keys)], "_at", *values, width.alias("_event_width"))
    return listed.withColumn("_event_bin", _bin(F.col("_at"), F.col("_event_width")))


def _inside(on: Keys) -> Column:
    same = [F.col(a) == F.col(b) for a, b in [*on, ("_width", "_event_width"), ("_bin", "_event_bin")]]
    return reduce(and_, [*same, F.col("_at") >= F.col("_from"), F.col("_at") <= F.col("_to")])


def overlapping(
    left: DataFrame, right: DataFrame, on: Keys, *, left_period: tuple[str, str], right_period: tuple[str, str], keep: Sequence[str], days: int = BIN_DAYS
) -> DataFrame:
    """Rows of both sides with equal keys whose periods share a moment, each pair once.

    ``keep`` are columns of the right side, which get the prefix ``other_``. Periods that
    are missing an end or run backwards overlap nothing.

    Two periods meet in bins of the width of the longer one (see ``_width``), where that one
    is listed in one or two bins; the shorter one is listed for its own and all wider bins,
    so a period costs a fixed number of rows however long it is. Short periods never meet in
    wide bins: one side of a join is always listed by its own width alone.
    """
    (start, end), (from_, to) = left_period, right_period
    values = [F.col(c).alias(f"other_{c}") for c in keep]
    keys = [F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(on)]
    others = right.filter(present([r for _, r in on])).select(*keys, F.col(from_).alias("_from"), F.col(to).alias("_to"), *values)
    mine = left.filter(present([a for a, _ in on]))
    same = [F.col(a) == F.col(f"_k{i}") for i, (a, _) in enumerate(on)]
    bins = [F.col(a) == F.col(b) for a, b in (("_width", "_other_width"), ("_bin", "_other_bin"))]
    both = [F.col(start) <= F.col("_to"), F.col("_from") <= F.col(end)]
    once = F.col("_bin") == _bin(F.greatest(F.col(start), F.col("_from")), F.col("_width"))
    found = None
    for longer, shorter in (("own", "from own"), ("above own", "own")):
        there = _by_width(others, "_from", "_to", days, shorter).withColumnsRenamed({"_width": "_other_width", "_bin": "_other_bin"})
        pairs = _by_width(mine, start, end, days, longer).join(there, reduce(and_, [*same, *bins, *both, once]))
        pairs = pairs.select(*left.columns, *[f"other_{c}" for c in keep])
        found = pairs if found is None else found.unionByName(pairs)
    return found


def _by_width(rows: DataFrame, start: str, end: str, days: int, which: str) -> DataFrame:
    """Valid periods once for each bin of their own width, of that and all wider ones, or of the wider ones alone."""
    own = _width(start, end, days)
    widths = F.array(*[F.lit(w) for w in _widths(days)])
    listed = {"own": F.array(own), "from own": F.filter(widths, lambda w: w >= own), "above own": F.filter(widths, lambda w: w > own)}
    each = rows.filter(_valid(start, end)).withColumn("_width", F.explode(listed[which]))
    return each.withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), F.col("_width")), _bin(F.col(end), F.col("_width")))))
