"""Titles that nearly agree."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import combinations
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from wardbook.operators.joins import present


def words(title: Column) -> Column:
    """Lower-case words between blanks."""
    return F.filter(F.split(F.lower(title), r"\s+"), lambda x: x != "")


def bigrams(title: Column) -> Column:
    """Pairs of neighbouring characters, for titles without blanks; a single character is itself."""
    text = F.regexp_replace(F.lower(title), r"\s+", "")
    pairs = F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: F.substring(text, i, F.lit(2)))
    return F.when(F.length(text) > 1, pairs).when(F.length(text) == 1, F.array(text)).otherwise(F.array().cast("array<string>"))


def _least(percent: int, n: Column) -> Column:
    """The smallest whole number that is at least ``percent`` of ``n``."""
    return F.floor((n * percent + 99) / 100)


# (tokens in a key, tokens that two titles of the larger size may differ in): up to 15 keys for a title.
_DEPTHS = ((4, 2), (2, 4))


def _depth(percent: int, n: Column) -> Column:
    """How many of the tokens that a pair must share make one key, by the larger title's size."""
    must = _least(percent, n)
    out = F.lit(1)
    for tokens, differ in reversed(_DEPTHS):
        out = F.when((must >= tokens) & (n - must <= differ), tokens).otherwise(out)
    return out


def _keys(percent: int, n: Column, tokens: int, differ: int) -> Column:
    """Hashes of ``tokens`` tokens each, among the first of a title's set, in the order of the set."""
    first = F.least(n, n - _least(percent, n) + tokens)
    out = F.array().cast("array<bigint>")
    for size in range(tokens, tokens + differ + 1):
        some = [F.xxhash64(*[F.get("_set", F.lit(i)) for i in at]) for at in combinations(range(size), tokens)]
        out = F.when(first == size, F.array(*some)).otherwise(out)
    return out


def title_index(rows: DataFrame, group: Sequence[str], title: str, *, percent: int, tokens: Callable[[Column], Column]) -> DataFrame:
    """Titles (``_t``) of each group (``_g0``, …) with their tokens (``_set``), once for each key (``_depth``, ``_token``)."""
    known = rows.filter(present([*group, title])).select(*[F.col(c).alias(f"_g{k}") for k, c in enumerate(group)], F.col(title).alias("_t")).distinct()
    keys = [f"_g{k}" for k in range(len(group))]
    split = known.select(*keys, "_t", F.explode(F.array_distinct(tokens(F.col("_t")))).alias("_token"))
    often = split.groupBy("_token").agg(F.count("*").alias("_often")).withColumnRenamed("_token", "_name")
    ranked = split.join(often, F.col("_token") == F.col("_name")).groupBy(*keys, "_t")
    # A title's own tokens: as long as the title.
    ranked = ranked.agg(F.transform(F.sort_array(F.collect_list(F.struct("_often", "_token"))), lambda x: x["_token"]).alias("_set"))
    sized, n = ranked.withColumn("_n", F.size("_set")), F.col("_n")
    # Sizes that the larger of a title and a partner of it can have.
    depths = F.array_distinct(F.transform(F.sequence(n, F.floor(n * 100 / percent).cast("int")), lambda m: _depth(percent, m)))
    one = F.transform(F.slice("_set", F.lit(1), (n - _least(percent, n) + 1).cast("int")), lambda x: F.xxhash64(x))
    sized = sized.withColumn("_depth", F.explode(depths))
    first = one
    for several, differ in _DEPTHS:
        first = F.when(F.col("_depth") == several, _keys(percent, n, several, differ)).otherwise(first)
    sized = sized.withColumn("_first", F.array_distinct(first))
    return sized.select("*", F.explode("_first").alias("_token"))


def near_titles(rows: DataFrame, group: Sequence[str], title: str, *, percent: int = 80, tokens: Callable[[Column], Column] = words) -> DataFrame:
    """Pairs of different titles of a group whose tokens agree to ``percent`` or more (Jaccard).

    Returns ``group``, ``title``, ``other_title`` (the later in order), ``shared`` and
    ``together``, the sizes of the two token sets' intersection and union. All such pairs
    are found: sets that agree so far share some of the first tokens of both, if tokens are
    put in one order. That order is by rarity, so that common tokens stay out of the index.
    Where titles may differ in few tokens only, they are indexed under several of the tokens
    that they must share at once, so titles made of a few common words are compared with
    those that hardly differ, not with all that share a word. Pairs that differ too much in
    size are never compared, and a pair is compared under the first key it shares only. The
    index is joined by group and key, and a hot key is split at run time.

    Equal titles count once. Titles without tokens and rows with a NULL in the group give
    nothing.
    """
    keys = [f"_g{k}" for k in range(len(group))]
    index = title_index(rows, group, title, percent=percent, tokens=tokens)
    other = index.select(*[F.col(c).alias(f"{c}_") for c in index.columns])
    same = [F.col(c) == F.col(f"{c}_") for c in [*keys, "_depth", "_token"]]
    near = [F.col("_t") < F.col("_t_"), F.col("_n_") >= _least(percent, F.col("_n")), F.col("_n") >= _least(percent, F.col("_n_"))]
    near.append(_depth(percent, F.greatest("_n", "_n_")) == F.col("_depth"))
    once = F.element_at(F.array_intersect("_first", "_first_"), 1) == F.col("_token")
    pairs = index.join(other, reduce(and_, [*same, *near, once])).withColumn("shared", F.size(F.array_intersect("_set", "_set_")))
    pairs = pairs.withColumn("together", F.col("_n") + F.col("_n_") - F.col("shared"))
    return pairs.filter(F.col("shared") * 100 >= F.col("together") * percent).select(
        *[F.col(f"_g{k}").alias(c) for k, c in enumerate(group)], F.col("_t").alias(title), F.col("_t_").alias(f"other_{title}"), "shared", "together"
    )
