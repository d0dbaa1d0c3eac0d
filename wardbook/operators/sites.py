"""Reading the same entity from several sites as one relation."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from wardbook.config import Site


def select_as(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Pick columns under new names: ``{new_name: old_name_or_expression}``."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in mapping.items()])


def tag_site(df: DataFrame, site: Site, id_col: str, name_col: str) -> DataFrame:
    return df.withColumns({id_col: F.lit(site.id), name_col: F.lit(site.name)})


@dataclass(frozen=True)
class Stacked:
    """Rows of several sites in one relation; ``number`` is the column with a site's place in ``sites``."""

    sites: Sequence[Site]
    rows: DataFrame
    number: str


def federate(
    branches: Iterable[tuple[Site, DataFrame]] | Stacked,
    columns: Mapping[str, Column],
    *,
    site_id: str,
    site_name: str,
    where: Callable[[Site], Column] | None = None,
) -> DataFrame:
    """Clean each site's table the same way, tag it with its site, and stack the results.

    The tag is a constant per branch, so a later filter on the site prunes whole branches.
    Rows that come stacked already are read in one pass; those of no known site are left out.
    """
    if isinstance(branches, Stacked):
        return _federate_stacked(branches, columns, site_id, site_name, where)
    parts = []
    for site, raw in branches:
        rows = raw if where is None else raw.filter(where(site))
        parts.append(tag_site(select_as(rows, columns), site, site_id, site_name))
    return reduce(DataFrame.unionByName, parts)


def _federate_stacked(
    stacked: Stacked, columns: Mapping[str, Column], site_id: str, site_name: str, where: Callable[[Site], Column] | None
) -> DataFrame:
    number = F.col(stacked.number)
    keep = [number == no if where is None else (number == no) & where(site) for no, site in enumerate(stacked.sites)]

    def tag(values: Sequence) -> Column:
        *others, last = values
        out = F.lit(last)
        for no, value in reversed(list(enumerate(others))):
            out = F.when(number == no, value).otherwise(out)
        return out

    tags = {site_id: tag([s.id for s in stacked.sites]), site_name: tag([s.name for s in stacked.sites])}
    return select_as(stacked.rows.filter(reduce(or_, keep)), {**columns, **tags})
