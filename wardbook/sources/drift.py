"""Sites whose tables differ: renamed, missing and wider columns brought to one schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from wardbook.config import Site

# What a type may widen to, narrowest first. Anything becomes text.
_LADDERS = (
    ("tinyint", "smallint", "int", "bigint", "decimal(38,10)", "string"),
    ("tinyint", "smallint", "int", "double", "string"),
    ("float", "double", "string"),
    ("date", "timestamp_ntz", "string"),
    ("boolean", "string"),
)
DRIFT = "site_id int, column_name string, kind string, found string, used string"


def widest(types: Iterable[T.DataType]) -> T.DataType:
    """The narrowest type that holds every value of all of them; text where nothing else does."""

    def wider(a: str, b: str) -> str:
        if a == b:
            return a
        ladders = [x for x in _LADDERS if a in x and b in x]
        if not ladders:
            return "string"
        # bigint and double meet in text, since doubles cannot hold every bigint.
        return min((x[max(x.index(a), x.index(b))] for x in ladders), key=lambda t: t == "string")

    return T._parse_datatype_string(reduce(wider, [t.simpleString() for t in types]))


def harmonise(
    sites: Iterable[tuple[Site, DataFrame]],
    schema: T.StructType,
    *,
    renames: Mapping[int, Mapping[str, str]] | None = None,
    required: Iterable[str] = (),
) -> tuple[list[tuple[Site, DataFrame]], DataFrame]:
    """Every site's table under one schema, and what had to be done to it.

    ``renames`` maps a site's own column names to the declared ones. A column that a site
    lacks is NULL there, unless it is ``required``, which is an error. A column that a site
    has in a wider type than declared gets the widest type of all sites, everywhere, so no
    value is lost. The report has a row for every renamed, missing, widened, cast and
    undeclared column: (``site_id``, ``column_name``, ``kind``, ``found``, ``used``). Only
    schemas are looked at; no data is read.
    """
    given = [(site, df.withColumnsRenamed(dict((renames or {}).get(site.id, {})))) for site, df in sites]
    types = {f.name: [f.dataType] + [df.schema[f.name].dataType for _, df in given if f.name in df.columns] for f in schema}
    used = T.StructType([T.StructField(f.name, widest(types[f.name]), True, f.metadata) for f in schema])
    drift, out = [], []
    for site, df in given:
        lacking = set(required) - set(df.columns)
        if lacking:
            raise ValueError(f"{site.name} lacks columns {sorted(lacking)}")
        drift += [(site.id, new, "renamed", old, new) for old, new in (renames or {}).get(site.id, {}).items()]
        columns = []
        for f in used:
            declared, there = schema[f.name].dataType.simpleString(), df.schema[f.name].dataType if f.name in df.columns else None
            final = f.dataType.simpleString()
            if there is None:
                drift.append((site.id, f.name, "missing", None, final))
                columns.append(F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata))
                continue
            if there.simpleString() != declared:
                drift.append((site.id, f.name, "widened" if final != declared else "cast", there.simpleString(), final))
            columns.append(F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata))
        drift += [(site.id, c, "undeclared", df.schema[c].dataType.simpleString(), None) for c in df.columns if c not in used.names]
        out.append((site, df.select(*columns)))
    return out, given[0][1].sparkSession.createDataFrame(drift, DRIFT)
