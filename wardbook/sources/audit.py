"""What a cleansing pass rejects, and why."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T


@dataclass(frozen=True)
class Audit:
    """Rows that passed, in their declared types; the others as they came, with reasons; and counts.

    ``counts`` has the rows seen, the rows rejected and, by name, those that failed each
    rule; a row may fail several.
    """

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def audit(rows: DataFrame, schema: T.StructType, rules: Mapping[str, Column], path: str) -> Audit:
    """Check every row against rules and declared types in one pass.

    ``rules`` must hold, and one that comes out NULL does not. Columns of ``schema`` are
    cast; where that loses a value, the row fails ``type of <column>``. The pass writes both
    kinds of rows to ``path`` and counts as it goes (an ``Observation``), so neither the
    counts nor the rejected rows need a second scan. Rejected rows are kept whole, as JSON.
    """
    named = {f.name: F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})") for f in schema}
    failures = {name: ~F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    failures |= {f"type of {c}": F.col(c).isNotNull() & cast.isNull() for c, cast in named.items()}
    reasons = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in failures.items()]), lambda x: x.isNotNull())
    checked = rows.select(*[cast.alias(c) for c, cast in named.items()], reasons.alias("reasons"), F.to_json(F.struct("*")).alias("raw"))
    bad = F.size("reasons") > 0
    checked = checked.withColumns({"rejected": bad, "raw": F.when(bad, F.col("raw"))})
    seen = Observation()
    labels = {"rows": F.count(F.lit(1)), "rejected": F.count_if("rejected")}
    labels |= {name: F.count_if(F.array_contains("reasons", name)) for name in failures}
    watched = checked.observe(seen, *[count.alias(f"m{k}") for k, count in enumerate(labels.values())])
    watched.write.mode("overwrite").partitionBy("rejected").parquet(path)
    counts = seen.get
    stored = rows.sparkSession.read.schema(checked.schema).parquet(path)
    return Audit(
        stored.filter("NOT rejected").select(*schema.names),
        stored.filter("rejected").select("reasons", "raw"),
        {name: counts.get(f"m{k}") or 0 for k, name in enumerate(labels)},
    )
