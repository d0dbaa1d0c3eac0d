"""Mixing sources to target weights by iterative proportional fitting (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardbook.llm.common import run_folder, stored

WORDS = r"[^\x20\x09-\x0D]+"
SIDES = ("_m0", "_m1", "_m2", "_m3", "_m4")
NONE = "(none)"


def topic(text_col: str = "text") -> Column:
    """A coarse topic from the text: tables, contact pages, prose."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.when(text.contains("|"), "table").when(text.contains("@"), "contact").otherwise("prose")


def tempered(cells: DataFrame, side: str, power: float) -> DataFrame:
    """(value, share): the present shares of tokens to ``power``, scaled to sum 1."""
    held = cells.groupBy(F.col(side).alias("value")).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("p"))
    total = held.agg(F.sum("p")).first()[0] or 1.0
    return held.select("value", (F.col("p") / total).alias("share"))


def rake(cells: DataFrame, sides: list[str], rounds: int, folder: str, *, per_table: int = 4) -> DataFrame:
    """``weight`` of every cell after ``rounds`` of fitting to ``<side>_share`` on each side in turn.

    Each step scales the cells of a value to the value's share. Cells are few against
    documents, and every step is a running total over its own side; each ``per_table``
    rounds become a table, so plans stay short.
    """
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    for n in range(rounds):
        for side in sides:
            held = F.sum("weight").over(Window.partitionBy(side))
            now = now.withColumn("weight", F.coalesce(F.try_divide(F.col("weight") * F.col(f"{side}_share"), held), F.lit(0.0)))
        if n % per_table == per_table - 1 or n == rounds - 1:
            now = stored(now, f"{folder}/raked-{n}")
    return now


def calibrated(cells: DataFrame, budget_share: float) -> DataFrame:
    """``probability`` of every cell: in proportion to weight per token, at most 1, with
    ``budget_share`` of all tokens expected.

    Cells whose probability would exceed 1 are taken whole and the rest scaled up, until no
    further cell exceeds; each pass is one aggregate row.
    """
    total = cells.agg(F.sum("tokens").alias("t"), F.sum("weight").alias("w")).first()
    if not total.t or not total.w:
        return cells.withColumn("probability", F.lit(1.0))
    budget, scale, whole = budget_share * total.t, budget_share * total.t / total.w, -1
    rate = F.try_divide("weight", F.col("tokens").cast("double"))
    while True:
        full = F.col("tokens") > 0, rate * scale >= 1
        row = cells.agg(
            F.count_if(full[0] & full[1]).alias("n"),
            F.sum(F.when(full[0] & full[1], F.col("tokens"))).alias("t"),
            F.sum(F.when(full[0] & ~full[1], F.col("weight"))).alias("w"),
        ).first()
        if row.n == whole or not row.w:
            break
        whole, scale = row.n, (budget - (row.t or 0)) / row.w
    return cells.withColumn(
        "probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), rate * scale)).otherwise(1.0)
    )


def draw(id_col: str, seed: int) -> Column:
    """A number from 0 to 1 that depends on the id alone: 52 bits of an MD5."""
    text = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    sides: Mapping[str, Column] | None = None,
    targets: Mapping[str, DataFrame] | None = None,
    power: float = 0.7,
    budget_share: float = 0.5,
    rounds: int = 16,
    seed: int = 17,
    folder: str | None = None,
) -> DataFrame:
    """Every row with ``n_tokens``, its value on each side, ``probability`` and ``sampled``.

    ``sides`` are the marginals, by default source, language and topic; ``targets`` gives
    (value, share) for some of them, others aim at their present shares to ``power``. A
    value without a target gets weight 0. Tokens here are words, runs without the
    characters 9 to 13 and 32.

    1. Tokens are summed per cell (one value per side), an aggregate that combines before
       its shuffle.
    2. Cell weights are raked to the targets, and probabilities follow so that
       ``budget_share`` of all tokens is expected; a cell is never taken more than once.
    3. Every row looks its cell's probability up and is sampled by a hash of its id.

    Null values on a side are a value of their own, ``(none)``. Null text has no tokens;
    cells without tokens are taken whole, as they cost nothing. Equal ids are drawn
    alike; rows with null id share one draw. An empty table gives no rows. Input columns
    stay; the added ones replace input columns of their name.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "mixing")
    sides = dict(sides or {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(text_col)})
    own = dict(zip(sides, SIDES))
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("bigint")
    values = [F.coalesce(column.cast("string"), F.lit(NONE)).alias(own[side]) for side, column in sides.items()]
    cells = stored(
        docs.select(*values, words.alias("tokens")).groupBy(*own.values()).agg(F.sum("tokens").alias("tokens")), f"{folder}/cells"
    )
    aimed = cells
    for side, name in own.items():
        given = (targets or {}).get(side)
        share = tempered(cells, name, power) if given is None else given.select(F.col("value").cast("string"), F.col("share").cast("double"))
        share = share.select(F.col("value").alias(f"{name}_value"), F.col("share").alias(f"{name}_share"))
        aimed = aimed.join(share, F.col(name) == F.col(f"{name}_value"), "left").drop(f"{name}_value").fillna(0.0, [f"{name}_share"])
    fitted = calibrated(rake(stored(aimed, f"{folder}/aimed"), list(own.values()), rounds, folder), budget_share)
    chances = stored(fitted.select(*[F.col(n).alias(f"{n}_cell") for n in own.values()], "probability"), f"{folder}/chances")
    added = {*sides, "n_tokens", "probability", "sampled"}
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(*kept, *values, words.alias("n_tokens"), draw(id_col, seed).alias("_draw"))
    on = [F.col(n) == F.col(f"{n}_cell") for n in own.values()]
    return rows.join(chances, on).select(
        *kept, *[F.col(n).alias(side) for side, n in own.items()], "n_tokens", "probability", (F.col("_draw") < F.col("probability")).alias("sampled")
    )


def mixing_sql(*, power: float = 0.7, budget_share: float = 0.5, rounds: int = 16, seed: int = 17) -> str:
    """The same over a table ``documents`` with source, language and topic."""
    steps, last = [], "aimed"
    for n in range(rounds):
        for side in ("source", "lang", "topic"):
            step = f"r{n}_{side}"
            steps.append(
                f"{step} AS MATERIALIZED (SELECT * REPLACE (coalesce(weight * {side}_share / nullif(sum(weight) OVER (PARTITION BY {side}), 0), 0)"
                f" AS weight) FROM {last})"
            )
            last = step
    shares = ", ".join(
        f"{s}_shares AS (SELECT {s}, pow(sum(tokens), {power}) / sum(pow(sum(tokens), {power})) OVER () AS {s}_share FROM cells GROUP BY {s})"
        for s in ("source", "lang", "topic")
    )
    return f"""
WITH rows AS (
    SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
           CASE WHEN contains(text, '|') THEN 'table' WHEN contains(text, '@') THEN 'contact' ELSE 'prose' END AS topic,
           coalesce(len(regexp_extract_all(text, '{WORDS}')), 0) AS n_tokens,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{seed}'), 1, 13))::BIGINT::DOUBLE / {1 << 52} AS draw
    FROM documents
),
cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM rows GROUP BY ALL),
{shares},
aimed AS (
    SELECT cells.*, source_share, lang_share, topic_share, tokens AS weight
    FROM cells JOIN source_shares USING (source) JOIN lang_shares USING (lang) JOIN topic_shares USING (topic)
),
{", ".join(steps)},
-- Cells by falling weight per token: the first k are taken whole for the smallest k that leaves the others below 1.
ranked AS (
    SELECT *, coalesce(sum(tokens) OVER before, 0) AS whole, sum(weight) OVER rest AS open, weight / tokens AS rate
    FROM {last} WHERE tokens > 0
    WINDOW before AS (ORDER BY weight / tokens DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           rest AS (ORDER BY weight / tokens DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
scale AS (
    SELECT min_by(({budget_share} * (SELECT sum(tokens) FROM cells) - whole) / open, whole) AS s
    FROM ranked WHERE ({budget_share} * (SELECT sum(tokens) FROM cells) - whole) / open * rate < 1
),
chance AS (
    SELECT source, lang, topic, CASE WHEN tokens > 0 THEN least(1.0, weight / tokens * s) ELSE 1.0 END AS probability
    FROM {last}, scale
)
SELECT doc_id, source, lang, topic, n_tokens, round(probability, 6) AS probability, draw < probability AS sampled
FROM rows JOIN chance USING (source, lang, topic)
"""
