"""Which of several namesakes a rotation belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wardbook.operators.joins import Keys, left_join
from wardbook.operators.periods import events_in_period, overlapping
from wardbook.operators.storage import stored

ONLY, EVIDENCE, AMBIGUOUS, UNKNOWN = "only", "evidence", "ambiguous", "unknown"


def one_person_per_rotation(
    rotations: DataFrame,
    people: DataFrame,
    log: DataFrame,
    *,
    on: Keys,
    person: str,
    period: tuple[str, str],
    log_on: Keys,
    log_person: str,
    log_time: str,
    folder: str,
    rounds: int = 3,
    alias: str = "person_id",
) -> DataFrame:
    """Distinct rotations, each with one person's id or none, how it was found, and the evidence.

    ``on`` pairs rotation columns with those of ``people``: who agrees in all of them is a
    candidate. ``link`` says ``only`` (one candidate), ``evidence``, ``ambiguous`` (several
    candidates, none of them decided on) or ``unknown`` (no candidate).

    Evidence for a candidate is the number of their log entries (``log_on``, ``log_time``)
    in the rotation's period. A person is in one place at a time, so rotations whose periods
    overlap compete. In each of ``rounds`` rounds a rotation claims its best candidate if no
    other has as much evidence, and gets them if no overlapping rotation claims them with as
    much; then it needs nobody else, and nobody else can have them in that time. What is
    still open after the last round is ambiguous.

    Candidates without evidence are never listed, only counted, so a name that very many
    people and rotations share gives no pairs but those that the log bears out. A rotation
    without a valid period has no evidence. Tables of each round are written to ``folder``.
    """
    start, end = period
    counted = people.groupBy(*[c for _, c in on]).agg(F.count_distinct(person).alias("_candidates"), F.min(person).alias("_only"))
    # Equal rotations are dropped where the join by their keys put them: the rows are shuffled once
    # and, since candidates are far fewer and are looked up by hash, not sorted.
    known = left_join(rotations, counted.hint("shuffle_hash"), on, ["_candidates", "_only"]).distinct()
    # Numbers are fixed when they are written.
    known = known.withColumn("_id", F.monotonically_increasing_id())
    known = stored(known, f"{folder}/rotations")
    several = known.filter("_candidates > 1")
    heard = events_in_period(
        several.select("_id", *dict.fromkeys([*[c for c, _ in log_on], start, end])),
        log, log_on, start=start, end=end, at=log_time, keep=[log_person],
    )
    claims = heard.groupBy("_id", F.col(log_person).alias("_person"), F.col(start).alias("_start"), F.col(end).alias("_end"))
    claims = stored(claims.agg(F.count("*").alias("evidence")), f"{folder}/claims-0")
    best = Window.partitionBy("_id").orderBy(F.desc("evidence"), "_person")
    span, same = ("_start", "_end"), [("_person", "_person")]
    decided = []
    for step in range(1, rounds + 1):
        ranked = claims.withColumns({"_rank": F.row_number().over(best), "_next": F.lead("evidence", 1, 0).over(best)})
        picks = stored(ranked.filter("_rank = 1 AND evidence > _next").drop("_rank", "_next"), f"{folder}/picks-{step}")
        rivals = overlapping(picks, picks, same, left_period=span, right_period=span, keep=["_id", "evidence"])
        beaten = rivals.filter("_id <> other__id AND other_evidence >= evidence").select("_id").distinct()
        given = stored(picks.join(beaten, "_id", "left_anti"), f"{folder}/given-{step}")
        decided.append(given)
        if step < rounds:
            free = claims.join(given.select("_id"), "_id", "left_anti")
            taken = overlapping(free, given, same, left_period=span, right_period=span, keep=[]).select("_id", "_person").distinct()
            claims = stored(free.join(taken, ["_id", "_person"], "left_anti"), f"{folder}/claims-{step}")
    found = decided[0]
    for more in decided[1:]:
        found = found.unionByName(more)
    named = found.select(F.col("_id").alias("_given"), "_person", "evidence")
    linked = known.join(named, F.col("_id") == F.col("_given"), "left")
    sole = F.col("_candidates") == 1
    label = F.when(F.col("_candidates").isNull(), UNKNOWN).when(sole, ONLY).when(F.col("_given").isNotNull(), EVIDENCE).otherwise(AMBIGUOUS)
    return linked.select(
        *rotations.columns, F.when(sole, F.col("_only")).otherwise(F.col("_person")).alias(alias), label.alias("link"), "evidence"
    )
