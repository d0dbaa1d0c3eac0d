"""DataFrame → DataFrame operators."""

from wardbook.operators.counts import (
    abnormal_headcount,
    class_counts,
    conditional_specialties,
    coverage,
    distinct_per,
    joined_distinct,
    presence_matrix,
    rollup_ratios,
    same_vs_other,
    standard_counts,
)
from wardbook.operators.intervals import fill_id, month_bucket_join, month_walk, rejected_intervals
from wardbook.operators.joins import (
    dedupe_keys,
    dedupe_rows,
    join_keeping_left,
    lookup_join,
    participation_log,
    population_events,
    registry_participants,
)
from wardbook.operators.naming import attach, classify_names
from wardbook.operators.ranking import rank_rate
from wardbook.operators.sites import federate, select_as, tag_site

__all__ = [
    "abnormal_headcount",
    "attach",
    "class_counts",
    "classify_names",
    "conditional_specialties",
    "coverage",
    "dedupe_keys",
    "dedupe_rows",
    "distinct_per",
    "federate",
    "fill_id",
    "join_keeping_left",
    "joined_distinct",
    "lookup_join",
    "month_bucket_join",
    "month_walk",
    "participation_log",
    "population_events",
    "presence_matrix",
    "rank_rate",
    "rejected_intervals",
    "registry_participants",
    "rollup_ratios",
    "same_vs_other",
    "select_as",
    "standard_counts",
    "tag_site",
]
