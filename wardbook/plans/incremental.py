"""Jobs brought up to date year by year, from the activities that changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from wardbook.operators.storage import stored
from wardbook.plans.warehouse import JOBS, Warehouse
from wardbook.sources.partitioned import publish_by_year, read_years, refresh_changed
from wardbook.sources.schemas import OUTPUTS

# Jobs whose rows of a year follow from the activities of that year, and where the year is.
_YEAR_COLUMN = {"t13": "year", "t14": "month", "t20": "month", "t22": "year", "t23": "year", "t24": "year"}


def _year(key: str) -> Column:
    """The year of a job's row, from a year or a month such as 2024-05."""
    return F.substring(F.col(_YEAR_COLUMN[key]).cast("string"), 1, 4).cast("int")


def refresh_years(warehouse: Warehouse, keys: Sequence[str] = tuple(_YEAR_COLUMN), folder: str | None = None) -> list[int | None]:
    """Bring the activities and the jobs that follow from them year by year up to date; returns the years that changed.

    Activities are cleansed anew and compared with the stored ones by content digests per
    year; only years that differ are written. The jobs are then composed from the stored
    activities of these years alone, whose folders are all that is read of them, and replace
    the same years of their tables. People and participations are read as they are: what a
    job says of a year depends on them only through that year's activities, so a change in
    them alone calls for a full refresh, ``Warehouse.publish``.

    Jobs that follow from another of ``keys`` (``t22`` from ``t13``) read its stored years
    instead of composing it anew. With a ``folder`` the cleansed activities and what the jobs
    read repeatedly are written there first, so nothing is computed twice.
    """
    cfg, spark = warehouse.cfg, warehouse.spark
    unknown = set(keys) - set(_YEAR_COLUMN)
    if unknown:
        raise ValueError(f"jobs {sorted(unknown)} do not follow year by year")
    spec = OUTPUTS["t02"]
    fresh = warehouse.table("t02")
    if folder:
        fresh = stored(fresh, f"{folder}/{spec.name}")
    years = refresh_changed(fresh, spec, cfg.db(spec.layer), time_col="activity_start_time", location=cfg.location)
    if years:
        part = Warehouse(spark, cfg, warehouse.source, from_catalog=False)
        part.tables["t02"] = read_years(spark, spec, cfg.db(spec.layer), years)
        due = [k for k in JOBS if k in set(keys)]
        if folder:
            part.stage(due, folder, kept=["t02"])
        for key in due:
            own = OUTPUTS[key]
            publish_by_year(part.table(key), own, cfg.db(own.layer), time_col=_year(key), years=years, location=cfg.location)
            part.tables[key] = read_years(spark, own, cfg.db(own.layer), years)
    return years
