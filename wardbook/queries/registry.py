"""Keys of all registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from wardbook.queries import adapter
from wardbook.queries.job_sql import JOB_KEYS, job_sql
from wardbook.queries.operator_queries import ENTRIES
from wardbook.queries.report_queries import REPORTS

Query = Callable[[SparkSession, str], DataFrame]


def _job(key: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = adapter.run_folder(spark, sf_dir, key)
        return adapter.warehouse(spark, sf_dir, folder).staged(key, folder)

    return run


def _operator(name: str) -> Query:
    build, _ = ENTRIES[name]
    return lambda spark, sf_dir: build(cache(lambda table: adapter.read(spark, sf_dir, table)))


def _report(name: str) -> Query:
    build, _ = REPORTS[name]
    return lambda spark, sf_dir: build(spark, sf_dir, adapter.run_folder(spark, sf_dir, name))


def queries() -> dict[str, Query]:
    jobs = {name: _job(key) for key, name in JOB_KEYS.items()}
    return {**{name: _operator(name) for name in ENTRIES}, **{name: _report(name) for name in REPORTS}, **jobs}


def oracle_sql() -> dict[str, str]:
    jobs = {name: job_sql(key) for key, name in JOB_KEYS.items()}
    return {**{name: sql for name, (_, sql) in (ENTRIES | REPORTS).items()}, **jobs}
