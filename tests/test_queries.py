"""Every registered query against its SQL on the smallest driver tables."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from wardbook import queries as registered

SF_DIR = "/root/testdata/sf0.001"
# The corpus queries have tests of their own.
QUERIES, ORACLE = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def cells(frame):
    def text(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        return f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(zip(*[[text(v) for v in frame[c].tolist()] for c in frame.columns]), key=str)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Cartesian", "NestedLoop", "Expand", "Python", "SinglePartition"):
        assert unwanted not in plan
    got, want = df.toPandas(), duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want) > 0 and cells(got) == cells(want)


@pytest.mark.parametrize("name", ["t06_student_log", "t08_teacher_log", "t11_rotation_detail", "t12_name_abnormal", "t14_counts_vs_standard"])
def test_plans_without_broadcasts(spark, conf, name):
    """Sides too large to broadcast are joined by their keys, and titles are grouped by hash."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Cartesian", "NestedLoop", "BroadcastHashJoin", "SinglePartition", "SortAggregate"):
        assert unwanted not in plan
    assert "SortMergeJoin" in plan


def test_registered_queries_are_all_in_the_contract():
    assert QUERIES.keys() <= contract.queries().keys() and ORACLE.keys() <= contract.oracle_sql().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
