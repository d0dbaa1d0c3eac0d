"""Column helpers, one edge case per line."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardbook.config import Kind
from wardbook.functions import (
    any_present,
    backfill,
    clean_text,
    differs_any,
    is_kind,
    map_values,
    meets,
    month_of,
    percent_text,
    safe_ratio,
    same_all,
    sentinel_fill,
    since_month,
    since_year,
    surrogate_key,
    valid_key,
)


def values(spark, rows, schema, col):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i int, {schema}")
    return [r[0] for r in df.orderBy("_i").select(col.alias("v"), "_i").orderBy("_i").collect()]


DIRTY = [(' a\r\nb"c ',), ("   ",), ("\t",), (None,), ("",), ("ok",)]


def test_clean_text_with_default(spark):
    got = values(spark, DIRTY, "x string", clean_text("x", "未知"))
    assert got == ["a  b c", "未知", "\t", "未知", "未知", "ok"]


def test_clean_text_without_default_keeps_null_and_empty(spark):
    assert values(spark, DIRTY, "x string", clean_text("x")) == ["a  b c", "", "\t", None, "", "ok"]


def test_titles_keep_blanks_and_quotes(spark):
    got = values(spark, DIRTY, "x string", clean_text("x", strip_quotes=False, trim=False))
    assert got == [' a  b"c ', "   ", "\t", None, "", "ok"]


def test_sentinel_fill(spark):
    assert values(spark, [(None,), (0,), (5,)], "x int", sentinel_fill("x", -1)) == [-1, 0, 5]


def test_map_values_first_match_and_null(spark):
    col = map_values("x", {"301": 130, "b": 110}, -1)
    assert values(spark, [("301",), ("b",), ("c",), (None,)], "x string", col) == [130, 110, -1, -1]


def test_backfill_only_replaces_the_sentinel(spark):
    rows = [(-1, 7), (-1, None), (3, 7), (None, 7)]
    assert values(spark, rows, "x int, y int", backfill("x", "y", -1)) == [7, -1, 3, None]


def test_surrogate_key_is_null_if_a_part_is(spark):
    got = values(spark, [(130, 5), (130, None)], "a int, b bigint", surrogate_key("a", "b"))
    assert got == ["130_5", None]


def test_month_of(spark):
    assert values(spark, [(dt.datetime(2019, 3, 31, 23, 59),), (None,)], "t timestamp_ntz", month_of("t")) == [
        "2019-03",
        None,
    ]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_year_cutoff_at_the_boundary(spark, kind):
    rows = [(dt.datetime(2018, 12, 31, 23, 59, 59),), (dt.datetime(2019, 1, 1),), (None,)]
    assert values(spark, rows, f"t {kind}", since_year("t", 2019)) == [False, True, None]


def test_year_and_month_cutoffs_on_plain_columns(spark):
    assert values(spark, [(2018,), (2019,)], "y int", since_year("y", 2019, is_year=True)) == [False, True]
    assert values(spark, [("2018-12",), ("2019-01",), (None,)], "m string", since_month("m", "2019-01")) == [
        False,
        True,
        None,
    ]


def test_year_cutoff_reaches_the_reader(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").filter(since_year("o_orderdate", 1998))
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "year(" not in plan and "1998-01-01" in plan


def test_valid_key_keeps_zero(spark):
    got = values(spark, [(None,), (-1,), (0,), (4,)], "k int", valid_key("k"))
    assert got == [False, False, True, True]


def test_any_present(spark):
    rows = [(None, None), (1, None), (None, 2)]
    assert values(spark, rows, "a int, b int", any_present("a", "b")) == [False, True, True]


def test_kind_needs_id_and_name(spark):
    rows = [(14, "入院教育"), (14, "x"), (15, "入院教育")]
    assert values(spark, rows, "i int, n string", is_kind("i", "n", Kind(14, "入院教育"))) == [True, False, False]


def test_pairs_under_three_valued_logic(spark):
    rows = [(1, 1, "a", "a"), (1, 2, "a", "a"), (1, None, "a", "b"), (1, None, "a", "a")]
    pairs = [("a", "b"), ("c", "d")]
    assert values(spark, rows, "a int, b int, c string, d string", same_all(pairs)) == [True, False, False, None]
    assert values(spark, rows, "a int, b int, c string, d string", differs_any(pairs)) == [False, True, True, None]


def test_meets_passes_without_a_standard(spark):
    assert values(spark, [(2, 2), (1, 2), (0, None)], "c int, s int", meets("c", "s")) == [1, 0, 1]


def test_ratio_is_half_up_and_null_for_zero(spark):
    rows = [(57, 100), (1, 3), (57, 200), (1, 0), (None, 2), (1, None)]
    assert values(spark, rows, "a int, b int", safe_ratio("a", "b")) == [0.57, 0.33, 0.29, None, None, None]


def test_percent_texts(spark):
    rows = [(57, 100), (2, 3), (1, 1), (0, 5), (1, 0)]
    assert values(spark, rows, "a int, b int", percent_text("a", "b")) == ["57.0%", "66.67%", "100.0%", "0.0%", None]
    assert values(spark, rows, "a int, b int", percent_text("a", "b", round_first=True)) == [
        "56.99999999999999%",
        "67.0%",
        "100.0%",
        "0.0%",
        None,
    ]


def test_columns_stay_in_the_jvm(spark):
    df = spark.range(3).select(clean_text(F.col("id").cast("string"), "x").alias("x"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
