"""Timings on the driver's tables; prints one JSON line.

``python bench.py``          all 28 jobs stored one after another (each reads the stored
                             tables below it), then single operators into a no-op sink.
``python bench.py --pairs``  straightforward forms against the ones used here, for

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all),
BENCH_RUNS (default 3; the median counts, after one warm-up), BENCH_MAX_MONTHS (default:
every month of a rotation; 12 measures the older window of thirteen months).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from dataclasses import replace
from tempfile import mkdtemp

from pyspark.sql import DataFrame, Window, functions as F

from wardbook import queries as registered
from wardbook.config import ENTITIES
from wardbook.functions import safe_ratio
from wardbook.operators import month_walk, rank_rate, registry_participants, same_vs_other
from wardbook.plans import JOBS
from wardbook.queries import adapter
from wardbook.queries.job_sql import JOB_KEYS
from wardbook.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 4)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
MAX_MONTHS = int(os.environ["BENCH_MAX_MONTHS"]) if "BENCH_MAX_MONTHS" in os.environ else None

OPERATORS = (
    "federated_union",
    "literal_dictionary",
    "clean_text",
    "dictionary_backfill",
    "semi_by_role",
    "participation_log",
    "id_backfill_join",
    "population_events",
    "month_walk",
    "month_bucket_join",
    "overview",
    "rank_avg_times",
    "standard_flag",
    "missed_standard_months",
    "conditional_sums",
    "coverage_by_site_year",
    "same_vs_other",
    "abnormal_headcount",
    "presence_matrix",
    "name_classification",
    "name_report",
    "ratio_of_sums",
    "ordered_report",
    "period_match",
    "missed_standard_runs",
)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_of(build, runs: int = RUNS) -> float:
    drain(build())
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        drain(build())
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def store_all(spark, folder: str) -> dict[str, float]:
    warehouse = adapter.warehouse(spark, SF_DIR, f"{folder}/inputs", replace(adapter.CFG, location=folder, max_months=MAX_MONTHS))
    start = time.perf_counter()
    for entity in ENTITIES:
        warehouse.source.shaped(entity)
    # Shaping the driver's tables into inputs is no job's work.
    times = {"input_shaping": round(time.perf_counter() - start, 3)}
    for key in JOBS:
        start = time.perf_counter()
        warehouse.publish([key])
        times[JOB_KEYS[key]] = round(time.perf_counter() - start, 3)
    return times


def headline(spark, scratch: str) -> dict:
    store_all(spark, f"{scratch}/warm")
    times = store_all(spark, f"{scratch}/run")
    known = registered.queries()
    for name in OPERATORS:
        times[name] = median_of(lambda: known[name](spark, SF_DIR))
    return {
        "metric": "28 jobs stored end to end, plus single operators (median)",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "jobs_end_to_end": round(sum(times[n] for n in JOB_KEYS.values()), 3),
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
    }


def pairs(spark, scratch: str) -> dict:
    """{pair: [straightforward, used here]} in seconds."""
    read = lambda name: adapter.read(spark, SF_DIR, name)
    lines, parts = read("lineitem"), read("part").select("p_partkey", "p_name")
    spans = lines.join(read("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey", "o_orderdate", "l_shipdate"
    )
    supplied = (
        read("orders")
        .join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(read("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    same, other = F.col("c_nationkey") == F.col("s_nationkey"), F.col("c_nationkey") != F.col("s_nationkey")

    elapsed = F.floor(F.months_between("l_shipdate", "o_orderdate"))
    longest = spans.agg(F.max(elapsed).alias("m")).first().m

    def all_steps():
        steps = F.explode(F.array(*[F.lit(n) for n in range(longest + 1)]))
        return (
            spans.withColumn("n", steps)
            .filter("n <= floor(months_between(l_shipdate, o_orderdate)) AND o_orderdate <= l_shipdate")
            .withColumn("month", F.date_format(F.add_months(F.trunc("o_orderdate", "MM"), F.col("n")), "yyyy-MM"))
        )

    def ratio_twice():
        rate = safe_ratio("a", "b")
        year = F.year("o_orderdate").alias("y")
        sums = supplied.groupBy(year, "c_nationkey").agg(F.count_if(same).alias("a"), F.count("*").alias("b"))
        window = Window.partitionBy("y").orderBy(rate.desc_nulls_last(), "c_nationkey")
        once = rank_rate(sums, "a", "b", "y", rate="r", rank="p", tie=["c_nationkey"])
        return sums.select("*", rate.alias("r"), F.row_number().over(window).alias("p")), once

    out = {
        "participants": [
            lambda: parts.join(lines, F.col("p_partkey") == F.col("l_partkey"), "left")
            .filter("l_partkey IS NOT NULL AND l_returnflag = 'R'")
            .select("p_partkey", "p_name")
            .distinct(),
            lambda: registry_participants(
                parts, lines, [("p_partkey", "l_partkey")], role_col="l_returnflag", role="R"
            ),
        ],
        "multi-distinct": [
            lambda: supplied.groupBy("c_nationkey", F.year("o_orderdate").alias("y")).agg(
                F.count_distinct("l_partkey").alias("n"),
                F.count_distinct(F.when(same, F.col("l_partkey"))).alias("s"),
                F.count_distinct(F.when(other, F.col("l_partkey"))).alias("o"),
            ),
            lambda: same_vs_other(
                supplied.withColumn("y", F.year("o_orderdate")),
                ["c_nationkey", "y"],
                "l_partkey",
                [("c_nationkey", "s_nationkey")],
                total="n",
                same="s",
                other="o",
            ),
        ],
        "month walk": [all_steps, lambda: month_walk(spans, "o_orderdate", "l_shipdate")],
        "rank": [lambda: ratio_twice()[0], lambda: ratio_twice()[1]],
    }
    return {name: [median_of(build, 5) for build in builds] for name, builds in out.items()}


def main() -> None:
    scratch = mkdtemp(prefix="wardbook-bench-")
    spark = build_session(
        "wardbook-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    result = (pairs if "--pairs" in sys.argv[1:] else headline)(spark, scratch)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
