"""Queries that write tables, in fresh sessions over one warehouse folder."""

import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wardbook.sources import OUTPUTS, publish
from wardbook.sources.schemas import schema

ROOT = Path(__file__).resolve().parents[1]
RUN = """
import sys
from wardbook import queries
from wardbook.session import build_session
folder, names = sys.argv[1], sys.argv[2:]
spark = build_session("again", "local[2]", **{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": folder})
spark.sparkContext.setLogLevel("OFF")
for name in names:
    print(name, queries.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("names", [["catalog_sites", "catalog_shared_inputs"], ["catalog_shared_inputs", "publish_roundtrip", "catalog_sites"]])
def test_catalog_queries_in_two_sessions(tmp_path, names):
    said = set()
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", RUN, str(tmp_path), *names], cwd=ROOT, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
        said.add(done.stdout)
    assert len(said) == 1 and [line.split()[0] for line in said.pop().splitlines()] == names


def test_a_refresh_never_takes_the_table_away(spark, tmp_path):
    spec = replace(OUTPUTS["t13"], name="always_there", schema=schema("a int"))
    rows = lambda n: spark.range(n).select(F.col("id").cast("int").alias("a"))
    for location, db in ((None, "wardbook_there"), (str(tmp_path), "wardbook_there_external")):
        name = publish(rows(1), spec, db, location=location, versions=2)
        reader = spark.table(name)
        files = reader.inputFiles()
        said = []
        spark.sparkContext._jvm.java.lang.System.gc()
        real = spark.sql

        def watched(text, *args, real=real, said=said, **kwargs):
            said.append(text.split()[0:2])
            return real(text, *args, **kwargs)

        spark.sql = watched
        try:
            publish(rows(2), spec, db, location=location, versions=2)
        finally:
            del spark.sql
        assert ["DROP", "TABLE"] not in said and ["ALTER", "TABLE"] in said
        assert spark.table(name).count() == 2
        assert reader.inputFiles() == files and reader.count() in (1, 2)
        assert spark.read.parquet(*files).count() == 1  # the version before stays for its readers
        publish(rows(3), spec, db, location=location, versions=2)
        with pytest.raises(Exception, match="(?i)path"):
            spark.read.parquet(*files).count()
        changed = replace(spec, schema=schema("a bigint, b int"))
        publish(rows(4).withColumn("b", F.lit(1)), changed, db, location=location)
        assert spark.table(name).columns == ["a", "b"] and spark.table(name).count() == 4
