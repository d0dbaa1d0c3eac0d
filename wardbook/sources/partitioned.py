"""Tables by year: refreshed year by year, read without the years that are not asked for."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from wardbook.functions import since_year
from wardbook.sources.schemas import TableSpec
from wardbook.sources.sink import conform, database_folder, ensure_database

YEAR = "refresh_year"


def by_year_name(spec: TableSpec, db: str) -> str:
    return f"`{db}`.`{spec.name}__by_year`"


def _labelled(df: DataFrame, spec: TableSpec, time_col: str | Column) -> DataFrame:
    """With the year: that of a time, or what an expression gives."""
    year = F.year(time_col) if isinstance(time_col, str) else time_col
    return conform(df, spec.schema).withColumn(YEAR, year.cast("int"))


def publish_by_year(
    df: DataFrame, spec: TableSpec, db: str, *, time_col: str | Column, years: Sequence[int | None] | None = None, location: str | None = None
) -> str:
    """Replace a table, or only some of its years; returns the name to read it by.

    Rows lie in one folder for each year of ``time_col``, a time or an expression that gives
    the year (those without one in a folder of their own), behind a view that has the declared columns in their declared order. With ``years`` only
    rows of these years are taken from ``df``, and only their folders are written: those of
    other years, and readers of them, notice nothing. A listed year without rows goes. Rows
    per year are counted in the pass that writes them.
    """
    spark = df.sparkSession
    ensure_database(spark, db)
    parts, view = by_year_name(spec, db), f"`{db}`.`{spec.name}`"
    rows = _labelled(df, spec, time_col)
    if years is None or not spark.catalog.tableExists(parts):
        folder = f"{location.rstrip('/')}/{db}" if location else database_folder(spark, db)
        spark.sql(f"DROP TABLE IF EXISTS {parts}")
        path = f"{folder}/{spec.name}__by_year/{uuid4().hex}"
        rows = rows if years is None else rows.filter(_one_of(years))
        rows.write.partitionBy(YEAR).option("path", path).saveAsTable(parts)
    else:
        seen = Observation()
        each = [F.count_if(F.col(YEAR).eqNullSafe(F.lit(y))).alias(f"y{k}") for k, y in enumerate(years)]
        chosen = rows.filter(_one_of(years))
        watched = chosen.observe(seen, F.count(F.lit(1)).alias("n"), *each)
        path = _location(spark, parts)
        watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(path)
        counts = seen.get
        for k, year in enumerate(years):
            if not counts.get(f"y{k}"):
                _remove_year(spark, path, year)
        spark.sql(f"MSCK REPAIR TABLE {parts} SYNC PARTITIONS")
        spark.catalog.refreshTable(parts)
    comments = {f.name: (f.metadata.get("comment") or "").replace("'", "\\'") for f in spec.schema}
    listed = ", ".join(f"`{c}` COMMENT '{text}'" for c, text in comments.items())
    columns = ", ".join(f"`{c}`" for c in comments)
    spark.sql(f"CREATE OR REPLACE VIEW {view} ({listed}) AS SELECT {columns} FROM {parts}")
    return view


def _one_of(years: Sequence[int | None]) -> Column:
    known = [y for y in years if y is not None]
    found = F.col(YEAR).isin(known) if known else F.lit(False)
    return found | F.col(YEAR).isNull() if None in years else found


def _location(spark: SparkSession, parts: str) -> str:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {parts}").collect()}["Location"]


def _remove_year(spark: SparkSession, folder: str, year: int | None) -> None:
    label = "__HIVE_DEFAULT_PARTITION__" if year is None else year
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{YEAR}={label}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_since(spark: SparkSession, spec: TableSpec, db: str, *, time_col: str, year: int) -> DataFrame:
    """The table's declared columns from a year on; folders of earlier years are not listed or read."""
    rows = spark.table(by_year_name(spec, db)).filter((F.col(YEAR) >= year) & since_year(time_col, year))
    return rows.select(*spec.schema.names)


def read_years(spark: SparkSession, spec: TableSpec, db: str, years: Sequence[int | None]) -> DataFrame:
    """The table's declared columns of some years alone."""
    return spark.table(by_year_name(spec, db)).filter(_one_of(years)).select(*spec.schema.names)


def digests(rows: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """One row per group: how many rows it has, and two sums of their hashes that no order changes.

    NULLs are marked apart, since hashes skip them; equal rows add up, so a repeated row
    changes the digest.
    """
    columns = [c for c in rows.columns if c != YEAR]
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in columns])
    wide = lambda seed: F.sum(F.xxhash64(F.lit(seed), nulls, *columns).cast("decimal(38,0)"))
    grouped = [F.col(k) if isinstance(k, str) else k for k in keys]
    return rows.groupBy(*grouped).agg(F.count("*").alias("rows"), wide("a").alias("first"), wide("b").alias("second"))


def changed_years(df: DataFrame, spec: TableSpec, db: str, *, time_col: str | Column) -> list[int | None]:
    """Years whose rows differ from what is stored: edited, added, or gone altogether."""
    spark = df.sparkSession
    parts = by_year_name(spec, db)
    new = digests(_labelled(df, spec, time_col), [YEAR])
    old = digests(spark.table(parts), [YEAR]) if spark.catalog.tableExists(parts) else new.limit(0)
    both = new.withColumn("_side", F.lit(1)).unionByName(old.withColumn("_side", F.lit(-1)))
    # A year that is the same on either side cancels out.
    differs = both.groupBy(YEAR, "rows", "first", "second").agg(F.sum("_side").alias("_side")).filter("_side <> 0")
    return [r[YEAR] for r in differs.select(YEAR).distinct().collect()]


def refresh_changed(df: DataFrame, spec: TableSpec, db: str, *, time_col: str | Column, location: str | None = None) -> list[int | None]:
    """Bring a table up to date by writing only the years that changed; returns these."""
    years = changed_years(df, spec, db, time_col=time_col)
    if years or not df.sparkSession.catalog.tableExists(by_year_name(spec, db)):
        publish_by_year(df, spec, db, time_col=time_col, years=years, location=location)
    return years
