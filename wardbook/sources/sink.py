"""Storing a job's result under its declared schema."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, types as T

from wardbook.sources.schemas import TableSpec


def ensure_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, in declared order and type, with their comments.

    Types follow store assignment: numbers and timestamps may become text, a number that
    does not fit is an error.
    """
    return df.to(schema)


def publish(
    df: DataFrame,
    spec: TableSpec,
    db: str,
    *,
    order_by: Sequence | None = None,
    location: str | None = None,
    format: str = "parquet",
    versions: int = 1,
) -> str:
    """Replace the table by this result; returns its qualified name.

    The result is written in full to a folder of its own, below ``location`` (a shared
    folder) or else below the database's, and the table is pointed there. So a job that
    fails, or reads the table it replaces, leaves the old one whole, and at no moment is
    there no table: readers find the old version or the new one. Only a table whose columns,
    comments or format change is dropped and created anew. The newest ``versions`` versions
    stay; with two, readers that began before a refresh still find their files.

    Order within the files follows ``order_by``; a table has no order of its own, so
    readers that need it sort again.
    """
    spark = df.sparkSession
    ensure_database(spark, db)
    out = conform(df, spec.schema)
    if order_by:
        out = out.orderBy(*order_by)
    name, fresh = f"`{db}`.`{spec.name}`", f"`{db}`.`{spec.name}__new`"
    folder = f"{location.rstrip('/')}/{db}/{spec.name}" if location else f"{database_folder(spark, db)}/{spec.name}__versions"
    path = f"{folder}/{uuid4().hex}"
    writer = out.write.format(format)
    comment = spec.comment.replace("'", "\\'")
    if _can_be_pointed(spark, name, out.schema, format):
        writer.save(path)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.sql(f"COMMENT ON TABLE {name} IS '{comment}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        writer.mode("overwrite").option("path", path).saveAsTable(fresh)
        spark.sql(f"COMMENT ON TABLE {fresh} IS '{comment}'")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    _remove_old(spark, folder, path, versions)
    return name


def database_folder(spark: SparkSession, db: str) -> str:
    return spark.catalog.getDatabase(db).locationUri.rstrip("/")


def _can_be_pointed(spark: SparkSession, name: str, schema: T.StructType, format: str) -> bool:
    """Whether the table is there with its files outside the catalog's care, and with these columns."""
    if not spark.catalog.tableExists(name):
        return False
    said = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    columns = lambda s: [(f.name, f.dataType, f.metadata.get("comment")) for f in s]
    same = columns(spark.table(name).schema) == columns(schema)
    return same and said.get("Type") == "EXTERNAL" and said.get("Provider", "").lower() == format.lower()


def _remove_old(spark: SparkSession, folder: str, current: str, versions: int) -> None:
    """Finished versions but for the current and the newest before it go."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    there = [s for s in files.listStatus(path(folder)) if s.getPath().getName() != current.rpartition("/")[2]]
    done = [s for s in there if files.exists(path(s.getPath(), "_SUCCESS"))]
    for old in sorted(done, key=lambda s: -s.getModificationTime())[max(versions - 1, 0) :]:
        files.delete(old.getPath(), True)
