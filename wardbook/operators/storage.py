"""Intermediate tables in a shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: it is computed once, and lineage ends here."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
