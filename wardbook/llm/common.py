"""Helpers of the corpus operators: the shared folder, typed reads, connected components."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

# Columns of the tables that the queries read; stating them spares a schema-inference job per read.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share.

    Below ``spark.checkpoint.dir``; where that is unset (local sessions, tests) below the
    warehouse folder, which is shared wherever a catalog is.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/wardbook-llm/{name}-{uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` below a shared folder and read it back: lineage ends here, files outlive executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drawn(df: DataFrame, key: str, rows: int, seed: int = 17) -> DataFrame:
    """About ``rows`` rows, or all if there are fewer, chosen by a hash of ``key``.

    The rate follows from a count, so nothing is sorted and no task sends more than its share.
    """
    rate = min(1.0, rows / max(df.count(), 1))
    return df.filter(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < int(rate * (1 << 30)))


def connected_components(edges: DataFrame, folder: str, *, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from every node of an undirected graph.

    ``edges`` has bigint columns ``a`` and ``b``; the result (``node``, ``root``) lists every
    node that has an edge to another node. Null ends and self-loops are ignored, repeated
    edges count once, no edges give no rows.

    Alternating star contraction: each round hangs every node's larger neighbours on the
    smallest node it knows, then every node's neighbours not above it likewise, until
    nothing changes. The number of rounds grows with the logarithm of a component's size.
    A node's neighbours are never gathered: the smallest is an aggregate that combines
    before its shuffle, and it is joined back to the edges, so a hot node's edges spread.
    Every round is a table in ``folder``.
    """
    spark = edges.sparkSession
    clean = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    pairs = clean.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    now = stored(pairs, f"{folder}/cc-0")
    size = None
    for step in range(1, max_rounds + 1):
        both = now.select("hi", "lo").union(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        smallest = both.groupBy("hi").agg(F.min("lo").alias("m")).select(
            F.col("hi").alias("k"), F.least("hi", "m").alias("m")
        )
        # Stored, like ``below``, so that the join reads plain shuffles and splits a hot node.
        smallest = stored(smallest, f"{folder}/cc-{step}-smallest")
        # Larger neighbours of k hang on the smallest node of k's neighbourhood.
        large = (
            now.join(smallest, F.col("lo") == F.col("k")).select("hi", F.col("m").alias("lo"))
        ).filter("hi <> lo").distinct()
        large = stored(large, f"{folder}/cc-{step}-large")
        # Neighbours not above k, and k itself, hang on the smallest of them.
        below = large.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "k")
        below = stored(below, f"{folder}/cc-{step}-below")
        hung = large.join(below, F.col("hi") == F.col("k")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        own = below.select(F.col("k").alias("hi"), F.col("m").alias("lo"))
        now = stored(hung.union(own).filter("hi <> lo").distinct(), f"{folder}/cc-{step}")
        # Stars are stable: as many edges as nodes that are no root, and no root hangs on another.
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if size == (seen.n, seen.h):
            break
        size = (seen.n, seen.h)
    else:
        raise RuntimeError(f"components not stable after {max_rounds} rounds")
    roots = now.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("root"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)


