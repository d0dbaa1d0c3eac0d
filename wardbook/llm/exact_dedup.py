"""Exact deduplication through an extendible-hash index (DataFrame functions only).

Index entries are one per distinct key, never one per document, so a text that a third of
all documents share is one entry and cannot overfill a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardbook.llm.common import run_folder, stored


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def _bits(column: str, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit key, 1 to 64, as a number."""
    return F.shiftrightunsigned(column, 64 - depth)


def directory(keys: DataFrame, *, capacity: int, max_depth: int) -> DataFrame:
    """The directory over the 64-bit column ``key``: (``slot``, ``depth``, ``bucket``).

    A bucket is a prefix of the key's bits. It begins as the whole key space; while it
    holds more than ``capacity`` keys it is split and the directory doubles by one bit,
    down to ``max_depth`` bits. ``slot`` is the prefix of ``max_depth`` bits, ``depth`` the
    number of bits that its bucket uses. At most ``2 ** max_depth`` rows, whatever the
    input; beyond that depth a bucket holds more. No keys, no rows.
    """
    filled = keys.groupBy(_bits("key", max_depth).alias("slot")).agg(F.count("*").alias("n"))
    doubled = filled.select("*", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth")).withColumn(
        "bucket", F.call_function("shiftrightunsigned", F.col("slot"), F.lit(max_depth) - F.col("depth"))
    )
    holds = doubled.groupBy("depth", "bucket").agg(F.sum("n").alias("n"))
    fits = holds.filter((F.col("n") <= capacity) | (F.col("depth") == max_depth)).select("depth", "bucket")
    leaf = doubled.join(fits, ["depth", "bucket"]).groupBy("slot").agg(F.min(F.struct("depth", "bucket")).alias("leaf"))
    return leaf.select("slot", "leaf.depth", "leaf.bucket")


def owned(texts: DataFrame, slots: DataFrame, *, max_depth: int) -> DataFrame:
    """Distinct (``key``, ``t``) with their bucket, dealt to owner tasks, and their place in the key's chain.

    Owners have ranges of the key space that begin and end with a bucket (``first``, its
    smallest slot), so one owner sees all of a bucket. There it chains different texts with
    one key, 0 first. What follows by key needs no other shuffle.
    """
    at = texts.withColumn("slot", _bits("key", max_depth)).join(slots.withColumnRenamed("slot", "_slot"), F.col("slot") == F.col("_slot"))
    first = F.call_function("shiftleft", F.col("bucket"), F.lit(max_depth) - F.col("depth"))
    routed = at.withColumn("first", first).drop("slot", "_slot").repartitionByRange("first")
    chain = Window.partitionBy("first", "key").orderBy(F.col("keep").desc_nulls_last(), "t")
    return routed.withColumn("chain", F.row_number().over(chain) - 1)


def exact_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    spare_bits: int = 4,
    folder: str | None = None,
) -> DataFrame:
    """Which row stays of those with the same text.

    Returns one row per input row: the id, ``keep_id`` (largest id of the group),
    ``group_size``, ``kept``, ``text_sha256``, ``bucket`` and ``chain`` (place of the text
    among different texts with the same key, 0 first).

    1. Keys (64-bit hash of the text) are aggregated before their shuffle to one entry
       each. ``directory`` splits them into buckets of at most ``capacity`` keys; its depth
       follows their number, with ``spare_bits`` for buckets that fill unevenly. Entries are
       written as index files in ranges of buckets.
    2. Only texts whose key has several rows are read again. Copies meet in an aggregate,
       compared byte by byte and combined before the shuffle, so a hot text is one row; what
       is left goes to the owner of its bucket, which chains texts that share a key.
       A collision makes a chain and never merges two texts.
    3. Every row looks its group up by key and bytes, in joins whose document side may be
       split at run time where a text is hot.

    Null text counts as empty. Rows with equal id and text are one document: they share
    ``kept``. A null id is never ``keep_id`` unless the whole group has none; such a group
    keeps all its rows. Further columns, whatever their names, are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "exact-dedup")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("t")).withColumn("key", _key(F.col("t")))

    entries = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    entries = stored(entries, f"{folder}/entries")
    max_depth = max(1, (entries.count() // capacity).bit_length() + spare_bits)
    slots = stored(directory(entries, capacity=capacity, max_depth=max_depth), f"{folder}/directory")
    placed = entries.withColumn("_slot", _bits("key", max_depth)).join(slots, F.col("_slot") == F.col("slot"))
    index = stored(
        placed.select("bucket", "depth", "key", "n", "top").repartitionByRange("depth", "bucket", "key").sortWithinPartitions("depth", "bucket", "key"),
        f"{folder}/index",
    )

    # Repeated keys grow with the corpus: the join is shuffled at every size, never broadcast.
    shared = index.filter("n > 1").select("key").hint("merge")
    colliding = stored(rows.join(shared, "key", "left_semi").select("id", "key", "t"), f"{folder}/colliding")
    groups = colliding.groupBy("key", "t").agg(F.count("*").alias("size"), F.max("id").alias("keep"))
    # Stored first: ranges are found from a sample, which would compute the groups twice.
    groups = stored(owned(stored(groups, f"{folder}/groups"), slots, max_depth=max_depth), f"{folder}/chains")

    slim = rows.select("id", "key", F.sha2("t", 256).alias("sha"))
    alone = slim.join(index.filter("n = 1").select("key", "bucket"), "key").select(
        "id", F.col("id").alias("keep"), F.lit(1).cast("bigint").alias("size"), "sha", "bucket", F.lit(0).alias("chain")
    )
    members = groups.select(F.col("key").alias("k"), F.col("t").alias("same"), "size", "keep", "chain", "bucket")
    # Both key and bytes are compared.
    found = colliding.join(members, (F.col("key") == F.col("k")) & (F.col("t") == F.col("same"))).select(
        "id", "keep", "size", F.sha2("t", 256).alias("sha"), "bucket", "chain"
    )
    return alone.union(found).select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "bucket",
        "chain",
    )
