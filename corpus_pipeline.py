"""A corpus prepared for training: filter, deduplicate, mix, pack.

Every stage takes documents and, but for the last, returns documents with all their
columns; the last returns the pieces that ``wardbook.llm.packing.pack`` describes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardbook.llm.common import read, run_folder, stored
from wardbook.llm.line_dedup import remove_repeated_lines
from wardbook.llm.mixing import mix
from wardbook.llm.packing import Encoder, pack
from wardbook.llm.quality_rules import keep_good
from wardbook.llm.simhash import near_duplicates

MIX_SHARE = 0.8  # of the tokens that reach the mixing stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or that the forest calibrated on ``labels`` rejects, go."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def _row_key(docs: DataFrame, seed: str) -> Column:
    """64 bits of a whole row; two seeds make 128, which tell rows apart that share an id or have none."""
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in docs.columns])  # hashes skip nulls
    return F.xxhash64(F.lit(seed), nulls, *docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three lines in a row go from the texts; ``n_chars`` follows.

    Rows with null id come after all others, in order of a hash of the row.
    """
    absent = F.col("doc_id").isNull()
    own = [F.when(absent, _row_key(docs, seed)).alias(seed) for seed in ("k1", "k2")]
    rows = docs.withColumn("_row", F.struct(absent.alias("absent"), F.col("doc_id"), *own))
    clean = remove_repeated_lines(rows, id_col="_row").select(*docs.columns)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, that with the smallest id.

    A null id comes after all others. Of rows that share the smallest id, or have none, the
    one with the smallest hash of the row stays, of equal rows one.
    """
    keyed = docs.select("*", _row_key(docs, "k1").alias("_k1"), _row_key(docs, "k2").alias("_k2"))
    # Ordered as above, so that a component's id is the row that stays.
    row = F.struct(F.col("doc_id").isNull().alias("absent"), F.col("doc_id"), F.col("_k1"), F.col("_k2"))
    groups = near_duplicates(keyed.select(row.alias("row"), "text"), id_col="row")
    stays = groups.filter("row = component_id").select(F.col("row._k1").alias("_s1"), F.col("row._k2").alias("_s2")).distinct()
    # As many documents stay as there are groups: shuffled at every size, never broadcast.
    found = keyed.join(stays.hint("merge"), (F.col("_k1") == F.col("_s1")) & (F.col("_k2") == F.col("_s2")), "left_semi")
    return found.dropDuplicates(["_k1", "_k2"]).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics approach their target weights."""
    return mix(docs.select("*", F.col("source").alias("_source"), F.col("lang").alias("_lang")), budget_share=MIX_SHARE).filter(
        "sampled"
    ).select(*[F.col(f"_{c}" if c in ("source", "lang") else c).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 4096."""
    return pack(docs, Encoder(public_tokenizers.path("word_bpe_49k.json"), by_word=True, lowered=True))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Fingerprints, forests and token ids cannot be written in SQL; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's result written and read again."""
    docs, folder = read(spark, sf_dir, "documents"), run_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{number}-{name}")
    return docs
