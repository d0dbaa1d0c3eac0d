"""Token counts through a digest cache."""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardbook.llm.common import run_folder, stored

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks already use every core

# Up to here the two libraries classify characters alike.
BEYOND = re.compile("[^\u0000-ɏ]")
# The faster library looks back over a run of white space on a stack, which overflows near a million characters.
LONG_BLANK = 100_000
BLANK = re.compile(rf"(?<!\s)\s{{{LONG_BLANK}}}")


@dataclass(frozen=True)
class Tokenizer:
    """A byte-level BPE tokenizer file; ``ranks`` is the same vocabulary for a faster library.

    Texts go to the faster library where both give the same ids: characters up to U+024F,
    no special string and no run of ``LONG_BLANK`` white-space characters. All others go to
    the file's own.
    """

    path: str
    ranks: str | None = None
    pattern: str | None = None

    def version(self) -> str:
        with open(self.path, "rb") as f:
            return hashlib.sha256(f.read()).hexdigest()

    def counts(self, texts: Sequence[str]) -> list[int]:
        exact, quick, special = _loaded(self)
        if quick is None:
            return [len(e) for e in exact.encode_batch_fast(texts, add_special_tokens=False)]
        plain = [
            not BEYOND.search(t) and not any(s in t for s in special) and not (len(t) >= LONG_BLANK and BLANK.search(t))
            for t in texts
        ]
        other = iter(exact.encode_batch_fast([t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        return [len(quick.encode_ordinary(t) if p else next(other)) for t, p in zip(texts, plain)]


@cache
def _loaded(tokenizer: Tokenizer):
    from tokenizers import Tokenizer as Exact

    exact = Exact.from_file(tokenizer.path)
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    if tokenizer.ranks is None:
        return exact, None, special
    import tiktoken

    with open(tokenizer.ranks, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    quick = tiktoken.Encoding("same", pat_str=tokenizer.pattern, mergeable_ranks=ranks, special_tokens={})
    return exact, quick, special


CACHE = "digest binary, version string, n_tokens bigint"


def count_tokens(
    docs: DataFrame,
    tokenizer: Tokenizer,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    cache_dir: str | None = None,
    normalise=lambda text: text,
) -> DataFrame:
    """Tokens of every whole text: id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    Counts are kept under the SHA-256 of the normalised text and of the tokenizer file in
    ``cache_dir``, a Parquet folder that later runs share; by default it is new. Only
    distinct texts whose digest it lacks are read again and encoded, and their counts
    appended. ``normalise`` maps a text column to what is encoded; it must not change
    counts.

    A text that many documents share is one digest: groups shrink before their shuffle.
    The documents whose text stands for a digest are found by digest and id together, so
    no key is hot; lookups in the cache have their document side split at run time.

    Null text counts as empty and has no tokens; ``n_bytes`` is that of the text as given.
    Equal rows are counted alike, null ids are allowed, further columns are ignored, an
    empty table gives no rows. A digest that two runs appended counts once.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "token-counts")
    cache_dir, version = cache_dir or f"{folder}/cache", tokenizer.version()
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache_dir)

    def known() -> DataFrame:
        read = spark.read.schema(CACHE).parquet(cache_dir).filter(F.col("version") == version)
        return read.groupBy(F.col("digest").alias("_digest")).agg(F.max("n_tokens").alias("n_tokens"))

    given: Column = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), given.alias("given")).select("id", "given", normalise(F.col("given")).alias("t"))
    digest = F.unhex(F.sha2("t", 256)).alias("digest")
    slim = stored(rows.select("id", F.octet_length("given").cast("bigint").alias("n_bytes"), digest), f"{folder}/digests")
    first = slim.groupBy("digest").agg(F.min("id").alias("first_id")).withColumnRenamed("digest", "_d")
    missing = first.join(known(), F.col("_d") == F.col("_digest"), "left_anti")
    texts = rows.select("id", "t", digest)
    # As many digests may be missing as there are texts: shuffled at every size.
    fresh = texts.join(
        missing.hint("merge"), (F.col("digest") == F.col("_d")) & F.col("id").eqNullSafe(F.col("first_id")), "left_semi"
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts = tokenizer.counts(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    counted = fresh.select("digest", "t").mapInArrow(encode, "digest binary, n_tokens bigint")
    counted.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache_dir)
    # Stored, so that the join reads plain shuffles and splits a hot digest.
    counts = stored(known(), f"{folder}/counts")
    return slim.join(counts, F.col("digest") == F.col("_digest")).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
