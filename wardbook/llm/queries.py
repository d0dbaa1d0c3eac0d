"""The operators' queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardbook.llm.alignment import TokenizerPair, align_tokens
from wardbook.llm.common import read
from wardbook.llm.exact_dedup import exact_dedup
from wardbook.llm.language_id import identify, learn
from wardbook.llm.line_dedup import remove_repeated_lines
from wardbook.llm.mixing import mix, mixing_sql
from wardbook.llm.neighbours import build_index, search
from wardbook.llm.packing import Encoder, pack
from wardbook.llm.quality_rules import quality_rules
from wardbook.llm.simhash import near_duplicates
from wardbook.llm.substring_dedup import remove_repeats
from wardbook.llm.token_counts import Tokenizer, count_tokens
from wardbook.llm.warc import archive_captures
from wardbook.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_captures(read(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = Tokenizer(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return count_tokens(read(spark, sf_dir, "documents"), tokenizer)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "sampled")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"), by_word=True, lowered=True)
    return pack(read(spark, sf_dir, "documents"), encoder)


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify(docs, learn(docs))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


_OP8 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_lines(docs)


_OP9 = """
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS place FROM split),
shingled AS (
    SELECT doc_id, place, line, lead(line, 1) OVER run AS second, lead(line, 2) OVER run AS third
    FROM line WINDOW run AS (PARTITION BY doc_id ORDER BY place)
),
ranked AS (
    SELECT doc_id, place, row_number() OVER (PARTITION BY line, second, third ORDER BY doc_id, place) AS nth
    FROM shingled WHERE third IS NOT NULL
),
gone AS (SELECT DISTINCT doc_id, place + k AS place FROM ranked, range(3) AS r(k) WHERE nth > 1),
kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY place) AS text, count(*) AS n
    FROM line ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CASE WHEN split.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       coalesce(len(lines), 0) AS n_lines, coalesce(len(lines), 0) - coalesce(n, 0) AS n_removed
FROM split LEFT JOIN kept USING (doc_id)
"""

def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    pair = TokenizerPair(a, b, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return align_tokens(read(spark, sf_dir, "documents"), pair)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, asked = read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0
    return search(build_index(vectors, queries=asked), vectors.filter(asked))


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_token_counts": op2_token_counts,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_mixing": op4_mixing,
    "op5_packing": op5_packing,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_language_id": op7_language_id,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

ORACLES: dict[str, str] = {"op4_mixing": mixing_sql(), "op8_exact_dedup": _OP8, "op9_line_dedup": _OP9}
