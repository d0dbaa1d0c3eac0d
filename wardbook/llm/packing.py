"""Packing token sequences by cutting-stock column generation."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import count
from struct import pack as packed

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wardbook.llm.alignment import byte_characters
from wardbook.llm.common import run_folder, stored

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks already use every core

# Latin-1 letters that have a lower case of their own kind, and at most one mark after them.
PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")
BYTE_CHARACTER = {byte: character for character, byte in byte_characters().items()}


@dataclass
class Encoder:
    """Ids of whole texts as little-endian 32-bit numbers.

    ``by_word``: for tokenizers that drop white space and never join across it, so that a
    text's ids are those of its words in turn. Words here are cut at spaces and line ends
    only. Their ids are remembered, ``remember`` words at most; then memory starts anew.

    ``lowered``: for files that lower-case, then split letters from other signs and map
    bytes to characters. New words of plain Latin letters, with one closing mark at most,
    go straight to the file's model in that form, past the general normaliser and splitter,
    which take several times as long; all others are encoded as a whole.
    """

    path: str
    by_word: bool = False
    remember: int = 600_000
    lowered: bool = False
    _known: dict = field(default_factory=dict, repr=False)
    _tokenizer: object = field(default=None, repr=False)

    def __reduce__(self):
        return _encoder, (self.path, self.by_word, self.remember, self.lowered)

    def _loaded(self):
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self._loaded().encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        if not self.lowered:
            return dict(zip(words, self._encode(words)))
        split = self._loaded().model.tokenize
        found, other = {}, []
        for word in words:
            parts = PLAIN_WORD.fullmatch(word)
            if parts is None:
                other.append(word)
                continue
            letters = parts[1].lower()
            if not letters.isascii():
                letters = "".join([BYTE_CHARACTER[b] for b in letters.encode()])
            ids = [token.id for token in split(letters)]
            if parts[2]:
                ids += [token.id for token in split(parts[2])]
            found[word] = packed(f"<{len(ids)}I", *ids)
        found.update(zip(other, self._encode(other)))
        return found

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._encode(texts)
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self._known) > self.remember:
            self._known.clear()
        known = self._known
        new = list({w for words in split for w in words if w not in known})
        for at in range(0, len(new), 4096):
            known.update(self._encode_words(new[at : at + 4096]))
        return [b"".join(map(known.__getitem__, words)) for words in split]


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(*settings) -> Encoder:
    """One encoder per Python worker, so that what it remembers outlives a task."""
    return _ENCODERS.setdefault(settings, Encoder(*settings))


def best_pattern(widths: np.ndarray, prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: most valuable counts of ``widths`` in ``room``."""
    value, taken = np.zeros(room + 1), np.full(room + 1, -1)
    for u in range(1, room + 1):
        able = np.searchsorted(widths, u, side="right")
        value[u] = value[u - 1]
        if able:
            gain = value[u - widths[:able]] + prices[:able]
            k = int(gain.argmax())
            if gain[k] > value[u] + 1e-12:
                value[u], taken[u] = gain[k], k
    counts, u = np.zeros(len(widths), np.int64), room
    while u > 0:
        if taken[u] < 0:
            u -= 1
        else:
            counts[taken[u]] += 1
            u -= widths[taken[u]]
    return float(value[room]), counts


def _first_plan(widths: np.ndarray, demand: np.ndarray, room: int) -> np.ndarray:
    """A pattern per width, as columns that use up ``demand`` in some amounts, none negative.

    Each is filled with what is still there from the widest down, and used until one of its
    widths runs out, which no later pattern has: so they are independent.
    """
    m, left = len(widths), demand.astype(np.float64)
    columns, there = np.zeros((m, m)), list(range(m))
    for _ in range(m):
        counts, free = np.zeros(m), room
        for k in reversed(there):
            counts[k] = free // widths[k]
            free -= counts[k] * widths[k]
        used = np.flatnonzero(counts)
        ratio = left[used] / counts[used]
        out = int(used[ratio.argmin()])
        left = np.maximum(left - ratio.min() * counts, 0)
        columns[:, out] = counts
        there.remove(out)
    return columns


def cutting_stock(widths: np.ndarray, demand: np.ndarray, room: int, *, gap: float = 1e-4) -> list[tuple[np.ndarray, int]]:
    """Patterns with multiplicities that cut exactly ``demand`` pieces of ascending ``widths``.

    The linear program minimises sequences over patterns. It starts from a greedy plan with
    one pattern per width; in every step the knapsack finds the best new pattern, and it
    enters the basis if it is worth more than a sequence by the current duals. The prices
    are these duals drawn towards the best ones known, which jump about less. Scaled so that
    no pattern is worth more than a sequence, prices bound what any plan needs; when the
    plan needs at most ``gap`` more than that, or one sequence, it is good enough, and when
    no pattern can enter, it is optimal. Multiplicities are rounded down; what is left, less
    than a sequence per width, is cut greedily from the widest down.
    """
    m = len(widths)
    if not m:
        return []
    columns = _first_plan(widths, demand, room)
    inverse = np.linalg.inv(columns)
    amount = inverse @ demand
    # Prices that bound the need from below: a sequence's worth of pieces never costs more than one.
    center = widths / room
    bound = float(center @ demand)
    for step in count():
        if step % 64 == 63:
            inverse = np.linalg.inv(columns)
            amount = inverse @ demand
        if amount.sum() <= max(bound * (1 + gap), bound + 1):
            break
        duals = inverse.sum(axis=0)
        for keep in (0.9, 0.5, 0.0):
            prices = keep * center + (1 - keep) * duals
            worth, counts = best_pattern(widths, prices, room)
            fair = prices / max(worth, 1.0)
            if fair @ demand > bound:
                center, bound = fair, float(fair @ demand)
            if counts @ duals > 1 + 1e-7:
                break
        else:
            break  # no pattern is worth more than a sequence: optimal
        change = inverse @ counts
        able = change > 1e-9
        ratio = np.where(able, np.maximum(amount, 0) / np.where(able, change, 1), np.inf)
        out = int(ratio.argmin())
        amount = amount - ratio[out] * change
        amount[out] = ratio[out]
        pivot = inverse[out] / change[out]
        inverse = inverse - np.outer(change, pivot)
        inverse[out] = pivot
        columns[:, out] = counts
    patterns, left = [], demand.astype(np.int64).copy()
    for k in np.argsort(-amount):
        counts = columns[:, k].round().astype(np.int64)
        used = counts > 0
        times = int(min(max(0, np.floor(amount[k] + 1e-6)), (left[used] // counts[used]).min()))
        if times:
            patterns.append((counts, times))
            left -= times * counts
    while left.any():
        counts, free = np.zeros(m, np.int64), room
        for k in range(m - 1, -1, -1):
            counts[k] = min(left[k], free // widths[k])
            free -= counts[k] * widths[k]
        used = counts > 0
        times = int((left[used] // counts[used]).min())
        patterns.append((counts, times))
        left -= times * counts
    return patterns


def token_pieces(docs: DataFrame, encoder: Encoder, *, id_col: str, text_col: str, end_id: int, capacity: int) -> DataFrame:
    """(id, start, length, crc, doc_tokens): every text's ids, cut where a sequence is full."""
    tail = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                owner, rows = [], []
                for k, ids in enumerate(encoder.ids([t or "" for t in part.column(1).to_pylist()])):
                    ids += tail
                    total = len(ids) // 4
                    for start in range(0, total, capacity):
                        length = min(capacity, total - start)
                        owner.append(k)
                        rows.append((start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total))
                numbers = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), *numbers], ["id", "start", "length", "crc", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(cut, f"id {kind}, start bigint, length bigint, crc bigint, doc_tokens bigint")


def pack(
    docs: DataFrame,
    encoder: Encoder,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    capacity: int = 4096,
    grain: int = 16,
    slice_rows: int = 50_000,
    folder: str | None = None,
) -> DataFrame:
    """Every text's ids, ended by ``end_id``, packed into sequences of at most ``capacity``.

    Returns one row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` and ``padded_length`` of the sequence (``capacity``, or its
    own length where that is a power of two).

    1. Texts longer than a sequence fill whole sequences, which are numbered as they are
       stored and need no packing; each text's last piece, like any short text, does.
    2. Their lengths, rounded up to ``grain``, make a histogram of ``capacity / grain``
       rows; only it reaches the driver. Column generation over it (``cutting_stock``)
       gives patterns that use up every piece.
    3. Pieces are ranked by length in their class. Ranks are counted per class and salt and
       shifted by the counts of the salts before, so a class that holds most pieces is
       spread; there are as many salts as leave about ``slice_rows`` pieces to each. A rank
       decides pattern, sequence and slot; offsets are running sums inside a sequence.

    Null text counts as empty: its end id alone. Null ids and equal rows are packed like
    any others; further columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "packing")
    pieces = token_pieces(docs, encoder, id_col=id_col, text_col=text_col, end_id=end_id, capacity=capacity)
    # Numbers are fixed when pieces are written.
    pieces = stored(
        pieces.withColumn("width", F.ceil(F.col("length") / grain).cast("int")).withColumn("serial", F.monotonically_increasing_id()),
        f"{folder}/pieces",
    )
    full, short = pieces.filter(F.col("length") == capacity), pieces.filter(F.col("length") < capacity)
    demand = {r["width"]: r["n"] for r in short.groupBy("width").agg(F.count("*").alias("n")).collect()}
    salts = max(8, -(-sum(demand.values()) // slice_rows))
    short = short.withColumn("salt", F.pmod(F.xxhash64("id", "start", "crc"), F.lit(salts)).cast("int"))
    held = stored(short.groupBy("width", "salt").agg(F.count("*").alias("n")), f"{folder}/held")
    widths = np.array(sorted(demand), np.int64)
    patterns = cutting_stock(widths, np.array([demand[w] for w in widths.tolist()], np.float64), capacity // grain)

    runs, used, base = [], dict.fromkeys(demand, 0), 0
    for counts, times in patterns:
        for k in np.flatnonzero(counts):
            w, each = int(widths[k]), int(counts[k])
            runs.append((w, used[w], used[w] + each * times, each, base))
            used[w] += each * times
        base += times
    runs = spark.createDataFrame(runs, "run_width int, low bigint, high bigint, each bigint, base bigint")

    earlier = Window.partitionBy("width").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select(
        F.col("width").alias("_width"), F.col("salt").alias("_salt"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    order = Window.partitionBy("width", "salt").orderBy(F.col("length").desc(), "id", "start", "crc", "serial")
    ranked = short.withColumn("rank", F.row_number().over(order) - 1)
    # Salts grow with the pieces: a plain join, broadcast only where its size allows.
    ranked = ranked.join(before, (F.col("width") == F.col("_width")) & (F.col("salt") == F.col("_salt")))
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    # Bounded by classes x patterns per class.
    placed = ranked.join(
        F.broadcast(runs), (F.col("width") == F.col("run_width")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    ).select(
        "id", "start", "length", "crc", "doc_tokens", "width",
        (F.col("base") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))).alias("sequence_id"),
        F.pmod(F.col("rank") - F.col("low"), "each").alias("slot"),
    )
    # Numbers above those of packed sequences.
    whole = full.select("id", "start", "length", "crc", "doc_tokens", (F.col("serial") + base).alias("sequence_id"))
    within = Window.partitionBy("sequence_id")
    total = F.sum("length").over(within)
    offset = (F.sum("length").over(within.orderBy(F.col("width").desc(), "slot")) - F.col("length")).alias("offset")
    padded = F.when(total.bitwiseAND(total - 1) == 0, total).otherwise(F.lit(capacity)).cast("bigint").alias("padded_length")
    columns = ["id", "start", "length", "crc", "doc_tokens", "sequence_id"]
    packed_pieces = placed.select(*columns, offset, padded)
    alone = whole.select(*columns, F.lit(0).cast("bigint").alias("offset"), F.lit(capacity).cast("bigint").alias("padded_length"))
    return packed_pieces.unionByName(alone).withColumnsRenamed({"id": id_col, "crc": "ids_crc32"})
