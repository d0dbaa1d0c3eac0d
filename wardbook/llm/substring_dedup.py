"""Removal of repeated byte strings by external induced suffix sorting."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from wardbook.llm.common import run_folder, stored
from wardbook.llm.induced_sort import sorted_suffixes

GRAM = 32  # bytes whose hashes choose the anchor of a string
PIECE = 1 << 20  # starts of strings that are looked at together
SEPARATOR = 0xFE  # a byte that UTF-8 never has
_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 21) - 1)


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        power = np.ones(1 << 21, np.uint64)
        for k in range(21):
            power[1 << k : 2 << k] = power[: 1 << k] * np.uint64(pow(base, 1 << k, 1 << 64))
        out.append(power)
    return out[0], out[1]


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` values in a row: running minima from both ends of blocks."""
    n = len(values)
    full = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    full[:n] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _pieces(text: bytes, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of starts that share their anchor, ``PIECE`` starts at a time: (first, number, anchor hash, sum of their bytes).

    The sum is of all bytes that a run covers, weighed by place: equal bytes have equal sums.
    """
    power, inverse = _powers()
    every = np.frombuffer(text, np.uint8)
    for begin in range(0, len(every) - size + 1, PIECE):
        own = every[begin : begin + PIECE + size - 1]
        sums = np.zeros(len(own) + 1, np.uint64)
        np.cumsum((own.astype(np.uint64) + np.uint64(1)) * inverse[: len(own)], out=sums[1:])
        h = (sums[GRAM:] - sums[:-GRAM]) * power[: len(own) - GRAM + 1]
        for _ in range(2):
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        place = np.arange(len(h), dtype=np.uint64)
        anchor = (_sliding_least((h & ~_PLACE) | place, size - GRAM + 1) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        number = np.diff(np.append(first, len(anchor)))
        covered = (sums[first + number + size - 1] - sums[first]) * power[first]
        yield first + begin, number, h[anchor[first]].view(np.int64), covered


def anchored(text: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts of ``size``-byte strings that share their anchor: (first, number, anchor hash).

    The anchor is the string's ``GRAM`` bytes with the smallest hash, the leftmost of equal
    ones. It depends on the string alone, so equal strings have equal anchors wherever they
    are, and every start belongs to one run.
    """
    found = [piece[:3] for piece in _pieces(text, size)]
    return tuple(np.concatenate(c) for c in zip(*found)) if found else tuple(np.zeros(0, np.int64) for _ in range(3))


def collapsed(text: bytes, size: int) -> np.ndarray:
    """Runs by their bytes, in rows (first, number, anchor hash, hash of the bytes, copies).

    Runs of a piece with equal bytes are one row, the first of them, with the number of
    copies; where there are several, rows without copies (0) say what they cover together:
    (first, bytes less ``size`` - 1, …). So a text of one repeated character gives two rows
    for a piece, not one for each byte. Bytes are compared, not only their sums.
    """
    rows = []
    for first, number, h, covered in _pieces(text, size):
        key = (h.view(np.uint64) ^ (h.view(np.uint64) >> np.uint64(31))) * np.uint64(_BASE) + covered + number.astype(np.uint64)
        _, one, same, many = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        copies, stands = np.ones(len(first), np.int64), np.arange(len(first))
        if len(one) < len(first):
            ends = first + number + (size - 1)
            twice = np.flatnonzero(many[same] > 1)
            originals = one[same[twice]]
            kept = {k: text[first[k] : ends[k]] for k in np.unique(originals).tolist()}
            alike = [text[a:b] == kept[k] for a, b, k in zip(first[twice].tolist(), ends[twice].tolist(), originals.tolist())]
            stands[twice] = np.where(alike, originals, twice)
            copies = np.bincount(stands, minlength=len(first))
            in_group = copies[stands] > 1
            low, high, owner = first[in_group], ends[in_group], stands[in_group]
            if len(low):
                begin = np.flatnonzero(np.append(True, low[1:] > high[:-1]))
                reach = np.append(high[begin[1:] - 1], high[-1])
                none, group = np.zeros(len(begin), np.int64), owner[begin]
                hashes = [_context_hash(kept[k]) for k in group.tolist()]
                rows.append(np.column_stack([low[begin], reach - low[begin] - (size - 1), h[group], np.array(hashes, np.int64), none]))
        mine = np.flatnonzero(copies)
        hashes = [_context_hash(text[a : a + n + size - 1]) for a, n in zip(first[mine].tolist(), number[mine].tolist())]
        rows.append(np.column_stack([first[mine], number[mine], h[mine], np.array(hashes, np.int64), copies[mine]]))
    return np.concatenate(rows) if rows else np.zeros((0, 5), np.int64)


def _context_hash(context: bytes) -> int:
    return xxhash.xxh3_64_intdigest(context) - (1 << 63)


def _string_hashes(context: bytes, size: int) -> np.ndarray:
    """128 bits of every ``size``-byte string of a run, as two columns."""
    digests = [xxhash.xxh3_128_digest(context[k : k + size]) for k in range(len(context) - size + 1)]
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


def _anchors(docs: DataFrame, size: int) -> DataFrame:
    """(id, at, n, h, c, m): runs of string starts by anchor, a hash of all bytes they cover, and their copies."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lot in range(0, batch.num_rows, 128):
                part = batch.slice(lot, 128)
                rows = [collapsed((value.as_py() or "").encode("utf-8", "replace"), size) for value in part.column(1)]
                ids = part.column(0).take(pa.array(np.repeat(np.arange(len(rows)), [len(r) for r in rows])))
                at, n, h, c, m = (np.ascontiguousarray(column) for column in np.concatenate(rows).T)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(at), pa.array(n.astype(np.int32)), pa.array(h), pa.array(c), pa.array(m)], ["id", "at", "n", "h", "c", "m"]
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(find, f"id {kind}, at bigint, n int, h bigint, c bigint, m bigint")


def _packed(docs: DataFrame) -> DataFrame:
    """(id, z): texts compressed, since they travel."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = [press.compress((v.as_py() or "").encode("utf-8", "replace")) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z, pa.binary())], ["id", "z"])

    return docs.mapInArrow(squeeze, f"id {docs.schema['id'].dataType.simpleString()}, z binary")


def _contexts(texts: DataFrame, size: int, kind: str) -> DataFrame:
    """The bytes of every wanted run of a document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for lot in range(0, batch.num_rows, 64):
                part = batch.slice(lot, 64)
                owner, rows = [], []
                for k, (z, runs) in enumerate(zip(part.column("z"), part.column("runs").to_pylist())):
                    text = open_.decompress(z.as_py())
                    for r in runs:
                        context = text[r["at"] : r["at"] + r["n"] + size - 1]
                        if _context_hash(context) == r["c"]:  # else another text under the same id
                            owner.append(k)
                            rows.append((r["h"], r["at"], r["n"], r["copies"], context))
                h, at, n, copies, context = zip(*rows) if rows else ([],) * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), part.column("id").take(pa.array(owner, pa.int64())), pa.array(at, pa.int64()),
                     pa.array(n, pa.int32()), pa.array(copies, pa.int64()), pa.array(context, pa.binary())],
                    ["h", "id", "at", "n", "copies", "context"],
                )

    return texts.mapInArrow(cut, f"h bigint, id {kind}, at bigint, n int, copies bigint, context binary")


def _strings(texts: DataFrame, size: int, kind: str) -> DataFrame:
    """(s1, s2, id, run, at, copies): every start of the wanted runs by its own string."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for k, (z, runs) in enumerate(zip(batch.column("z"), batch.column("runs").to_pylist())):
                text, rows = open_.decompress(z.as_py()), []
                for r in runs:
                    context = text[r["at"] : r["at"] + r["n"] + size - 1]
                    if _context_hash(context) == r["c"]:  # else another text under the same id
                        place = np.full((r["n"], 3), (r["at"], r["at"], r["copies"]), np.int64)
                        place[:, 1] += np.arange(r["n"])
                        rows.append(np.hstack([_string_hashes(context, size), place]))
                for lot in range(0, len(rows), 256):
                    s1, s2, run, at, copies = (pa.array(c) for c in np.concatenate(rows[lot : lot + 256]).T)
                    ids = batch.column("id").take(pa.array(np.full(len(at), k)))
                    yield pa.RecordBatch.from_arrays([s1, s2, ids, run, at, copies], ["s1", "s2", "id", "run", "at", "copies"])

    return texts.mapInArrow(cut, f"s1 bigint, s2 bigint, id {kind}, run bigint, at bigint, copies bigint")


def _dealt_again(texts: DataFrame, size: int, kind: str, folder: str) -> DataFrame:
    """(id, low, high) as of ``_repeats``, for anchors with too many runs for one shard.

    Every start is dealt by a hash of its own string, so equal strings still meet, and a
    key's rows are one string's occurrences: they are counted, combining before the
    shuffle, and joined back, split at run time where a string is hot. Strings of one run
    overlap, since they all hold its anchor: a run's repeated starts cover one stretch.
    """
    strings = _stored(_strings(texts, size, kind), f"{folder}/strings")
    again = strings.groupBy(F.col("s1").alias("_s1"), F.col("s2").alias("_s2")).count().filter("count > 1").select("_s1", "_s2")
    again = _stored(again, f"{folder}/again").hint("merge")
    repeated = strings.filter("copies = 1").join(again, (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2")), "left_semi")
    spans = repeated.groupBy("id", "run").agg(F.min("at").alias("low"), (F.max("at") + size).alias("high"))
    return _stored(spans.select("id", "low", "high"), f"{folder}/partial-again")


def repeated_owned(text: np.ndarray, owned: np.ndarray, size: int) -> np.ndarray:
    """Which owned starts have their ``size`` bytes in common with another owned start."""
    out = np.zeros(len(text), bool)
    seen, single = 0, -1  # owned starts of the run of equal strings that is still open, and the first
    for positions, common in sorted_suffixes(text, size):
        run = np.cumsum(common < size)
        mine = owned[positions]
        positions, run, last = positions[mine], run[mine], int(run[-1])
        counts = np.bincount(run, minlength=last + 1)
        counts[0] += seen
        out[positions[counts[run] > 1]] = True
        if seen == 1 and counts[0] > 1:
            out[single] = True
        if last or not seen:  # another run is open now, or its first start is here
            held = positions[run == last]
            single = int(held[0]) if len(held) else -1
        seen = min(int(counts[last]), 2)
    return out


def _repeats(contexts: DataFrame, size: int, kind: str) -> DataFrame:
    """(id, low, high) of bytes covered by repeated strings in runs that have no exact copy."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.NamedTemporaryFile() as spool:
            held, places = [], 0
            for batch in batches:
                lengths = []
                for value in batch.column("context"):
                    context = value.as_buffer()
                    spool.write(context)
                    spool.write(bytes([SEPARATOR]))
                    lengths.append(context.size + 1)
                begin = places + np.cumsum([0, *lengths])
                places = int(begin[-1])
                held.append((batch.column("id"), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("at", "n", "copies")), begin[:-1]))
            if not places:
                return
            spool.flush()
            ids = pa.chunked_array([x[0] for x in held]).combine_chunks()
            at, n, copies, begin = (np.concatenate(x) for x in list(zip(*held))[1:])
            edge = np.zeros(places + 1, np.int8)
            edge[begin] += 1
            edge[begin + n] -= 1
            owned = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
            found = np.flatnonzero(repeated_owned(np.memmap(spool.name, np.uint8, "r"), owned, size))
            if not len(found):
                return
            first = np.flatnonzero(np.append(True, found[1:] != found[:-1] + 1))
            low, many = found[first], np.diff(np.append(first, len(found)))
            which = np.searchsorted(begin, low, side="right") - 1
            alone = copies[which] == 1
            which, low, many = which[alone], low[alone], many[alone]
            start = at[which] + low - begin[which]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(which)), pa.array(start), pa.array(start + many - 1 + size)], ["id", "low", "high"])

    return contexts.mapInArrow(search, f"id {kind}, low bigint, high bigint")


def remove_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 200,
    shard_bytes: int = 2 << 20,
    folder: str | None = None,
) -> DataFrame:
    """Every document without the bytes of ``size``-byte strings that also start elsewhere.

    Returns id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed stretches),
    ``kept`` (what remains, as bytes) and ``kept_sha256``. Texts are UTF-8; strings lie
    inside one document, are judged on the input, and may overlap.

    1. Every string has an anchor that depends on its bytes alone (``anchored``); starts
       are taken in runs with one anchor, copies inside a text together (``collapsed``). Only anchors that occur twice or more can hold
       repeats: counts combine before their shuffle, and the join back is split at run time
       where an anchor is hot.
    2. Runs with the same anchor and the same bytes are repeats as they are, and one of
       them stands for all. Of anchors with different runs, the bytes of one run each are
       read and dealt by anchor, so that equal strings meet in one shard.
    3. A shard lays its runs on its own disk and sorts their suffixes by external induced
       sorting (``sorted_suffixes``); strings that share ``size`` bytes are neighbours. Its
       memory is a few arrays over the shard, which holds about ``shard_bytes``.
    4. An anchor whose different runs have more than ``shard_bytes`` is not sorted: its
       starts are dealt again by 128 bits of their own strings (``_dealt_again``).
    5. Stretches are gathered per document and cut out.

    Null text counts as empty. Rows with one id, null included, are told apart by their
    bytes only: they share removed stretches, and equal rows repeat each other. Further
    columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "substring-dedup")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    anchors = _anchors(rows, size)
    often = anchors.groupBy(F.col("h").alias("_h")).agg(F.sum("m").alias("times")).filter("times > 1").select("_h")
    # Stored, like what is joined below, so that joins read plain shuffles and split a hot anchor.
    often = _stored(often, f"{folder}/often")
    occurring = anchors.join(often.hint("merge"), F.col("h") == F.col("_h"), "left_semi")
    occurring = _stored(occurring, f"{folder}/occurring")

    groups = occurring.filter("m > 0").groupBy("h", "c").agg(F.sum("m").alias("copies"), F.min(F.struct("id", "at", "n")).alias("one"))
    groups = _stored(groups.select("h", "c", "copies", "one.*"), f"{folder}/groups")
    mixed = groups.groupBy(F.col("h").alias("_h")).agg(F.count("*").alias("runs"), F.sum(F.col("n") + size).alias("bytes"))
    mixed = mixed.filter("runs > 1").select("_h", (F.col("bytes") > shard_bytes).alias("hot"))
    mixed = _stored(mixed, f"{folder}/mixed")
    wanted = groups.join(mixed.hint("merge"), F.col("h") == F.col("_h"))
    # A document's own runs, no more than it has bytes.
    lists = wanted.groupBy(F.col("id").alias("_id"), "hot").agg(F.collect_list(F.struct("at", "n", "h", "c", "copies")).alias("runs"))
    lists = _stored(lists, f"{folder}/wanted")
    total = dict(lists.select("hot", F.explode("runs").alias("r")).groupBy("hot").agg(F.sum(F.col("r.n") + size)).collect())

    def texts(hot: bool) -> DataFrame:
        own = lists.filter(F.col("hot") == hot).hint("merge")
        return _packed(rows).join(own, F.col("id").eqNullSafe(F.col("_id"))).select("id", "z", "runs")

    contexts = _contexts(texts(False), size, kind).repartition(max(1, -(-total.get(False, 0) // shard_bytes)), "h")
    partial = _stored(_repeats(contexts, size, kind), f"{folder}/partial")
    if True in total:
        partial = partial.union(_dealt_again(texts(True), size, kind, folder))

    copied = groups.filter("copies > 1").select(F.col("h").alias("_h"), F.col("c").alias("_c")).hint("merge")
    # Rows without copies of their own cover several; their hashes are those of one of these.
    whole = occurring.join(copied, (F.col("h") == F.col("_h")) & (F.col("c") == F.col("_c")), "left_semi").select(
        "id", F.col("at").alias("low"), (F.col("at") + F.col("n") + (size - 1)).alias("high")
    )
    spans = whole.union(partial).groupBy(F.col("id").alias("_id")).agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    spans = _stored(spans, f"{folder}/spans").hint("merge")
    joined = _packed(rows).join(spans, F.col("id").eqNullSafe(F.col("_id")), "left").select("id", "z", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for lot in range(0, batch.num_rows, 256):
                part = batch.slice(lot, 256)
                out = [cut_out(open_.decompress(z.as_py()), s) for z, s in zip(part.column("z"), part.column("spans").to_pylist())]
                n_bytes, removed, count, kept = zip(*out)
                sha = [hashlib.sha256(k).hexdigest() for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *(pa.array(x, pa.int64()) for x in (n_bytes, removed, count)), pa.array(kept, pa.binary()), pa.array(sha, pa.string())],
                    ["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
                )

    found = joined.mapInArrow(remove, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")
    return found.withColumnRenamed("id", id_col)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_out(text: bytes, spans: list[dict] | None) -> tuple[int, int, int, bytes]:
    """(bytes, removed, maximal stretches, what remains)"""
    size = len(text)
    if not spans or not size:
        return size, 0, 0, text
    low = np.minimum(np.array([s["low"] for s in spans], np.int64), size)
    high = np.minimum(np.array([s["high"] for s in spans], np.int64), size)
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, low, 1)
    np.add.at(edge, high, -1)
    gone = np.cumsum(edge[:size]) > 0
    count = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return size, int(gone.sum()), count, np.frombuffer(text, np.uint8)[~gone].tobytes()
