"""Alignment of two tokenizers' tokens between anchors at white space."""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardbook.llm.common import run_folder, stored
from wardbook.llm.token_counts import BEYOND, BLANK, LONG_BLANK


@dataclass(frozen=True)
class TokenizerPair:
    """A byte-level BPE file (A) and a sentencepiece model (B) that are compared.

    ``ranks`` and ``pattern`` are A's vocabulary for the faster library, which encodes the
    texts for which both libraries give the same ids (see ``token_counts``).
    """

    bytes_path: str
    piece_path: str
    ranks: str | None = None
    pattern: str | None = None


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, for the
    characters from U+0100.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(0x100) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class _Tokens:
    """What one Python worker keeps: both tokenizers, their tokens' bytes, and known windows."""

    def __init__(self, pair: TokenizerPair):
        from sentencepiece import SentencePieceProcessor

        self.pair, self._exact, self.quick = pair, None, None
        self.pieces = SentencePieceProcessor(model_file=pair.piece_path)
        if pair.ranks is not None:
            import tiktoken

            with open(pair.ranks, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.quick = tiktoken.Encoding("same", pat_str=pair.pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [_entries(pair.bytes_path), [self._piece(k) for k in range(self.pieces.get_piece_size())]]
        self.sizes = [np.array([len(t) for t in side], np.int64) for side in self.bytes]
        self.marked = [np.array([t[:1] == b" " for t in side]) for side in self.bytes]
        self.names = [str(k) for k in range(max(map(len, self.bytes)))]
        self.forget()

    def _piece(self, k: int) -> bytes:
        name = self.pieces.id_to_piece(k)
        return bytes([int(name[3:5], 16)]) if self.pieces.is_byte(k) else name.replace("▁", " ").encode()

    @property
    def exact(self):
        """The file's own library, loaded when a text needs it."""
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_file(self.pair.bytes_path)
            self._exact.encode_special_tokens = True
        return self._exact

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Both tokenizers' ids of every text; none where a side's bytes are not the text's."""
        spaced = [" " + t for t in texts]
        plain = [
            self.quick is not None and not BEYOND.search(t) and not (len(t) >= LONG_BLANK and BLANK.search(t)) for t in spaced
        ]
        rest = [t for t, p in zip(spaced, plain) if not p]
        other = iter(self.exact.encode_batch_fast(rest, add_special_tokens=False) if rest else ())
        ids = [self.quick.encode_ordinary(t) if p else next(other).ids for t, p in zip(spaced, plain)]
        found = []
        for text, own, a, b in zip(texts, spaced, ids, self.pieces.encode(texts, num_threads=1)):
            raw = own.encode()
            same = text and all(b"".join(map(table.__getitem__, side)) == raw for table, side in zip(self.bytes, (a, b)))
            found.append((a, b) if same else ([], []))
        return found

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}  # a window's ids → its number
        self.texts: list[str] = []  # its groups
        self.links = np.empty(0, np.int64)  # the links of all known windows
        self.ends = np.zeros(1, np.int64)  # where each one's links begin and end

    def learn(self, keys: list[bytes], sides: list[np.ndarray], ends: np.ndarray) -> None:
        """Align new windows: ``sides`` are both sides' ids of one after another, ``ends`` their last bytes, counted through."""
        shared, *last = np.intersect1d(*[np.cumsum(size[ids]) for size, ids in zip(self.sizes, sides)], assume_unique=True, return_indices=True)
        written = []
        for ids, at in zip(sides, last):
            names, edges = [self.names[i] for i in ids.tolist()], [0, *(at + 1).tolist()]
            written.append([names[i] if j - i == 1 else ",".join(names[i:j]) for i, j in zip(edges, edges[1:])])
        groups = list(map("|".join, zip(*written)))
        edges = np.searchsorted(shared, ends) + 1
        self.known.update(zip(keys, range(len(self.texts), len(self.texts) + len(keys))))
        self.texts += [";".join(groups[i:j]) for i, j in zip([0, *edges.tolist()], edges.tolist())]
        # A's id above B's.
        self.links = np.concatenate([self.links, sides[0][last[0]] << 32 | sides[1][last[1]]])
        self.ends = np.concatenate([self.ends, self.ends[-1] + edges])

    def windows(self, ids: list[tuple[list[int], list[int]]]) -> tuple[np.ndarray, list[int]]:
        """The windows of texts that have tokens, as numbers, and each text's first window.

        A window begins where a token of either side begins with a space and both sides'
        tokens before it end at the same byte: that end is compared, not supposed.
        """
        flat, cuts = [], []
        for side, size, marked in zip(zip(*ids), self.sizes, self.marked):
            tokens = np.fromiter(chain.from_iterable(side), np.int64)
            ends = np.cumsum(size[tokens])
            first = np.cumsum([0, *map(len, side)])[:-1]
            may = marked[tokens]
            may[first] = True  # a text's first byte is an anchor
            at = np.flatnonzero(may)
            begin = ends - size[tokens]
            flat.append(tokens)
            cuts.append((at, begin[at]))
        begins, total = begin[first], int(ends[-1])
        shared, *chosen = np.intersect1d(cuts[0][1], cuts[1][1], assume_unique=True, return_indices=True)
        starts = [at[c] for (at, _), c in zip(cuts, chosen)]
        lengths = [np.diff(np.append(at, len(tokens))) for at, tokens in zip(starts, flat)]
        one, same = _alike(flat, starts, lengths)  # a window for each kind in this batch, and each window's kind
        raw = [tokens.astype("<u4").tobytes() for tokens in flat]
        spans = [(4 * at[one], 4 * (at[one] + n[one])) for at, n in zip(starts, lengths)]
        # A's part is as long as the first number says.
        keys = [
            n + raw[0][i:j] + raw[1][k:m]
            for n, i, j, k, m in zip(_prefixes(lengths[0][one]), *(x.tolist() for span in spans for x in span))
        ]
        number = list(map(self.known.get, keys))
        new = np.array([k for k, n in enumerate(number) if n is None], np.int64)
        if len(new):
            sides = []
            for tokens, at, n in zip(flat, starts, lengths):
                at, n = at[one[new]], n[one[new]]
                sides.append(tokens[np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum())])
            sizes = np.diff(np.append(shared, total))[one[new]]
            self.learn([keys[k] for k in new.tolist()], sides, np.cumsum(sizes))
            number = list(map(self.known.__getitem__, keys))
        return np.array(number, np.int64)[same], np.searchsorted(shared, begins).tolist()


def _entries(path: str) -> list[bytes]:
    """The bytes of a byte-level file's tokens, by id; added tokens stand for themselves."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    of = byte_characters()
    names = {k: bytes(of[c] for c in name) for name, k in told["model"]["vocab"].items()}
    names |= {t["id"]: t["content"].encode() for t in told["added_tokens"]}
    return [names.get(k, b"") for k in range(max(names) + 1)]


def _prefixes(lengths: np.ndarray) -> list[bytes]:
    raw = lengths.astype("<u4").tobytes()
    return [raw[i : i + 4] for i in range(0, len(raw), 4)]


def _alike(flat: list[np.ndarray], starts: list[np.ndarray], lengths: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Windows with the same ids: one of each kind, and every window's kind.

    Kinds are told apart by 64 bits, then every window is compared, id by id, with the one
    that stands for it; a window that differs is a kind of its own.
    """
    mark = np.zeros(len(starts[0]), np.uint64)
    for tokens, at, n in zip(flat, starts, lengths):
        place = (np.arange(len(tokens)) - np.repeat(at, n)).astype(np.uint64)
        mixed = (tokens.astype(np.uint64) + np.uint64(1)) * (np.uint64(0x9E3779B97F4A7C15) + place * np.uint64(0xD1B54A32D192ED03))
        mixed ^= mixed >> np.uint64(29)
        mark = mark * np.uint64(0xBF58476D1CE4E5B9) + np.add.reduceat(mixed * np.uint64(0x94D049BB133111EB), at) + n.astype(np.uint64)
    _, one, same = np.unique(mark, return_index=True, return_inverse=True)
    differs = np.zeros(len(mark), bool)
    for tokens, at, n in zip(flat, starts, lengths):
        stands = one[same]
        longer = n != n[stands]
        differs |= longer
        # Compared at the window's own length; where lengths differ it is a kind of its own anyway.
        other = np.repeat(at[stands] - at, n) + np.arange(len(tokens))
        unlike = tokens[np.minimum(other, len(tokens) - 1)] != tokens
        differs |= np.add.reduceat(unlike, at) > 0
    own = np.flatnonzero(differs)
    same[own] = len(one) + np.arange(len(own))
    return np.concatenate([one, own]), same


@cache
def _tokens(pair: TokenizerPair) -> _Tokens:
    return _Tokens(pair)



DOC = "struct<id: {}, n_a: bigint, n_b: bigint, n_groups: bigint, groups_sha256: string>"


def _bundle(tokens: _Tokens, ids: list, texts: list[str], remember: int) -> tuple:
    """Documents' own columns, distinct pairs with their links, and every link's pair in order."""
    if len(tokens.known) > remember:
        tokens.forget()
    encoded = tokens.encode(texts)
    have = [k for k, (a, _) in enumerate(encoded) if a]
    digest, groups, codes = [""] * len(ids), [0] * len(ids), np.empty(0, np.int64)
    if have:
        number, first = tokens.windows([encoded[k] for k in have])
        named = tokens.texts
        for k, low, high in zip(have, first, [*first[1:], len(number)]):
            digest[k] = hashlib.sha256(";".join([named[w] for w in number[low:high].tolist()]).encode()).hexdigest()
        at, n = tokens.ends[number], tokens.ends[number + 1] - tokens.ends[number]
        for k, sum_ in zip(have, np.add.reduceat(n, first).tolist()):
            groups[k] = sum_
        codes = tokens.links[np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum())]
    pairs, which, times = np.unique(codes, return_inverse=True, return_counts=True)
    docs = [
        {"id": i, "n_a": len(a), "n_b": len(b), "n_groups": g, "groups_sha256": s}
        for i, (a, b), g, s in zip(ids, encoded, groups, digest)
    ]
    return docs, pairs, times, which.astype("<u4").tobytes()


def align_tokens(
    docs: DataFrame,
    pair: TokenizerPair,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bundle_chars: int = 250_000,
    remember: int = 100_000,
    folder: str | None = None,
) -> DataFrame:
    """How two tokenizers' tokens of the same text lie to each other, per document.

    A encodes a space and the text, B the text, to which it adds the space. Where both
    sides end a token at the same byte, a group ends, and the two tokens are a link. No
    token is empty, so a shared end belongs to one token a side and a document has as many
    links as groups. Returns the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair is the most frequent of its B id, ties included),
    ``count_sum`` (links of the whole input with the same pair, summed over links) and
    ``groups_sha256`` of the groups written as ``a1,a2|b1;a3|b2,b3``.

    1. Whole texts are encoded, and documents split into windows at anchors: shared ends
       before tokens that begin with a space. A window's groups are remembered by its ids; a
       task that knows more than ``remember`` windows begins anew. Some documents with
       together about ``bundle_chars`` characters make a bundle, whose links are stored as
       places among its distinct pairs.
    2. Pairs are counted over all bundles; a pair counts once a bundle with its links, so a
       pair that is everywhere is spread over bundles.
    3. Every bundle looks its distinct pairs up, and sums them over its documents' links.

    Texts that are null, empty, or that a side does not give back byte by byte have no
    tokens: zeros and an empty digest. Null ids and equal rows are kept like any others,
    further columns are ignored, an empty table gives no rows. A very long text is a bundle
    of its own.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "alignment")
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    made = f"docs array<{DOC.format(kind)}>, pairs array<bigint>, times array<bigint>, which binary"
    arrow = spark.createDataFrame([], made).toArrow().schema

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(pair)
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            one = dict(zip(arrow.names, _bundle(tokens, ids, texts, remember)))
            return pa.RecordBatch.from_arrays([pa.array([one[f.name]], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if ids and size + len(text) > bundle_chars:
                    yield row()
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(text)
                size += len(text) + 64
        if ids:
            yield row()
        tokens.forget()  # the worker may stay, idle, while others need its memory

    # The number is fixed when the bundles are written.
    bundled = stored(given.mapInArrow(bundles, made).withColumn("bundle", F.monotonically_increasing_id()), f"{folder}/bundles")

    counted = bundled.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
    counted = stored(counted.agg(F.sum("x.times").alias("n")), f"{folder}/pairs")
    b_id = F.col("pair").bitwiseAND(0xFFFFFFFF)
    # A row for each of B's ids at most: bounded by its vocabulary.
    best = F.broadcast(counted.groupBy(b_id.alias("b")).agg(F.max("n").alias("most")))
    # Stored, so that the join reads plain shuffles. The lowest bit says whether the pair is its B id's best.
    coded = (2 * F.col("n") + F.when(F.col("n") == F.col("most"), 1).otherwise(0)).alias("coded")
    looked_up = stored(counted.join(best, b_id == F.col("b")).select(F.col("pair").alias("_pair"), coded), f"{folder}/counts")
    # One row for each distinct pair of a bundle: a list never exceeds its bundle.
    own = bundled.select("bundle", F.posexplode("pairs").alias("place", "pair"))
    held = own.join(looked_up.hint("merge"), F.col("pair") == F.col("_pair")).groupBy(F.col("bundle").alias("_bundle"))
    held = held.agg(F.collect_list(F.struct("place", "coded")).alias("coded"))
    joined = bundled.select("bundle", "docs", "which").join(held.hint("merge"), F.col("bundle") == F.col("_bundle"), "left")

    out = f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    names = [f.strip().split(" ")[0] for f in out.split(",")]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, which, coded in zip(*batch.columns):
                docs = docs.values
                places = coded.values if coded.is_valid else None
                n = docs.field("n_groups").to_numpy()
                value = np.zeros(len(places) if places is not None else 0, np.int64)
                if len(value):
                    value[places.field("place").to_numpy()] = places.field("coded").to_numpy()
                value = value[np.frombuffer(which.as_py(), "<u4")]
                edges = np.cumsum([0, *n])
                # Whole numbers: a running sum loses nothing.
                both = [np.concatenate([[0], np.cumsum(v)])[edges] for v in (value & 1, value >> 1)]
                sums = [pa.array(np.diff(v), pa.int64()) for v in both]
                columns = {f: docs.field(f) for f in ("id", "n_a", "n_b", "n_groups", "groups_sha256")}
                columns |= {"n_best": sums[0], "count_sum": sums[1]}
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    rows = joined.select("docs", "which", "coded").mapInArrow(summed, out)
    return rows.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"
    )
