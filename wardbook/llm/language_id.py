"""Language identification by hyperdimensional letter profiles."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BLANK = np.uint64(32)
SEED = 20_011


@cache
def _alphabetic() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@cache
def letter_vector(code: int, dims: int) -> np.ndarray:
    """The random vector of +1 and -1 that stands for a character, the same everywhere."""
    return np.random.default_rng((SEED, code)).integers(0, 2, dims, np.int8) * np.int8(2) - np.int8(1)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct letter trigrams, 21 bits a letter, with their counts; None without a letter.

    Letters are in lower case; anything between letters is one blank, also before the
    first and after the last.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")
    letter = _alphabetic()[codes]
    if not letter.any():
        return None
    codes = np.concatenate([[BLANK], np.where(letter, codes, BLANK).astype(np.uint64), [BLANK]])
    codes = codes[np.append(True, (codes[1:] != BLANK) | (codes[:-1] != BLANK))]
    runs = (codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:]
    return np.unique(runs, return_counts=True)


def bound(runs: np.ndarray, dims: int) -> np.ndarray:
    """One vector per trigram: first letter rotated twice, second once, third not, multiplied."""
    out = None
    for shift, turn in ((42, 2), (21, 1), (0, 0)):
        codes, at = np.unique((runs >> np.uint64(shift)) & np.uint64((1 << 21) - 1), return_inverse=True)
        letters = np.stack([np.roll(letter_vector(int(c), dims), turn) for c in codes])[at]
        out = letters if out is None else out * letters
    return out


def bundles(texts: list[str | None], dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(one vector per text, whether it has a letter): sums of its trigrams' vectors, of length 1.

    Counts enter as their square roots, so that a repeated phrase does not drown the rest.
    """
    found = [trigrams(t) for t in texts]
    has = np.array([f is not None for f in found], bool)
    out = np.zeros((len(texts), dims), np.float32)
    if not has.any():
        return out, has
    for at in range(0, len(texts), 64):
        rows = [k for k in range(at, min(at + 64, len(texts))) if has[k]]
        if not rows:
            continue
        runs, place = np.unique(np.concatenate([found[k][0] for k in rows]), return_inverse=True)
        weight = np.zeros((len(rows), len(runs)), np.float32)
        owner = np.repeat(np.arange(len(rows)), [len(found[k][0]) for k in rows])
        weight[owner, place] = np.sqrt(np.concatenate([found[k][1] for k in rows]))
        for lot in range(0, len(runs), 8192):
            out[rows] += weight[:, lot : lot + 8192] @ bound(runs[lot : lot + 8192], dims).astype(np.float32)
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, length, out=out, where=length > 0), has


@dataclass(frozen=True)
class Prototypes:
    """A unit vector per language and what all languages have in common."""

    names: tuple[str, ...]
    vectors: np.ndarray
    common: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Closest language by cosine after the common part is taken away, and the cosine, 0 to 1.

        Equal cosines go to the first name; ``und`` with score 0 for texts without a
        letter and where nothing was learned.
        """
        vectors, has = bundles(texts, len(self.common))
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts))
        vectors -= self.common
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        near = vectors @ self.vectors.T
        best = near.argmax(axis=1)
        score = np.where(has, np.clip(near[np.arange(len(texts)), best], 0, 1), 0.0)
        return [self.names[b] if h else "und" for b, h in zip(best, has)], score.astype(np.float64)


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def learn(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 2000,
    dims: int = 1024,
    seed: int = 17,
) -> Prototypes:
    """Prototypes from documents with a language that are not held out.

    About ``per_language`` documents of each language, chosen by a hash of their ids at a
    rate that follows from the language's size, are bundled; the bound keeps the fit alike
    at every size. What reaches the driver is a size and a vector per language.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.col(lang_col).alias("name"))
    rows = rows.filter(F.col("name").isNotNull() & F.col("t").isNotNull() & ~F.coalesce(held_out("id"), F.lit(False)))
    sizes = {r["name"]: r["count"] for r in rows.groupBy("name").count().collect()}
    if not sizes:
        return Prototypes((), np.zeros((0, dims), np.float32), np.zeros(dims, np.float32))
    rates = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.filter(draw < F.try_element_at(rates, F.col("name")))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, has = bundles(batch.column(1).to_pylist(), dims)
            names = np.array(batch.column(0).to_pylist(), object)
            for name in set(names[has]):
                own = vectors[has & (names == name)]
                yield pa.RecordBatch.from_pydict(
                    {"name": [name], "n": pa.array([len(own)], pa.int64()), "sum": [own.sum(axis=0).tolist()]},
                    pa.schema([("name", pa.string()), ("n", pa.int64()), ("sum", pa.list_(pa.float32()))]),
                )

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(part["sum"].to_list()).astype(np.float64), axis=0)
        return pd.DataFrame({"name": part["name"].iloc[:1], "n": [part["n"].sum()], "sum": [total.astype(np.float32)]})

    kind = "name string, n bigint, sum array<float>"
    sums = chosen.select("name", "t").mapInArrow(bundle, kind).groupBy("name").applyInPandas(add, kind)
    learned = sorted(sums.collect(), key=lambda r: r["name"])
    if not learned:
        return Prototypes((), np.zeros((0, dims), np.float32), np.zeros(dims, np.float32))
    means = np.array([r["sum"] for r in learned], np.float32) / np.array([[r["n"]] for r in learned], np.float32)
    common = means.mean(axis=0) if len(means) > 1 else np.zeros(dims, np.float32)
    own = means - common
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
    return Prototypes(tuple(r["name"] for r in learned), own, common)


def identify(docs: DataFrame, prototypes: Prototypes, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, ``held_out``, ``lang_pred`` and ``score`` from its whole text alone.

    Null, empty and letterless texts are ``und`` with score 0; a null id is not held out.
    Equal rows get equal results; further columns are ignored; no rows give no rows.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                names, score = prototypes.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(id_col, text_col).mapInArrow(predict, f"id {kind}, lang_pred string, score double")
    return found.select(
        F.col("id").alias(id_col), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
