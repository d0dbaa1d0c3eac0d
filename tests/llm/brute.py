"""Plain forms of what the operators compute, for small inputs."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(n: int, pairs) -> list[int]:
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def simhash(text: str | None, shingle: int = 3) -> int:
    words = [re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), w) for w in WORD.findall(text or "")]
    if not words:
        return 0
    runs = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(rows: list[tuple[int, str | None]], max_bits: int = 2) -> dict[int, tuple[str, int]]:
    rows = sorted(rows)
    fps = [simhash(t) for _, t in rows]
    values = np.array(fps, np.uint64)
    pairs = np.argwhere(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= max_bits, 1))
    roots = components(len(rows), pairs.tolist())
    return {d: (f"{fp:016x}", rows[r][0]) for (d, _), fp, r in zip(rows, fps, roots)}


def rule_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )
