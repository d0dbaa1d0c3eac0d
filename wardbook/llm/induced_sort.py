"""External induced suffix sorting with common prefixes, a block of suffixes at a time.

Suffixes are ordered by at most ``cap`` bytes, which is all that a search for strings of
that length needs; common prefixes count up to ``cap``.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 19  # suffixes that are handled at a time
Block = tuple[np.ndarray, np.ndarray]  # positions, common prefix of each with the one before it


class BucketQueue:
    """A priority queue on disk: first by bucket, then by arrival.

    In induced sorting suffixes arrive in the order of what follows their first byte, so
    arrival is their order inside the bucket. Beyond ``in_memory`` entries all that is held
    goes to a temporary file.
    """

    def __init__(self, in_memory: int = 1 << 21):
        self.limit, self.size, self.file = in_memory, 0, None
        self.held: list[list] = [[] for _ in range(256)]

    def push(self, bucket: int, positions: np.ndarray, common: np.ndarray) -> None:
        self.held[bucket].append((positions, common))
        self.size += len(positions)
        if self.size > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for blocks in self.held:
            for k, block in enumerate(blocks):
                if not isinstance(block[0], int):
                    blocks[k] = (self.file.tell(), len(block[0]))
                    self.file.write(block[0].astype("<i8").tobytes())
                    self.file.write(block[1].tobytes())
        self.size = 0

    def _read(self, block) -> Block:
        if not isinstance(block[0], int):
            self.size -= len(block[0])
            return block
        self.file.seek(block[0])
        positions = np.frombuffer(self.file.read(8 * block[1]), "<i8")
        return positions, np.frombuffer(self.file.read(block[1]), np.uint8)

    def ascending(self, bucket: int) -> Iterator[Block]:
        """Entries of a bucket as they arrived, those pushed meanwhile included; they leave the queue."""
        while self.held[bucket]:
            blocks, parts, size = self.held[bucket], [], 0
            while blocks and size < BLOCK:
                parts.append(self._read(blocks.pop(0)))
                size += len(parts[-1][0])
            yield _joined(parts)

    def descending(self, bucket: int) -> Iterator[Block]:
        """Entries of a bucket from the last; a common prefix is then with the entry before it here, 0 for the first."""
        blocks, carried = self.held[bucket], np.uint8(0)
        while blocks:
            parts, size = [], 0
            while blocks and size < BLOCK:
                parts.append(self._read(blocks.pop()))
                size += len(parts[-1][0])
            positions, common = _joined(parts[::-1])
            yield positions[::-1], np.append(carried, common[:0:-1]).astype(np.uint8)
            carried = common[0]


def _joined(parts: list[Block]) -> Block:
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(c) for c in zip(*parts))


def _chunks(block: Block) -> Iterator[Block]:
    for at in range(0, len(block[0]), BLOCK):
        yield block[0][at : at + BLOCK], block[1][at : at + BLOCK]


class _Words:
    """Eight bytes at any place of a text, as a number that orders like them; zeros follow its end.

    The text is read where it is, mapped or not; only its last bytes are copied.
    """

    def __init__(self, text: np.ndarray, cap: int):
        self.edge = max(len(text) - 7, 0)  # words from here on reach beyond the end
        end = np.concatenate([text[self.edge :], np.zeros(16, np.uint8)])
        self.end = np.lib.stride_tricks.sliding_window_view(end, 8)
        self.rows = np.lib.stride_tricks.sliding_window_view(text, 8) if self.edge else self.end

    def at(self, places: np.ndarray) -> np.ndarray:
        rows = self.rows[np.minimum(places, len(self.rows) - 1)]
        late = np.flatnonzero(places >= self.edge)
        if len(late):
            rows[late] = self.end[np.minimum(places[late] - self.edge, len(self.end) - 1)]
        return rows.view(">u8").ravel().astype(np.uint64)


def _common(words: _Words, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of pairs of suffixes, up to ``cap``."""
    out, live = np.full(len(a), cap, np.int64), np.arange(len(a))
    for at in range(0, cap, 8):
        if not len(live):
            break
        differ = words.at(a[live] + at) ^ words.at(b[live] + at)
        found = np.flatnonzero(differ)
        high = np.frexp((differ[found] >> np.uint64(8)).astype(np.float64))[1]  # 0 if only the last byte differs
        out[live[found]] = at + 7 - (high + 7) // 8
        live = live[differ == 0]
    return np.minimum(out, cap).astype(np.uint8)


def _refine(rank: np.ndarray, subset: np.ndarray, key: np.ndarray) -> None:
    """Split groups of equal ``rank`` by ``key``; a rank is the place of its group's first entry."""
    order = np.lexsort((key, rank[subset]))
    group, key, subset = rank[subset][order], key[order], subset[order]
    new_group = np.append(True, group[1:] != group[:-1])
    new = new_group | np.append(True, key[1:] != key[:-1])
    places = np.arange(len(subset))
    first = np.maximum.accumulate(np.where(new_group, places, 0))
    rank[subset] = group + np.maximum.accumulate(np.where(new, places, 0)) - first


def _tied(rank: np.ndarray) -> np.ndarray:
    """Entries that share their rank."""
    counts = np.bincount(rank, minlength=len(rank))
    return np.flatnonzero(counts[rank] > 1)


def sorted_seeds(text: np.ndarray, seeds: np.ndarray, cap: int) -> Block:
    """The seeds (leftmost rising suffixes) in order, with common prefixes.

    Substrings from seed to seed are named in order; the shorter text of names is ordered
    by doubling, each round by the ranks of twice as many names, until ranks are unique or
    ``cap`` bytes decide them.
    """
    n, m, words = len(text), len(seeds), _Words(text, cap)
    if not m:
        return seeds, np.zeros(0, np.uint8)
    following = np.append(seeds[1:], n)
    length = following - seeds + 1
    rank = np.zeros(m, np.int64)
    subset = np.arange(m)
    for at in range(0, cap + 8, 8):
        if at:
            tied = _tied(rank)
            going = np.zeros(m, bool)
            going[rank[tied[length[tied] > at]]] = True
            subset = tied[going[rank[tied]]]
            if not len(subset):
                break
        left = np.clip(length[subset] - at, 0, 8).astype(np.uint64)
        # What follows a substring counts as more than any byte: a rising end is greater than a falling byte.
        beyond = np.where(left < 8, (np.uint64(1) << (np.uint64(8) * (np.uint64(8) - np.maximum(left, 1)))) - np.uint64(1), np.uint64(0))
        beyond = np.where(left == 0, np.uint64(2**64 - 1), beyond)
        beyond = np.where(following[subset] == n, np.uint64(0), beyond)
        _refine(rank, subset, words.at(seeds[subset] + at) | beyond)
    step = 1
    while step < m:
        tied = _tied(rank)
        covered = np.where(tied + step < m, seeds[np.minimum(tied + step, m - 1)], n) - seeds[tied]
        subset = tied[covered < cap]
        if not len(subset):
            break
        key = np.where(subset + step < m, rank[np.minimum(subset + step, m - 1)] + 1, 0)
        _refine(rank, subset, key)
        step *= 2
    order = np.argsort(rank, kind="stable")
    common = np.zeros(m, np.uint8)
    same = rank[order[1:]] == rank[order[:-1]]
    pairs = np.flatnonzero(~same) + 1
    common[1:][same] = cap
    common[pairs] = _common(words, seeds[order[pairs - 1]], seeds[order[pairs]], cap)
    # Equal names at the very end of the text may tie short suffixes.
    common = np.minimum(common, np.append(0, np.minimum(n - seeds[order[1:]], n - seeds[order[:-1]]))).astype(np.uint8)
    return seeds[order], common


class _Inducer:
    """Pushes the suffixes that begin one byte before those of a stream, with common prefixes.

    Of two neighbours in a bucket, the common prefix is one more than the least of the
    stream between the two that induced them.
    """

    def __init__(self, text: np.ndarray, queue: BucketQueue, cap: int):
        self.text, self.queue, self.cap = text, queue, cap
        self.least = np.zeros(256, np.uint8)  # of the stream since the bucket's last entry
        self.seen = np.zeros(256, bool)

    def feed(self, positions: np.ndarray, common: np.ndarray, chosen: np.ndarray) -> None:
        """``chosen``: which positions induce; byte by byte before them is read here."""
        at = np.flatnonzero(chosen)
        lowest = np.minimum.accumulate(common)
        if len(at):
            before = positions[at] - 1
            byte = self.text[before]
            order = np.argsort(byte, kind="stable")
            at, before, byte = at[order], before[order], byte[order]
            first = np.append(True, byte[1:] != byte[:-1])
            least = np.empty(len(at), np.uint8)
            least[first] = np.minimum(lowest[at[first]], self.least[byte[first]])
            rest = np.flatnonzero(~first)
            least[rest] = _range_least(common, at[rest - 1] + 1, at[rest])
            value = np.minimum(least.astype(np.int64) + 1, self.cap).astype(np.uint8)
            heads = np.flatnonzero(first)
            value[heads[~self.seen[byte[heads]]]] = 0
            ends = np.append(heads[1:], len(at))
            self.least[:] = np.minimum(self.least, lowest[-1])
            highest_first = np.minimum.accumulate(common[::-1])[::-1]
            for a, b in zip(heads.tolist(), ends.tolist()):
                k, last = int(byte[a]), int(at[b - 1])
                self.queue.push(k, before[a:b], value[a:b])
                self.seen[k] = True
                self.least[k] = highest_first[last + 1] if last + 1 < len(common) else 255
        elif len(common):
            self.least[:] = np.minimum(self.least, lowest[-1])


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``values[low..high]``, both included, for many ranges: a sparse table."""
    out = np.empty(len(low), np.uint8)
    if not len(low):
        return out
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    table = values
    for k in range(int(level.max()) + 1):
        if k:
            table = np.minimum(table[: -(1 << (k - 1))], table[1 << (k - 1) :])
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(table[low[own]], table[high[own] - (1 << k) + 1])
    return out


def sorted_suffixes(text: np.ndarray, cap: int, *, in_memory: int = 1 << 21) -> Iterator[Block]:
    """All suffixes of ``text`` from the greatest, with common prefixes up to ``cap`` (at most 254).

    ``text`` is an array of bytes, which may be mapped from disk. Falling suffixes are
    induced from the sorted seeds in ascending order, then rising ones from those in
    descending order, both through queues on disk.
    """
    n = len(text)
    if not n:
        return
    # A suffix rises if the first byte that differs from its own run is greater; the end is least.
    change = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    up = np.append(text[change[:-1] + 1] > text[change[:-1]], False)
    rises = np.repeat(up, np.diff(np.append(-1, change)))
    seeds = np.flatnonzero(rises[1:] & ~rises[:-1]) + 1
    order, common = sorted_seeds(text, seeds, cap)
    starts = np.searchsorted(text[order], np.arange(257)) if len(order) else np.zeros(257, np.int64)
    words = _Words(text, cap)

    def seam(a: int, b: int) -> int:
        return int(min(_common(words, np.array([a]), np.array([b]), cap)[0], n - a, n - b))

    falling, results = BucketQueue(in_memory), BucketQueue(in_memory)
    inducer = _Inducer(text, falling, cap)
    falling.push(int(text[n - 1]), np.array([n - 1]), np.zeros(1, np.uint8))  # before the end of the text
    inducer.seen[text[n - 1]] = True
    inducer.least[:] = 0
    for byte in range(256):
        last = None
        for block in falling.ascending(byte):
            for positions, shared in _chunks(block):
                results.push(byte, positions, shared)
                previous = text[np.maximum(positions - 1, 0)]
                inducer.feed(positions, shared, (positions > 0) & (previous >= byte))
                last = int(positions[-1])
        a, b = int(starts[byte]), int(starts[byte + 1])
        if a < b:
            shared = common[a:b].copy()
            shared[0] = 0 if last is None else seam(last, int(order[a]))
            for positions, shared in _chunks((order[a:b], shared)):
                inducer.feed(positions, shared, np.ones(len(positions), bool))
    rising = BucketQueue(in_memory)
    inducer = _Inducer(text, rising, cap)
    for byte in range(255, -1, -1):
        last = None
        for block in rising.ascending(byte):
            for positions, shared in _chunks(block):
                previous = text[np.maximum(positions - 1, 0)]
                inducer.feed(positions, shared, (positions > 0) & (previous <= byte))
                last = int(positions[-1])
                yield positions, shared
        for k, block in enumerate(results.descending(byte)):
            for j, (positions, shared) in enumerate(_chunks(block)):
                if k == j == 0 and last is not None:
                    shared = shared.copy()
                    shared[0] = seam(last, int(positions[0]))
                previous = text[np.maximum(positions - 1, 0)]
                inducer.feed(positions, shared, (positions > 0) & (previous < byte))
                yield positions, shared
