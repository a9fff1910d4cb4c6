"""Words of whole texts as hash arrays, computed for a block of texts at a time with numpy.

A text is taken as its UTF-8 bytes. All separators are ASCII, so splitting bytes is the same
as splitting characters. The 64-bit hash of a word depends on its bytes alone.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 << 20
_WINDOW = 1 << 18
_RNG = np.random.RandomState(20240229)
_BYTE = _RNG.randint(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes of words: everything but white space; or digits, lower-case letters and all non-ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finishing step of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grow(n: int) -> None:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)


def blocks(texts: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of texts with about max_bytes, one text at least.

    A null counts as an empty text. bounds[i]:bounds[i + 1] are the bytes of the i-th text.
    """
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32, count=texts.offset + len(texts) + 1)
    ends = ends[texts.offset:].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + max_bytes, "right")) - 1)
        yield at, to, raw[ends[at]:ends[to]], ends[at:to + 1] - ends[at]
        at = to


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes start:end of each span; spans are in order and do not overlap."""
    out = np.empty(len(start), np.uint64)
    cuts = np.unique(np.searchsorted(start, np.arange(0, len(data) + _WINDOW, _WINDOW)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        lo, hi = start[a], end[b - 1]
        _grow(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[data[lo:hi]] * _powers[0][:hi - lo], out=sums[1:])
        s, e = start[a:b] - lo, end[a:b] - lo
        out[a:b] = mix((sums[e] - sums[s]) * _powers[1][s] + (e - s).astype(np.uint64))
    return out


class Words:
    """Words of a block: hash, start and end byte of each, and first[d]:first[d + 1] of text d."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, letters: np.ndarray, lower: bool = True):
        self.data = LOWER[data] if lower else data
        inside = letters[self.data]
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[bounds] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before[edge[:n]] = False
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after[edge[1:]] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, bounds)
        self.hash = span_hashes(self.data, self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, a: int, b: int) -> bytes:
        """Words a to b, joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b]))


def fold(hashes: np.ndarray) -> np.uint64:
    """Hash of a whole short sequence; differs from that of any window by its length."""
    x = np.array([len(hashes)], np.uint64)
    for k in range(len(hashes)):
        x = mix(x * np.uint64(_BASE) + hashes[k:k + 1])
    return x[0]


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of `size` consecutive words, and first[d]:first[d + 1] of text d.

    A text with fewer words has one window of all its words; one without words has none.
    """
    counts = np.diff(first)
    n = len(hashes)
    sums = np.zeros(max(0, n - size + 1), np.uint64)
    factor = np.uint64(1)
    for j in range(size if len(sums) else 0):
        sums += hashes[j:n - size + 1 + j] * factor
        factor = np.uint64(int(factor) * _BASE & 0xFFFFFFFFFFFFFFFF)
    short = (counts > 0) & (counts < size)
    number = np.where(short, 1, np.maximum(0, counts - size + 1))
    begin = np.concatenate([[0], np.cumsum(number)])
    out = np.empty(begin[-1], np.uint64)
    full = ~short & (counts > 0)
    if full.any():
        place = np.repeat(first[:-1][full] - begin[:-1][full], number[full])
        slots = np.flatnonzero(np.repeat(full, number))
        out[slots] = mix(sums[slots + place])
    for d in np.flatnonzero(short):
        out[begin[d]] = fold(hashes[first[d]:first[d + 1]])
    return out, begin
