"""Vectorised work on batches of texts inside Arrow tasks: bytes, words and hashes.

Texts are handled in slices of about ``SLICE`` bytes, so that memory does not depend on how many
rows an Arrow batch holds; one very long text makes a slice of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20

# The separators of words, which are space and the bytes 0x09 to 0x0D.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SEPARATORS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BYTE_HASH = np.random.default_rng(20240901).integers(1, 1 << 63, size=256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, size: int) -> np.ndarray:
    """base**0 .. base**(size-1) modulo 2**64, kept for the life of the worker."""
    known = _powers.get(int(base))
    if known is None or len(known) < size:
        factors = np.full(max(size, SLICE + 4096), base, dtype=np.uint64)
        factors[0] = 1
        known = _powers[int(base)] = np.cumprod(factors, dtype=np.uint64)
    return known[:size]


def give_back() -> None:
    """To be called when a task is done with large arrays: the worker lives on, and the C library and Arrow keep freed memory."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit over all output bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def raw_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every row; null counts as empty."""
    return [value if value is not None else b"" for value in column.cast(pa.large_binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges [first, last) of about ``limit`` bytes each."""
    first, size = 0, 0
    for row, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, row
            first, size = row, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


class Words:
    """The words of a slice of texts: A-Z lower-cased, cut at ``SEPARATORS``.

    ``doc`` holds the row of every word and ``counts`` the words of every row; ``hashes`` are 64-bit
    hashes of whole words.
    """

    def __init__(self, texts: list[bytes], lower: bool = True):
        joined = np.frombuffer(b" ".join([b"", *texts, b""]), dtype=np.uint8)
        self.raw = joined
        self.bytes = _LOWER[joined] if lower else joined
        inside = _IS_WORD[joined]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.starts, self.ends = edges[0::2], edges[1::2]
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        after = np.cumsum(lengths + 1) + 1
        upto = np.searchsorted(self.starts, after, side="left")
        self.counts = np.diff(upto, prepend=0)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.first = upto - self.counts

    def hashes(self) -> np.ndarray:
        summed = np.zeros(len(self.bytes) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_HASH[self.bytes] * powers(_BASE, len(self.bytes)), out=summed[1:])
        values = (summed[self.ends] - summed[self.starts]) * powers(_INVERSE, len(self.bytes))[self.starts]
        return mix(values + (self.ends - self.starts).astype(np.uint64))

    def word(self, index: int) -> bytes:
        return self.bytes[self.starts[index] : self.ends[index]].tobytes()


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the runs of ``size`` words of every row; a shorter row is one run by itself."""
    total = len(hashes)
    row = np.repeat(np.arange(len(counts)), counts)
    last = np.repeat(np.cumsum(counts), counts)
    place = np.arange(total)
    value = np.zeros(total, dtype=np.uint64)
    for step in range(size):
        reach = np.minimum(place + step, total - 1)
        term = mix(hashes[reach] + powers(_BASE, size + 1)[step + 1])
        value += np.where(place + step < last, term, np.uint64(0)) if total else term
    whole = place + size <= last
    short = (np.repeat(counts, counts) < size) & (place == last - np.repeat(counts, counts))
    keep = whole | short
    return row[keep], mix(value[keep])


def byte_prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span of ``data``."""
    summed = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_HASH[data] * powers(_BASE, len(data)), out=summed[1:])
    return summed


def span_hash(summed: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    values = (summed[ends] - summed[starts]) * powers(_INVERSE, len(summed))[starts]
    return mix(values + (ends - starts).astype(np.uint64))


def gram_hashes(summed: np.ndarray, size: int) -> np.ndarray:
    """``span_hash`` of the ``size`` bytes from every place on that has so many."""
    values = summed[size:] - summed[:-size]
    values *= powers(_INVERSE, len(summed))[: len(values)]
    return mix(values + np.uint64(size))


def to_planes(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, no wider than the largest needs; equal high bytes compress away."""
    raw = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(len(values), 8)
    width = 8
    while width > 1 and not raw[:, width - 1].any():
        width -= 1
    return bytes([width]) + np.ascontiguousarray(raw[:, :width].T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    width, count = data[0], (len(data) - 1) // data[0]
    raw = np.zeros((count, 8), dtype=np.uint8)
    raw[:, :width] = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(width, count).T
    return raw.reshape(-1).view("<u8")


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards as ranges of hashes: in sorted order, a shard's hashes lie together."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
