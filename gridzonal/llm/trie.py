"""A two-level n-gram trie in Elias-Fano form, held in memory-mapped files.

Level one lists contexts and level two, for each context, the words that follow it. Both are monotone sequences: a word is
stored relative to its context, as its id above the last value of the context before, so one sequence covers all contexts and
a successor search finds a word within its own. Pointers from contexts to their words are a third
sequence. Probabilities and back-off weights are one byte each, a logarithm in steps of ``1 / STEPS`` of a bit.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np

BLOCK = 4096
STEPS = 6


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary, and a directory of every ``BLOCK``th value."""

    PARTS = ("shape", "low", "high", "at", "first")

    def __init__(self, shape, low, high, at, first):
        self.shape, self.low, self.high, self.at, self.first = shape, low, high, at, first

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, dtype=np.uint64)
        count = len(values)
        top = int(values[-1]) if count else 0
        width = max(0, (top // max(count, 1)).bit_length() - 1)
        shift = np.uint64(width)
        upper = (values >> shift).astype(np.int64)
        ones = upper + np.arange(count)
        bits = np.zeros(int(ones[-1]) + 1 if count else 0, dtype=np.uint8)
        bits[ones] = 1
        planes = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        return cls(
            np.array([count, width], dtype=np.int64),
            np.packbits(planes.astype(np.uint8).reshape(-1)),
            np.packbits(bits),
            ones[::BLOCK].astype(np.int64),
            values[::BLOCK].copy(),
        )

    def save(self, folder: Path, name: str) -> None:
        for part in self.PARTS:
            np.save(folder / f"{name}.{part}.npy", getattr(self, part))

    @classmethod
    def open(cls, folder: Path, name: str) -> "EliasFano":
        return cls(*(np.load(folder / f"{name}.{part}.npy", mmap_mode="r") for part in cls.PARTS))

    def __len__(self) -> int:
        return int(self.shape[0])

    def block(self, number: int) -> np.ndarray:
        """The values of one block, decoded from the mapped bits."""
        count, width = (int(x) for x in self.shape)
        first, last = number * BLOCK, min(count, (number + 1) * BLOCK)
        start = int(self.at[number])
        stop = int(self.at[number + 1]) if number + 1 < len(self.at) else len(self.high) * 8
        bits = np.unpackbits(self.high[start // 8 : -(-stop // 8)])[start % 8 :]
        ones = np.flatnonzero(bits)[: last - first] + start
        values = (ones - np.arange(first, last)).astype(np.uint64) << np.uint64(width)
        if width:
            begin, end = first * width, last * width
            low = np.unpackbits(self.low[begin // 8 : -(-end // 8)])[begin % 8 : begin % 8 + end - begin]
            weights = np.uint64(1) << np.arange(width, dtype=np.uint64)
            values += (low.reshape(-1, width).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
        return values

    def values(self) -> np.ndarray:
        return np.concatenate([self.block(b) for b in range(len(self.at))] or [np.zeros(0, dtype=np.uint64)])

    def at_index(self, index: np.ndarray) -> np.ndarray:
        """Values at sorted positions."""
        out = np.zeros(len(index), dtype=np.uint64)
        edges = np.searchsorted(index, np.arange(len(self.at) + 1) * BLOCK)
        for number in np.flatnonzero(np.diff(edges)):
            part = slice(edges[number], edges[number + 1])
            out[part] = self.block(number)[index[part] - number * BLOCK]
        return out

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Positions of sorted values by successor search, -1 where absent; values are taken to be distinct."""
        out = np.full(len(wanted), -1, dtype=np.int64)
        if not len(self):
            return out
        edges = np.append(np.searchsorted(wanted, self.first), len(wanted))
        for number in np.flatnonzero(np.diff(edges)):
            part = slice(edges[number], edges[number + 1])
            held = self.block(number)
            place = np.minimum(np.searchsorted(held, wanted[part]), len(held) - 1)
            out[part] = np.where(held[place] == wanted[part], number * BLOCK + place, -1)
        return out


def quantise(values: np.ndarray) -> np.ndarray:
    """Codes 1 to 255 of probabilities from 1 down to 2**(-254 / STEPS), under which no count of a corpus falls; 0 stands for none."""
    return (1 + np.clip(np.round(-np.log2(values) * STEPS), 0, 254)).astype(np.uint8)


def chances(codes: np.ndarray) -> np.ndarray:
    """The probabilities of codes."""
    return np.where(codes > 0, 2.0 ** ((1.0 - codes) / STEPS), 0.0)


class Trie:
    """Discounted probabilities of words after contexts, and each context's back-off weight."""

    SEQUENCES = ("contexts", "pointers", "words")
    ARRAYS = ("codes", "backoff")

    @staticmethod
    def write(folder: Path, context: np.ndarray, word: np.ndarray, count: np.ndarray, discount: float) -> None:
        """From distinct (context, word) rows in sorted order with counts above 0."""
        heads = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, int)
        ends = np.append(heads[1:], len(context)) if len(heads) else heads
        total = np.add.reduceat(count, heads).astype(np.float64) if len(heads) else np.zeros(0)
        own = np.repeat(np.arange(len(heads)), ends - heads)
        last = word[ends - 1] + np.uint64(1) if len(heads) else np.zeros(0, dtype=np.uint64)
        base = np.concatenate([[0], np.cumsum(last)[:-1]]).astype(np.uint64) if len(heads) else last
        EliasFano.build(context[heads]).save(folder, "contexts")
        EliasFano.build(np.append(heads, len(context))).save(folder, "pointers")
        EliasFano.build(word + base[own] if len(heads) else word).save(folder, "words")
        codes = quantise((count - discount) / total[own])
        backoff = quantise(discount * (ends - heads) / total)
        for name, held in zip(Trie.ARRAYS, (codes, backoff)):
            np.save(folder / f"{name}.npy", held)

    def __init__(self, folder: Path):
        for name in self.SEQUENCES:
            setattr(self, name, EliasFano.open(folder, name))
        for name in self.ARRAYS:
            setattr(self, name, np.load(folder / f"{name}.npy", mmap_mode="r"))
        # The end of a context's words is the base of the next one's.
        ends = self.pointers.values()[1:].astype(np.int64)
        self.base = np.concatenate([[np.uint64(0)], self.words.at_index(ends - 1) + np.uint64(1)])

    def look_up(self, context: np.ndarray, runs: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of words and of contexts. ``context`` is sorted, ``runs`` counts its words, and those are sorted within it."""
        place = self.contexts.find(context)
        known = place >= 0
        backoff = np.where(known, self.backoff[np.maximum(place, 0)] if len(self.backoff) else 0, 0).astype(np.uint8)
        own = np.repeat(place, runs)
        codes = np.zeros(len(word), dtype=np.uint8)
        asked = np.flatnonzero(own >= 0)
        start, end = self.base[own[asked]], self.base[own[asked] + 1]
        value = word[asked] + start
        inside = value < end
        found = self.words.find(value[inside])
        hit = asked[inside][found >= 0]
        codes[hit] = self.codes[found[found >= 0]]
        return codes, backoff
