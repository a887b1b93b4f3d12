"""Encoding of whole texts with a public tokenizer, inside Arrow tasks.

The tokenizer's normaliser composes characters, then lower-cases; its splitter never joins characters across white space, nor a letter
with ASCII punctuation other than an apostrophe. So a text is lower-cased in ASCII and cut at ASCII white space, closing
punctuation is taken off, each different piece is encoded once by the library and remembered, and a text's ids are joined from
those of its pieces: Arrow cuts a batch of texts and numbers its different pieces, only these are looked up one by one, and
their ids are gathered by number. Two kinds of pieces are known by their own bytes and encoded as they are: those with the sign ``<|`` of special
tokens, which are told by their case, and those where a combining mark may follow a capital, since some letters compose in one case
only. A text of any length is taken whole; null counts as empty. Two generations of at most ``REMEMBERED`` pieces are remembered, so that the memory is bounded and
frequent pieces stay.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED = 100_000
BATCH = 20_000

# ASCII punctuation without the apostrophe, which starts contractions.
CLOSING = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

# Fixed value: how every special token of these vocabularies begins.
SPECIAL = b"<|"

_encoders: dict[str, "Encoder"] = {}


# Letters that the normaliser maps one to one, whatever their neighbours: basic and Western European Latin.
_LETTERS = re.compile("[a-zà-öø-ÿÀ-ÖØ-Þß]+")


def _byte_signs() -> dict[int, str]:
    """The signs by which a byte-level vocabulary writes bytes: printable ones themselves, others from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


# The first UTF-8 bytes of combining marks that compose with ASCII letters (U+0300 to U+036F).
MARKS = (b"\xcc", b"\xcd")


def _by_case(text: bytes) -> bool:
    return SPECIAL in text or MARKS[0] in text or MARKS[1] in text


def _pieces(text: bytes) -> list[bytes]:
    if not _by_case(text):
        return text.lower().split()
    return [piece if _by_case(piece) else piece.lower() for piece in text.split()]


class Encoder:
    """Only for byte-level tokenizers that lower-case and drop white space, as the docstring of the module says."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.signs = _byte_signs()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _one(self, piece: str) -> bytes:
        """The ids of a piece that the splitter keeps whole."""
        signs = piece if piece.isascii() else piece.lower().encode().decode("latin-1").translate(self.signs)
        ids = [token.id for token in self.merge(signs)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _coded(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of every piece. Letters and closing punctuation are remembered apart, other pieces whole."""
        young, old = self.young, self.old
        coded = list(map(young.get, pieces))
        rest: list[int] = []
        for at, ids in enumerate(coded):
            if ids is not None:
                continue
            piece = pieces[at]
            core = piece.rstrip(CLOSING)
            if core and not (core.isalpha() and core.islower()) and not _LETTERS.fullmatch(core.decode()):
                known = old.get(piece)
                if known is None:
                    rest.append(at)
                else:
                    coded[at] = young[piece] = known
                continue
            ids = b""
            for part in (core, piece[len(core) :]):
                if part:
                    known = young.get(part)
                    if known is None:
                        known = young[part] = old.get(part) or self._one(part.decode())
                    ids += known
            coded[at] = ids
        for start in range(0, len(rest), BATCH):
            part = rest[start : start + BATCH]
            found = self.tokenizer.encode_batch_fast([pieces[at].decode() for at in part], add_special_tokens=False)
            for at, got in zip(part, found):
                coded[at] = young[pieces[at]] = struct.pack(f"<{len(got.ids)}I", *got.ids)
        return coded

    def forget(self) -> None:
        """To be called at the end of a task: the worker lives on, and what it holds is missing to the stages after."""
        self.young, self.old = {}, {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text; null counts as empty."""
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        raw = [(text or "").encode() for text in texts]
        odd = [row for row, text in enumerate(raw) if _by_case(text)]
        plain = list(raw)
        for row in odd:
            plain[row] = b""
        cut = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(plain, pa.large_string())))
        words = cut.flatten().dictionary_encode()
        coded = self._coded(words.dictionary.cast(pa.large_binary()).to_pylist())
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
        ids = np.frombuffer(b"".join(coded), dtype="<u4")
        code = words.indices.to_numpy()
        held = sizes[code]
        upto = np.concatenate([[0], np.cumsum(held)])
        # Where the ids of each word's piece are, less where they go.
        shift = (np.cumsum(sizes) - sizes)[code] - upto[:-1]
        joined = ids[np.repeat(shift, held) + np.arange(upto[-1])].tobytes()
        edges = (4 * upto[cut.offsets.to_numpy()]).tolist()
        out = [joined[a:b] for a, b in zip(edges, edges[1:])]
        for row in odd:
            out[row] = b"".join(self._coded(_pieces(raw[row])))
        return out


def encoder(path: str) -> Encoder:
    """One encoder for each worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def groups(texts: list[str | None], limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` characters."""
    first, size = 0, 0
    for row, text in enumerate(texts):
        if size and size + len(text or "") > limit:
            yield first, row
            first, size = row, 0
        size += len(text or "")
    if first < len(texts):
        yield first, len(texts)
