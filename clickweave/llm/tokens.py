"""Exact and fast encoding with public tokenizers.

The tokenizers library defines the result; this module only avoids asking it
for the same string twice. Both supported kinds split a text into pre-tokens
that never run across a change from non-space to space, so a text can be cut
there and the ids of the parts joined (``units``). A unit of plain characters is
split into pre-tokens here and each distinct pre-token is merged once by the
library's model; any other unit is encoded by the library as it is.

Memory: a memo has two generations of ``MEMO`` entries. When the young one is full
it becomes the old one and what was old is forgotten; entries that are asked for
again move to the young one, so frequent words stay.
"""

from __future__ import annotations

import functools
import os
import re
import struct
from collections.abc import Iterable

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MEMO = 500_000
#: Characters of a unit beyond which it is neither split here nor kept.
LONG = 200
#: ASCII separators that str.split() counts as space and the tokenizers do not.
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Characters for which lower-casing, NFC and the character classes of the
#: patterns below are the same here and in the library.
PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
_LETTER, _DIGIT, _OTHER = r"[^\W\d_]", r"\d", r"(?:[^\s\w]|_)"
_SHORT = r"'s|'t|'re|'ve|'m|'ll|'d"
#: Pre-token patterns (fixed values, as published with the vocabularies).
WORD_PATTERN = re.compile(rf"{_SHORT}|{_LETTER}+|{_DIGIT}|{_OTHER}+")
BYTE_PATTERN = re.compile(rf"{_SHORT}| ?{_LETTER}+| ?{_DIGIT}+| ?{_OTHER}+|\s+(?!\S)|\s+")
_UNIT = re.compile(r"\s*\S+|\s+")


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others for the characters from 256 on, in byte order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in shown else chr(next(rest)) for b in range(256)}


_ALPHABET = byte_letters()
_MAP = {c: "".join(_ALPHABET[b] for b in chr(c).encode()) for c in [*range(128), *range(0xC0, 0x100)]}


def mapped(piece: str) -> str:
    """A plain piece in the byte-level alphabet."""
    return piece.translate(_MAP)


class Memo(dict):
    """Values by text, made when first asked for; see above. Long texts are not kept."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, text: str) -> bytes:
        got = self.old.get(text)
        if got is None:
            got = self.make(text)
        if len(text) <= LONG:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[text] = got
        return got


@functools.lru_cache(maxsize=4)
def library(path: str):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class Codec:
    """Encoder of one vocabulary file: ids as little-endian uint32 bytes."""

    def __init__(self, path: str, memo: int = MEMO):
        import json
        self.tok = library(path)
        self.model = self.tok.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        #: "word": lower-cased, white space dropped; "byte": every byte kept.
        self.kind = "word" if spec["normalizer"] else "byte"
        self.pattern = WORD_PATTERN if self.kind == "word" else BYTE_PATTERN
        #: of units, and of the pre-tokens of units that hold several
        self.units = Memo(self._unit, memo)

    def split(self, text: str) -> list[str]:
        return text.split() if self.kind == "word" else _UNIT.findall(text)

    def asked(self, text: str) -> bytes:
        """The library's own answer."""
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        # printable ASCII but the space stands for itself in the byte-level alphabet
        same = piece.isascii() and piece.isprintable() and " " not in piece
        ids = [t.id for t in self.model.tokenize(piece if same else mapped(piece))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _unit(self, unit: str) -> bytes:
        plain = unit.isascii() and unit.isprintable()
        if "<|" in unit or len(unit) > LONG or not (plain or PLAIN.fullmatch(unit)):
            return self.asked(unit)
        low = unit.lower() if self.kind == "word" else unit
        # letters alone are one piece
        pieces = [low] if plain and low.isalpha() else self.pattern.findall(low)
        if pieces == [unit]:
            return self._piece(unit)
        return b"".join(map(self.units.__getitem__, pieces))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if ODD_SPACE.search(text):
            return self.asked(text)
        return b"".join(map(self.units.__getitem__, self.split(text)))


@functools.lru_cache(maxsize=4)
def codec(path: str, memo: int = MEMO) -> Codec:
    """One codec a worker process."""
    return Codec(path, memo)


class Decoder:
    """Byte strings of the ids of a byte-level vocabulary."""

    def __init__(self, path: str):
        tok = library(path)
        back = {c: b for b, c in _ALPHABET.items()}
        added = {i: t.content.encode() for i, t in tok.get_added_tokens_decoder().items()}
        table: list[bytes] = []
        for i in range(tok.get_vocab_size(with_added_tokens=True)):
            token = tok.id_to_token(i) or ""
            table.append(added.get(i) or bytes(back[c] for c in token))
        self.table = table

    def decode(self, ids: Iterable[int]) -> bytes:
        """UTF-8 bytes of the decoded text (ill-formed parts replaced)."""
        raw = b"".join(map(self.table.__getitem__, ids))
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()


@functools.lru_cache(maxsize=4)
def decoder(path: str) -> Decoder:
    return Decoder(path)
