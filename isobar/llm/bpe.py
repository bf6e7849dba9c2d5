"""Byte-pair encoding through a table of pre-tokens.

A pre-token's ids do not depend on its neighbours, so each worker encodes a
pre-token once, keeps its ids as little-endian 32-bit bytes and joins them.
Texts are split by the vocabulary's pattern. Characters on which regular
expressions of different libraries might differ are stood for by a plain one of
their class, which the tokenizers library itself tells, once for each character
that a worker meets; it also normalises such texts where the vocabulary does.
Only texts with special-token strings go to the library whole. Either way the
ids are the library's.
"""

from __future__ import annotations

import array
import os
import re
import unicodedata
from functools import cached_property

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Characters of the classes below end here; texts are split as they are only if all characters are below U+0220, whose lower case ends here too.
CLASS_END = 0x2B0
#: All others, and these: one library takes them as white space and another not, or lower-cases them in another way.
UNSURE = re.compile("[^\\x00-\\x1b\\x20-\\x84\\x86-\\u012f\\u0131-\\u021f]")


def _class(kind: str) -> str:
    """The characters below CLASS_END of a Unicode category, for a character class."""
    return "".join(re.escape(chr(c)) for c in range(CLASS_END) if unicodedata.category(chr(c))[0] == kind)


L, N = _class("L"), _class("N")
#: The split patterns of the public vocabularies.
PATTERNS = {
    "byte_bpe_50k.json": rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^\s{L}{N}]+|\s+(?!\S)|\s+",
    "word_bpe_49k.json": rf"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^\s{L}{N}]+",
}
LOWERS = {"word_bpe_49k.json"}


def _byte_characters() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


BYTE_CHARACTERS = _byte_characters()
#: Entries that a worker's cache holds at most before it starts anew.
CACHE_ENTRIES = 150_000


class _Ids(dict):
    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        out = self.encode(piece)
        if len(piece) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = out
        return out


#: For each class (letter, number, other, space) a character around which one of the class stands in one pre-token, and one that stands for the class.
CLASSES = (("a", "é"), ("1", "²"), ("!", "§"))
SPACE = "\t"


class _Shadow(dict):
    """Code point -> one below U+0220 of the same class; what is missing is asked of the library's pre-tokenizer."""

    def __init__(self, pre_tokenize):
        super().__init__({c: c for c in range(0x220) if not UNSURE.match(chr(c))})
        self.pre_tokenize = pre_tokenize

    def __missing__(self, point: int) -> int:
        c = chr(point)
        self[point] = ord(next((sign for beside, sign in CLASSES if self._together(beside, c)), SPACE))
        return self[point]

    def _together(self, beside: str, c: str) -> bool:
        """Whether the pattern takes the character into the class of its neighbours; single numbers stand alone there, but are no others."""
        found = len(self.pre_tokenize(beside + c + beside))
        return found == 1 or beside == "1" and found == 3 and len(self.pre_tokenize("1" + c + "!")) == 3 and len(self.pre_tokenize("a" + c + "!")) == 3 and len(self.pre_tokenize("!" + c + "a")) == 3


class PieceEncoder:
    """Encodes texts as tokenizers' ``encode(text, add_special_tokens=False)`` does."""

    def __init__(self, path: str):
        self.path, self.name = path, os.path.basename(path)
        self.split = re.compile(PATTERNS[self.name]) if self.name in PATTERNS else None
        self.lowers = self.name in LOWERS
        self.ids = _Ids(self.piece)

    def __reduce__(self):
        return PieceEncoder, (self.path,)

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @cached_property
    def special(self):
        return re.compile("|".join(map(re.escape, sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values()))) or "(?!)")

    def library(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    @cached_property
    def merge(self):
        return self.tokenizer.model.tokenize

    def piece(self, piece: str) -> bytes:
        """The ids of one pre-token."""
        written = piece.encode().decode("latin-1").translate(BYTE_CHARACTERS)
        return array.array("I", [t.id for t in self.merge(written)]).tobytes()

    @cached_property
    def shadow(self) -> _Shadow:
        return _Shadow(self.tokenizer.pre_tokenizer.pre_tokenize_str)

    def pieces(self, text: str) -> list[str] | None:
        """The text's pre-tokens; None if the library must see the whole text."""
        if self.split is None or self.special.search(text):
            return None
        if not UNSURE.search(text):
            return self.split.findall(text.lower() if self.lowers else text)
        if self.lowers:
            text = self.tokenizer.normalizer.normalize_str(text)
        return [text[m.start() : m.end()] for m in self.split.finditer(text.translate(self.shadow))]

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        pieces = self.pieces(text)
        return self.library(text) if pieces is None else b"".join(map(self.ids.__getitem__, pieces))


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's own encoder of this vocabulary; its cache lives as long as the worker."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
