"""SentencePiece encoding and decoding through a table of distinct marked words.

No piece of the vocabulary has a whitespace marker behind another character,
so the segmentation of a text is that of its marked words (markers, then other
characters) one after the other. Each task keeps a table of the distinct
marked words that it has met: a word is segmented and decoded by the library
once, and its ids and its text are joined back by position. Vocabularies with
pieces across markers, or that change texts before they segment them, are
refused.

The table is a task's own. A table over the whole corpus would have to shuffle
words to it and ids back, which is more than the texts themselves (README).

Nulls, empty texts and empty tables: a null text counts as empty; an empty
text has no ids and decodes to an empty text; an empty table gives an empty
result. Repeated rows and null ids each give a row. Columns other than those
in ``keep`` are left out. Texts are taken whole at any length.
"""

from __future__ import annotations

import hashlib

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from isobar.llm.common import map_texts, text_or_empty

MARK = "▁"
#: Words that a task's table holds at most before it starts anew.
TABLE_ENTRIES = 300_000
WORDS = regex.compile(" +[^ ]*").findall


class _Table(dict):
    """A marked word's ids (decimal, comma-joined) and decoded text."""

    def __init__(self, processor):
        super().__init__()
        self.processor = processor

    def __missing__(self, word: str) -> tuple[str, str]:
        # The library puts one marker before a text and takes one space off what it decodes.
        ids = self.processor.encode(word[1:]) if len(word) > 1 else [self.processor.piece_to_id(MARK)]
        text = self.processor.decode(ids)
        out = ",".join(map(str, ids)), text if word == " " and text else " " + text
        if len(word) <= 64:
            if len(self) >= TABLE_ENTRIES:
                self.clear()
            self[word] = out
        return out


class PieceCodec:
    """Encodes and decodes whole texts as the sentencepiece library does."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = p = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [p.id_to_piece(i) for i in range(p.vocab_size()) if not (p.is_control(i) or p.is_byte(i) or p.is_unknown(i) or p.is_unused(i))]
        if any(MARK in piece.lstrip(MARK) for piece in pieces) or p.normalize(" a  ﬁ① ") != f"{MARK}{MARK}a{MARK}{MARK}ﬁ①{MARK}":
            raise ValueError("the pieces cross whitespace markers, or the vocabulary rewrites texts")
        self.table = _Table(p)

    def words(self, text: str) -> list[str]:
        return WORDS(" " + text.replace(MARK, " ")) if text else []

    def __call__(self, text: str) -> tuple[str, str]:
        """The ids, decimal and comma-joined, and the text that the library decodes them to."""
        found = list(map(self.table.__getitem__, self.words(text)))
        return ",".join([x[0] for x in found]), "".join([x[1] for x in found])[1:]


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def encode_pieces(docs: DataFrame, model: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """``keep``, n_tokens and the named outputs of every row.

    Outputs: ids (array<int>), decoded (string), ids_sha256 and decoded_sha256
    (lowercase hex digests of the comma-joined decimal ids and of the text).
    """
    kinds = {"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    make = {
        "ids": lambda ids, text: [int(x) for x in ids.split(",")] if ids else [],
        "decoded": lambda ids, text: text,
        "ids_sha256": lambda ids, text: hashlib.sha256(ids.encode()).hexdigest(),
        "decoded_sha256": lambda ids, text: hashlib.sha256(text.encode()).hexdigest(),
    }

    def start():
        run = codec(model)

        def encode(texts: list[str]) -> list:
            found = list(map(run, texts))
            return [[ids.count(",") + 1 if ids else 0 for ids, _ in found], *([make[name](*x) for x in found] for name in outputs)]

        return encode

    fields = [T.StructField("n_tokens", T.LongType()), *(T.StructField(name, kinds[name]) for name in outputs)]
    return map_texts(docs, keep, text_or_empty(text_col), start, fields)
