"""Token ids of a public byte-level BPE through a sentencepiece model made from its vocabulary.

A vocabulary of byte strings with ranks is serialised directly as a
sentencepiece BPE model: every byte string becomes a piece of stand-in
characters (one per byte, none of them white space), scored by its negative
rank, so that sentencepiece merges in the order of the ranks; normalisation is
the identity. A piece's index is its rank, hence the ids need no translation.
Texts are split into pre-tokens first, as the public tokenizer does.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the public vocabularies are; only the driver reads them.
FOLDER = "/opt/tokenizers"

#: Fixed value: the split of the byte_bpe vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pre-tokens whose ids a worker keeps at most.
CACHE = 1 << 18


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a .tiktoken file, by rank."""
    pairs = [line.split() for line in open(path, "rb") if line.strip()]
    ranks = sorted((int(r), base64.b64decode(t)) for t, r in pairs)
    if [r for r, _ in ranks] != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [t for _, t in ranks]


def stand_ins() -> list[str]:
    """A printable character for each byte: itself where that is visible, else the next free one from U+0100."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in visible else next(free)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _int(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def model_bytes(tokens: list[bytes]) -> bytes:
    """The sentencepiece model of a vocabulary; the piece behind the last rank is the unknown one, which no text yields."""
    of = stand_ins()
    pieces = [_field(1, "".join(of[b] for b in t).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(r)) + _int(3, 1) for r, t in enumerate(tokens)]
    unknown = _field(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _int(3, 2)
    trainer = _int(3, 2) + _int(4, len(tokens) + 1) + _int(40, len(tokens)) + b"".join(_varint(n << 3) + b"\xff" * 9 + b"\x01" for n in (41, 42, 43))
    normalizer = _field(1, b"identity") + _int(3, 0) + _int(4, 0) + _int(5, 0)
    return b"".join(_field(1, p) for p in [*pieces, unknown]) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes and decodes texts with a model of model_bytes."""

    def __init__(self, model: bytes):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(PATTERN).findall
        self.table = dict(enumerate(stand_ins()))
        self.back = {c: b for b, c in self.table.items()}
        self.known: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; none for null and for the empty text."""
        out: list[int] = []
        if not text:
            return out
        known = self.known
        for word in self.split(text):
            ids = known.get(word)
            if ids is None:
                ids = self.model.encode(word.encode().decode("latin-1").translate(self.table))
                if len(known) < CACHE:
                    known[word] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return bytes(self.back[c] for i in ids for c in self.model.id_to_piece(i)).decode("utf-8", "replace")


_codecs: dict[bytes, Codec] = {}


def codec(model: bytes) -> Codec:
    """One codec per model and Python worker."""
    key = hashlib.sha256(model).digest()
    if key not in _codecs:
        _codecs[key] = Codec(model)
    return _codecs[key]


def _model(spark: SparkSession, name: str, folder: str):
    return spark.sparkContext.broadcast(model_bytes(read_ranks(f"{folder}/{name}.tiktoken")))


def token_ids(spark: SparkSession, text: Column, name: str = "byte_bpe_50k", folder: str = FOLDER) -> Column:
    """array<int>: the ids of each text, whole, without special tokens; empty for null and empty texts.

    Strings that look like special tokens are ordinary text. What is broadcast
    is the vocabulary, whose size is fixed.
    """
    held = _model(spark, name, folder)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(held.value)
        for texts in batches:
            yield pd.Series([c.encode(t) for t in texts])

    return encode(text)


def token_count(spark: SparkSession, text: Column, name: str = "byte_bpe_50k", folder: str = FOLDER) -> Column:
    """bigint: how many ids token_ids gives."""
    held = _model(spark, name, folder)

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(held.value)
        for texts in batches:
            yield pd.Series([len(c.encode(t)) for t in texts], dtype="int64")

    return count(text)


def token_texts(spark: SparkSession, ids: Column, name: str = "byte_bpe_50k", folder: str = FOLDER) -> Column:
    """string: the texts of id lists; null for null."""
    held = _model(spark, name, folder)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(held.value)
        for lists in batches:
            yield pd.Series([None if x is None else c.decode([int(i) for i in x]) for x in lists], dtype=object)

    return decode(ids)


def encode_corpus(docs: DataFrame, key: str, text: str, name: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """key, ids for every row of docs, repeated rows included."""
    return docs.select(key, token_ids(docs.sparkSession, F.col(text), name, folder).alias("ids"))
