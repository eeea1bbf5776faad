"""Byte-level BPE by sentencepiece: a model file built from nothing but a rank vocabulary.

Each token's bytes are mapped to one character a byte and scored by its negative rank, so that the best-scored merge
is the one of the lowest rank; normalisation is the identity. Texts are cut by the vocabulary's pattern and each match
is encoded on its own; one that is a token as it stands is that token. Decoding maps the pieces' characters back.
The serialised model is broadcast: its size is that of the vocabulary, whatever the documents.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes become characters from here on: letters that no normaliser or white-space rule touches.
FIRST_CHARACTER = 0x100
#: Pieces remembered by a task, and the length up to which they are; together some 100 MB at most.
REMEMBERED = 300_000
REMEMBERED_LENGTH = 40
#: Rows handed on at a time, and the matches of a long text handled at a time.
ROWS = 256
MATCHES = 200_000

_TO_CHARACTERS = "".join(chr(FIRST_CHARACTER + b) for b in range(256))


# What the classes of a pattern hold of the characters below 256.
_NARROW = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ÿ", r"\p{N}": "0-9²³¹¼-¾", r"\s": r"\t-\r \x85\xa0"}


def narrow(pattern: str) -> re.Pattern | None:
    """The pattern for texts of characters below 256 alone, in terms of plain ranges; None if it has other classes."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        name = next((n for n in _NARROW if pattern.startswith(n, at)), None)
        if name:
            out.append(_NARROW[name] if inside else f"[{_NARROW[name]}]")
            at += len(name)
        elif pattern.startswith(r"\S", at) and not inside:
            out.append(f"[^{_NARROW[chr(92) + 's']}]")
            at += 2
        elif pattern[at] == "\\":
            return None
        else:
            inside = pattern[at] == "[" or inside and pattern[at] != "]"
            out.append(pattern[at])
            at += 1
    return re.compile("".join(out))


def _is_narrow(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes(out) + bytes([value])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def characters(token: bytes) -> str:
    return token.decode("latin-1").translate(_TO_CHARACTERS)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The model file: piece 0 is the unknown piece, piece r + 1 the token of rank r; ranks without gaps."""
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    unknown, normal, bpe = 2, 1, 2
    pieces = [_bytes(1, "<unk>".encode()) + _float(2, 0.0) + _number(3, unknown)]
    pieces += [_bytes(1, characters(t).encode()) + _float(2, -float(r)) + _number(3, normal) for r, t in enumerate(tokens)]
    trainer = _number(3, bpe) + _number(4, len(pieces)) + _number(40, 0)
    trainer += b"".join(_number(field, -1) for field in (41, 42, 43))
    normalizer = _bytes(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return b"".join(_bytes(1, p) for p in pieces) + _bytes(2, trainer) + _bytes(3, normalizer)


def load(model: bytes) -> sentencepiece.SentencePieceProcessor:
    processor = sentencepiece.SentencePieceProcessor()
    processor.LoadFromSerializedProto(model)
    return processor


def token_bytes(processor: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes of each rank, by the inverse of the mapping."""
    back = {FIRST_CHARACTER + b: b for b in range(256)}
    return [
        processor.id_to_piece(i).translate(back).encode("latin-1") for i in range(1, processor.get_piece_size())
    ]


class Encoder:
    def __init__(self, model: bytes, pattern: str):
        self.processor, self.pattern = load(model), regex.compile(pattern)
        self.narrow = narrow(pattern)  # several times faster, with the same matches
        self.known: dict[str, list[int]] = {}

    def _learn(self, pieces: set[str]) -> None:
        # "replace": a lone surrogate has no bytes of its own
        new = list(pieces)
        mapped = [characters(p.encode("utf-8", "replace")) for p in new]
        whole = self.processor.piece_to_id(mapped)
        parts = self.processor.encode(mapped, out_type=int, num_threads=1)
        for piece, token, ids in zip(new, whole, parts):
            self.known[piece] = [token - 1] if token else [i - 1 for i in ids]

    def encode(self, text: str) -> list[int]:
        pattern = self.narrow if self.narrow and _is_narrow(text) else self.pattern
        if len(text) <= MATCHES:
            return self._ids(pattern.findall(text))
        matches, out = (m[0] for m in pattern.finditer(text)), []
        while part := list(islice(matches, MATCHES)):
            out += self._ids(part)
        return out

    def _ids(self, pieces: list[str]) -> list[int]:
        distinct = set(pieces)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if missing := {x for x in distinct if x not in self.known}:
            self._learn(missing)
        ids = list(chain.from_iterable(map(self.known.__getitem__, pieces)))
        for long in [p for p in distinct if len(p) > REMEMBERED_LENGTH]:
            del self.known[long]
        return ids


def encode(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Rows (doc_id, ids array<int>), one per row of documents (doc_id, text); null and empty texts have no ids."""
    model = documents.sparkSession.sparkContext.broadcast(serialise(read_ranks(ranks_path)))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids = [encoder.encode(text.as_py() or "") for text in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(apply, "doc_id long, ids array<int>")


def round_trip(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Rows (doc_id, ids, bytes): `encode`, and the bytes that the ids decode to, in one pass."""
    model = documents.sparkSession.sparkContext.broadcast(serialise(read_ranks(ranks_path)))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value, pattern)
        tokens = token_bytes(encoder.processor)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids = [encoder.encode(text.as_py() or "") for text in part.column(1)]
                texts = [b"".join(map(tokens.__getitem__, own)) for own in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.binary())],
                    ["doc_id", "ids", "bytes"],
                )

    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(apply, "doc_id long, ids array<int>, bytes binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """encoded (doc_id, ids, ...) with the column `bytes` in place of all others but doc_id and ids."""
    model = encoded.sparkSession.sparkContext.broadcast(serialise(read_ranks(ranks_path)))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(load(model.value))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts = [b"".join(map(tokens.__getitem__, ids.as_py() or ())) for ids in part.column(1)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], ["doc_id", "ids", "bytes"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(apply, "doc_id long, ids array<int>, bytes binary")
