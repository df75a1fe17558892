"""Byte-level BPE by a sentencepiece model that is written from the vocabulary.

The ranks of a byte-level BPE vocabulary say everything its merges do: of all
neighbouring symbols whose concatenation is in the vocabulary, the one of
lowest rank is merged first.  A sentencepiece BPE model does the same with
scores, so a model whose pieces are the vocabulary's byte strings (each byte
mapped to one printable character) with the negative rank as score gives the
same ids.  The model is serialised here directly; nothing is trained.

Text is cut into pre-tokens by the tokenizer's pattern and each pre-token is
encoded by itself.  Decoding looks the bytes of every id up again.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.words import slices

#: Pre-tokens remembered per task; the memory is emptied when full.
REMEMBERED = 200_000
#: Pre-tokens handed to the model as one string.
GROUPED = 32

ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by byte string, from lines of base64 and rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def byte_characters() -> list[str]:
    """One printable, non-space character for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes, a 32-bit float or a varint."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """Serialised model: piece i + 1 is the vocabulary's i-th byte string by rank, piece 0 is unknown.

    Field numbers are those of the public sentencepiece model format: 1 pieces
    (1 text, 2 score, 3 type), 2 trainer (3 model type, 40 unknown id), 3
    normaliser (1 name, 3 dummy prefix, 4 extra spaces, 5 escaped spaces).
    """
    chars = byte_characters()
    unknown = _field(1, "▁unknown▁".encode()) + _field(2, 0.0) + _field(3, 2)
    pieces = [_field(1, unknown)]
    for piece, rank in sorted(ranks.items(), key=lambda x: x[1]):
        text = "".join(chars[b] for b in piece).encode()
        pieces.append(_field(1, _field(1, text) + _field(2, -float(rank)) + _field(3, 1)))
    trainer = _field(3, 2) + _field(40, 0) + _field(41, (1 << 64) - 1) + _field(42, (1 << 64) - 1) + _field(43, (1 << 64) - 1)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encoder and decoder of one vocabulary, made once per task."""

    def __init__(self, ranks: dict[bytes, int], model: bytes, pattern: str):
        self.pattern = regex.compile(pattern)
        # piece 0 is the unknown one and never stands in a token
        self.rank_of = np.array([0, *sorted(ranks.values())], "<u4")
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
        # a pre-token that is itself in the vocabulary is one token, whatever the merges say
        self.whole = {p.decode(): struct.pack("<I", r) for p, r in ranks.items() if _is_text(p)}
        self.known: dict[str, bytes] = dict(self.whole)
        self.characters = dict(enumerate(byte_characters()))
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)

    def learn(self, tokens: set[str]) -> None:
        """Encode pre-tokens that are not remembered.

        They are mapped to characters all at once, with 0xFF, which no UTF-8
        text has, between them, and handed to the model in groups of some
        characters; the separator there is not in the vocabulary, so nothing
        is merged across it and its unknown piece shows where a token ends.
        """
        new = [t for t in tokens if t not in self.known]
        if len(self.known) + len(new) > REMEMBERED + len(self.whole):
            self.known = dict(self.whole)
            new = [t for t in tokens if t not in self.known]
        if not new:
            return
        raw = b"\xff".join([t.encode("utf-8", "replace") for t in new]) + b"\xff"
        mapped = raw.decode("latin-1").translate(self.characters | {0xFF: "\n"}).split("\n")[:-1]
        groups = ["\n".join(mapped[i : i + GROUPED]) + "\n" for i in range(0, len(mapped), GROUPED)]
        pieces = np.array([p for group in self.processor.encode(groups, num_threads=1) for p in group], np.int64)
        ends = np.flatnonzero(pieces == 0)
        starts = (np.r_[0, ends[:-1] + 1] * 4).tolist()
        ids = self.rank_of[pieces].tobytes()
        self.known.update(zip(new, [ids[a:b] for a, b in zip(starts, (ends * 4).tolist(), strict=True)], strict=True))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        tokens = self.pattern.findall(text)
        out = []
        for start in range(0, len(tokens), REMEMBERED):  # a very long text is encoded in runs
            run = tokens[start : start + REMEMBERED]
            try:
                out.append(b"".join(map(self.known.__getitem__, run)))
            except KeyError:
                self.learn(set(run))
                out.append(b"".join(map(self.known.__getitem__, run)))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _is_text(piece: bytes) -> bool:
    try:
        piece.decode()
    except UnicodeDecodeError:
        return False
    return True


def encode(docs: DataFrame, path: str, pattern: str, full: tuple[str, ...] = ()) -> DataFrame:
    """Token ids of every text and the text decoded from them, as digests and on request in full.

    One narrow pass: no shuffle, and a task holds one slice of texts and a
    bounded memory of pre-tokens.  A null text is encoded as the empty one,
    which has no tokens.  Repeated rows give repeated results; a null id stays
    null.  Other columns are ignored.  The vocabulary is read by the driver
    and sent to the tasks (its size is fixed by the vocabulary).

    ``full`` may name ``ids`` (array of int) and ``decoded`` (binary), which
    the result then has too.
    """
    spark = docs.sparkSession
    ranks = read_ranks(path)
    sent = spark.sparkContext.broadcast((ranks, sentencepiece_model(ranks), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*sent.value)
        for batch in slices(batches):
            rows: dict[str, list] = {"doc_id": batch.column(0).to_pylist(), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            more: dict[str, list] = {name: [] for name in full}
            for text in batch.column(1).to_pylist():
                ids = codec.encode(text or "")
                decoded = codec.decode(ids)
                rows["n_tokens"].append(len(ids) // 4)
                rows["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                for name, value in (("ids", ids), ("decoded", decoded)):
                    if name in more:
                        more[name].append(value)
            columns = [pa.array(v, pa.int64() if k in ("doc_id", "n_tokens") else pa.string()) for k, v in rows.items()]
            for name, values in more.items():
                if name == "ids":  # never as Python numbers
                    ends = np.cumsum([0, *(len(v) // 4 for v in values)], dtype=np.int32)
                    columns.append(pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(values), "<i4")))
                else:
                    columns.append(pa.array(values, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*rows, *more])

    types = {"ids": "array<int>", "decoded": "binary"}
    schema = ENCODED + "".join(f", {name} {types[name]}" for name in full)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
