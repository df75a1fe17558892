"""SentencePiece BPE by a table of prefixes.

Merging the best pair over and over has one property that makes a table
possible: a split into pieces is the encoding of a text just when every two
neighbouring pieces, encoded by themselves, stay these two pieces.  So each
prefix of a text has exactly one last piece: the piece that ends there and is
compatible with the last piece of the prefix before it.  An automaton over the
vocabulary gives all pieces that end at a place; the compatible one is written
to the table; the ids are read off the table from the end backwards.

Two pieces are compatible if no merge across their border would have come
first.  The only symbols that ever touch the border are the right-hand parts of
the left piece and the left-hand parts of the right one, each from the merge
that makes it to the merge that uses it.  Where merges of equal score decide
(runs of blanks), or a merge scores better than one that made its parts, the
two pieces are encoded in full instead.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from daytally.llm.words import Remembered, slices

#: What stands for a blank in the pieces, and the code of a character outside the vocabulary.
BLANK, FOREIGN = "▁", -1
#: Characters of a segment that is remembered; a longer one is encoded each time.
SHORT = 48

ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Pieces:
    """The pieces of a model, the order of their merges and the parts that each is merged from.

    ``rank`` grows from the best score on, and equal scores share one.
    """

    def __init__(self, model: bytes):
        self.digest = hashlib.sha256(model).hexdigest()
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        kinds = {k: [i for i, p in enumerate(spec.pieces) if p.type == k] for k in range(1, 7)}
        n = spec.normalizer_spec
        if spec.trainer_spec.model_type != 2 or kinds[4] or kinds[5] or len(kinds[6]) != 256:
            raise ValueError("the model must be a BPE model with byte pieces and without user-defined or unused ones")
        if n.precompiled_charsmap or n.remove_extra_whitespaces or not (n.add_dummy_prefix and n.escape_whitespaces):
            raise ValueError("the model must leave texts as they are, but for the blank before them")
        self.text = [p.piece for p in spec.pieces]
        self.id_of = {self.text[i]: i for i in kinds[1]}
        self.byte_ids = kinds[6]  # in order of the bytes
        scores = sorted({spec.pieces[i].score for i in kinds[1]}, reverse=True)
        place = {s: r for r, s in enumerate(scores, 1)}
        self.rank = {i: place[spec.pieces[i].score] for i in kinds[1]}
        shared = np.bincount(list(self.rank.values())) > 1
        self.parts: dict[int, tuple[int, int]] = {}
        self.whole: set[int] = set()
        self.orderly: set[int] = set()  # made by merges of rising, unshared ranks
        for i in sorted(kinds[1], key=lambda i: len(self.text[i])):
            merged, parts = self.merge(self.text[i])
            if merged != [i]:
                continue  # never comes out of any text
            self.whole.add(i)
            if parts is None:
                self.orderly.add(i)
                continue
            self.parts[i] = parts
            rises = all(p not in self.parts or self.rank[p] < self.rank[i] for p in parts)
            if rises and not shared[self.rank[i]] and all(p in self.orderly for p in parts):
                self.orderly.add(i)
        self.shared = {i for i in self.rank if shared[self.rank[i]]}
        self.segments = self._segments()
        self.bytes_of = [t.replace(BLANK, " ").encode() for t in self.text]
        for value, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([value])
        for i in kinds[3]:
            self.bytes_of[i] = b""
        for i in kinds[2]:
            self.bytes_of[i] = spec.trainer_spec.unk_surface.encode()

    def _segments(self) -> str | None:
        """Pattern of the segments that are encoded apart: every border between two of them lies inside no piece.

        The finest pattern that holds is taken: runs of letters and digits and
        runs of other characters, each with the blanks before it; else the
        words between blanks; else the whole text.
        """
        odd = {c for t in self.id_of for pair in zip(t, t[1:]) for c in pair if c.isalnum() and not all(d.isalnum() or d == BLANK for d in pair)}
        listed = re.escape("_" + "".join(sorted(odd)))
        for pattern in (f"{BLANK}*[^\\W{listed}]+|{BLANK}*(?:[^\\w{BLANK}]|[{listed}])+|{BLANK}+", f"{BLANK}*[^{BLANK}]+|{BLANK}+"):
            if all(len(re.findall(pattern, t)) == 1 for t in self.id_of):
                return pattern
        return None

    def merge(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """Plain merging of a short text, best score and then leftmost first, with the parts of the last merge."""
        now = [self.id_of.get(c, FOREIGN) for c in text]
        symbols, last = list(text), None
        while len(symbols) > 1:
            found = [(self.rank[i], at, i) for at, pair in enumerate(zip(symbols, symbols[1:])) if (i := self.id_of.get("".join(pair))) is not None]
            if not found:
                break
            _, at, i = min(found)
            last = (now[at], now[at + 1])
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            now[at : at + 2] = [i]
        return now, last


class Encoder:
    """Encoder and decoder of one model; its memories are bounded."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.automaton = ahocorasick.Automaton()
        for i in pieces.whole:
            self.automaton.add_word(pieces.text[i], (len(pieces.text[i]), i))
        self.automaton.make_automaton()
        self.decimal = [str(i) for i in range(len(pieces.text))]
        self.right_edge = Remembered(lambda i: self._edge(i, 1))
        self.left_edge = Remembered(lambda i: self._edge(i, 0))
        self.fits = Remembered(lambda pair: self.compatible(*pair))
        self.known = Remembered(self.table)
        self.segments = re.compile(pieces.segments).findall if pieces.segments else lambda t: [t]

    def _edge(self, piece: int, side: int) -> list[tuple[str, int, float]]:
        """Symbols at one end of a piece on the way to it: text, rank that makes it, rank that uses it."""
        out, used = [], float("inf")
        while True:
            parts = self.p.parts.get(piece)
            out.append((self.p.text[piece], self.p.rank[piece] if parts else 0, used))
            if not parts:
                return out
            used, piece = self.p.rank[piece], parts[side]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces, side by side, are encoded as themselves."""
        p = self.p
        if left == FOREIGN or right == FOREIGN:
            return True
        if left in p.orderly and right in p.orderly:
            for x, x_made, x_used in self.right_edge[left]:
                for y, y_made, y_used in self.left_edge[right]:
                    i = p.id_of.get(x + y)
                    if i is None:
                        continue
                    rank = p.rank[i]
                    if i in p.shared or rank <= max(x_made, y_made):
                        return p.merge(p.text[left] + p.text[right])[0] == [left, right]
                    # at equal rank, the merge further left comes first
                    if rank < x_used and rank <= y_used:
                        return False
            return True
        return p.merge(p.text[left] + p.text[right])[0] == [left, right]

    def table(self, segment: str) -> list[int]:
        """Ids of a normalised text: the last piece of every prefix, then backwards."""
        n = len(segment)
        last: list[int | None] = [None] * (n + 1)
        fits = self.fits
        for end, (length, piece) in self.automaton.iter(segment):  # at one place, the longest piece first
            if last[end + 1] is not None:
                continue
            start = end + 1 - length
            if start:
                before = last[start]
                if before is None:
                    last[start] = before = FOREIGN
                if not fits[before, piece]:
                    continue
            last[end + 1] = piece
        ids: list[int] = []
        while n:
            piece = last[n]
            if piece is None or piece == FOREIGN:
                ids.extend(self.p.byte_ids[b] for b in reversed(segment[n - 1].encode("utf-8", "replace")))
                n -= 1
            else:
                ids.append(piece)
                n -= len(self.p.text[piece])
        ids.reverse()
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text; the empty text has none."""
        if not text:
            return []
        segments = self.segments(BLANK + text.replace(" ", BLANK))
        return list(chain.from_iterable(self.known[s] if len(s) <= SHORT else self.table(s) for s in segments))

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the text that has these ids: their bytes without the blank put before it."""
        joined = b"".join(map(self.p.bytes_of.__getitem__, ids))
        return joined[1:] if ids and self.p.text[ids[0]].startswith(BLANK) else joined


_MADE: dict[str, Encoder] = {}


def encoder_of(pieces: Pieces) -> Encoder:
    """The encoder of this worker process, which later tasks find with its memories."""
    if pieces.digest not in _MADE:
        _MADE.clear()
        _MADE[pieces.digest] = Encoder(pieces)
    return _MADE[pieces.digest]


def encode(docs: DataFrame, path: str, full: tuple[str, ...] = ()) -> DataFrame:
    """Piece ids of every whole text and the text decoded from them, as digests and on request in full.

    One narrow pass without a shuffle; a task holds one slice of texts and
    bounded memories of segments and pairs.  A null text is encoded as the
    empty one, which has no ids.  Characters outside the vocabulary become
    byte pieces.  Repeated rows give repeated results; a null id stays null;
    other columns are ignored; an empty table gives an empty result.  The model
    is read by the driver and sent to the tasks; its size is fixed.

    ``full`` may name ``ids`` (array of int) and ``decoded`` (string), which the
    result then has too.
    """
    spark = docs.sparkSession
    with open(path, "rb") as file:
        sent = spark.sparkContext.broadcast(Pieces(file.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(sent.value)
        for batch in slices(batches):
            rows: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            more: dict[str, list] = {name: [] for name in full}
            for text in batch.column(1).to_pylist():
                ids = encoder.encode(text or "")
                decoded = encoder.decode(ids)
                rows["n_tokens"].append(len(ids))
                rows["ids_sha256"].append(hashlib.sha256(",".join(map(encoder.decimal.__getitem__, ids)).encode()).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                for name, value in (("ids", np.array(ids, np.int32)), ("decoded", decoded.decode("utf-8", "replace"))):
                    if name in more:
                        more[name].append(value)
            columns = [batch.column(0), *(pa.array(v, pa.int64() if k == "n_tokens" else pa.string()) for k, v in rows.items())]
            columns += [pa.array(v, pa.list_(pa.int32()) if k == "ids" else pa.string()) for k, v in more.items()]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *rows, *more])

    types = {"ids": "array<int>", "decoded": "string"}
    schema = ENCODED + "".join(f", {name} {types[name]}" for name in full)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
