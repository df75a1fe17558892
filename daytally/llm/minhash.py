"""Document fingerprints by one-permutation MinHash.

All shingle hashes are binned once: the high bits choose the bin, and each bin
keeps its least hash.  An empty bin takes the value of another one, chosen by
a hash of the bin and the attempt until a filled bin is met (optimal
densification), so two sets fill their empty bins alike where they are alike.
Only the low bits of each value are kept and packed; two unrelated values
agree in b bits with probability 2^-b, and the likeness is corrected for it.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.words import WordHashes, fmix, shingle_hashes, words
from daytally.scratch import materialize

SHINGLE = 5
BIN_BITS = 8
KEPT_BITS = 4

_BINS = 1 << BIN_BITS
_STARTS = np.arange(_BINS, dtype=np.uint64) << np.uint64(64 - BIN_BITS)


@functools.cache
def _donors(attempt: int, tries: int) -> np.ndarray:
    """For each bin, the bins that it asks at these attempts."""
    at = (np.arange(_BINS, dtype=np.uint64) << np.uint64(32))[:, None] + np.arange(attempt, attempt + tries, dtype=np.uint64)
    return (fmix(at) % np.uint64(_BINS)).astype(np.int64)


def sketch(hashes: np.ndarray) -> bytes:
    """Packed low bits of the densified bins; all zero for an empty set."""
    if not len(hashes):
        return bytes(_BINS * KEPT_BITS // 8)
    ordered = np.sort(hashes)
    at = np.searchsorted(ordered, _STARTS)
    least = ordered[np.minimum(at, len(ordered) - 1)]
    filled = (at < len(ordered)) & (least >> np.uint64(64 - BIN_BITS) == np.arange(_BINS, dtype=np.uint64))
    value = np.where(filled, least, np.uint64(0))
    empty = np.flatnonzero(~filled)
    if filled.sum() == 1:
        value[:] = value[filled][0]
    else:
        attempt, tries = 0, 8
        while len(empty):
            other = _donors(attempt, tries)[empty]
            usable = filled[other]
            found = usable.any(axis=1)
            value[empty[found]] = value[other[found, usable[found].argmax(axis=1)]]
            empty = empty[~found]
            attempt, tries = attempt + tries, tries * 4
    low = (fmix(value) & np.uint64((1 << KEPT_BITS) - 1)).astype(np.uint8)
    return (low[0::2] << np.uint8(4) | low[1::2]).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal shingles that two fingerprints tell, corrected for chance agreement, from 0 to 1."""
    if a == b:
        return 1.0
    if not any(a) or not any(b):
        return 0.0
    x = np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)
    same = int((x & 15 == 0).sum() + (x >> 4 == 0).sum()) / _BINS
    chance = 2.0**-KEPT_BITS
    return min(1.0, max(0.0, (same - chance) / (1 - chance)))


def fingerprint(text: str | None, known: WordHashes, shingle: int = SHINGLE) -> bytes:
    return sketch(shingle_hashes(words(text), shingle, known))


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the beginning of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


#: Rows that a range of ids leaves open: its first and its last document.
_DONE, _FIRST, _LAST = 0, 1, 2

_ROWS = pa.schema(
    [
        ("part", pa.int32()),
        ("kind", pa.int32()),
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fp", pa.binary()),
        ("edited_fp", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("text", pa.string()),
    ]
)
_SCHEMA = (
    "part int, kind int, doc_id long, n_chars long, edited_sha256 string, fp binary, edited_fp binary, "
    "near_edited double, near_next double, text string"
)


def _result(part: int, doc: tuple, following: tuple, known: WordHashes, shingle: int) -> tuple:
    doc_id, text, fp = doc
    changed = edited(text, following[1])
    changed_fp = fp if changed == text else fingerprint(changed, known, shingle)
    digest = hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest()
    return (part, _DONE, doc_id, len(text), digest, fp, changed_fp, likeness(fp, changed_fp), likeness(fp, following[2]), None)


def _open(part: int, kind: int, doc: tuple) -> tuple:
    return (part, kind, doc[0], None, None, doc[2], None, None, None, doc[1])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROWS, strict=True)], schema=_ROWS)


def fingerprint_edits(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how near they and the next document are.

    Documents are dealt out in ranges of ids and read in order, so each task
    holds two texts at a time.  The first and the last document of a range are
    left open; there are two per partition, and a second small step closes
    them, from the last of one range to the first of the next.  A null text is
    empty.  Repeated rows are documents of their own, in the order of their
    texts; a null id comes first.  A single document is followed by itself.
    Other columns are ignored.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("part", F.spark_partition_id())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, previous, part, rows = WordHashes(), None, 0, []
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                cut = batch.slice(start, 256)
                part = cut.column(2)[0].as_py()
                for doc_id, text in zip(cut.column(0).to_pylist(), cut.column(1).to_pylist(), strict=True):
                    doc = (doc_id, text, fingerprint(text, known, shingle))
                    rows.append(_open(part, _FIRST, doc) if previous is None else _result(part, previous, doc, known, shingle))
                    previous = doc
                yield _batch(rows)
                rows = []
        if previous is not None:
            yield _batch([_open(part, _LAST, previous)])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, first, last = WordHashes(), None, None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                doc = (r["doc_id"], r["text"], r["fp"])
                if r["kind"] == _LAST:
                    last = doc
                elif first is None:
                    first = doc
                else:
                    rows.append(_result(0, last, doc, known, shingle))
            if rows:
                yield _batch(rows)
        if last is not None:
            yield _batch([_result(0, last, first, known, shingle)])

    stored = materialize(ordered.mapInArrow(run, _SCHEMA), "fingerprints")
    ends = stored.where(F.col("kind") != _DONE).repartition(1).sortWithinPartitions("part", "kind")
    rows = stored.where(F.col("kind") == _DONE).unionByName(ends.mapInArrow(close, _SCHEMA))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fp")).alias("fingerprint"),
        F.lower(F.hex("edited_fp")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
