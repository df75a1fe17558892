"""Words, shingles and small column helpers shared by the operators.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z in lower
case; a null text has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows per Arrow batch when texts are sent to Python; a batch of them must fit a worker.
SLICE_BYTES = 8 << 20


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes."""
    return (text or "").encode("utf-8", "replace").lower().split()


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that no cut holds much more text than ``size`` bytes or one row."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        per_row = max(1, column.nbytes // max(1, batch.num_rows))
        step = max(1, size // per_row)
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def fmix(h: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit values (wraps on overflow)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Remembered(dict):
    """What a function gives for each token, for a bounded number of tokens."""

    LIMIT = 300_000

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def __missing__(self, token: bytes):
        if len(self) >= self.LIMIT:
            self.clear()
        made = self[token] = self.make(token)
        return made


class WordHashes(Remembered):
    """64-bit hash of each word."""

    def __init__(self):
        super().__init__(lambda word: xxhash.xxh64_intdigest(word, 42))


def shingle_hashes(found: list[bytes], size: int, known: WordHashes) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence when it is shorter."""
    if not found:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    size = min(size, len(found))
    n = len(found) - size + 1
    out = np.full(n, np.uint64(size))
    for j in range(size):
        out = (out ^ each[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        out = out ^ (out >> np.uint64(29))
    return fmix(out)


def crc_of_id(doc_id: Column) -> Column:
    """CRC-32 of the id written as decimal text."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(df: DataFrame) -> int:
    """Number of shuffle partitions that the session asks for."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
