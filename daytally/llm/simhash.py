"""SimHash near-dedup by an inverted index over the bytes of the fingerprints.

A 64-bit fingerprint is eight bytes at eight positions.  Two fingerprints
within ``d`` bits differ in at most ``d`` bytes, so they share at least
``8 - d`` positional bytes: that is the guaranteed number of matches.  With
d = 2 it is six, hence of the four pairs of neighbouring positions at least
two pairs agree as a whole.  The index therefore posts every distinct
fingerprint under each two of its four byte pairs (six postings of four
positional bytes).  Within a posting the shared positional bytes of each pair
are tallied, pairs below the guaranteed number are dropped, and the rest are
verified by their bit distance.

A posting of single bytes would hold 1/256 of the corpus and its pairs would
grow with the square; four bytes keep it small.  What is still long (many
near copies agree in most bytes) is posted again under each two of the other
four positions, since a pair that reaches six matches must share two of them.
Such a posting has at most 65,536 members, because only 16 bits are left.
Pairs are counted inside the task only; what leaves it is a spanning set of
links, at most one per member.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.components import components
from daytally.llm.words import slices, words
from daytally.scratch import materialize

#: Members from which a posting is split by two more positions.
LONG_POSTING = 512

SHINGLE = 3
MAX_BITS = 2


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text: a bit is set when over half of the shingles' XXH64 (seed 42) have it."""
    found = words(text)
    if not found:
        return 0
    if len(found) <= shingle:
        parts = [b" ".join(found)]
    else:
        parts = [b" ".join(x) for x in zip(*(found[i:] for i in range(shingle)), strict=False)]
    hashed = np.fromiter((xxhash.xxh64_intdigest(p, 42) for p in parts), np.uint64, len(parts))
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashed), 1 << 16):
        block = hashed[start : start + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashed)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and the fingerprint as a signed long ``fp`` of every document; one narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([simhash(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _byte(fp, position: int):
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def _postings(fps: DataFrame) -> DataFrame:
    """Each fingerprint under every two of its four byte pairs: ``combo``, ``bytes``, ``fp``."""
    fp = F.col("fp")
    keys = []
    for combo, (i, j) in enumerate(combinations(range(4), 2)):
        four = [_byte(fp, p) for p in (2 * i, 2 * i + 1, 2 * j, 2 * j + 1)]
        key = F.lit(combo).cast("long")
        for b in four:
            key = F.shiftleft(key, 8).bitwiseOR(b)
        keys.append(key)
    return fps.select(F.explode(F.array(*keys)).alias("posting"), "fp")


def _rest(combo: int) -> list[int]:
    """Positions that a posting leaves open."""
    used = list(combinations(range(4), 2))[combo]
    return [p for p in range(8) if p // 2 not in used]


def _split(long_postings: DataFrame) -> DataFrame:
    """Long postings under each two of their four open positions."""
    fp = F.col("fp")
    by_combo = None
    for combo in range(6):
        subs = [
            F.lit((s + 1) << 16).bitwiseOR(F.shiftleft(_byte(fp, a), 8)).bitwiseOR(_byte(fp, b))
            for s, (a, b) in enumerate(combinations(_rest(combo), 2))
        ]
        here = F.shiftright("posting", 32) == combo
        by_combo = F.when(here, F.array(*subs)) if by_combo is None else by_combo.when(here, F.array(*subs))
    return long_postings.select("posting", F.explode(by_combo).alias("sub"), "fp")


def spanning_links(group: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is within ``max_bits`` in the same group; ``group`` must be sorted.

    Compares each member with the next, the second next and so on, for all
    groups at once; a pair has to share enough positional bytes before its
    bits are counted.
    """
    n = len(fps)
    end = np.searchsorted(group, group, side="right")
    left, right = [], []
    alive = np.arange(n)
    step = 1
    while len(alive := alive[alive + step < end[alive]]):
        x = fps[alive] ^ fps[alive + step]
        shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        enough = shared >= 8 - max_bits
        near = alive[enough][np.bitwise_count(x[enough]) <= max_bits]
        left.append(near)
        right.append(near + step)
        step += 1
    a = np.concatenate(left) if left else np.empty(0, np.int64)
    b = np.concatenate(right) if right else np.empty(0, np.int64)
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            break
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints that join all that are within ``max_bits``.

    Not all pairs: a spanning set for each posting, so that whatever is
    connected by links is connected here.  ``max_bits`` may be 0, 1 or 2.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2: the postings guarantee no more")
    postings = _postings(fps)
    sizes = postings.groupBy("posting").agg(F.count("*").alias("members")).where("members > 1")
    shared = postings.join(sizes, "posting")
    short = shared.where(F.col("members") <= LONG_POSTING).select("posting", F.lit(0).alias("sub"), "fp")
    split = _split(shared.where(F.col("members") > LONG_POSTING).select("posting", "fp"))
    members = short.unionByName(split)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            same = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            cut = int(np.argmax(same))
            if cut:
                yield made([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held is not None:
            yield made(held)

    def made(columns: list[np.ndarray]) -> pa.RecordBatch:
        posting, sub, fp = columns
        new = np.r_[True, (posting[1:] != posting[:-1]) | (sub[1:] != sub[:-1])]
        fp = np.ascontiguousarray(fp).view(np.uint64)
        a, b = spanning_links(np.cumsum(new), fp, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], names=["a", "b"])

    grouped = members.repartition("posting", "sub").sortWithinPartitions("posting", "sub", "fp")
    return grouped.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Fingerprint and component of every document: ``doc_id``, ``fingerprint``, ``component_id``.

    Documents are linked when their fingerprints differ in at most
    ``max_bits`` bits; ``component_id`` is the smallest id that links reach.
    Copies share a fingerprint and are one node.  A null or blank text has
    fingerprint zero and is linked like any other.  Repeated rows give
    repeated results; a null id is ignored in the minimum (a component of null
    ids only has a null id).  Other columns are ignored.
    """
    found = materialize(fingerprints(docs, shingle), "simhash")
    nodes = found.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(nodes.select("fp"), max_bits))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = rooted.join(least, "root").select("fp", "component_id")
    return found.join(by_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def select(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents, with all their columns, that stand for their component.

    That is the document with the component's smallest id; of rows that repeat
    this id the first by their text stays.  A row without an id stands for
    itself and stays.
    """
    name = "_kept"
    while name in docs.columns:
        name += "_"
    found = near_duplicates(docs, shingle, max_bits).where(F.col("doc_id") == F.col("component_id"))
    kept = found.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")).distinct()
    same = Window.partitionBy("doc_id").orderBy("text")
    first = docs.join(kept, "doc_id", "left_semi").withColumn(name, F.row_number().over(same)).where(F.col(name) == 1)
    return first.select(*docs.columns).unionByName(docs.where("doc_id is null"))
