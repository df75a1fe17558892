"""Removal of repeated 50-byte strings by a common-prefix-aware distributed merge sort of suffixes.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts
in a document with a smaller id.  Sorting the suffixes of all positions would
exchange many times the corpus, so the suffixes are sparse: each window of
``LENGTH`` bytes is represented by its anchor, the place of the smallest hash
of ``GRAM`` bytes in it.  Equal windows have the same anchor at the same
offset, so nothing is lost.

1. Documents are packed into runs of some megabytes, which all later steps
   read.  Each run sorts its anchors and exchanges their hashes with a digest
   of what the anchor's windows see, two short hashes of what stands after
   and before it, and its place.  Where anchors look alike, all but the first
   document's are covered.  Windows that two anchors share make them agree
   after or before the anchor: what agrees with nothing else that has another
   first document is done, however often its ``GRAM`` bytes occur.
2. What is left stands where a repetition begins or ends, once for all that
   look alike.  These suffixes, with the bytes before the anchor behind them,
   are sorted within each run, front-coded (length of the prefix shared with
   the one before, and the rest) and exchanged.
3. A loser tree merges the runs.  It keeps the length of the prefix that a
   suffix shares with the last one put out, decides by these lengths where it
   can, and compares bytes only beyond them.  The lengths of the merged order
   tell which suffixes agree in how many bytes, and so, for each offset of a
   window from its anchor, the smallest document that has it.
4. A hash of which more has to be merged than one task should is split by its
   whole windows, which Spark aggregates with a partial step.

Within a run only the first of the documents that look alike has an entry in
the exchange, so a passage that a third of all documents share is one per run.
"""

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.words import fmix, partitions, slices
from daytally.scratch import materialize

LENGTH = 50
GRAM = 16
#: Offsets that an anchor can have in a window.
OFFSETS = LENGTH - GRAM + 1
#: Bytes before and from an anchor that its windows can see.
BEFORE, SEEN = OFFSETS - 1, OFFSETS - 1 + LENGTH
#: Columns of eight bytes that hold them.
COLUMNS = -(-SEEN // 8)
#: The last offset of the windows that reach farther behind the anchor's gram than before it.
HALF = OFFSETS // 2
#: Bytes of text in a run (a longer document is a run of its own) and of a segment that is hashed at once.
RUN_BYTES = 8 << 20
SEGMENT = 1 << 16
#: Places of one hash that have to be merged; with more, its windows are aggregated.
CROWDED = 50_000

_NO_ID = np.iinfo(np.int64).max


def _planes(*arrays: np.ndarray) -> np.ndarray:
    """Arrays of equal length as byte planes, one below the other."""
    return np.concatenate([np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T for a in arrays])


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length as compressed byte planes."""
    return zstandard.compress(_planes(*arrays).tobytes(), 3)


def _unpacked(blob: bytes, *types: str) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.decompress(blob), np.uint8)
    n = len(data) // sum(np.dtype(t).itemsize for t in types)
    out, at = [], 0
    for t in types:
        width = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(data[at : at + n * width].reshape(width, n).T).view(t).reshape(n))
        at += n * width
    return out


def pack(docs: DataFrame) -> DataFrame:
    """Runs of documents: ``run`` (a random number), ``ids``, ``sizes`` and ``blob`` (the compressed texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "replace")
                if held and size + len(data) > RUN_BYTES:
                    yield made(held)
                    held, size = [], 0
                held.append((doc_id, data))
                size += len(data)
        if held:
            yield made(held)

    def made(held: list) -> pa.RecordBatch:
        row = {
            "run": pa.array([uuid.uuid4().int >> 65]),
            "ids": pa.array([[i for i, _ in held]], pa.list_(pa.int64())),
            "sizes": pa.array([[len(d) for _, d in held]], pa.list_(pa.int64())),
            "blob": pa.array([zstandard.compress(b"".join(d for _, d in held), 3)], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(row)

    schema = "run long, ids array<long>, sizes array<long>, blob binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _two(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A hash of two numbers that is good in its high bits."""
    out = x * np.uint64(0x9E3779B97F4A7C15)
    out ^= y
    out *= np.uint64(0xFF51AFD7ED558CCD)
    return out


def _visible() -> np.ndarray:
    """For each column of eight bytes around an anchor, by the bytes that are not seen at its outer end, what is seen."""
    place = np.arange(8 * COLUMNS)
    seen = np.zeros((COLUMNS, OFFSETS, 8 * COLUMNS), np.uint8)
    for offset in range(OFFSETS):
        seen[: COLUMNS // 2, offset] = np.where(place >= BEFORE - offset, 255, 0)  # by the largest offset
        seen[COLUMNS // 2 :, offset] = np.where(place < SEEN - offset, 255, 0)  # by the smallest offset
    return np.stack([np.ascontiguousarray(seen[j, :, 8 * j : 8 * j + 8]).view("<u8")[:, 0] for j in range(COLUMNS)])


_VISIBLE = _visible()


def _looks(loads: np.ndarray, anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash of each anchor (48 bits), digest of all that its windows see (48 bits), and hashes of what stands after and before it (24 bits).

    Its windows are those at offsets ``low`` to ``high``.  All windows at
    offsets up to ``HALF`` see the 16 bytes after the anchor, all others the
    16 bytes before it, so two anchors that share a window agree in one of
    them; 0 where an anchor has no such window.
    """
    at = [loads[anchor + 8 * j] for j in range(COLUMNS)]
    around = {j: loads[anchor + BEFORE + j] for j in (-16, -8, 0, 8, 16, 24)}
    hashes = fmix(fmix(around[0] + np.uint64(0x9E3779B97F4A7C15)) ^ around[8]) >> np.uint64(16)
    digest = (high << 8 | low).astype(np.uint64)
    for j, column in enumerate(at):
        column &= _VISIBLE[j][high if j < COLUMNS // 2 else low]
        digest ^= column
        digest *= np.uint64(0x9E3779B97F4A7C15)
        digest += np.uint64(1)
        digest = fmix(digest)
    right = np.where(low <= HALF, _two(around[16], around[24]) >> np.uint64(40), 0).astype(np.uint32)
    left = np.where(high > HALF, _two(around[-16], around[-8]) >> np.uint64(40), 0).astype(np.uint32)
    return hashes, digest >> np.uint64(16), right, left


class Run:
    """Anchors of a run, sorted by hash, surroundings and document."""

    def __init__(self, ids: list, sizes: list[int], blob: bytes):
        data = zstandard.decompress(blob) if sum(sizes) else b""
        self.data = bytes(BEFORE) + data + bytes(LENGTH + 8)  # position p is at p + BEFORE
        self.ends = np.cumsum(np.array(sizes, np.int64))
        self.ids = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        found = self._anchors(len(data))
        anchor, low, _, hashes, digest = found[:5]
        doc = self.ids[np.searchsorted(self.ends, anchor - low, side="right")]
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        tied = np.flatnonzero(np.r_[False, same] | np.r_[same, False][: len(order)])
        few = order[tied]
        order[tied] = few[np.lexsort((doc[few], digest[few], hashes[few]))]
        self.doc = doc[order]
        self.anchor, self.low, self.high, self.hash, self.digest, self.right, self.left = (a[order] for a in found)
        new = np.r_[np.ones(min(len(order), 1), bool), (self.hash[1:] != self.hash[:-1]) | (self.digest[1:] != self.digest[:-1])]
        starts = np.flatnonzero(new)
        #: Whether a smaller document of the run has the same surroundings.
        self.later = self.doc > self.doc[starts][np.cumsum(new) - 1] if len(order) else new

    def _anchors(self, n: int) -> list[np.ndarray]:
        """Anchors, the least and largest offset of the windows that each represents, and their looks."""
        types = (np.int64, np.uint8, np.uint8, np.uint64, np.uint64, np.uint32, np.uint32)
        found = [[np.empty(0, t) for t in types]]
        inside = np.ones(n, bool)  # not for windows that reach over the end of a document
        for end in np.unique(self.ends).tolist():
            inside[max(0, end - LENGTH + 1) : end] = False
        step = min(SEGMENT, (1 << 16) - OFFSETS + 1)  # places have 16 bits
        for at in range(0, max(0, n - LENGTH + 1), step):
            windows = min(step, n - LENGTH + 1 - at)
            grams = windows + OFFSETS - 1
            # eight bytes from each place on; the segment's position p is at p + BEFORE
            loads = np.ndarray((grams + 8 * (COLUMNS - 1),), "<u8", self.data, at, (1,)).copy()
            mixed = _two(loads[BEFORE : BEFORE + grams], loads[BEFORE + 8 : BEFORE + 8 + grams])
            mixed >>= np.uint64(32)
            least = mixed.astype(np.uint32) & np.uint32(0xFFFF0000) | np.arange(grams, dtype=np.uint32)
            width = 1
            while width * 2 <= OFFSETS:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < OFFSETS:
                least = np.minimum(least[: len(least) - (OFFSETS - width)], least[OFFSETS - width :])
            starts = np.flatnonzero(inside[at : at + windows])
            if len(starts):
                place = (least & np.uint32(0xFFFF)).astype(np.int64)[starts]
                # a new anchor, or the same place seen from another document, begins a new group of windows
                change = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)])
                anchor = place[change]
                low, high = anchor - starts[np.r_[change[1:] - 1, len(starts) - 1]], anchor - starts[change]
                found.append([anchor + at, low.astype(np.uint8), high.astype(np.uint8), *_looks(loads, anchor, low, high)])
        return [np.concatenate(x) for x in zip(*found, strict=True)]


def around(text: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """What windows can see: the bytes from the anchor on, then those before it, backwards."""
    seen = np.lib.stride_tricks.sliding_window_view(text, SEEN)[anchors]
    return np.concatenate([seen[:, BEFORE:], seen[:, :BEFORE][:, ::-1]], axis=1)


def _ranges(hashes: np.ndarray, n: int) -> np.ndarray:
    """Range of each 48-bit hash."""
    return ((hashes >> np.uint64(24)) * np.uint64(n) >> np.uint64(24)).astype(np.int64)


def _runs_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of equal key, from batches that are sorted by it."""
    held: list[dict] = []
    for batch in batches:
        for row in _runs_of(batch):
            if held and held[0][key] != row[key]:
                yield held[0][key], held
                held = []
            held.append(row)
    if held:
        yield held[0][key], held


_ENTRY = ("<u8", "<u8", "<i8", "<u4", "u1", "u1", "<u4", "<u4")
_PLACED = ("<i8", "<u4", "u1", "u1")
#: What a row holds: entries; covered windows; places whose suffixes are merged; places whose windows are aggregated.
_ENTRIES, _COVER, _MERGE, _CROWD = range(4)
_FOUND = pa.schema([("range", pa.int64()), ("run", pa.int64()), ("what", pa.int32()), ("blob", pa.binary())])
_FOUND_SQL = "range long, run long, what int, blob binary"


def _as_rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _hash_rows(ranges: int):
    """The entries of each run by range, and the windows that a smaller document of the same run covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _runs_of(batch):
                yield of(row)

    def of(row: dict) -> pa.RecordBatch:
        here = Run(row["ids"], row["sizes"], row["blob"])
        later, use = np.flatnonzero(here.later), np.flatnonzero(~here.later)
        hashes = here.hash[use]
        bounds = np.searchsorted(_ranges(hashes, ranges), np.arange(ranges + 1))
        step = np.r_[hashes[:1], np.diff(hashes)]
        begun = bounds[:-1][np.diff(bounds) > 0]
        step[begun] = hashes[begun]
        columns = (here.digest, here.doc, here.anchor.astype("<u4"), here.low, here.high, here.right, here.left)
        planes = _planes(step, *(c[use] for c in columns))
        out = [(int(r), row["run"], _ENTRIES, zstandard.compress(planes[:, bounds[r] : bounds[r + 1]].tobytes(), 1)) for r in np.flatnonzero(np.diff(bounds))]
        if len(later):
            later = later[np.argsort(here.anchor[later])]
            anchor = here.anchor[later]
            out.append((row["run"] % ranges, row["run"], _COVER, _packed(anchor - here.high[later], anchor - here.low[later])))
        return _as_rows(out, _FOUND)

    return run


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal keys together, and where each begins in it."""
    order = np.argsort(keys, kind="stable")  # quick, as runs come sorted
    return order, np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])


def _spread(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the values of a key are not all the same, for each of its places."""
    out = np.zeros(len(keys), bool)
    if len(keys):
        order, starts = _groups(keys)
        differ = np.minimum.reduceat(values[order], starts) < np.maximum.reduceat(values[order], starts)
        out[order] = np.repeat(differ, np.diff(np.r_[starts, len(keys)]))
    return out


def _settled(hashes: np.ndarray, digest: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, right: np.ndarray, left: np.ndarray, crowded: int) -> np.ndarray:
    """What becomes of each entry: covered, merged, aggregated, or nothing (-1).

    What looks alike is covered but for its smallest document.  That one is
    merged if something of the same hash that looks otherwise, and has
    another smallest document, agrees with it after or before the anchor.
    """
    out = np.full(len(hashes), -1, np.int8)
    several = np.flatnonzero(_spread(doc, hashes))
    if not len(several):
        return out
    hashes, digest, doc, low, high, right, left = (a[several] for a in (hashes, digest, doc, low, high, right, left))
    order, starts = _groups(hashes)
    group = np.empty(len(order), np.uint64)
    group[order] = np.repeat(np.arange(len(starts), dtype=np.uint64), np.diff(np.r_[starts, len(order)]))
    bits = min(48, 64 - len(starts).bit_length())  # of the digest, that fit beside the group
    order = np.argsort(group << np.uint64(bits) | digest >> np.uint64(48 - bits), kind="stable")
    new = np.r_[True, (group[order][1:] != group[order][:-1]) | (digest[order][1:] != digest[order][:-1])]
    starts = np.flatnonzero(new)
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    one = order[starts]  # of each kind
    least = np.minimum.reduceat(doc[order], starts)
    merge = np.zeros(len(one), bool)
    for part, use in ((right, low <= HALF), (left, high > HALF)):
        some = np.flatnonzero(use[one])
        merge[some] |= _spread(least[some], group[one][some] << np.uint64(24) | part[one][some])
    first, group = doc == least[kind], group.astype(np.int64)
    much = np.bincount(group, merge[kind] & first) > crowded
    state = np.where(merge[kind], np.where(much[group], _CROWD, _MERGE), -1)
    out[several] = np.where(first, state, _COVER)
    return out


def _classes(crowded: int):
    """What becomes of each run's entries, from all runs' hashes of a range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _by_key(batches, "range"):
            out = [(key, r["run"], _COVER, r["blob"]) for r in rows if r["what"] == _COVER]
            rows = [r for r in rows if r["what"] == _ENTRIES]
            if rows:
                out += ((key, rows[k]["run"], what, blob) for k, what, blob in places([r["blob"] for r in rows]))
            yield _as_rows(out, _FOUND)

    def places(blobs: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
        parts = [_unpacked(blob, *_ENTRY) for blob in blobs]
        run = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        hashes = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        digest, doc, anchor, low, high, right, left = (np.concatenate([p[k] for p in parts]) for k in range(1, len(_ENTRY)))
        del parts
        found = _settled(hashes, digest, doc, low, high, right, left, crowded)
        use = np.flatnonzero(found >= 0)
        use = use[np.lexsort((anchor[use], found[use], run[use]))]
        new = np.flatnonzero(np.r_[np.ones(min(len(use), 1), bool), (run[use][1:] != run[use][:-1]) | (found[use][1:] != found[use][:-1])])
        for one in np.split(use, new[1:]) if len(use) else []:
            what, place = int(found[one[0]]), anchor[one].astype(np.int64)
            columns = (place - high[one], place - low[one]) if what == _COVER else (doc[one], anchor[one], low[one], high[one])
            yield int(run[one[0]]), what, _packed(*columns)

    return run


def front_code(rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Sorted rows of bytes as lengths shared with the row before, and the rest of each."""
    if not len(rows):
        return np.empty(0, np.uint8), b""
    differ = rows[1:] != rows[:-1]
    shared = np.r_[0, np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])].astype(np.uint8)
    rest = rows[np.arange(rows.shape[1])[None, :] >= shared[:, None]]
    return shared, rest.tobytes()


def front_decode(shared: np.ndarray, rest: bytes, width: int) -> list[bytes]:
    out, at, row = [], 0, b""
    for n in shared.tolist():
        end = at + width - n
        row = row[:n] + rest[at:end]
        out.append(row)
        at = end
    return out


def sorted_rows(rows: np.ndarray) -> np.ndarray:
    """Order of rows of bytes."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return np.lexsort(wide.view(">u8").T[::-1])


class LoserTree:
    """Merge of sorted runs that never compares a known prefix again.

    Every inner node keeps the loser of its match and how many leading bytes
    it shares with the string that beat it.  When the winner is replaced, the
    next string of its run comes with the length it shares with the winner
    (from the front coding).  On the way up, of two strings whose shared
    lengths with the last winner differ, the one that shares more is smaller;
    only for equal lengths are bytes compared, from that length on.
    """

    def __init__(self, runs: list[list[bytes]], shared: list[list[int]], width: int):
        self.runs, self.shared, self.width = runs, shared, width
        self.at = [0] * len(runs)
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.loser = [-1] * self.size  # run
        self.known = [0] * self.size  # bytes it shares with its winner
        self.winner, self.winner_known = self._build(1)

    def _string(self, run: int) -> bytes | None:
        return self.runs[run][self.at[run]] if 0 <= run < len(self.runs) and self.at[run] < len(self.runs[run]) else None

    def _match(self, a: int, a_known: int, b: int, b_known: int) -> tuple[int, int, int, int]:
        """Winner with what it shares with the last winner, loser with what it shares with this one."""
        x, y = self._string(a), self._string(b)
        if x is None:
            return b, b_known, a, 0
        if y is None:
            return a, a_known, b, 0
        if a_known > b_known:
            return a, a_known, b, b_known
        if b_known > a_known:
            return b, b_known, a, a_known
        rest_x, rest_y = x[a_known:], y[a_known:]
        if rest_x == rest_y:
            return (a, a_known, b, self.width) if a < b else (b, a_known, a, self.width)
        bits = (int.from_bytes(rest_x) ^ int.from_bytes(rest_y)).bit_length()
        same = self.width - (bits + 7) // 8
        return (a, a_known, b, same) if rest_x < rest_y else (b, a_known, a, same)

    def _build(self, node: int) -> tuple[int, int]:
        if node >= self.size:
            return node - self.size, 0
        left, right = self._build(2 * node), self._build(2 * node + 1)
        winner, known, self.loser[node], self.known[node] = self._match(*left, *right)
        return winner, known

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """Run and place in it of each string in order, and the bytes that it shares with the one before."""
        while (self._string(self.winner)) is not None:
            run = self.winner
            yield run, self.at[run], self.winner_known
            self.at[run] += 1
            known = self.shared[run][self.at[run]] if self.at[run] < len(self.runs[run]) else 0
            node = (run + self.size) // 2
            while node:
                run, known, self.loser[node], self.known[node] = self._match(run, known, self.loser[node], self.known[node])
                node //= 2
            self.winner, self.winner_known = run, known


def covered_offsets(rows: np.ndarray, shared: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each merged suffix, a bit for each offset whose window a smaller document has.

    ``shared`` are the lengths of the merged order; a suffix stands for the
    windows at offsets ``low`` to ``high``.
    """
    n = len(rows)
    before = rows[:, LENGTH:]
    order = sorted_rows(before)
    differ = before[order][1:] != before[order][:-1]
    alike = np.r_[0, np.where(differ.any(axis=1), differ.argmax(axis=1), before.shape[1])]
    by_doc = np.argsort(doc, kind="stable")
    bits = np.zeros(n, np.uint64)
    for offset in range(OFFSETS):
        right = np.cumsum(shared < LENGTH - offset)
        left = np.empty(n, np.int64)
        left[order] = np.cumsum(alike < offset) if offset else 0
        use = by_doc[(low[by_doc] <= offset) & (offset <= high[by_doc])]
        window = right[use] * (n + 1) + left[use]
        place = np.argsort(window, kind="stable")
        use, window = use[place], window[place]
        if len(use):
            first = np.r_[True, window[1:] != window[:-1]]
            least = doc[use][first][np.cumsum(first) - 1]
            bits[use[doc[use] > least]] |= np.uint64(1 << offset)
    return bits


_ITEM = ("<i8", "<i8", "u1", "u1", "u1")
_SECOND = pa.schema([("what", pa.int32()), ("range", pa.int64()), ("run", pa.int64()), ("blob", pa.binary()), ("rest", pa.binary()), ("doc", pa.int64())])
_SECOND_SQL = "what int, range long, run long, blob binary, rest binary, doc long"


def _second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs and places, the suffixes that have to be merged and the windows that have to be aggregated."""
    for batch in batches:
        for row in _runs_of(batch):
            text = np.frombuffer(bytes(BEFORE) + zstandard.decompress(row["blob"]) + bytes(LENGTH), np.uint8)
            out = []
            for place in row["places"]:
                if place["what"] != _MERGE:
                    continue
                doc, anchor, low, high = _unpacked(place["blob"], *_PLACED)
                rows = around(text, anchor)
                order = sorted_rows(rows)
                shared, rest = front_code(rows[order])
                blob = _packed(doc[order], anchor[order].astype("<i8"), low[order], high[order], shared)
                out.append((_MERGE, place["range"], row["run"], blob, zstandard.compress(rest, 3), None))
            yield _as_rows(out, _SECOND)
            for place in row["places"]:
                if place["what"] != _CROWD:
                    continue
                doc, anchor, low, high = (a.tolist() for a in _unpacked(place["blob"], *_PLACED))
                for start in range(0, len(doc), 4096):
                    out = []
                    for d, a, l, h in zip(*(x[start : start + 4096] for x in (doc, anchor, low, high)), strict=True):
                        for p in range(a - h, a - l + 1):
                            out.append((_CROWD, p, row["run"], text[p + BEFORE : p + BEFORE + LENGTH].tobytes(), None, d))
                    yield _as_rows(out, _SECOND)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the front-coded runs of a range; give the windows that smaller documents have."""
    for key, rows in _by_key(batches, "range"):
        parts = [_unpacked(r["blob"], *_ITEM) for r in rows]
        strings = [front_decode(p[4], zstandard.decompress(r["rest"]), SEEN) for p, r in zip(parts, rows, strict=True)]
        merged = np.array(list(LoserTree(strings, [p[4].tolist() for p in parts], SEEN)), np.int64).reshape(-1, 3)
        before = np.cumsum([0] + [len(s) for s in strings])
        place = before[merged[:, 0]] + merged[:, 1]
        flat = np.frombuffer(b"".join(s for run in strings for s in run), np.uint8).reshape(-1, SEEN)[place]
        doc, anchor, low, high = (np.concatenate([p[i] for p in parts])[place] for i in range(4))
        bits = covered_offsets(flat, merged[:, 2], doc, low, high)
        hit, offset = np.nonzero(bits[:, None] >> np.arange(OFFSETS, dtype=np.uint64)[None, :] & np.uint64(1))
        start, of = anchor[hit] - offset, merged[hit, 0]
        order = np.lexsort((start, of))
        bounds = np.searchsorted(of[order], np.arange(len(rows) + 1)).tolist()
        found = ((r["run"], start[order[a:b]]) for r, a, b in zip(rows, bounds, bounds[1:], strict=False) if a < b)
        yield _as_rows([(key, r, _COVER, _packed(mine, mine)) for r, mine in found], _FOUND)


def _intervals(covers: list[bytes], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each span of covered bytes, none of which reaches over the end of a document, and its document."""
    parts = [_unpacked(blob, "<i8", "<i8") for blob in covers] or [[np.empty(0, np.int64)] * 2]
    first, last = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order]) + LENGTH
    owner = np.searchsorted(ends, first, side="right")
    new = np.flatnonzero(np.r_[np.ones(min(len(first), 1), bool), (first[1:] > reach[:-1]) | (owner[1:] != owner[:-1])])
    return first[new], reach[np.r_[new[1:] - 1, len(first) - 1][: len(new)]], owner[new]


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _runs_of(batch):
            sizes = np.array(row["sizes"], np.int64)
            data = memoryview(zstandard.decompress(row["blob"]) if sizes.sum() else b"")
            ends = np.cumsum(sizes)
            begins, reaches, owner = _intervals(row["covers"] or [], ends)
            bounds = np.searchsorted(owner, np.arange(len(sizes) + 1)).tolist()
            begins, reaches = begins.tolist(), reaches.tolist()
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            out: dict[str, list] = {n: [] for n in names}
            for k, (doc_id, size, end) in enumerate(zip(row["ids"], sizes.tolist(), ends.tolist(), strict=True)):
                spans = slice(bounds[k], bounds[k + 1])
                kept = b"".join(data[a:b] for a, b in zip([end - size, *reaches[spans]], [*begins[spans], end], strict=True))
                for n, v in zip(names, (doc_id, size, size - len(kept), spans.stop - spans.start, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    out[n].append(v)
            types = {"kept_sha256": pa.string(), "kept": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(out[n], types.get(n, pa.int64())) for n in names], names=names)


def remove_repeats(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """What is left of each document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``kept`` (binary).

    A null text is empty.  Rows that repeat an id are documents of the same
    rank, neither of which covers the other.  A row without an id is covered
    by any other document and covers none.  Other columns are ignored.
    """
    ranges = partitions(docs)
    runs = materialize(pack(docs), "runs")
    hashes = runs.mapInArrow(_hash_rows(ranges), _FOUND_SQL)
    together = hashes.repartitionById(ranges, F.col("range").cast("int")).sortWithinPartitions("range")
    classes = materialize(together.mapInArrow(_classes(crowded), _FOUND_SQL), "classes")
    places = classes.where(F.col("what") != _COVER).groupBy("run").agg(F.collect_list(F.struct("range", "what", "blob")).alias("places"))  # two a range
    second = materialize(runs.select("run", "blob").join(places, "run").mapInArrow(_second, _SECOND_SQL), "suffixes")

    items = second.where(F.col("what") == _MERGE).repartitionById(ranges, F.col("range").cast("int")).sortWithinPartitions("range")
    merged = items.mapInArrow(_merged, _FOUND_SQL).select("run", "blob")
    windows = second.where(F.col("what") == _CROWD).select("run", F.col("range").alias("start"), F.col("blob").alias("window"), "doc")
    least = windows.groupBy("window").agg(F.min("doc").alias("least"))
    crowd = windows.join(least, "window").where("least < doc").groupBy("run").agg(F.sort_array(F.collect_list("start")).alias("starts"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [_packed(*[np.array(s, np.int64)] * 2) for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], names=["run", "blob"])

    covers = classes.where(F.col("what") == _COVER).select("run", "blob").unionByName(merged).unionByName(crowd.mapInArrow(packed, "run long, blob binary"))
    by_run = covers.groupBy("run").agg(F.collect_list("blob").alias("covers"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return runs.join(by_run, "run", "left").mapInArrow(_results, schema)
