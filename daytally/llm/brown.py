"""Language model scoring by Brown classes.

A word's probability is that of its class after the class before it, times
that of the word in its class:

    P(w | v) = P(class(w) | class(v)) * P(w | class(w))

Exchange clustering moves words to the class that raises the likelihood of the
class bigrams most.  It starts from the most frequent words alone, whose table of
bigrams has a fixed size, with every other word in a class by its surface (last
byte, digits, length).  Then every other word of the training texts takes part,
by turns: first the head (the most frequent words, whose classes are sent to
the tasks) in order of frequency, then all others by their hash.  In a turn the
words are dealt out with the classes of their neighbours, and each finds its
best class against the class bigrams, while the others stay; a turn's words
make up a small share of the tokens, as words that move at once do not see each
other.

The texts are written once as numbers for that, a word outside the head as a
64-bit hash; two such words of one hash would share their class, nothing else.
A word that the training texts lack has the class that most words seen once
and of its surface have come to.

Class transitions and word counts are taken over all training texts.  Counts
and classes have as many rows as there are different words; they stay in Spark.
For scoring, those of the head are sent to the tasks; the other words of each
text are joined with theirs.  They are rare by construction, so the join has
no hot key.

Both scores add log10((count + 1) / (size + words + 1)), the base over the
whole corpus and the class model within the word's class, where the extra
word is the unknown one.  The class transitions are smoothed by the class
frequencies.  Both are proper distributions over the words and one unknown.
"""

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.words import Remembered, partitions, slices, words
from daytally.scratch import materialize

#: Words that the exchange starts from; the bigram table between them is at most its square.
CLUSTERED = 1000
#: Classes for them at the start.
CLASSES = 48
#: Classes by surface for all other words at the start.
SURFACES = 24
#: Words whose counts and classes are sent to the tasks.
HEAD = 65_536
#: Share of all tokens whose words may move at once.
TURN = 0.1
#: The head's words are dealt out to at most so many.
HEAD_PARTS = 32
#: Text that is turned into numbers at once.
AT_ONCE = 3 << 20
#: Weight of the class frequencies in the smoothed transitions.
SMOOTHING = 20.0
SWEEPS = 8

#: The end of a text, which no word can equal; its class is the last one.
END = b"\n"
END_CLASS = CLASSES + SURFACES
ALL_CLASSES = END_CLASS + 1

#: Cost of naming a class.
NAMING = float(np.log(END_CLASS))

#: Counts of a word's neighbours: by class before it, beside itself, by class after it.
OWN = ALL_CLASSES
AFTER = OWN + 1
SLOTS = AFTER + ALL_CLASSES


def surface(word: bytes) -> int:
    """Class of a word outside the first ones before any sweep."""
    if any(48 <= b <= 57 for b in word):
        return CLASSES
    kind = zlib.crc32(word[-1:]) % 6 + (6 if any(b >= 128 for b in word) else 0)
    return CLASSES + 1 + (kind * 2 + (len(word) > 8)) % (SURFACES - 1)


def _flushed(counts: Counter, limit: int) -> Iterator[pa.RecordBatch]:
    if len(counts) > limit:
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
        counts.clear()


def word_counts(docs: DataFrame, limit: int = 400_000) -> DataFrame:
    """``word`` (binary) and ``n`` over all texts, with one END for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                counts.update(words(text))
                counts[END] += 1
            yield from _flushed(counts, limit)
        yield from _flushed(counts, 0)

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


#: In texts as numbers, a word outside the head and the end of a text; below them, the words of the head by frequency.
RARE_CODE = 65_534
END_CODE = 65_535


def _coded(batch: pa.RecordBatch, known: Remembered) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words of a batch's texts, END after each text and before the first, their codes, and for words outside the head what ``known`` has less 2^16."""
    found = [END]
    for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
        found += words(text)
        found.append(END)
    codes = np.fromiter(map(known.__getitem__, found), np.int32, len(found))
    return found, np.minimum(codes, RARE_CODE).astype(np.uint16) + (codes == END_CODE).astype(np.uint16), codes[codes > END_CODE] - END_CODE - 1


def _known(head: dict[bytes, int], rest) -> Remembered:
    """Codes of words; ``rest`` has the class for a word that is not in ``head``."""
    table = head | {END: END_CODE}
    return Remembered(lambda word: table[word] if word in table else END_CODE + 1 + rest(word))


def encode(docs: DataFrame, head_codes) -> DataFrame:
    """All texts as numbers, many in a row: ``codes`` (uint16), and for the words outside the head ``rare`` (hash) and ``start`` (class by surface).

    ``head_codes()`` makes the head's table from word to code, 0 and up.  A row
    begins with the end of a text, and each text ends with one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(head_codes(), surface)
        for batch in slices(batches, size=AT_ONCE):
            found, codes, start = _coded(batch, known)
            rare = np.array([xxhash.xxh64_intdigest(found[i], 42) for i in np.flatnonzero(codes == RARE_CODE).tolist()], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (codes, rare, start.astype(np.uint8))], names=["codes", "rare", "start"])

    return docs.select("text").mapInArrow(run, "codes binary, rare binary, start binary")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """Rows of binary columns, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield [c[i].as_py() for c in batch.columns]


def numbers(member: np.ndarray, end: int = END_CLASS) -> np.ndarray:
    """What stands for each code: ``member`` for the head, -1 for a word outside it."""
    out = np.full(END_CODE + 1, -1, np.int64)
    out[: len(member)], out[END_CODE] = member, end
    return out


def _classes(codes: np.ndarray, start: bytes, class_of: np.ndarray) -> np.ndarray:
    """Classes of the words of a row, those outside the head by surface."""
    classes = class_of[codes]
    classes[codes == RARE_CODE] = np.frombuffer(start, np.uint8)
    return classes


def pair_counts(encoded: DataFrame, number_of: np.ndarray, size: int, rare: bool = True) -> DataFrame:
    """Counts ``n`` of neighbours ``i``, ``j`` by what ``number_of`` has for their codes, below ``size``; -1 is left out.

    Words outside the head count by their class by surface, or are left out
    without ``rare``.  A task holds one table of ``size`` by ``size``.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(number_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size * size, np.int64)
        for codes, start in _rows(batches):
            codes = np.frombuffer(codes, np.uint16)
            ids = _classes(codes, start, sent.value) if rare else sent.value[codes]
            left, right = ids[:-1], ids[1:]
            table += np.bincount((left * size + right)[(left >= 0) & (right >= 0)], minlength=size * size)
        cells = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(cells // size), pa.array(cells % size), pa.array(table[cells])], names=["i", "j", "n"])

    return encoded.select("codes", "start").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))


def table_of(pairs: DataFrame, size: int) -> np.ndarray:
    """A table of fixed size on the driver."""
    made = np.zeros((size, size))
    cells = pairs.select("i", "j", "n").toArrow()
    made[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["n"].to_numpy()
    return made


def _entropy(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(bigrams: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each word, by exchange on the bigram table of the words (in order of frequency).

    The objective is the class-bigram log likelihood
    sum N(c, d) log N(c, d) - sum N(c.) log N(c.) - sum N(.d) log N(.d); each
    word moves to the class that raises it most, until a sweep moves none.
    """
    n = len(bigrams)
    member = np.arange(n) % classes
    one = np.eye(classes)[member]
    rest = one.T @ bigrams @ one
    for _ in range(sweeps):
        moved = 0
        for w in range(n):
            row, column = np.bincount(member, bigrams[w], classes), np.bincount(member, bigrams[:, w], classes)
            own, old = bigrams[w, w], member[w]
            row[old] -= own
            column[old] -= own
            rest[old] -= row
            rest[:, old] -= column
            rest[old, old] -= own
            # with w in class c, row c and column c of the table grow; the sums of the others grow alike for every c
            sums, heads = rest.sum(axis=1) + column, rest.sum(axis=0) + row
            base = _entropy(rest)
            gain_row = (_entropy(rest + row[None, :]) - base).sum(axis=1)
            gain_column = (_entropy(rest + column[:, None]) - base).sum(axis=0)
            both = np.diag(rest)
            twice = _entropy(both + row + column + own) - _entropy(both + row) - _entropy(both + column) + _entropy(both)
            gain = gain_row + gain_column + twice
            total_row, total_column = row.sum() + own, column.sum() + own
            gain -= _entropy(sums + total_row) - _entropy(sums) + _entropy(heads + total_column) - _entropy(heads)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            rest[new] += row
            rest[:, new] += column
            rest[new, new] += own
            member[w] = new
            moved += new != old
        if not moved:
            break
    return member


def best_classes(at: np.ndarray, slot: np.ndarray, n: np.ndarray, old: np.ndarray, start: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class that each word moves to, while all others stay.

    ``n`` neighbours of kind ``slot`` belong to word ``at`` (an index to
    ``old``, the words' classes; ascending); ``table`` has all class bigrams.
    A class other than that by surface, ``start``, has to be named, which costs
    the logarithm of their number; it must gain more than that.
    """
    new = old.copy()
    starts = np.searchsorted(at, np.arange(len(old) + 1))
    first = 0
    while first < len(old):  # as many words at once as have some thousand kinds of neighbours
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + 20_000, "right")) - 1)
        these = slice(starts[first], starts[last])
        new[first:last] = _best(at[these] - first, slot[these], n[these], old[first:last], start[first:last], table)
        first = last
    return new


def _best(at: np.ndarray, slot: np.ndarray, n: np.ndarray, old: np.ndarray, start: np.ndarray, table: np.ndarray) -> np.ndarray:
    """See ``exchange`` for the gain; only the few cells that a word's neighbours touch are looked at."""
    k, each = END_CLASS, np.arange(len(old))
    every = np.zeros((len(old), SLOTS))
    every[at, slot] = n
    before, own, after = every[:, :OWN], every[:, OWN], every[:, AFTER:]
    gain = np.zeros((len(old), k))
    for mine, other, bigrams in ((after, before, table), (before, after, table.T)):
        w, d = np.nonzero(mine)
        if not len(w):
            continue
        m = mine[w, d]
        kinds, which = np.unique(d + ALL_CLASSES * m.astype(np.int64), return_inverse=True)
        rest = bigrams[:k, kinds % ALL_CLASSES].T
        step = (_entropy(rest + (kinds // ALL_CLASSES)[:, None]) - _entropy(rest))[which]
        # the table still has the word in its old class: its row there, and its column where the neighbour is of that class
        left = bigrams[old[w], d] - m
        step[np.arange(len(w)), old[w]] = _entropy(left + m) - _entropy(left)
        same = np.flatnonzero(d == old[w])
        if len(same):
            rest = bigrams[:k, d[same]].T - other[w[same], :k]
            rest[np.arange(len(same)), d[same]] -= m[same] + own[w[same]]
            step[same] = _entropy(rest + m[same, None]) - _entropy(rest)
        edges = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        gain[w[edges]] += np.add.reduceat(step, edges)
    w, c = np.nonzero(((before[:, :k] > 0) & (after[:, :k] > 0)) | (own > 0)[:, None])
    row, column, beside = after[w, c], before[w, c], own[w]
    both = table[c, c] - (c == old[w]) * (row + column + beside)
    gain[w, c] += _entropy(both + row + column + beside) - _entropy(both + row) - _entropy(both + column) + _entropy(both)
    for total, sums in ((after.sum(axis=1) + own, table.sum(axis=1)[:k]), (before.sum(axis=1) + own, table.sum(axis=0)[:k])):
        kinds, which = np.unique(total, return_inverse=True)
        gain -= (_entropy(sums + kinds[:, None]) - _entropy(sums))[which]
        gain[each, old] += _entropy(sums[old] + total) - 2 * _entropy(sums[old]) + _entropy(sums[old] - total)
    gain[each, start] += NAMING
    new = gain.argmax(axis=1)
    return np.where(gain[each, new] > gain[each, old] + 1e-9, new, old)


def _added(cells: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each cell once, ascending, with its sum."""
    if n is None:
        return np.unique(cells, return_counts=True)
    cells, which = np.unique(cells, return_inverse=True)
    return cells, np.bincount(which, n, len(cells)).astype(np.int64)


def _moved(cells: np.ndarray, n: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """What the class bigrams gain when words, whose neighbours are counted in ``cells``, go from class ``old`` to ``new``."""
    some = (old != new)[cells // SLOTS]
    w, slot, n = cells[some] // SLOTS, cells[some] % SLOTS, n[some]
    change = np.zeros(ALL_CLASSES * ALL_CLASSES, np.int64)
    for sign, c in ((-1, old[w]), (1, new[w])):
        pair = np.where(slot < OWN, slot * ALL_CLASSES + c, np.where(slot == OWN, c * ALL_CLASSES + c, c * ALL_CLASSES + slot - AFTER))
        change += sign * np.bincount(pair, n, len(change)).astype(np.int64)
    return change


def head_turn(encoded: DataFrame, member: np.ndarray, start: np.ndarray, table: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The words ``low`` to ``high`` of the head move to their best classes.

    ``member`` has the classes of the head, ``start`` those by surface,
    ``table`` the class bigrams of all texts; the new classes and bigrams are
    returned.  A task holds one count for each of the words and kind of
    neighbour.
    """
    spark, parts = encoded.sparkSession, min(partitions(encoded), HEAD_PARTS)
    sent = spark.sparkContext.broadcast((member, numbers(member), start, table))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, counts = sent.value[1], np.zeros((high - low) * SLOTS, np.int64)
        for codes, by_surface in _rows(batches):
            codes = np.frombuffer(codes, np.uint16)
            classes = _classes(codes, by_surface, class_of)
            places = np.flatnonzero((codes >= low) & (codes < high))  # never the first or the last, which end texts
            here = codes[places]
            at = (here.astype(np.int64) - low) * SLOTS
            counts += np.bincount(at + np.where(codes[places - 1] == here, OWN, classes[places - 1]), minlength=len(counts))
            counts += np.bincount((at + AFTER + classes[places + 1])[codes[places + 1] != here], minlength=len(counts))
        cells = np.flatnonzero(counts)
        edges = np.searchsorted(cells, (np.arange(parts + 1) * (high - low) // parts) * SLOTS)
        rows = [(p, cells[a:b].astype(np.int32).tobytes(), counts[cells[a:b]].tobytes()) for p, a, b in zip(range(parts), edges[:-1], edges[1:], strict=True) if a < b]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 3, (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["part", "cells", "n"])

    def choose(dealt: pa.Table) -> pa.Table:
        member, _, start, table = sent.value
        cells, n = (np.concatenate([np.frombuffer(b, kind) for b in dealt.column(c).to_pylist()]) for c, kind in (("cells", np.int32), ("n", np.int64)))
        cells, n = _added(cells, n)
        w, at = np.unique(cells // SLOTS, return_inverse=True)
        cells = at * SLOTS + cells % SLOTS
        old = member[w + low]
        new = best_classes(at, cells % SLOTS, n, old, start[w + low], table)
        out = [(w + low).astype(np.int64), new.astype(np.int64), _moved(cells, n, old, new)]
        return pa.table([pa.array([x.tobytes()], pa.binary()) for x in out], names=["w", "c", "change"])

    dealt = encoded.select("codes", "start").mapInArrow(deal, "part int, cells binary, n binary").groupBy("part")
    member, table = member.copy(), table.copy()
    for r in dealt.applyInArrow(choose, "w binary, c binary, change binary").collect():
        member[np.frombuffer(r.w, np.int64)] = np.frombuffer(r.c, np.int64)
        table += np.frombuffer(r.change, np.int64).reshape(table.shape)
    return member, table


#: A word outside the head with its class at the start and the classes of its neighbours; RARE is added to that of one outside the head.
_MET = np.dtype([("word", "<u8"), ("old", "u1"), ("before", "u1"), ("after", "u1")])
RARE = 128


def meetings(encoded: DataFrame, member: np.ndarray) -> DataFrame:
    """All words outside the head with their neighbours; a row has all of its words' occurrences, by word."""
    spark, parts = encoded.sparkSession, partitions(encoded)
    sent = spark.sparkContext.broadcast(numbers(member))

    def dealt(met: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(met)
        part = (rows["word"] % np.uint64(parts)).astype(np.int64)
        rows, ends = rows[np.argsort(part, kind="stable")], np.r_[0, np.bincount(part, minlength=parts).cumsum()]
        some = [(p, rows[a:b].tobytes()) for p, a, b in zip(range(parts), ends[:-1], ends[1:], strict=True) if a < b]
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in some], pa.int32()), pa.array([b for _, b in some], pa.binary())], names=["part", "met"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, held = [], 0
        for codes, rare, start in _rows(batches):
            codes, words = np.frombuffer(codes, np.uint16), np.frombuffer(rare, np.uint64)
            classes = _classes(codes, start, sent.value) + RARE * (codes == RARE_CODE)
            places = np.flatnonzero(codes == RARE_CODE)
            rows = np.empty(len(words), _MET)
            rows["word"], rows["old"] = words, np.frombuffer(start, np.uint8)
            rows["before"], rows["after"] = classes[places - 1], classes[places + 1]
            beside = np.flatnonzero((places[1:] == places[:-1] + 1) & (words[1:] == words[:-1]))
            rows["before"][beside + 1] = rows["after"][beside] = RARE + OWN
            met.append(rows)
            held += len(rows)
            if held > 1 << 20:
                yield dealt(met)
                met, held = [], 0
        if held:
            yield dealt(met)

    def whole(dealt: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(b, _MET) for b in dealt.column("met").to_pylist()])
        return pa.table([pa.array([rows[np.argsort(rows["word"], kind="stable")].tobytes()], pa.binary())], names=["met"])

    return encoded.mapInArrow(deal, "part int, met binary").groupBy("part").applyInArrow(whole, "met binary")


def rare_turn(met: DataFrame, table: np.ndarray, turn: int, turns: int) -> DataFrame:
    """A share of the words outside the head, by their hash, moves to its best classes.

    Rows with a ``word`` (its hash) have its class before, ``i``, and now,
    ``j``, and its count ``n``.  The others have class bigrams: ``n`` of such
    words with the head by the new classes, and the ``change`` of all, where
    neighbours outside the head count in their class at the start.
    """
    sent = met.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "i", "j", "n", "change"]
        for (b,) in _rows(batches):
            met = np.frombuffer(b, _MET)
            met = met[(met["word"] >> np.uint64(32)) % np.uint64(turns) == np.uint64(turn)]
            firsts = np.flatnonzero(np.r_[True, met["word"][1:] != met["word"][:-1]][: len(met)])
            n = np.diff(np.r_[firsts, len(met)])
            at = np.repeat(np.arange(len(firsts)), n)
            before, after = met["before"].astype(np.int64), met["after"].astype(np.int64)
            cells = np.concatenate([at * SLOTS + before % RARE, (at * SLOTS + AFTER + after % RARE)[after != RARE + OWN]])
            cells, counts = _added(cells)
            old = met["old"][firsts].astype(np.int64)
            new = best_classes(cells // SLOTS, cells % SLOTS, counts, old, old, sent.value)
            word = pa.array(met["word"][firsts].view(np.int64))
            yield pa.RecordBatch.from_arrays([word, pa.array(old), pa.array(new), pa.array(n), pa.array(np.zeros_like(n))], names=names)
            now, change = new[at], _moved(cells, counts, old, new)
            pairs = np.concatenate([(before * ALL_CLASSES + now)[before < RARE], (now * ALL_CLASSES + after)[after < RARE]])
            pairs = np.bincount(pairs, minlength=len(change))
            some = np.flatnonzero(pairs | change)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(some), pa.int64()), pa.array(some // ALL_CLASSES), pa.array(some % ALL_CLASSES), pa.array(pairs[some]), pa.array(change[some])], names=names
            )

    return met.mapInArrow(run, "word long, i long, j long, n long, change long")


def rare_pairs(encoded: DataFrame) -> DataFrame:
    """Neighbours ``v``, ``w`` (hashes) that are both outside the head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, rare in _rows(batches):
            places, words = np.flatnonzero(np.frombuffer(codes, np.uint16) == RARE_CODE), np.frombuffer(rare, np.int64)
            found = np.flatnonzero(places[1:] == places[:-1] + 1)
            yield pa.RecordBatch.from_arrays([pa.array(words[found]), pa.array(words[found + 1])], names=["v", "w"])

    return encoded.select("codes", "rare").mapInArrow(run, "v long, w long")


@dataclass
class Model:
    """Counts and classes stay in ``counts`` and ``rare``; the rest has a fixed size."""

    counts: DataFrame  # word, n
    rare: DataFrame  # word, n, c: the words outside the head
    head: dict[bytes, int]  # counts of the most frequent words
    tokens: int
    distinct: int
    class_of: dict[bytes, int]  # classes of the head
    unseen: np.ndarray  # by class at the start, class of a word that the training texts lack
    log_transitions: np.ndarray
    log_sizes: np.ndarray  # by class, log10(size + words + 1)


def head(counts: DataFrame, most: int = HEAD) -> dict[bytes, int]:
    """Counts of the most frequent words, at most ``most`` of them.

    The words are cut at a count, found from the sizes of a few hundred bands
    of counts, so nothing is sorted and only what is returned is fetched.
    """
    band = F.floor(F.log2("n") * 8).alias("band")
    sizes = counts.groupBy(band).agg(F.count("*").alias("words")).orderBy(F.desc("band")).collect()
    total, least = 0, None
    for r in sizes:
        total += r.words
        if total > most:
            break
        least = r.band
    if least is None:
        return {}
    return {bytes(r.word): r.n for r in counts.where(F.floor(F.log2("n") * 8) >= least).collect()}


def fit(training: DataFrame, most: int = HEAD) -> Model:
    """Learn from all texts of ``training`` (column ``text``; null is empty); ``most`` words are the head."""
    spark = training.sparkSession
    counts = materialize(word_counts(training), "words")
    sizes = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    known = head(counts, most)
    order = sorted(known.keys() - {END}, key=lambda w: (-known[w], w))[:RARE_CODE]
    known = {w: known[w] for w in order}
    sent_codes = spark.sparkContext.broadcast({w: i for i, w in enumerate(order)})
    encoded = materialize(encode(training, lambda: sent_codes.value), "encoded")

    start = np.array([surface(w) for w in order], np.int64)
    member, size = start.copy(), min(CLUSTERED, len(order))
    if size:
        first = np.arange(len(order))
        first[size:] = -1
        bigrams = table_of(pair_counts(encoded, numbers(first, -1), size, rare=False), size)
        member[:size] = exchange(bigrams, CLASSES)

    def transitions() -> np.ndarray:
        return table_of(pair_counts(encoded, numbers(member), ALL_CLASSES), ALL_CLASSES)

    table, share = transitions(), max(1.0, sizes.n * TURN if sizes.n else 1.0)
    low = size
    while low < len(order):
        # as many words as make up a turn, one at least
        met = np.cumsum([known[w] for w in order[low:]])
        high = low + max(1, int(np.searchsorted(met, share, "right")))
        member, table = head_turn(encoded, member, start, table, low, high)
        low = high
    table = transitions()
    met, turns = materialize(meetings(encoded, member), "meetings"), max(1, int(np.ceil(((sizes.n or 0) - sum(known.values())) / share)))
    swept = None
    for turn in range(turns):
        made = materialize(rare_turn(met, table, turn, turns), "swept")
        swept = made if swept is None else swept.unionByName(made)
        if turn + 1 < turns:
            table += table_of(made.where("word is null").groupBy("i", "j").agg(F.sum("change").alias("n")), ALL_CLASSES)
    classes = swept.where("word is not null")
    pairs = rare_pairs(encoded).join(classes.select(F.col("word").alias("v"), F.col("j").alias("a")), "v").join(classes.select(F.col("word").alias("w"), "j"), "w")
    pairs = pairs.groupBy(F.col("a").alias("i"), "j").agg(F.count("*").alias("n"))
    pairs = pairs.unionByName(pair_counts(encoded, numbers(member), ALL_CLASSES, rare=False)).unionByName(swept.where("word is null").select("i", "j", "n"))
    table = table_of(pairs.groupBy("i", "j").agg(F.sum("n").alias("n")), ALL_CLASSES)

    n, found, once = np.zeros(ALL_CLASSES), np.zeros(ALL_CLASSES), np.zeros((END_CLASS, END_CLASS))
    n += np.bincount(member, [known[w] for w in order], ALL_CLASSES)
    found += np.bincount(member, minlength=ALL_CLASSES)
    single = np.array([known[w] == 1 for w in order], bool)
    np.add.at(once, (start[single], member[single]), 1)
    for r in classes.groupBy("i", "j").agg(F.sum("n").alias("n"), F.count("*").alias("words"), F.count_if(F.col("n") == 1).alias("once")).collect():
        n[r.j] += r.n
        found[r.j] += r.words
        once[r.i, r.j] += r.once
    log_sizes = np.log10(n + found + 1)  # a class without words has only the unknown one
    log_sizes[END_CLASS] = 0.0
    unseen = np.where(once.any(axis=1), once.argmax(axis=1), np.arange(END_CLASS))

    rare = counts.withColumn("hash", F.xxhash64("word")).join(classes.select(F.col("word").alias("hash"), F.col("j").cast("int").alias("c")), "hash").drop("hash")
    share = table.sum(axis=0) + 1
    share = share / share.sum()
    smooth = (table + SMOOTHING * share) / (table.sum(axis=1, keepdims=True) + SMOOTHING)
    class_of = dict(zip(order, member.tolist(), strict=True))
    return Model(counts, rare, known, int(sizes.n or 0), int(sizes.v), class_of, unseen, np.log10(smooth), log_sizes)


_SCORED = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, counted double, fixed double, asked array<struct<part:int,words:binary>>, met binary, keys binary, tallies binary"
#: A word outside the head: who is asked for it, the classes beside it (ALL_CLASSES for one outside the head) and its class if nobody knows it.
_ASKED = np.dtype([("part", "<u2"), ("before", "u1"), ("after", "u1"), ("unseen", "u1")])
_WORDS = pa.list_(pa.struct([("part", pa.int32()), ("words", pa.binary())]))
_ANSWER = np.dtype([("n", "<i8"), ("c", "i1")])


def _answers(asked: DataFrame, rare: DataFrame, parts: int) -> DataFrame:
    """For each blob of words asked for, in their order, counts and classes; 0 and -1 for an unknown word."""

    def answer(asked: pa.Table, rare: pa.Table) -> pa.Table:
        table = dict(zip(rare.column("word").to_pylist(), zip(rare.column("n").to_pylist(), rare.column("c").to_pylist(), strict=True), strict=True))
        out = [np.array([table.get(w, (0, -1)) for w in b.split(END)], _ANSWER).tobytes() for b in asked.column("words").to_pylist()]
        return pa.table({"slice": asked.column("slice"), "part": asked.column("part"), "answer": pa.array(out, pa.binary())})

    owned = rare.select(F.pmod(F.xxhash64("word"), F.lit(parts)).cast("int").alias("part"), "word", "n", "c")
    return asked.groupBy("part").cogroup(owned.groupBy("part")).applyInArrow(answer, "slice long, part int, answer binary")


def score(docs: DataFrame, model: Model, held_out) -> DataFrame:
    """Both scores of every text: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``held_out`` is a column that is carried along.  A null text is empty and
    has one token, its end.  Repeated rows give repeated results; a null id
    stays; other columns are ignored.  Besides, ``perplexity`` is 10 to the
    power of the negative mean score.

    Words outside the head are asked for by slices of texts: the words of a
    slice go where their counts and classes are, those come back in the same
    order, and the slice adds up what its texts lack.
    """
    spark = docs.sparkSession
    end, parts = model.counts.where(F.col("word") == F.lit(END)).collect(), min(partitions(docs), 1 << 16)
    n_ends = sum(r.n for r in end)
    order = list(model.class_of)
    member, logs = numbers(np.array([model.class_of[w] for w in order], np.int64)), np.zeros(END_CODE + 1)
    logs[: len(order)] = np.log10(np.array([model.head[w] for w in order], float) + 1)
    member[RARE_CODE] = ALL_CLASSES
    # a bigram with a word outside the head counts nothing at first
    inner, sizes = np.zeros((ALL_CLASSES + 1, ALL_CLASSES + 1)), np.r_[model.log_sizes, 0.0]
    inner[:-1, :-1] = model.log_transitions
    sent = spark.sparkContext.broadcast(({w: i for i, w in enumerate(order)}, model.unseen, member, logs, inner, sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of, unseen, member, logs, inner, sizes = sent.value
        known = _known(codes_of, lambda word: int(unseen[surface(word)]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        for batch in slices(batches, size=AT_ONCE):
            if not batch.num_rows:
                continue
            found, codes, rest = _coded(batch, known)
            classes, ends = member[codes], np.flatnonzero(codes == END_CODE)
            outside = np.flatnonzero(codes == RARE_CODE)
            steps = inner[classes[:-1], classes[1:]] - sizes[classes[1:]]
            fixed, counted = np.add.reduceat(steps, ends[:-1]), np.add.reduceat(logs[codes[1:]], ends[:-1])
            n_tokens, tallies = np.diff(ends), np.diff(np.searchsorted(outside, ends))
            words = [found[i] for i in outside.tolist()]
            met = np.empty(len(words), _ASKED)
            met["part"] = np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64).view(np.int64) % parts
            met["before"], met["after"], met["unseen"] = classes[outside - 1], classes[outside + 1], rest
            by_part = np.argsort(met["part"], kind="stable")
            words, each = [words[i] for i in by_part.tolist()], np.r_[0, np.bincount(met["part"], minlength=parts).cumsum()].tolist()
            asked = [{"part": p, "words": END.join(words[a:b])} for p, (a, b) in enumerate(zip(each[:-1], each[1:], strict=True)) if a < b]
            keys, n = batch.column(0), batch.num_rows
            # what concerns the slice stands in the row of its first text
            once = [[asked], [met.tobytes()], [np.array(keys.to_pylist(), np.int64).tobytes()], [tallies.astype(np.int64).tobytes()]]
            n_known = n_tokens - tallies - (n_ends == 0)
            arrays = [keys, *batch.columns[1:3], *(pa.array(x, t) for x, t in zip((n_tokens, n_known, counted, fixed), types[1:], strict=True))]
            arrays += [pa.array(x + [None] * (n - 1), t) for x, t in zip(once, (_WORDS, pa.binary(), pa.binary(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in _SCORED.split(", ")])

    def add(slice: pa.Table, answers: pa.Table) -> pa.Table:
        _, _, _, _, inner, sizes = sent.value
        made = []
        for key, met, keys, tallies in zip(*(slice.column(c).to_pylist() for c in ("slice", "met", "keys", "tallies")), strict=True):
            met, tallies = np.frombuffer(met, _ASKED), np.frombuffer(tallies, np.int64)
            got = sorted(zip(answers.column("part").to_pylist(), answers.column("answer").to_pylist(), strict=True))
            answer = np.empty(len(met), _ANSWER)
            answer[np.argsort(met["part"], kind="stable")] = np.frombuffer(b"".join(b for _, b in got), _ANSWER)
            c = np.where(answer["c"] < 0, met["unseen"], answer["c"]).astype(np.int64)
            before, after = met["before"].astype(np.int64), met["after"].astype(np.int64)
            # of two such words side by side, the second one has the bigram
            second = np.flatnonzero(before == ALL_CLASSES)
            before[second] = c[second - 1]
            more = np.log10(answer["n"] + 1.0)
            step = inner[before, c] + inner[c, after] - sizes[c]
            some = np.flatnonzero(tallies)
            starts = np.r_[0, tallies.cumsum()][some]
            made.append([np.frombuffer(keys, np.int64)[some], *(np.add.reduceat(x, starts) for x in (more, step, (answer["n"] > 0).astype(np.int64)))])
        return pa.table(dict(zip(("key", "more", "steps", "more_known"), map(np.concatenate, zip(*made, strict=True)), strict=True)))

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    texts = materialize(keyed.mapInArrow(run, _SCORED), "scored")
    asking = texts.where("size(asked) > 0").withColumnRenamed("key", "slice")
    answers = _answers(asking.select("slice", F.explode("asked").alias("x")).select("slice", "x.part", "x.words"), model.rare, parts)
    sums = asking.select("slice", "met", "keys", "tallies").groupBy("slice").cogroup(answers.groupBy("slice"))
    sums = sums.applyInArrow(add, "key long, more double, steps double, more_known long")
    more = F.coalesce("more", F.lit(0.0))
    base = F.col("counted") + more + F.lit(float(np.log10(n_ends + 1))) - F.col("n_tokens") * F.lit(float(np.log10(model.tokens + model.distinct + 1)))
    total = F.col("fixed") + F.col("counted") + more + F.coalesce("steps", F.lit(0.0))
    return (
        texts.select("key", "doc_id", "held_out", "n_tokens", "n_known", "counted", "fixed")
        .join(sums, "key", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(model.tokens).cast("long").alias("train_tokens"),
            base.alias("base_score"),
            total.alias("score"),
            F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
        )
    )
