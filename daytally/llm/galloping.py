"""Alignment of two tokenizers by a galloping intersection of their token ends.

Both encode the same bytes, so tokens are told by the byte offsets at which
they end.  The shorter list of ends drives: each of its ends is looked for in
the longer one from where the last was found, in steps that double and then by
halving.  That gives every end's rank in the longer list.  Ends in both lists
cut the tokens into groups, and the ranks of two successive ends bound the run
of tokens that the token between them overlaps.

Texts are cut where a token of either kind surely ends: before a blank between
two other characters, around a line break between two others, and between a
letter or digit and a punctuation mark.  So the same word is aligned once and
remembered; a text without such a place is aligned as a whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.byte_bpe import Codec, byte_characters, sentencepiece_model
from daytally.llm.prefix_table import BLANK, Encoder, Pieces
from daytally.llm.words import slices
from daytally.scratch import materialize

#: Aligned words remembered per task, and the characters of the longest one.
REMEMBERED, SHORT = 120_000, 64
#: Tokens of a word from which on it is aligned by itself.
ALONE = 64
#: Characters of the texts, and new words, that are handed to the libraries at once.
RUN, BLOCK = 1 << 18, 20_000
#: Most id pairs whose counts are sent to every task; the documents' other pairs are joined with theirs.
HEAD = 1 << 19
#: Distinct pairs that a task holds while counting.
HELD = 1 << 20

ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def gallop(short: list[int], long: list[int]) -> list[int]:
    """How many of ``long`` are below each of ``short``; both rise."""
    ranks, at = [], 0
    for end in short:
        step, probe = 1, at
        while probe < len(long) and long[probe] < end:
            at, probe, step = probe + 1, probe + step, step * 2
        at = bisect_left(long, end, at, min(probe, len(long)))
        ranks.append(at)
    return ranks


class Runs(NamedTuple):
    """Lists one after the other: their values, and where each starts and ends."""

    values: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @staticmethod
    def of(values: np.ndarray, counts: np.ndarray) -> Runs:
        ends = np.cumsum(counts)
        return Runs(values, ends - counts, ends)


def gallop_many(short: Runs, long: Runs) -> np.ndarray:
    """For each value of each short list, the place in ``long.values`` of the first one of its long list that is not below.

    All values rise over all lists, and the last ones of a short and its long
    list are equal.  The lists advance together, each from where its last
    value was found; a very long one goes alone.
    """
    ranks, count = np.zeros(len(short.values), np.int64), short.ends - short.starts
    for i in np.flatnonzero(count > ALONE):
        found = gallop(short.values[short.starts[i] : short.ends[i]].tolist(), long.values[long.starts[i] : long.ends[i]].tolist())
        ranks[short.starts[i] : short.ends[i]] = np.array(found) + long.starts[i]
    here, at = np.flatnonzero(count <= ALONE), long.starts.copy()
    turn = 0
    while len(here := here[count[here] > turn]):
        place = short.starts[here] + turn
        end, low, last = short.values[place], at[here], long.ends[here] - 1
        probe, step = low.copy(), 1
        open_ = np.flatnonzero(long.values[probe] < end)
        while len(open_):  # steps that double
            low[open_] = probe[open_] + 1
            probe[open_] = np.minimum(probe[open_] + step, last[open_])
            step *= 2
            open_ = open_[long.values[probe[open_]] < end[open_]]
        open_ = np.flatnonzero(low < probe)
        while len(open_):  # halving
            middle = (low[open_] + probe[open_]) // 2
            below = long.values[middle] < end[open_]
            low[open_], probe[open_] = np.where(below, middle + 1, low[open_]), np.where(below, probe[open_], middle)
            open_ = open_[low[open_] < probe[open_]]
        ranks[place] = at[here] = low
        turn += 1
    return ranks


def align(a: Runs, b: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links of two tokenizers over the same words; values are byte offsets at which tokens end.

    Gives the group of every token of A and of B, numbered over all words, and
    the tokens of A and of B of every link, word by word.
    """
    turned = (a.ends - a.starts) > (b.ends - b.starts)
    shorter, longer = (_picked(a, b, turned), _picked(b, a, turned))
    ranks = gallop_many(shorter, longer)
    common = longer.values[ranks] == shorter.values
    # a token overlaps those from where the token before it ended to where it ends itself
    low = np.r_[0, ranks[:-1] + common[:-1]]
    runs = ranks - low + 1
    left = np.repeat(np.arange(len(ranks)), runs)
    right = np.arange(len(left)) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(low, runs)
    ends = shorter.values[common]
    groups = [np.searchsorted(ends, x.values) for x in (a, b)]
    # back from places in the picked lists to those in the given ones
    word = np.repeat(np.arange(len(turned)), shorter.ends - shorter.starts)[left]
    flip = turned[word]
    short_at, long_at = left - shorter.starts[word], right - longer.starts[word]
    return (*groups, a.starts[word] + np.where(flip, long_at, short_at), b.starts[word] + np.where(flip, short_at, long_at))


def _picked(x: Runs, y: Runs, turned: np.ndarray) -> Runs:
    """The lists of ``x``, or of ``y`` where turned."""
    starts, ends = np.where(turned, y.starts, x.starts), np.where(turned, y.ends, x.ends)
    counts = ends - starts
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)
    second = np.repeat(turned, counts)
    values = np.empty(len(at), np.int64)
    values[second], values[~second] = y.values[at[second]], x.values[at[~second]]
    return Runs.of(values, counts)


def byte_level_ranks(path: str) -> dict[bytes, int]:
    """Ids by byte string of a byte-level BPE tokenizer file, without its special tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec["pre_tokenizer"]
    if spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
        raise ValueError("the tokenizer must be byte-level and leave texts as they are")
    special = {t["content"] for t in spec["added_tokens"]}
    value = {c: b for b, c in enumerate(byte_characters())}
    ids = {t: i for t, i in model["vocab"].items() if t not in special}
    made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if [ids.get(t) for t in made] != sorted(ids.values())[len(value) :]:
        raise ValueError("the merges must be in the order of their ids")
    return {bytes(map(value.__getitem__, t)): i for t, i in ids.items()}


# Letters and digits, and punctuation, that all tables of characters agree on.
_LETTER, _MARK = "0-9A-Za-zÀ-ÖØ-öø-ÿ", r"!-/:-@\[-`{-~"
_CUT = rf"(?:(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)|(?<=[{_LETTER}])(?=[{_MARK}])|(?<=[{_MARK}])(?<!')(?=[{_LETTER}]))"
#: Pieces of a text between places where tokens end; an apostrophe may belong to the letters after it.
WORDS = re.compile(
    rf" ?[{_LETTER}]++(?=[{_MARK}]|[ \n]\S|\Z)| ?[{_MARK}]++(?:(?=[ \n]\S|\Z)|(?<!')(?=[{_LETTER}]))|\n(?=\S)|.(?:(?!{_CUT}).)*+",
    re.DOTALL,
)


class Aligner:
    """Both tokenizers and what they make of each word, once per worker process; its memories are bounded."""

    def __init__(self, ranks: dict[bytes, int], a_model: bytes, pattern: str, b_model: bytes, pieces: Pieces):
        self.a = Codec(ranks, a_model, pattern)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_inner = Encoder(pieces)
        self.b_bytes = pieces.bytes_of
        # a cut is one for B if it lies inside no piece
        cut = all(len(WORDS.findall(t.replace(BLANK, " "))) == 1 for t in pieces.id_of)
        self.words = WORDS.findall if cut else lambda t: [t]
        self.known: dict[str, tuple | None] = {}
        self.kind = pair_kind(self.a.bytes_of, self.b_bytes)
        self.a_sizes, self.b_sizes = (np.array([*map(len, x)], np.int64) for x in (self.a.bytes_of, self.b_bytes))
        # how an id is shown inside a group and at the end of its side of it
        self.a_shown = [f"{i}," for i in range(len(self.a.bytes_of))], [f"{i}|" for i in range(len(self.a.bytes_of))]
        self.b_shown = [f"{i}," for i in range(len(self.b_bytes))], [f"{i};" for i in range(len(self.b_bytes))]

    def learn(self, words: list[str]) -> dict[str, tuple | None]:
        """Token counts, groups and linked pairs of words; none where bytes differ."""
        made: dict[str, tuple | None] = {}
        for start in range(0, len(words), BLOCK):
            block = words[start : start + BLOCK]
            tokens = [self.a.pattern.findall(w) for w in block]
            self.a.learn(set(chain.from_iterable(tokens)))
            a_ids = [b"".join([self.a.known[t] for t in found]) for found in tokens]
            # B puts a blank before whatever it is given
            spaced = iter(self.b.encode([w[1:] for w in block if w[0] == " "], num_threads=1))
            b_ids = [next(spaced) if w[0] == " " else self.b_inner.table(w.replace(" ", BLANK)) for w in block]
            made |= dict.fromkeys(block)
            same = [i for i, w in enumerate(block) if self._same(w, a_ids[i], b_ids[i])]
            made.update(zip([block[i] for i in same], self._aligned([a_ids[i] for i in same], [b_ids[i] for i in same]), strict=True))
        return made

    def _same(self, word: str, a: bytes, b: list[int]) -> bool:
        raw = word.encode("utf-8", "replace")
        return b"".join([self.b_bytes[i] for i in b]) == raw and self.a.decode(a) == raw

    def _aligned(self, a_ids: list[bytes], b_ids: list[list[int]]) -> list[tuple[int, int, int, str, bytes]]:
        if not a_ids:
            return []
        a, b = np.frombuffer(b"".join(a_ids), "<u4").astype(np.int64), np.fromiter(chain.from_iterable(b_ids), np.int64)
        a_count, b_count = np.array([len(x) // 4 for x in a_ids], np.int64), np.array([*map(len, b_ids)], np.int64)
        a_runs, b_runs = Runs.of(np.cumsum(self.a_sizes[a]), a_count), Runs.of(np.cumsum(self.b_sizes[b]), b_count)
        a_group, b_group, i, j = align(a_runs, b_runs)
        pairs = (a[i] * len(self.b_bytes) + b[j]).astype(self.kind)
        links = np.bincount(np.repeat(np.arange(len(a_ids)), a_count)[i], minlength=len(a_ids))
        # tokens in the order in which they are shown: by group, A before B
        shown = np.empty(len(a) + len(b), object)
        order = np.argsort(np.r_[a_group * 2, b_group * 2 + 1], kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        for ids, group, table, at in ((a, a_group, self.a_shown, place[: len(a)]), (b, b_group, self.b_shown, place[len(a) :])):
            last = np.r_[group[1:] != group[:-1], True]
            shown[at] = [table[x][y] for x, y in zip(last.tolist(), ids.tolist(), strict=True)]
        shown = shown.tolist()
        ends = (a_runs.ends + b_runs.ends).tolist()
        starts = (a_runs.starts + b_runs.starts).tolist()
        groups = np.diff(np.r_[0, a_group[a_runs.ends - 1] + 1]).tolist()
        raw, cuts = pairs.tobytes(), (np.r_[0, np.cumsum(links)] * pairs.itemsize).tolist()
        return [
            (x, y, n, "".join(shown[s:e])[:-1], raw[c:d])
            for x, y, n, s, e, c, d in zip(a_count.tolist(), b_count.tolist(), groups, starts, ends, cuts, cuts[1:], strict=False)
        ]

    def texts(self, texts: list[str]) -> list[tuple[int, int, int, str, bytes]]:
        """The same for whole texts; zeros where one has no tokens."""
        split = [self.words(" " + t) if t else [] for t in texts]
        new = list({w for words in split for w in words if w not in self.known})
        found = self.learn(new)
        out = []
        for words in split:
            parts = [found[w] if w in found else self.known[w] for w in words]
            if not parts or None in parts:
                out.append((0, 0, 0, "", b""))
                continue
            groups = hashlib.sha256(";".join([p[3] for p in parts]).encode()).hexdigest()
            counts = (sum([p[i] for p in parts]) for i in range(3))
            out.append((*counts, groups, b"".join([p[4] for p in parts])))
        if len(self.known) + len(found) > REMEMBERED:  # common words are in this run too
            self.known = {w: self.known[w] for words in split for w in words if w in self.known}
        self.known.update((w, p) for w, p in found.items() if len(w) <= SHORT)
        return out


def runs(texts: list[str | None]) -> Iterator[list[str]]:
    """Texts in runs of some characters, so that few calls serve many short ones."""
    run, size = [], 0
    for text in texts:
        run.append(text or "")
        size += len(run[-1])
        if size > RUN:
            yield run
            run, size = [], 0
    if run:
        yield run


def pair_kind(a: list, b: list) -> type:
    """The smaller integer type that holds the key of every id pair."""
    return np.int32 if len(a) * len(b) < 2**31 else np.int64


_MADE: dict[str, Aligner] = {}


def aligner(digest: str, *args) -> Aligner:
    """The aligner of this worker process, which later tasks find with its memories."""
    if digest not in _MADE:
        _MADE.clear()
        _MADE[digest] = Aligner(*args)
    return _MADE[digest]


def _links(docs: DataFrame, a_path: str, pattern: str, b_path: str) -> tuple[DataFrame, int, type]:
    """``row``, ``doc_id``, the counts and digest, and ``pairs`` (keys of linked ids) of every row; the size of B; the type of a key."""
    ranks = byte_level_ranks(a_path)
    with open(b_path, "rb") as file:
        b_model = file.read()
    pieces = Pieces(b_model)
    args = (ranks, sentencepiece_model(ranks), pattern, b_model, pieces)
    digest = hashlib.sha256(repr(sorted(ranks.items())).encode() + pattern.encode() + b_model).hexdigest()
    sent = docs.sparkSession.sparkContext.broadcast((digest, *args))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = aligner(*sent.value)
        size = made.kind().itemsize
        for batch in slices(batches):
            rows = [row for run in runs(batch.column(2).to_pylist()) for row in made.texts(run)]
            columns = [batch.column(0), batch.column(1)]
            columns += [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            columns += [pa.array([len(r[4]) // size for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.string())]
            columns.append(pa.array([r[4] for r in rows], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = pair_kind([b""] * (max(ranks.values(), default=-1) + 1), pieces.bytes_of)
    return materialize(rows.mapInArrow(run, f"row long, doc_id long, {ALIGNED}, pairs binary"), "links"), len(pieces.bytes_of), kind


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(keys, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, at, counts)
    return distinct, total


def _counted(links: DataFrame, kind: type) -> DataFrame:
    """``pair`` and ``n``, the number of links that hold it; each task adds up what it can hold before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])

        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in slices(batches, "pairs"):
            here, n = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), return_counts=True)
            keys, counts = _summed(np.r_[keys, here.astype(np.int64)], np.r_[counts, n])
            if len(keys) > HELD:
                yield out()
                keys, counts = keys[:0], counts[:0]
        yield out()

    parts = links.select("pairs").mapInArrow(run, "pair long, n long")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"))


def _head(counts: DataFrame) -> tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The least count, a power of two, that at most ``HEAD`` pairs reach, and these pairs."""
    bands = {r.band: r.pairs for r in counts.groupBy(F.length(F.bin("n")).alias("band")).agg(F.count("*").alias("pairs")).collect()}
    band, held = max(bands, default=0) + 1, 0
    while band - 1 in range(1, 65) and held + bands.get(band - 1, 0) <= HEAD:
        band -= 1
        held += bands.get(band, 0)
    least = 1 << (band - 1)
    table = counts.where(F.col("n") >= least).select("pair", "n", "best").toArrow()
    pair, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    return least, (pair[order], n[order], best[order].astype(np.int64))


def _measured(links: DataFrame, kind: type, head: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """By row: sums over the links of the head's pairs, and each other pair with its number of links."""
    sent = links.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = sent.value
        for batch in slices(batches, "pairs"):
            row, lists = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            keys = np.frombuffer(b"".join(lists), kind).astype(np.int64)
            ends = np.cumsum([0, *(len(x) // kind().itemsize for x in lists)])
            at = np.minimum(np.searchsorted(pair, keys), max(0, len(pair) - 1))
            known = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
            sums = [np.r_[0, np.cumsum(np.where(known, v[at], 0) if len(pair) else np.zeros(len(keys), np.int64))] for v in (best, n)]
            best_sum, n_sum = (s[ends[1:]] - s[ends[:-1]] for s in sums)
            rare, owner = keys[~known], np.repeat(np.arange(len(row)), np.diff(ends))[~known]
            order = np.lexsort((rare, owner))
            rare, owner = rare[order], owner[order]
            starts = np.flatnonzero(np.r_[True, (rare[1:] != rare[:-1]) | (owner[1:] != owner[:-1])][: len(rare)])
            often = np.diff(np.r_[starts, len(rare)])
            none = pa.nulls(len(row), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(row), none, none, pa.array(best_sum), pa.array(n_sum)], names=names)
            none = pa.nulls(len(starts), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(row[owner[starts]]), pa.array(rare[starts]), pa.array(often), none, none], names=names)

    names = ["row", "pair", "links", "n_best", "count_sum"]
    return links.select("row", "pairs").mapInArrow(run, "row long, pair long, links long, n_best long, count_sum long")


def alignment(docs: DataFrame, a_path: str, pattern: str, b_path: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers over every whole text.

    A is a byte-level BPE tokenizer file whose ``pattern`` parts letters and
    digits, punctuation and white space, but for an apostrophe before letters
    and the blank before a word; it encodes a blank and the text.  B is
    a sentencepiece BPE model that puts the blank there itself.  Special tokens
    are plain text to both.

    Result per row: ``doc_id``, numbers of tokens ``n_a`` and ``n_b``,
    ``n_groups`` and ``n_links``, ``n_best`` (links whose id pair is linked as
    often in all texts as any pair of its B id), ``count_sum`` (over links, how
    often their pair is linked in all texts) and ``groups_sha256``, the digest
    of ``a1,a2|b1;a3|b2,b3``.

    A text that is null or empty, or whose bytes either tokenizer changes (a
    text with U+2581), has no tokens: zeros and an empty digest.  Repeated rows
    count each; a null id stays null; an empty table gives an empty result;
    other columns are ignored.

    Links are written once.  Pairs are added up per task and then shuffled by
    pair.  The counts of the commonest pairs, at most ``HEAD``, are sent to the
    tasks; what a text holds of the others is joined with their counts.  How
    often a B id is linked at best has one row per id of B and is sent too.
    """
    links, size, kind = _links(docs, a_path, pattern, b_path)
    counts = materialize(_counted(links, kind), "pairs").withColumn("b", F.col("pair") % size)
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    counts = materialize(counts.join(F.broadcast(best), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    least, head = _head(counts)
    parts = materialize(_measured(links, kind, head), "measured")
    rare = parts.where("pair is not null").join(counts.where(F.col("n") < least), "pair")
    rare = rare.select("row", F.when(F.col("best"), F.col("links")).otherwise(0).alias("n_best"), (F.col("links") * F.col("n")).alias("count_sum"))
    sums = parts.where("pair is null").select("row", "n_best", "count_sum").unionByName(rare)
    sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return links.join(sums, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
