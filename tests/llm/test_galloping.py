"""Alignment against both libraries and a comparison of all token pairs of a text."""

from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daytally.llm import galloping, queries

SF_DIR = "/root/testdata/sf0.001"
HARD = [
    None,
    "",
    " ",
    "  two  blanks \t\n and more \n",
    "a▁b",
    "▁",
    "<|endoftext|> <s></s><unk><0x41> ⁇ ",
    "é日本語😀\x00\x01 ́½ don't 123m² m²n  \x1c a \x85 b\xa0c",
    "a" * 3000,
    "long " * 2000,
    "日本語" * 500,
    "tabs\tand\nlines it's we'll  they 've",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(queries.BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)


def plain(texts, libraries):
    """One row per text from what the libraries give, pair by pair."""
    a, b = libraries
    value = {c: i for i, c in enumerate(galloping.byte_characters())}
    found = []
    for _, text in texts:
        groups, links, sizes = [], [], (0, 0)
        if text:
            a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            a_bytes = [bytes(value[c] for c in a.id_to_token(i)) for i in a_ids]
            b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                sizes = (len(a_ids), len(b_ids))
                owner = [[k for k, t in enumerate(x) for _ in t] for x in (a_bytes, b_bytes)]
                links = [(a_ids[i], b_ids[j]) for i, j in sorted(set(zip(*owner, strict=True)))]
                left, right = [], []
                for at, (i, j) in enumerate(zip(*owner, strict=True)):
                    left += [i] if not at or owner[0][at - 1] != i else []
                    right += [j] if not at or owner[1][at - 1] != j else []
                    if at + 1 == len(owner[0]) or (owner[0][at + 1] != i and owner[1][at + 1] != j):
                        groups.append(",".join(str(a_ids[k]) for k in left) + "|" + ",".join(str(b_ids[k]) for k in right))
                        left, right = [], []
        found.append((sizes, groups, links))
    count = Counter(link for _, _, links in found for link in links)
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return sorted(
        (
            str(i), *sizes, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for (i, _), (sizes, groups, links) in zip(texts, found, strict=True)
    )


@pytest.fixture(scope="module")
def table(spark, libraries):
    hard = [(i, t) for i, t in enumerate(HARD)] + [(None, "no id"), (3, HARD[3])]
    frame = spark.createDataFrame(hard, "doc_id long, text string").unionByName(
        spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    )
    frame = frame.withColumns({c: F.lit("x") for c in ("row", "pair", "n", "b", "best", "links", "n_best")})
    return frame, plain([(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()], libraries)


def result(frame):
    got = galloping.alignment(frame, queries.BYTE_LEVEL, public_tokenizers.PATTERN, queries.MODEL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((str(r[0]), *tuple(r)[1:]) for r in got.collect())


@pytest.mark.parametrize("head", [galloping.HEAD, 500, 0])
def test_rows_are_those_of_the_libraries(table, monkeypatch, head):
    """Whether the counts of all pairs, of some or of none are sent to the tasks."""
    monkeypatch.setattr(galloping, "HEAD", head)
    assert result(table[0]) == table[1]


def test_empty_table_and_texts_without_tokens(spark):
    assert result(spark.createDataFrame([], "doc_id long, text string")) == []
    none = spark.createDataFrame([(1, None), (2, ""), (2, "▁")], "doc_id long, text string")
    assert result(none) == [("1", 0, 0, 0, 0, 0, 0, ""), ("2", 0, 0, 0, 0, 0, 0, ""), ("2", 0, 0, 0, 0, 0, 0, "")]


def test_a_task_that_holds_few_pairs_counts_the_same(spark, monkeypatch):
    frame = spark.createDataFrame([(np.array([i % 7, i % 11], np.int32).tobytes(),) for i in range(200)], "pairs binary")
    want = Counter(x for i in range(200) for x in (i % 7, i % 11))
    monkeypatch.setattr(galloping, "HELD", 2)
    assert {r.pair: r.n for r in galloping._counted(frame, np.int32).collect()} == want


def _rising(rng, size, share):
    return sorted({*rng.sample(range(1, size + 1), int(size * share)), size})


@pytest.mark.parametrize("alone", [0, 5, 1000])
def test_galloping_ranks_and_overlaps(monkeypatch, alone):
    """Lists that go alone and lists that go together, of one to some hundred ends."""
    monkeypatch.setattr(galloping, "ALONE", alone)
    rng = random.Random(1)
    sizes = [rng.choice([1, 2, 5, 9, 300]) for _ in range(300)]
    lists = [[_rising(rng, n, rng.choice([0, 0.1, 0.5, 1])) for n in sizes] for _ in range(2)]
    assert all(galloping.gallop(a, b) == [bisect_left(b, x) for x in a] for a, b in zip(*lists, strict=True))
    base = [sum(sizes[:i]) for i in range(len(sizes))]
    a, b = (galloping.Runs.of(np.array([x + s for s, one in zip(base, each, strict=True) for x in one]), np.array([*map(len, each)])) for each in lists)
    a_group, b_group, left, right = galloping.align(a, b)
    spans = [[(s, e) for s, e in zip([0, *x.values.tolist()], x.values.tolist())] for x in (a, b)]
    owner = [[i for i, (s, e) in enumerate(each) for _ in range(s, e)] for each in spans]
    assert sorted(zip(left.tolist(), right.tolist(), strict=True)) == sorted(set(zip(*owner, strict=True)))
    common = sorted({*a.values.tolist()} & {*b.values.tolist()})
    for groups, runs in ((a_group, a), (b_group, b)):
        assert groups.tolist() == [bisect_left(common, x) for x in runs.values.tolist()]


def test_the_shorter_list_drives():
    class Counted(list):
        read = 0

        def __getitem__(self, i):
            Counted.read += 1
            return super().__getitem__(i)

    galloping.gallop([5, 90_000, 100_000], Counted(range(1, 100_001)))
    assert Counted.read < 150


def test_texts_are_cut_where_both_tokenizers_cut(libraries):
    a, b = libraries
    texts = ["it's a _b_ (c)d 'e' f\n\ng\nh  i,j. k's", "a1b2 x.y\tz ²½m² \u00e9t\u00e9!", " 'tis don't'x", "\n a", "\x1c b"]
    for text in texts:
        words = galloping.WORDS.findall(" " + text)
        assert "".join(words) == " " + text
        whole = a.encode(" " + text, add_special_tokens=False).ids
        assert [i for w in words for i in a.encode(w, add_special_tokens=False).ids] == whole
        at, ends = 0, set()
        for i in b.encode(text):
            at += 1 if b.is_byte(i) else len(b.id_to_piece(i).replace("▁", " ").encode())
            ends.add(at)
        assert {len("".join(words[: n + 1]).encode()) for n in range(len(words))} <= ends
    assert galloping.WORDS.findall(" it's, a\nb") == [" it", "'s", ",", " a", "\n", "b"]
