"""Encoding by the table of prefixes against the library that owns the model."""

from __future__ import annotations

import hashlib
import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from daytally.llm import prefix_table, queries

SF_DIR = "/root/testdata/sf0.001"
HARD = [
    None,
    "",
    " ",
    "  \n\t ",
    " " * 37 + "x" + " " * 5,
    "a",
    "a▁b ▁ c",
    "<s></s><unk><0x41> ⁇ ",
    "é日本語😀\x00\x01 ́½ don't 123m² m²n",
    "​﻿\U0010ffff",
    "a" * 40_000,
    "ab" * 20_000 + "\n" * 3_000,
    "long " * 30_000,
    "日本語" * 5_000,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)


@pytest.fixture(scope="module")
def encoder():
    with open(queries.MODEL, "rb") as file:
        return prefix_table.Encoder(prefix_table.Pieces(file.read()))


def want(library, text):
    ids = library.encode(text or "")
    decoded = library.decode(ids)
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids, decoded)


def test_ids_are_those_of_the_library(spark, library):
    hard = [(i, t) for i, t in enumerate(HARD)] + [(None, "no id"), (3, HARD[3])]
    frame = spark.createDataFrame(hard, "doc_id long, text string").unionByName(
        spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    )
    frame = frame.withColumns({c: F.lit("x") for c in ("ids", "decoded", "n_tokens", "ids_sha256")})
    got = prefix_table.encode(frame, queries.MODEL, ("ids", "decoded"))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    texts = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got.collect()) == sorted((str(i), *want(library, t)) for i, t in texts)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert prefix_table.encode(none, queries.MODEL).collect() == []


def test_random_texts(library, encoder):
    rng = random.Random(1)
    vocabulary = list(encoder.p.id_of)
    characters = "ab cd  eé日本語😀\n\t\x00▁ thein<0x41>́²."
    for n in range(3000):
        pool = characters if n % 2 else vocabulary
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 30))).replace("▁", " " if n % 3 else "▁")
        ids = library.encode(text)
        assert encoder.encode(text) == ids, text
        assert encoder.decode(ids).decode() == library.decode(ids), text


def test_pairs_by_their_edges_are_pairs_by_merging(encoder):
    """The compatibility test against encoding both pieces in full."""
    rng = random.Random(2)
    pieces = sorted(encoder.p.whole)
    for _ in range(20_000):
        left, right = rng.choice(pieces), rng.choice(pieces)
        text = encoder.p.text[left] + encoder.p.text[right]
        assert encoder.compatible(left, right) == (encoder.p.merge(text)[0] == [left, right]), text


def test_the_table_of_a_whole_text_is_that_of_its_segments(encoder):
    for text in HARD[4:]:
        whole = prefix_table.BLANK + text[:3000].replace(" ", prefix_table.BLANK)
        assert encoder.table(whole) == encoder.encode(text[:3000])


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    spec.trainer_spec.model_type = 1
    with pytest.raises(ValueError, match="BPE"):
        prefix_table.Pieces(spec.SerializeToString())
