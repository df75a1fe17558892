"""Each operator against a plain version on small tables, hard rows included."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from daytally import scratch
from daytally.llm import brown, byte_bpe, components, lsh_forest, minhash, mixing, pii, queries, ratings, simhash, suffixes, toxicity
from daytally.llm.words import WordHashes, crc_of_id

SF_DIR = "/root/testdata/sf0.001"

HARD = [
    (None, "no id"),
    (-1, None),
    (-2, ""),
    (-3, " \t\n "),
    (-4, "one"),
    (-5, "two words"),
    (-6, "same text again and again and again"),
    (-7, "same text again and again and again"),
    (-7, "same text again and again and again"),
    (-8, "long " * 30_000),
    (-9, "a" * 40_000),
    (-10, "é日本語😀 \x00\x01 ́ ½ don't 123"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with hard rows, and columns whose names clash with results and helpers."""
    hard = spark.createDataFrame([(i, t, "en", None, 0) for i, t in HARD], "doc_id long, text string, lang string, source string, n_chars long")
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").unionByName(hard)
    clash = {c: F.lit("x") for c in ("score", "fingerprint", "key", "run", "_kept", "digest", "tokens", "weight", "spans")}
    return table.withColumns(clash).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_every_operator_has_a_query():
    found = {int(m[1]) for q in entry.queries() if (m := re.match(r"op(\d+)_", q))}
    assert found == set(range(1, 14)) and "pipeline" in entry.queries()


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert lsh_forest.nearest(vectors, vectors).count() == 0
    assert byte_bpe.encode(none, queries.VOCABULARY, public_tokenizers.PATTERN).count() == 0
    assert pii.report(none).count() == 0
    assert suffixes.remove_repeats(none).count() == 0
    labels = spark.createDataFrame([], "doc_id long, grade int, label int")
    assert ratings.rate(none, ratings.fit(none, labels)).count() == 0
    assert brown.score(none, brown.fit(none), F.lit(False)).count() == 0
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0
    assert mixing.mix(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert minhash.fingerprint_edits(none).count() == 0


# 1


@pytest.mark.parametrize("group", [lsh_forest.QUERY_GROUP, 10])
def test_nearest_neighbours(spark, group):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((900, 16)) * rng.uniform(0.5, 2, (900, 1))
    x[100:160] = x[100]  # a common vector
    rows = [(i, [float(np.float32(v)) for v in x[i]]) for i in range(900)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16), (1004, [float("inf")] * 16), (None, rows[0][1])]
    vectors = spark.createDataFrame(rows + odd + rows[:1], "vec_id long, embedding array<float>")
    got = lsh_forest.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20, shard=300, group=group).collect()
    a = np.array([r[1] for r in rows])
    hit = total = 0
    for q in range(0, 900, 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21)) and q not in {r.vec_id for r in mine}
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        scores = a @ a[q]
        assert all(abs(scores[r.vec_id] - r.score) < 1e-9 for r in mine)
        want = sorted((i for i in range(900) if i != q), key=lambda i: (-scores[i], i))[:20]
        hit += len({r.vec_id for r in mine} & set(want))
        total += 20
    assert len(got) == total and hit / total >= 0.9


def test_fewer_candidates_than_wanted(spark):
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = lsh_forest.nearest(vectors, vectors.where("vec_id = 0")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 1.0), (1, 0.0)]


def test_vectors_of_several_lengths(spark):
    rows = [(i, [float(i), 1.0, 2.0]) for i in range(30)] + [(40 + i, [float(i)] * 2) for i in range(20)] + [(60, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = lsh_forest.nearest(vectors, vectors.where("vec_id in (0, 20, 40, 60)"), 3).collect()
    assert {(r.query_id, r.vec_id) for r in got} == {(0, 1), (0, 2), (0, 3), (20, 29), (20, 28), (20, 27)}


def test_the_last_share_is_the_whole_shard():
    x = np.random.default_rng(5).standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    shard = lsh_forest.Shard(x, lsh_forest.planes(65), 1.0)
    for found in shard.candidates(x[:20], lsh_forest.SHARES, 21):
        assert all(len(f) >= s * 3000 for f, s in zip(found, lsh_forest.SHARES, strict=True))
        assert all(np.isin(a, b).all() for a, b in zip(found, found[1:], strict=False))


def test_vectors_without_structure_reach_the_recall(spark):
    x = np.random.default_rng(6).standard_normal((4000, 384))
    x /= np.linalg.norm(x, axis=1)[:, None]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = lsh_forest.nearest(vectors, vectors.where("vec_id % 20 = 0")).collect()
    products = x[::20] @ x.T
    products[np.arange(200), np.arange(0, 4000, 20)] = -2
    want = {(int(q) * 20, int(i)) for q, best in enumerate(np.argsort(-products, axis=1)[:, :20]) for i in best}
    assert len(want & {(r.query_id, r.vec_id) for r in got}) >= 0.96 * len(want)


# 2


def test_byte_bpe_is_that_of_the_library(docs, texts):
    ranks = byte_bpe.read_ranks(queries.VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = byte_bpe.encode(docs, queries.VOCABULARY, public_tokenizers.PATTERN, ("ids", "decoded")).collect()
    want = []
    for i, t in texts:
        ids = library.encode_ordinary(t or "")
        want.append((str(i), len(ids), ids, hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), (t or "").encode()))
    assert sorted(want) == sorted((str(r.doc_id), r.n_tokens, r.ids, r.ids_sha256, bytes(r.decoded)) for r in got)


# 3

_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_spans(text):
    out = []
    for kind, pattern in _KINDS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c.isdigit()]
            odd = sum(2 * d - 9 * (d > 4) for d in digits[-2::-2])
            if {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and (sum(digits[-1::-2]) + odd) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_personal_data_has_the_base_spans(spark, docs, texts):
    more = [
        (-20, "a@b.c-d@e.f a@b.c_d@e.f +49 (0) 123-456.789x 1.2.3.4.5 999.1.1.1 00012.1.2.3 4111 1111 1111 1111x4111-1111-1111-1112"),
        (-21, "\x01 é😀 x@y.zz \x02 1.1.1.256 " + " ".join(f"u{i}@h{i}.com 10.0.0.{i % 300}" for i in range(400))),
        (-22, "9" * 20_000 + " +" + "1" * 15),
    ]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = {(str(r.doc_id), r.base_sha256) for r in pii.report(both).collect()}
    assert got == {(str(i), hashlib.sha256(_plain_spans(t or "").encode()).hexdigest()) for i, t in texts + more}


def test_context_finds_identifiers_that_no_pattern_knows(spark):
    rows = [(i, f"please write her mail address {'u%d@x.org' % i if i % 10 else 'u%d(at)x.org' % i} today {i} apples") for i in range(100)]
    got = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        start = t.index(f"u{i}")
        kind = "email" if i % 10 else "context"
        assert got[i] == f"{kind}:{start}:{t.index(' today')}"


@pytest.mark.parametrize("lead", ["", "user {i} pin ", "12 {i} ", "please write to " + "x" * 40 + " ", "write " + "y" * 200 + " to "])
def test_context_reaches_every_place_of_a_record(spark, lead):
    rows = [(i, lead.format(i=i) + ("u%d@x.org" if i % 10 else "u%d(at)x.org") % i + " today") for i in range(100)]
    got = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        place = f"{t.index(f'u{i}' + ('@' if i % 10 else '('))}:{t.index(' today')}"
        assert got[i] == f"{'email' if i % 10 else 'context'}:{place}"


def test_words_of_a_list_are_those_really_before(spark):
    rows = [(1, "4711 pin 0815 iban DE89 a@b.cc"), (2, "call +49 123 456 7890 now 5")]
    scanned = pii._scan(spark.createDataFrame(rows, "doc_id long, text string"))
    ids = {r.key: r.doc_id for r in scanned.collect()}
    got = {1: [], 2: []}
    for r in sorted(pii._candidates(scanned).collect(), key=lambda r: r.start):
        got[ids[r.key]].append(r.pattern)
    assert got == {1: ["0 0", "@ pin", "@ iban", "iban @"], 2: ["0 call", "", "", "", "@ now"]}


def test_redaction_keeps_columns_and_rows(spark):
    rows = [(1, "call +4912345678901 or a@b.cc", 3), (None, None, 4), (2, "nothing", 7), (2, "nothing", 7)]
    got = pii.redact(spark.createDataFrame(rows, "doc_id int, text string, n_chars int"))
    assert got.dtypes == [("doc_id", "int"), ("text", "string"), ("n_chars", "int")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(str, [(1, "call [PHONE] or [EMAIL]", 23), (None, None, 4), (2, "nothing", 7), (2, "nothing", 7)])
    )


def _plain_redaction(text, spans):
    out, at = "", 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def test_redaction_is_that_of_the_spans(spark, docs):
    """Whole texts, overlapping spans, places at and around the borders of blocks."""
    rng = random.Random(8)
    more = []
    for i in range(60):
        words = ["x" * rng.randint(1, 300), "é😀\n", "a@b.cc", "+49 (0) 123-456.789", "1.2.3.4", "4111 1111 1111 1111", "+4111111111111111 4111111111111111"]
        more.append((-100 - i, "".join(rng.choice(words) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(1, 30)))))
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string")).where("doc_id is not null")
    spans = {(r.doc_id, r.digest): [tuple(s) for s in [*r.base, *r.found]] for r in pii.detect(table).collect()}
    digests = table.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest")).collect()
    want = sorted((r.doc_id, str(r.text and _plain_redaction(r.text, spans[r.doc_id, r.digest]))) for r in digests)
    assert sorted((r.doc_id, str(r.text)) for r in pii.redact(table).collect()) == want
    assert sum(len(s) for s in spans.values()) > 300


def test_a_text_of_many_emails_takes_seconds(spark):
    n = 50_000
    text = " ".join(f"to u{i}@x.org" for i in range(n))
    table = spark.createDataFrame([(1, text), (2, "a" * 1_000_000), (3, "1" * 1_000_000)], "doc_id long, text string")
    start = time.time()
    got = {r.doc_id: r for r in pii.report(table).collect()}
    assert got[1].n_email == n and got[2].n_email == 0
    texts = {r.doc_id: r.text for r in pii.redact(table).collect()}
    assert texts[1] == " ".join(["to [EMAIL]"] * n) and texts[2] == "a" * 1_000_000
    assert time.time() - start < 60


# 4


def _plain_removal(rows):
    rank = lambda i: math.inf if i is None else i
    first: dict[bytes, float] = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(first.get(b[p : p + 50], math.inf), rank(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < rank(i):
                gone[p : p + 50] = b"\1" * 50
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("run_bytes", "segment", "crowded"), [(4 << 20, 1 << 21, 50_000), (15_000, 700, 50_000), (15_000, 1 << 21, 2)])
def test_repeats_are_removed(spark, docs, texts, monkeypatch, run_bytes, segment, crowded):
    monkeypatch.setattr(suffixes, "RUN_BYTES", run_bytes)
    monkeypatch.setattr(suffixes, "SEGMENT", segment)
    rng = random.Random(1)
    base = "".join(rng.choice("ab ") for _ in range(400))
    more = [(10**6 + i, "".join(rng.choice(["x", "é"]) for _ in range(rng.randint(0, 60))) + base[rng.randint(0, 100) : rng.randint(100, 400)]) for i in range(120)]
    more += [(2 * 10**6 + i, "\0" * rng.randint(30, 80) + base[:60] + "q" * rng.randint(0, 99)) for i in range(10)] + [(None, "b" * 10 + base)]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = suffixes.remove_repeats(both, crowded).drop("kept").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == _plain_removal(texts + more)


def test_only_suffixes_that_can_share_a_window_are_merged(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(100)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = some(60)  # its words, and so 16 bytes of it, are everywhere
    rows = [(i, some(300)) for i in range(40)] + [(100 + i, f"{some(50)} {passage}" + " " * (i % 3)) for i in range(60)]
    path = Path(scratch.shared_dir(spark).removeprefix("file://"))
    before = set(path.glob("suffixes-*"))
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).drop("kept").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == _plain_removal(rows)
    (made,) = set(path.glob("suffixes-*")) - before
    blobs = [r.blob for r in spark.read.parquet(str(made)).where("rest is not null").collect()]
    assert sum(len(suffixes._unpacked(b, *suffixes._ITEM)[0]) for b in blobs) < 400  # of about 13000 anchors


def test_spans_of_one_document_meet_and_of_two_do_not():
    covers = [suffixes._packed(*np.array(c)) for c in ([[110, 0], [110, 10]], [[60], [60]], [[5], [5]])]  # first and last windows
    spans = suffixes._intervals(covers, np.array([110, 110, 220]))
    assert [a.tolist() for a in spans] == [[0, 110], [110, 160], [0, 2]]


def test_loser_tree_merges_and_knows_shared_prefixes():
    rng = random.Random(2)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(rng.randint(0, 40))) for _ in range(7)]
    shared = [suffixes.front_code(np.array([list(s) for s in r], np.uint8).reshape(-1, 12)) for r in runs]
    decoded = [suffixes.front_decode(n, rest, 12) for n, rest in shared]
    assert decoded == runs
    merged = list(suffixes.LoserTree(runs, [n.tolist() for n, _ in shared], 12))
    strings = [runs[r][i] for r, i, _ in merged]
    assert strings == sorted(s for r in runs for s in r)
    for (a, b), (_, _, known) in zip(zip(strings, strings[1:], strict=False), merged[1:], strict=True):
        assert known == next((k for k in range(12) if a[k] != b[k]), 12)


# 5


def test_ordinal_model_orders_grades_and_rejects_junk(spark):
    rng = random.Random(3)
    kinds = [["bad", "worse"], ["fair", "plain"], ["good", "fine"]]
    rows = [(i, " ".join(rng.choice(kinds[i % 3] + ["the", "of"]) for _ in range(30)), i % 3) for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = ratings.fit(table, table.where("doc_id < 400").select("doc_id", "grade"))
    assert model.grades == [0, 1, 2] and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in ratings.rate(table, model).collect()}
    for i, _, g in rows[400:]:
        assert round(got[i].expected_grade) == g and got[i].keep == (g >= 1)


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = queries.labels(spark, "/root/testdata/sf0.01")
    held = crc_of_id(F.col("doc_id")) % 5 == 0
    rated = ratings.rate(docs, ratings.fit(docs, queries.grades(labels.where(~held)))).join(labels.where(held), "doc_id").collect()
    assert np.mean([r.keep == (r.quality == 1) for r in rated]) > 0.9


def test_without_grades_everything_stays(docs, spark):
    one = spark.createDataFrame([(-4, 1), (None, 0), (-5, None)], "doc_id long, grade int")
    kept = ratings.select(docs, ratings.fit(docs, one))
    assert kept.columns == docs.columns and kept.count() == docs.count()


# 6


def test_scores_of_the_language_model(docs, texts):
    out = F.coalesce(crc_of_id(F.col("doc_id")) % 7 == 2, F.lit(False))
    model = brown.fit(docs.where(~out))
    got = brown.score(docs, model, out).collect()
    counts = Counter()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    for i, t in texts:
        if not held(i):
            counts.update((t or "").encode().lower().split())
            counts[brown.END] += 1
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in texts:
        tokens = [*(t or "").encode().lower().split(), brown.END]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        want.append((str(i), held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 5)))
    assert sorted(want) == sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got)
    out_of_sample = [r for r in got if r.held_out]
    assert sum(r.score for r in out_of_sample) > sum(r.base_score for r in out_of_sample)
    # every class's transitions and every word distribution sum to one
    assert np.allclose((10**model.log_transitions).sum(axis=1), 1)


def test_exchange_groups_words_of_one_kind():
    rng = np.random.default_rng(4)
    kind = np.arange(30) % 3
    bigrams = np.array([[rng.poisson(40) if kind[j] == (kind[i] + 1) % 3 else 0 for j in range(30)] for i in range(30)], float)
    member = brown.exchange(bigrams, 3)
    assert len({(kind[i], member[i]) for i in range(30)}) == 3


def test_best_class_of_each_word_against_the_whole_likelihood():
    rng = np.random.default_rng(6)
    n, end = 40, brown.END_CLASS
    for _ in range(5):
        words = np.r_[-1, rng.integers(0, n, 400), -1, rng.integers(0, n, 200), -1]
        words[1:-1][rng.random(len(words) - 2) < 0.1] = -1  # ends of texts
        words[5:9] = 3
        old, start = rng.integers(0, 6, n), rng.integers(0, 6, n)

        def table(member):
            c = np.where(words < 0, end, member[words])
            return np.bincount(c[:-1] * brown.ALL_CLASSES + c[1:], minlength=brown.ALL_CLASSES**2).reshape(brown.ALL_CLASSES, -1).astype(float)

        def gain(w, c):
            member = old.copy()
            member[w] = c
            t = table(member)
            return sum(f * brown._entropy(x).sum() for f, x in ((1, t), (-1, t.sum(axis=0)), (-1, t.sum(axis=1)))) + brown.NAMING * (c == start[w])

        counts, c = np.zeros((n, brown.SLOTS), int), np.where(words < 0, end, old[words])
        for i, w in enumerate(words):
            if w >= 0:
                counts[w, brown.OWN if words[i - 1] == w else c[i - 1]] += 1
                if words[i + 1] != w:
                    counts[w, brown.AFTER + c[i + 1]] += 1
        at, slot = np.nonzero(counts)
        new = brown.best_classes(at, slot, counts[at, slot], old, start, table(old))
        assert (new != old).any()
        for w in np.unique(at):
            best = max(gain(w, c) for c in range(end))
            assert math.isclose(gain(w, new[w]), best, abs_tol=1e-6)
        moved = brown._moved(at * brown.SLOTS + slot, counts[at, slot], old, np.where(np.arange(n) == 3, new, old))
        member = np.where(np.arange(n) == 3, new, old)
        assert (table(old) + moved.reshape(table(old).shape) == table(member)).all()


@pytest.mark.parametrize("most", [brown.HEAD, 100])
def test_every_word_of_the_training_texts_is_clustered(spark, most):
    """Words beyond the most frequent 1000, each seen some times, stand by turns before and after frequent words of two kinds."""
    rng = random.Random(5)
    rare = [f"{'xy'[i % 2]}{i:04d}" for i in range(1400)]
    rows = []
    for i in range(9000):
        k = rng.randrange(2)
        w = rare[2 * (i % 700) + k]
        rows.append((i, f"a{k}{rng.randrange(15)} {w} b{k}{rng.randrange(15)} " + (f"{w} {w} {rng.choice(rare[k::2])} b{k}1" if i % 50 == 0 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = brown.fit(docs, most)
    class_of = model.class_of | {bytes(r.word): r.c for r in model.rare.collect()}
    counts = Counter(w for _, t in rows for w in t.encode().split())
    assert set(class_of) == set(counts)
    # by surface all words with digits are in one class; their neighbours tell them apart, if the start has some of either kind
    kinds = [Counter(class_of[w.encode()] for w in rare[k::2]) for k in (0, 1)]
    assert most == 100 or sum(max(k[c] for k in kinds) for c in kinds[0].keys() | kinds[1].keys()) > 0.8 * len(rare)
    # transitions and scores as plain code has them
    table, end = np.zeros((brown.ALL_CLASSES, brown.ALL_CLASSES)), brown.END_CLASS
    for _, t in rows:
        c = [end, *(class_of[w] for w in t.encode().split()), end]
        np.add.at(table, (c[:-1], c[1:]), 1)
    share = (table.sum(axis=0) + 1) / (table.sum(axis=0) + 1).sum()
    smooth = np.log10((table + brown.SMOOTHING * share) / (table.sum(axis=1, keepdims=True) + brown.SMOOTHING))
    assert np.allclose(smooth, model.log_transitions)
    sizes = Counter()
    for w, n in counts.items():
        sizes[class_of[w]] += n + 1
    more = spark.createDataFrame([(-1, "new1 a01 x0000 x0002 y0001 newer1 newest"), (-2, None), (-3, "x0000"), (-3, "x0000")], docs.schema)
    got = brown.score(docs.unionByName(more), model, F.lit(False)).collect()
    texts = Counter()
    for i, t in [*rows, *((r.doc_id, r.text) for r in more.collect())]:
        found = (t or "").encode().split()
        c = [end, *(class_of[w] if w in class_of else int(model.unseen[brown.surface(w)]) for w in found), end]
        want = smooth[c[:-1], c[1:]].sum() + sum(math.log10((counts[w] + 1) / (sizes[k] + 1)) for w, k in zip(found, c[1:-1], strict=True))
        texts[i, len(found) + 1, sum(counts[w] > 0 for w in found) + 1, round(want, 5)] += 1
    assert texts == Counter((r.doc_id, r.n_tokens, r.n_known, round(r.score, 5)) for r in got)


# 7


def test_toxicity_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = queries.op7_boosted_toxicity(spark, sf_dir).join(queries.labels(spark, sf_dir), "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    caught = [r.predicted for r in got if r.toxic == 1]
    wrong = [r.predicted for r in got if r.toxic == 0]
    assert np.mean(caught) > 0.85 and np.mean(wrong) < 0.02


def test_toxicity_of_hard_rows(docs, spark):
    scored = toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame([(-4, 1)], "doc_id long, label int")))
    assert scored.count() == docs.count() and scored.where("score <> 0").count() == 0
    weight = toxicity.Weights({w + b" ": 3.0 for w in toxicity.INSULTS})
    plain, hidden = (dict(zip(toxicity.FEATURES, toxicity.measures(t, weight), strict=True)) for t in ("you idiot", "you 1d.i0t!"))
    assert plain["lexicon"] == 1 and plain["near_second"] == 1 and plain["hidden_lexicon"] == 0
    assert dict(zip(toxicity.FEATURES, toxicity.measures(None, weight), strict=True))["log_words"] == 0
    assert hidden["lexicon"] == 0


def test_hidden_words_are_read_once():
    plain = re.compile(rb"[a-z\x80-\xff@$!*0-9._-]*[a-z][@$!*0-9._-]+[a-z][a-z\x80-\xff@$!*0-9._-]*")
    rng = random.Random(9)
    for _ in range(20_000):
        text = bytes(rng.choice(b"ab\x80@$!*0._- ,\n") for _ in range(rng.randint(0, 25)))
        assert toxicity.hidden_words(text) == plain.findall(text)


def test_toxicity_of_hard_rows_by_a_fitted_model(docs, spark):
    """A megabyte without blanks, in several forms, and the other hard rows."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = toxicity.fit(table, spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", F.col("toxic").alias("label")))
    assert model is not None
    long = [(-50, "a" * 1_000_000), (-51, "a." * 500_000), (-52, "." * 1_000_000), (-53, "a1" * 500_000), (-54, "a" + "_" * 1_000_000)]
    hard = docs.select("doc_id", "text").unionByName(spark.createDataFrame(long, "doc_id long, text string"))
    start = time.time()
    rows = toxicity.score(hard, model).collect()
    assert time.time() - start < 60
    assert len(rows) == hard.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


# 8


def _plain_mix(rows, keep):
    """Probability of each cell by raking to the end, every factor found by halving; asked and reachable targets."""
    cells = Counter()
    for *key, t in rows:
        cells[tuple(key)] += t
    size = keep * sum(cells.values())
    asked, targets = [], []
    for d in range(3):
        sums = Counter()
        for k, t in cells.items():
            sums[k[d]] += t
        scaled = {v: t**mixing.TEMPER for v, t in sums.items()}
        asked.append({v: x / sum(scaled.values()) for v, x in scaled.items()})
        low, high = 0.0, 1e9
        for _ in range(200):
            s = (low + high) / 2
            low, high = (s, high) if sum(min(sums[v] / size, s * x) for v, x in asked[d].items()) < 1 else (low, s)
        targets.append({v: min(sums[v] / size, high * x) for v, x in asked[d].items()})
    weight, most = {k: float(t) for k, t in cells.items()}, {k: t / size for k, t in cells.items()}
    for _ in range(400):
        for d in range(3):
            for v, target in targets[d].items():
                mine = [k for k in cells if k[d] == v]
                low, high = 0.0, 1e9
                for _ in range(100):
                    f = math.sqrt(max(low, 1e-30) * high)
                    low, high = (f, high) if sum(min(most[k], f * weight[k]) for k in mine) < target else (low, f)
                for k in mine:
                    weight[k] *= high
        if max(abs(sum(min(most[k], weight[k]) for k in cells if k[d] == v) - t) for d in range(3) for v, t in targets[d].items()) < 1e-7:
            break
    return {k: min(1, weight[k] / most[k]) if t else 1.0 for k, t in cells.items()}, asked, targets


def test_mixture_reaches_its_targets(docs):
    got = mixing.mix(docs, tolerance=1e-7, rounds=200).collect()
    want, asked, _ = _plain_mix([(r.source, r.lang, r.topic, r.tokens) for r in got], mixing.KEEP)
    size, total = sum(r.tokens * r.probability for r in got), sum(r.tokens for r in got)
    assert abs(size / total - mixing.KEEP) < 1e-5
    for r in got:
        assert abs(r.probability - want[r.source, r.lang, r.topic]) < 1e-3
        digest = hashlib.md5(f"{mixing.SEED}:{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        assert r.selected == (int(digest[:12], 16) / 16**12 < r.probability)
    missed = max(
        abs(sum(r.tokens * r.probability for r in got if r[d] == v) / size - share) for d, shares in zip(mixing.DIMENSIONS, asked, strict=True) for v, share in shares.items()
    )
    assert {r.missed for r in got} == {got[0].missed} and abs(got[0].missed - missed) < 1e-4
    kept = mixing.select(docs)
    assert kept.columns == docs.columns and abs(kept.count() - sum(r.selected for r in got)) <= 0.02 * len(got)


def test_given_targets(spark):
    rows = [(i, "w " * 10, "a" if i % 3 else "b", "en") for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = mixing.mix(table, {"source": {"a": 0.5, "b": 0.5, "c": 9.0}}, keep=0.4).collect()
    by_source = {s: sum(r.probability for r in got if r.source == s) for s in "ab"}
    assert abs(by_source["a"] - 60) < 0.1 and abs(by_source["b"] - 60) < 0.1
    assert got[0].missed < 1e-3
    # "b" has a third of the tokens, so at 0.8 it cannot be half of the sample: it is kept whole and "a" gives the rest
    got = mixing.mix(table, {"source": {"a": 0.5, "b": 0.5}}, keep=0.8).collect()
    by_source = {s: sum(r.probability for r in got if r.source == s) for s in "ab"}
    assert abs(by_source["b"] - 100) < 1e-6 and abs(by_source["a"] - 140) < 0.1
    assert abs(got[0].missed - (0.5 - 100 / 240)) < 1e-3
    # a value without target is left out, and the size is what the others have
    got = mixing.mix(table, {"source": {"b": 1.0}}, keep=0.8).collect()
    assert {r.probability for r in got if r.source == "a"} == {0.0} and all(abs(r.probability - 1) < 1e-6 for r in got if r.source == "b")


def test_a_tiny_cell_does_not_set_the_size(spark):
    rows = [(i, "w " * 100, "a" if i % 4 else "b", "en" if i % 3 else "de") for i in range(2000)]
    rows += [(5000, "w", "tiny", "xx"), (5001, "w @", "a", "xx"), (5002, "w = w", "b", "de")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    for keep in (0.3, 0.7, 0.95):
        got = mixing.mix(table, keep=keep).collect()
        size, total = sum(r.tokens * r.probability for r in got), sum(r.tokens for r in got)
        assert abs(size / total - keep) < 0.01 * keep
        assert abs(sum(r.tokens for r in got if r.selected) / total - keep) < 0.05


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_sample_has_its_size_and_the_target_shares(spark, scale):
    got = queries.op8_raked_mixture(spark, f"/root/testdata/{scale}").collect()
    _, asked, targets = _plain_mix([(r.source, r.lang, r.topic, r.tokens) for r in got], mixing.KEEP)
    assert max(r.probability for r in got) <= 1
    size, total = sum(r.tokens * r.probability for r in got), sum(r.tokens for r in got)
    assert abs(size / total - mixing.KEEP) < 0.001
    missed = 0.0
    for name, wanted, reachable in zip(mixing.DIMENSIONS, asked, targets, strict=True):
        for value, share in reachable.items():
            mine = [r for r in got if r[name] == value]
            expected = sum(r.tokens * r.probability for r in mine) / size
            assert abs(expected - share) < 2 * mixing.TOLERANCE
            missed = max(missed, abs(expected - wanted[value]))
            drawn = sum(r.tokens for r in mine if r.selected)
            noise = math.sqrt(sum(r.tokens**2 * r.probability * (1 - r.probability) for r in mine))
            assert abs(drawn - share * size) < 4.5 * noise + 2e-4 * size
    assert abs(missed - got[0].missed) < 1e-3


def test_as_much_as_all_targets_allow(spark):
    got = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), keep=None).collect()
    assert max(r.probability for r in got) > 1 - 1e-9
    assert got[0].missed <= mixing.TOLERANCE


# 9


def _plain_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _plain_components(ids, fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= bits):
            root[find(int(j))] = find(i)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def test_near_duplicates(docs, texts):
    got = simhash.near_duplicates(docs).collect()
    ids, fps = [r.doc_id for r in got], np.array([int(r.fingerprint, 16) for r in got], np.uint64)
    assert sorted((str(i), _plain_simhash(t)) for i, t in texts) == sorted((str(i), int(f)) for i, f in zip(ids, fps, strict=True))
    assert [r.component_id for r in got] == _plain_components(ids, fps, 2)


@pytest.mark.parametrize("long_posting", [512, 4])
def test_links_of_close_fingerprints(spark, monkeypatch, long_posting):
    monkeypatch.setattr(simhash, "LONG_POSTING", long_posting)
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(50)}
    for f in list(fps):
        for _ in range(8):
            fps.add(f)
            for b in rng.sample(range(64), rng.randint(1, 3)):
                f ^= 1 << b
    array = np.array(sorted(fps), np.uint64)
    table = spark.createDataFrame([(int(x),) for x in array.view(np.int64)], "fp long")
    found = {r.node: r.root for r in components.components(simhash.links(table)).collect()}
    mine = [found.get(int(x), int(x)) for x in array.view(np.int64)]
    want = _plain_components(list(range(len(array))), array, 2)
    assert len(set(zip(mine, want, strict=True))) == len(set(mine)) == len(set(want))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200) if i != 77], "a long, b long")
    roots = {r.node: r.root for r in components.components(edges).collect()}
    assert len({roots[i] for i in range(78)}) == 1 and len({roots[i] for i in range(78, 201)}) == 1 and roots[0] != roots[200]


# 10


def test_fingerprints_of_edits(docs, texts):
    got = minhash.fingerprint_edits(docs).collect()
    order = sorted(((-math.inf if i is None else i, t or "") for i, t in texts))
    want = []
    for (i, t), (_, u) in zip(order, order[1:] + order[:1], strict=True):
        m = len(t) // 4
        want.append((str(i), len(t), hashlib.sha256((t[: len(t) - m] + u[:m]).encode()).hexdigest()))
    assert sorted((str(-math.inf if r.doc_id is None else r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    by_id = {r.doc_id: r for r in got}
    assert by_id[-6].fingerprint == by_id[-7].fingerprint and by_id[-1].fingerprint == by_id[-2].fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_likeness_is_that_of_the_sets():
    rng, known = random.Random(6), WordHashes()
    errors = []
    for _ in range(200):
        shared, n = rng.randint(0, 300), 300
        hashes = np.array([rng.getrandbits(64) for _ in range(2 * n - shared)], np.uint64)
        a, b = minhash.sketch(hashes[:n]), minhash.sketch(hashes[n - shared :])
        errors.append(minhash.likeness(a, b) - shared / (2 * n - shared))
    assert abs(np.mean(errors)) < 0.02 and np.mean(np.abs(errors)) < 0.04
    assert minhash.likeness(minhash.fingerprint("", known), minhash.fingerprint("a b", known)) == 0.0


# the pipeline


def test_pipeline_stages_take_effect(spark, docs, tmp_path):
    source = docs.select("doc_id", "text", "lang", "source", "n_chars")
    source.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, str(tmp_path))
        path = str(tmp_path / name.replace(" ", "-"))
        out.write.parquet(path)
        made = spark.read.parquet(path)
        assert made.columns == source.columns and 0 < made.count() <= table.count()
        table = made
    encoded = corpus_pipeline.encoding(spark, table, str(tmp_path))
    assert encoded.count() == table.count()
    groups = simhash.near_duplicates(table.where("doc_id is not null"))
    assert groups.groupBy("doc_id").count().where("count > 1").count() == 0
    assert not [r for r in table.collect() if _plain_spans(r.text or "")]
