"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are densities and rates, none of them a label or an
attribute of the row: words of the lexicon and their weights, words that are
in it only after obfuscation is undone, lexicon words near a second-person
word, capitals, punctuation and digits, obfuscated words, length.

The lexicon has words and stems (beginnings of words) that toxic training
documents hold far more often, by their likelihood ratio, and a few common
insults in the languages of the corpus.  Trees are fitted on one part of the
training rows, the calibration on the other.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.words import Remembered, slices
from daytally.scratch import materialize

#: Labelled documents that the model learns from, at most; chosen by a hash of the id.
MAX_LABELLED = 20_000
#: Training documents that must hold a word or stem for the lexicon.
LEAST_DOCUMENTS = 8
#: Likelihood ratio (G squared) that a word or stem must reach, and the share of its documents that must be toxic.
LEAST_RATIO = 25.0
LEAST_SHARE = 0.4
#: Bytes of a stem.
STEMS = (5, 6, 7)
#: Words between a lexicon word and a second-person word that still count as near.
NEAR = 4

#: Common insults, beside those that are learned.
INSULTS = frozenset(
    (
        "idiot idiots moron morons stupid scum trash worthless loser losers clown pathetic imbecile bastard jerk dumb garbage "
        "disgusting idioten trottel dummkopf arschloch abschaum imbécile connard salaud crétin ordure idiota imbécil estúpido "
        "estúpida basura escoria"
    )
    .encode()
    .split()
)
SECOND_PERSON = frozenset(b"you your yours yourself youre du dich dir dein deine ihr euch tu toi ton votre vous usted ustedes te eres vos".split())

_WORD = re.compile(rb"[a-z\x80-\xff]+")
# A run of letters and signs with a sign in it, found where it starts and read once; it is a hidden word if letters surround signs.
_SIGNED = re.compile(rb"(?<![a-z\x80-\xff@$!*0-9._-])[a-z\x80-\xff]*+[@$!*0-9._-][a-z\x80-\xff@$!*0-9._-]*+")
_SURROUNDED = re.compile(rb"[a-z][@$!*0-9._-]++[a-z]")
#: Characters that stand for letters, and those put between letters.
_UNHIDE = bytes.maketrans(b"013457@$!", b"oieastasi")
_BETWEEN = b"*._-"

FEATURES = [
    "lexicon",
    "lexicon_share",
    "weight",
    "weight_share",
    "hidden_lexicon",
    "near_second",
    "second_share",
    "capitals",
    "exclamations",
    "punctuation",
    "digits",
    "hidden_share",
    "log_words",
]


def units(word: bytes) -> list[bytes]:
    """What the lexicon may hold of a word: itself, marked by a blank, and its stems."""
    return [word + b" ", *(word[:n] for n in STEMS if len(word) > n)]


class Weights(Remembered):
    """Weight of each word, 0 if it is not in the lexicon; remembered for a bounded number of words."""

    def __init__(self, lexicon: dict[bytes, float]):
        super().__init__(lambda word: max(lexicon.get(u, 0.0) for u in units(word)))


def hidden_words(low: bytes) -> list[bytes]:
    """Words in lower case that have signs between letters; the time is linear in the text."""
    return [run for run in _SIGNED.findall(low) if _SURROUNDED.search(run)]


def measures(text: str | None, weight: Weights) -> list[float]:
    """The features of one text, in the order of ``FEATURES``; an empty text has zeros."""
    data = (text or "").encode("utf-8", "replace")
    size = max(1, len(data))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    low = data.lower()
    found = _WORD.findall(low)
    n = max(1, len(found))
    each = np.fromiter(map(weight.__getitem__, found), float, len(found))
    hits = np.flatnonzero(each)
    second = sum(map(SECOND_PERSON.__contains__, found))
    near = 0
    if len(hits) and second:
        persons = np.array([i for i, w in enumerate(found) if w in SECOND_PERSON])
        after = np.searchsorted(persons, hits)
        gap = np.minimum(np.abs(persons[np.minimum(after, len(persons) - 1)] - hits), np.abs(persons[np.maximum(after - 1, 0)] - hits))
        near = int((gap <= NEAR).sum())
    hidden = hidden_words(low)
    shown = sum(weight[w.translate(_UNHIDE, _BETWEEN)] > 0 for w in hidden)
    marks = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    return [
        float(min(len(hits), 50)),
        100 * len(hits) / n,
        float(min(each.sum(), 100.0)),
        100 * float(each.sum()) / n,
        float(min(shown, 20)),
        float(min(near, 20)),
        100 * second / n,
        int(counts[65:91].sum()) / size,
        int(counts[33]) / size,
        marks / size,
        int(counts[48:58].sum()) / size,
        100 * len(hidden) / n,
        float(np.log1p(len(found))),
    ]


@dataclass
class Model:
    lexicon: dict[bytes, float]
    trees: GBTClassificationModel
    calibration: IsotonicRegressionModel


_COUNTED = pa.schema([("unit", pa.binary()), ("clean", pa.int64()), ("toxic", pa.int64())])


def learn_lexicon(labelled: DataFrame) -> dict[bytes, float]:
    """Words and stems that toxic training documents hold far more often, with their log odds as weight.

    ``labelled`` has ``text`` and ``label``.  Each task sends its counts of
    documents by word and stem; Spark sums and tests them.  All that pass are
    kept: a labelled sample of bounded size has a bounded number of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sums = [Counter(), Counter()]
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = set(_WORD.findall((text or "").encode("utf-8", "replace").lower()))
                sums[int(label)].update({u for w in found for u in units(w)})
            names = list(sums[0].keys() | sums[1].keys())
            columns = [names, [sums[0][u] for u in names], [sums[1][u] for u in names]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COUNTED, strict=True)], schema=_COUNTED)

    sizes = {r.label: float(r["count"]) for r in labelled.groupBy("label").count().collect()}
    clean, toxic = F.lit(sizes.get(0, 0.0)), F.lit(sizes.get(1, 0.0))
    counts = labelled.select("text", "label").mapInArrow(run, "unit binary, clean long, toxic long")
    counts = counts.groupBy("unit").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")).where(F.col("c") + F.col("t") >= LEAST_DOCUMENTS)
    share = toxic / (clean + toxic)
    n = F.col("c") + F.col("t")
    term = lambda got, due: F.when(got > 0, got * F.log(got / due)).otherwise(0.0)
    rest = clean + toxic - n
    ratio = 2 * (
        term(F.col("t"), n * share)
        + term(F.col("c"), n * (1 - share))
        + term(toxic - F.col("t"), rest * share)
        + term(clean - F.col("c"), rest * (1 - share))
    )
    odds = F.log((F.col("t") + 0.5) / (F.col("c") + 0.5)) - F.log((toxic + 0.5) / (clean + 0.5))
    best = counts.withColumn("ratio", ratio).where((F.col("t") >= LEAST_SHARE * n) & (F.col("ratio") >= LEAST_RATIO))
    best = best.select("unit", odds.alias("weight"))
    return {w + b" ": 3.0 for w in INSULTS} | {bytes(r.unit): min(6.0, max(0.5, r.weight)) for r in best.collect()}


def features(docs: DataFrame, lexicon: dict[bytes, float], keep: list[str]) -> DataFrame:
    """Columns ``keep`` (long) and the features of every text."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    names = [*keep, *FEATURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Weights(sent.value)
        for batch in slices(batches):
            made = np.array([measures(t, known) for t in batch.column(len(keep)).to_pylist()]).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(made[:, i]) for i in range(made.shape[1]))], names=names)

    schema = ", ".join([f"{k} long" for k in keep] + [f"{f} double" for f in FEATURES])
    return docs.select(*(F.col(k).cast("long").alias(k) for k in keep), "text").mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model | None:
    """Learn lexicon, trees and calibration from labelled documents, at most ``max_labelled``.

    ``labels`` has ``doc_id`` and ``label`` (0 or 1); nulls take no part, and a
    document with both labels counts as 1.  A quarter of the documents, by a
    hash of the id, is kept for the calibration.  Without both labels there is
    nothing to learn and the result is None.
    """
    clean = labels.where("doc_id is not null and label in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    chosen = clean.agg(F.max(F.col("label").cast("long")).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    texts = materialize(texts, "labelled")
    lexicon = learn_lexicon(texts)
    rows = materialize(features(texts, lexicon, ["doc_id", "label"]).repartition(8), "toxicity")
    part = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(4)) == 0
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select(
        F.col("label").cast("double").alias("label"), "features", part.alias("calibration")
    )
    sizes = {(r.label, r.calibration): r["count"] for r in rows.groupBy("label", "calibration").count().collect()}
    if not (sizes.get((0.0, False)) and sizes.get((1.0, False))):
        return None
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=42, cacheNodeIds=False).fit(rows.where(~F.col("calibration")))
    held = rows.where("calibration") if sum(n for (_, c), n in sizes.items() if c) else rows
    raw = trees.transform(held).select("label", vector_to_array("probability")[1].alias("p"))
    calibration = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="score").fit(raw)
    return Model(lexicon, trees, calibration)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (score at least 0.5) of every document; one narrow pass.

    A null text is scored as the empty one.  Without a model the score is 0.
    Repeated rows give repeated results; null ids stay; other columns are
    ignored.
    """
    if model is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(docs, model.lexicon, ["doc_id"]))
    raw = model.trees.transform(rows).select("doc_id", vector_to_array("probability")[1].alias("p"))
    out = model.calibration.transform(raw)
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score"))
    return out.select("doc_id", bounded.alias("score"), (bounded >= 0.5).cast("int").alias("predicted"))
