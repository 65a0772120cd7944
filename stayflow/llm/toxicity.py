"""Toxicity: a counterfactual-regularised classifier.

A document is scored by the words it holds and by their beginnings. Training has three parts, all from labelled rows that are not held out:

1. A bounded sample of the rows (``MAX_TRAINING_ROWS``) is counted by word and label (a distributed sum). The words whose
   presence tells the labels apart most clearly (chi-square) are the vocabulary, so that long texts do not gather the
   noise of rare words. Identity terms always belong to it.
2. A logistic regression on word presence is fitted on the sample.
3. In each training text that names a group, every identity term is swapped for the next one of the list. The squared
   difference between the scores (log-odds) of the text and its swapped copy is added to the loss with the weight
   ``COUNTERFACTUAL``. A term can then raise the score only as much as all the others do: what stays is the insult, not
   the group it is aimed at, and neutral mentions of a group are not taken for toxic.

The model is some hundred words and word beginnings with their weights; it is broadcast and applied in one pass.

Defined results: null and empty texts score the bias of the model (no word present); without training rows of both
labels every score is the share of label 1 (0 if there are none). Repeated rows score alike. Labels, language, source
and id are not inputs of the score. Other columns pass through.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, words_of
from .labelled import training_rows

MAX_TRAINING_ROWS = 12_000
VOCABULARY = 400
MIN_CHI_SQUARE, MIN_HOLDERS, MIN_SHARE = 25.0, 5, 0.001
PREFIXES = (5, 6, 7)
RIDGE = 0.1
COUNTERFACTUAL = 10.0
STEPS = 400
FLUSH = 100_000
# Words that name groups of people.
IDENTITY = (
    "women men woman man girls boys gay straight lesbian transgender black white asian latino muslim christian jewish "
    "hindu buddhist atheist immigrants refugees disabled deaf blind old young american african european chinese indian"
).split()


@dataclass
class Model:
    """Weights of words and the bias."""

    weights: dict[bytes, float]
    bias: float

    def score(self, data: bytes | None) -> float:
        get = self.weights.get
        x = self.bias + sum(get(f, 0.0) for f in features_of(set(words_of(data)))) if data else self.bias
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, x))))


def features_of(words: set[bytes]) -> set[bytes]:
    """The words, and the beginnings of longer ones (marked by ``^``): inflected and compound insults share them."""
    return words.union(*({b"^" + w[:n] for w in words if len(w) > n} for n in PREFIXES))


def swapped(words: set[bytes], identity: Sequence[bytes]) -> set[bytes] | None:
    """The words with every identity term replaced by the next of the list; None without such a term."""
    place = {t: i for i, t in enumerate(identity)}
    named = [w for w in words if w in place]
    if not named:
        return None
    return (words - set(named)) | {identity[(place[w] + 1) % len(identity)] for w in named}


def fit(
    examples: Sequence[tuple[set[bytes], int, set[bytes] | None]],
    vocabulary: Sequence[bytes],
    counterfactual: float = COUNTERFACTUAL,
    ridge: float = RIDGE,
    steps: int = STEPS,
) -> Model:
    """Logistic regression with ridge and counterfactual penalties, by accelerated gradient steps.

    An example has its features, its label, and the features of its swapped copy if it names a group.
    """
    place = {w: i for i, w in enumerate(vocabulary)}
    n, d = len(examples), len(vocabulary)
    y = np.array([label for _, label, _ in examples], float)
    if not n or y.min() == y.max():
        rate = float(y.mean()) if n else 0.0
        return Model({}, math.log((rate + 1e-9) / (1 - rate + 1e-9)))
    x = np.zeros((n, d), np.float32)
    pairs = []
    for r, (features, _, other) in enumerate(examples):
        x[r, [place[f] for f in features if f in place]] = 1
        if other is not None:
            change = np.zeros(d, np.float32)
            change[[place[f] for f in features - other if f in place]] += 1
            change[[place[f] for f in other - features if f in place]] -= 1
            pairs.append(change)
    change = np.array(pairs, np.float32).reshape(-1, d)
    w, b, last_w, last_b = np.zeros(d), math.log(y.mean() / (1 - y.mean())), np.zeros(d), 0.0
    last_b = b
    # Largest curvature of the loss, by power iteration.
    v = np.ones(d)
    for _ in range(20):
        v = x.T @ (x @ v) / 4 + 2 * counterfactual * (change.T @ (change @ v)) + ridge * v
        size = np.linalg.norm(v) or 1.0
        v /= size
    rate = 1.0 / (size + n / 4)
    for t in range(steps):
        k = t / (t + 3)
        aw, ab = w + k * (w - last_w), b + k * (b - last_b)
        error = 1 / (1 + np.exp(-np.clip(x @ aw + ab, -30, 30))) - y
        gw = x.T @ error + ridge * aw + 2 * counterfactual * (change.T @ (change @ aw))
        last_w, last_b = w, b
        w, b = aw - rate * gw, ab - rate * error.sum()
    return Model({word: float(w[i]) for word, i in place.items()}, float(b))


def count_presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, label, n): documents that hold a word, in bounded dictionaries; the empty word counts documents."""
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def out() -> pa.RecordBatch:
        rows = [(w, label, n) for label, c in counts.items() for w, n in c.items()]
        word, label, n = zip(*rows) if rows else ((), (), ())
        for c in counts.values():
            c.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(word, pa.binary()), pa.array(label, pa.int32()), pa.array(n, pa.int64())], names=["word", "label", "n"]
        )

    for batch in batches:
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text")):
            counts[label].update({*features_of(set(words_of(text.as_buffer().to_pybytes()))), b""})
        if sum(map(len, counts.values())) > FLUSH:
            yield out()
    yield out()


def telling_words(sample: DataFrame, size: int = VOCABULARY) -> list[bytes]:
    """The words whose presence depends most on the label."""
    counted = sample.select(F.col("text").cast("binary").alias("text"), "label").mapInArrow(
        count_presence, "word binary, label int, n long"
    )
    by_label = lambda v: F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0)).cast("double")
    sums = counted.groupBy("word").agg(by_label(0).alias("a"), by_label(1).alias("b"))
    sums = stored(sums.where(F.col("a") + F.col("b") >= MIN_HOLDERS), "toxicity-words")
    texts = sums.where(F.length("word") == 0).first()
    n0, n1 = (texts["a"], texts["b"]) if texts else (0.0, 0.0)
    if not n0 or not n1:
        return []
    a, b, n = F.col("a"), F.col("b"), n0 + n1
    holds = a + b
    chi = n * F.pow(b * (n0 - a) - a * (n1 - b), F.lit(2.0)) / (n0 * n1 * holds * (n - holds))
    best = sums.where((holds < n) & (holds >= max(MIN_HOLDERS, MIN_SHARE * n))).select("word", chi.alias("chi"))
    best = best.where(F.col("chi") >= MIN_CHI_SQUARE)
    return [bytes(r["word"]) for r in best.orderBy(F.desc("chi"), "word").limit(size).collect()]


def train(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    identity: Sequence[str] = IDENTITY,
    max_rows: int = MAX_TRAINING_ROWS,
    counterfactual: float = COUNTERFACTUAL,
) -> Model:
    terms = [t.encode() for t in identity]
    sample = stored(training_rows(documents, labels, label, max_rows), "toxicity-sample")
    vocabulary = telling_words(sample)
    vocabulary += sorted(features_of(set(terms)) - set(vocabulary))
    wanted, examples = set(vocabulary), []
    for r in sample.toLocalIterator():
        words = set(words_of(r["text"].encode()))
        other = swapped(words, terms)
        examples.append((features_of(words) & wanted, r["label"], other and features_of(other) & wanted))
    examples.sort(key=lambda e: (e[1], sorted(e[0]), sorted(e[2] or ())))
    return fit(examples, vocabulary, counterfactual)


def score_with(text: Column, model: Model, documents: DataFrame) -> Column:
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in batches:
            yield pa.array([m.score(t.as_buffer().to_pybytes() if t.is_valid else None) for t in batch], pa.float64())

    return scored(text.cast("binary"))


def classify_toxicity(documents: DataFrame, labels: DataFrame, into: str = "toxicity", **options) -> DataFrame:
    """The documents with their score in ``into``."""
    return documents.withColumn(into, score_with(F.col("text"), train(documents, labels, **options), documents))
