"""Toxicity by multiple-instance learning: documents are bags of sentences.

A sentence scores p = sigmoid(bias - log(n) + sum of the weights of its distinct words and of their
first 5, 6 and 7 letters), where n is the number of sentences of its document: the prior belief that a document
is toxic is shared out over its sentences, so that many blameless ones do not sum up.  A
document scores by noisy-or, 1 - product(1 - p).  Only documents carry labels, so the weights are
trained through the noisy-or: the gradient of a toxic document goes to the sentences that
explain it.  The same rule scores documents, and the same weights locate the offending sentences.

The classifier is fitted on a bounded sample, by one task: for each label the labelled documents in
the order of a hash of their id, up to ``per_class`` documents and ``characters`` characters; a document
beyond what is left of the characters is passed over.  Scores are computed for every document over
its whole text.

Texts without a word (null and empty ones too) have no sentence and score 0.  A document labelled more than
once counts as toxic if any label says so; null labels, labels of unknown documents and null ids
teach nothing.  Without labels of both kinds, as with an empty table, every score is 0.  Repeated rows are scored each by
itself, and teach each by itself.  Texts alike in their words tie.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hidden, id_as_text, id_restored, shown, small_batches, text_or_empty

PER_CLASS = 2500
CHARACTERS = 8_000_000
#: A word is a feature if so many documents of the sample have it.
LEAST_DOCS = 4
EPOCHS = 250
RATE = 0.2
PENALTY = 2e-4
START_BIAS = -2.0
#: Lengths of the beginnings of words that are features too.
BEGINNINGS = (5, 6, 7)
#: Words whose weights a worker remembers.
CACHED = 1 << 18

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W_]+")


def features(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in BEGINNINGS if len(word) > k)]


@dataclass
class Model:
    bias: float = -math.inf
    weights: dict[str, float] = field(default_factory=dict)
    known: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        if len(self.known) >= CACHED:
            self.known.clear()
        value = self.known[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return value

    def spans(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, logit) of the sentences that have a word; ends are exclusive."""
        low = text.lower()
        if len(low) != len(text):  # a few capitals grow when lowered; keep the places
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        known, found = self.known, []
        for m in SENTENCE.finditer(low):
            words = set(WORD.findall(m[0]))
            if words:
                found.append((m.start(), m.end(), sum([known[w] if w in known else self.weight(w) for w in words])))
        prior = self.bias - math.log(len(found)) if found else 0.0
        return [(a, b, z + prior) for a, b, z in found]

    def document(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Score, and the sentences that are offending by themselves with theirs; 0 for a model without training."""
        if not math.isfinite(self.bias):
            return 0.0, []
        spans = self.spans(text)
        return noisy_or([z for _, _, z in spans]), [(a, b, 1 / (1 + math.exp(-z))) for a, b, z in spans if z >= 0]


def noisy_or(logits: list[float]) -> float:
    """1 - product(1 - sigmoid(z))."""
    if not logits:
        return 0.0
    z = np.asarray(logits, float)
    return float(-np.expm1(-np.logaddexp(0.0, z).sum()))


@dataclass
class Bags:
    """Features of sentences, sentences of documents, and labels, as flat arrays."""

    feature: np.ndarray
    sentence: np.ndarray
    document: np.ndarray
    labels: np.ndarray

    def loss(self, theta: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean negative log likelihood with both labels weighing the same, and its gradient; the last of theta is the bias."""
        y, b, n = self.labels, self.document, len(self.labels)
        share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / n
        z = np.bincount(self.sentence, theta[self.feature], len(b)) + theta[-1] - np.log(np.bincount(b, minlength=n))[b]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.clip(np.bincount(b, np.logaddexp(0, z), n), 1e-9, 50)  # -log(1 - P)
        value = float((share * np.where(y == 1, -np.log(-np.expm1(-clean)), clean)).sum() + PENALTY / 2 * (theta[:-1] ** 2).sum())
        slope = np.where(y == 1, -1 / np.expm1(clean), 1.0) * share
        g = slope[b] * p
        return value, np.append(np.bincount(self.feature, g[self.sentence], len(theta) - 1) + PENALTY * theta[:-1], g.sum())


def flat(bags: list[tuple[int, list[list[str]]]]) -> tuple[Bags, dict[str, int]]:
    """From (label, sentences as lists of distinct words); documents without a sentence are left out."""
    bags = [x for x in bags if x[1]]
    seen: dict[str, int] = {}
    for _, bag in bags:
        for w in {f for s in bag for w in s for f in features(w)}:
            seen[w] = seen.get(w, 0) + 1
    index = {w: i for i, w in enumerate(sorted(w for w, n in seen.items() if n >= LEAST_DOCS))}
    found, of_sentence, of_bag = [], [], []
    for k, (_, bag) in enumerate(bags):
        for s in bag:
            ids = np.array([index[f] for w in s for f in features(w) if f in index], np.int32)
            found.append(ids)
            of_sentence.append(np.full(len(ids), len(of_bag), np.int32))
            of_bag.append(k)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return Bags(join(found), join(of_sentence), np.array(of_bag, np.int32), np.array([y for y, _ in bags], float)), index


def fit(bags: list[tuple[int, list[list[str]]]]) -> Model:
    """By full-batch Adam on the noisy-or likelihood."""
    data, index = flat(bags)
    if not len(data.labels) or data.labels.min() == data.labels.max():
        return Model()
    theta = np.zeros(len(index) + 1)
    theta[-1] = START_BIAS
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, EPOCHS + 1):
        grad = data.loss(theta)[1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Model(float(theta[-1]), {w: float(theta[i]) for w, i in index.items() if abs(theta[i]) > 1e-3})


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, characters: int = CHARACTERS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on the bounded sample of the labelled rows of docs.

    The sample is fitted by one task on an executor; what reaches the driver is a weight for each
    word of the sample that several of its documents have.
    """
    small_batches(docs.sparkSession)
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_l")).agg(F.max(F.col(label_col).cast("int")).alias("_y"))
    narrow = docs.filter(F.length(text_col).between(1, characters)).select(F.col(id_col).alias("_l"), F.length(text_col).alias("_n")).groupBy("_l").agg(F.sum("_n").alias("_n")).join(known, "_l")
    order = [F.xxhash64(F.col("_l").cast("string")), F.col("_l")]
    room = Window.orderBy("_h", "_l").rowsBetween(Window.unboundedPreceding, 0)
    picked = None
    for y in (0, 1):  # ids only; at most per_class of each
        some = narrow.filter(F.col("_y") == y).orderBy(*order).limit(per_class).withColumn("_h", order[0])
        some = some.withColumn("_all", F.sum("_n").over(room)).filter(F.col("_all") <= characters).select("_l", "_y")
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.filter(F.length(text_col).between(1, characters)).select(F.col(id_col).alias("_l"), F.col(text_col).alias("_text")).join(F.broadcast(picked), "_l").select("_y", "_text")

    def words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bags = [[dict.fromkeys(WORD.findall(s)) for s in SENTENCE.findall(t.lower())] for t in frame["_text"]]
            yield pd.DataFrame({"y": frame["_y"], "bag": ["\n".join(" ".join(s) for s in bag if s) for bag in bags]})

    def fitted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted(row for frame in frames for row in zip(frame["y"], frame["bag"], strict=True))
        model = fit([(y, [s.split(" ") for s in bag.split("\n") if s]) for y, bag in rows])
        yield pd.DataFrame({"word": ["", *model.weights], "weight": [model.bias, *model.weights.values()]})

    found = texts.mapInPandas(words, "y int, bag string").repartition(1).mapInPandas(fitted, "word string, weight double").collect()
    weights = {r["word"]: r["weight"] for r in found}
    return Model(weights.pop("", -math.inf), weights)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, offending): offending holds (start, end, score) of sentences with 0.5 or more."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.bias, model.weights))  # at most the sample's words

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(*shared.value)
        for frame in frames:
            got = [own.document(t) for t in frame["_text"]]
            yield pd.DataFrame({"_id": frame["_id"], "score": [s for s, _ in got], "offending": [f for _, f in got]})

    out = docs.select(id_as_text(id_col), text_or_empty(text_col).alias("_text")).mapInPandas(run, "_id string, score double, offending array<struct<start:int,end:int,score:double>>")
    return id_restored(out, docs, id_col)


def reject(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs that score below the threshold, with all their columns."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.bias, model.weights))

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(*shared.value)
        for texts in parts:
            yield pd.Series([own.document(t)[0] for t in texts], dtype=float)

    own, names = hidden(docs)
    return own.filter(scored(text_or_empty(names[text_col])) < threshold).select(*shown(names))
