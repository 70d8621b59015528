"""Quality classifier: a linear support vector machine over naive Bayes features.

Indicators of n-grams are scaled by the logarithm of their smoothed class ratio; dual coordinate
descent fits the hinge loss, and a logistic curve over the margins turns them into scores. N-grams
run over word shapes (case pattern and marks of a word, or a sign that a word repeats the one
before it) and over single words, so markup, shouting, tables and stuttering are seen in every
language.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import held_out, per_text
from pitwall.llm.training import Rows, indicator_rows, labelled_sample, logistic

LONGEST_GRAM = 3
GAP = "\x1f"
REPEATED = "="
_CACHE = 100_000
_RUNS = re.compile(r"(.)\1+", re.DOTALL)
_CLASS = str.maketrans(
    "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "a" * 26 + "A" * 26 + "9" * 10,
)


def shape(word: bytes) -> str:
    """Character classes of a word with runs shortened to one; other letters count by case."""
    text = word.decode()
    if not text.isascii():
        text = "".join(
            c if c.isascii() else "A" if c.isupper() else "a" if c.isalpha() else "?" for c in text
        )
    return _RUNS.sub(r"\1", text.translate(_CLASS))[:12]


class _Shapes(dict):
    def __missing__(self, word: bytes) -> str:
        if len(self) >= _CACHE:
            self.clear()
        found = shape(word)
        if len(word) <= 32:
            self[word] = found
        return found


_SHAPES = _Shapes()


def features(data: bytes) -> set[str]:
    """Shape n-grams and small-letter words of a text."""
    words = data.split()
    marks = [
        REPEATED if word == before else _SHAPES[word]
        for word, before in zip(words, [b"", *words])
    ]
    grams = set(zip(marks))
    for n in range(2, LONGEST_GRAM + 1):
        grams.update(zip(*(marks[i:] for i in range(n))))
    found = {GAP + GAP.join(gram) for gram in grams}
    found.update(word.decode() for word in set(data.lower().split()))
    return found


@dataclass
class Model:
    """Weight of each feature, the bias, and the curve from margin to score."""

    weights: dict[str, float]
    bias: float
    slope: float
    offset: float

    def score(self, data: bytes) -> float:
        """Probability of label 1."""
        known = features(data) & self.weights.keys()
        margin = self.bias + sum(self.weights[f] for f in sorted(known))
        return float(logistic(self.slope * margin + self.offset))


def class_ratios(rows: Rows, smoothing: float = 1.0) -> np.ndarray:
    """Logarithm of the ratio of smoothed feature shares in the two classes."""
    positive = smoothing + rows.spread((rows.labels == 1).astype(float))
    negative = smoothing + rows.spread((rows.labels == 0).astype(float))
    return np.log(positive / positive.sum()) - np.log(negative / negative.sum())


def fit_hinge(
    rows: Rows, scale: np.ndarray, penalty: float, rounds: int, seed: int = 11
) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model by dual coordinate descent."""
    sign = np.where(rows.labels == 1, 1.0, -1.0)
    weights, bias = np.zeros(len(rows.vocabulary)), 0.0
    squares = rows.times(scale**2) + 1.0
    dual = np.zeros(len(sign))
    ends = np.append(rows.starts, len(rows.ids))
    draw = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in draw.permutation(len(sign)):
            own = rows.ids[ends[i] : ends[i + 1]]
            values = scale[own]
            gradient = sign[i] * (weights[own] @ values + bias) - 1.0
            step = min(max(dual[i] - gradient / squares[i], 0.0), penalty) - dual[i]
            if step:
                dual[i] += step
                weights[own] += step * sign[i] * values
                bias += step * sign[i]
                moved = max(moved, abs(step))
        if moved < 1e-4 * penalty:
            break
    return weights, bias


def fit_curve(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve through softened labels, by damped Newton steps."""
    ones, zeros = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    slope, offset = 1.0, 0.0
    for _ in range(rounds):
        p = logistic(slope * margins + offset)
        spread = p * (1 - p) + 1e-9
        gradient = np.array([((p - target) * margins).sum(), (p - target).sum()])
        hessian = np.array(
            [
                [(spread * margins**2).sum() + 1e-3, (spread * margins).sum()],
                [(spread * margins).sum(), spread.sum() + 1e-3],
            ]
        )
        step = np.linalg.solve(hessian, gradient)
        step /= max(1.0, np.abs(step).max())
        slope, offset = max(slope - step[0], 1e-3), offset - step[1]
    return float(slope), float(offset)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    rows: int = 8_000,
    least_docs: int = 10,
    most_features: int = 20_000,
    penalty: float = 0.05,
    rounds: int = 30,
) -> Model:
    """Model from at most ``rows`` labelled documents that are not held out.

    With labels of one class only, or none, every text gets the smoothed share of label 1.
    """
    sample = indicator_rows(
        labelled_sample(docs, labels, label, rows),
        features,
        least_docs=least_docs,
        most_features=most_features,
    )
    ones, every = int(sample.labels.sum()), len(sample.labels)
    if ones in (0, every):
        return Model({}, 0.0, 1.0, float(np.log((ones + 1) / (every - ones + 1))))
    scale = class_ratios(sample)
    weights, bias = fit_hinge(sample, scale, penalty, rounds)
    weights *= scale
    slope, offset = fit_curve(sample.times(weights) + bias, sample.labels)
    kept = {f: float(w) for f, w in zip(sample.vocabulary, weights) if w}
    return Model(kept, bias, slope, offset)


def score_column(docs: DataFrame, model: Model, text: Column) -> Column:
    """Score of a text; the model travels as a broadcast of bounded size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = shared.value
        return lambda data: (own.score(data),)

    return per_text({"score": "double"}, make)(text)["score"]


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    threshold: float = 0.5,
    model: Model | None = None,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts have no features and get the score of the bias. Rows without an id count
    as held out. Repeated rows stay repeated; other columns are not read.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model = model or train(plain, labels)
    return plain.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        score_column(docs, model, F.col("text")).alias("score"),
    ).select("*", (F.col("score") >= threshold).cast("int").alias("predicted"))
