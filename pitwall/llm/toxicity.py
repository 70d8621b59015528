"""Toxicity classifier that is regularised by counterfactuals.

A sparse logistic model over the words of a text and their beginnings. Wherever a labelled text
names a group, the name is swapped for the other names of its kind and for a neutral word; the
square of the change in score, over the name and all its beginnings, is penalised while fitting, so
a mere mention of a group carries no weight, and texts are judged by what is said.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import held_out, per_text
from pitwall.llm.training import Rows, indicator_rows, labelled_sample, logistic

# Names of groups that can stand for one another.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "mexican", "chinese"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("immigrant", "refugee", "foreigner", "citizen"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("disabled", "blind", "deaf", "elderly", "old", "young"),
)
#: Lengths of the beginnings of words that are features, and the sign in front of them.
STEMS = (3, 4, 5, 6, 7, 8)
STEM = "^"
_LETTERS = re.compile(r"[^\W\d_]+")
_MARKS = ".,;:!?\"'()[]{}*#$%&|<>-_"


def words(data: bytes) -> set[str]:
    """Words of a text in small letters, without marks and digits."""
    found = set()
    for word in {word.strip(_MARKS) for word in set(data.decode().lower().split())}:
        if word.isalpha():
            found.add(word)
        elif word:
            found.update(_LETTERS.findall(word))
    return found


def with_beginnings(found: set[str]) -> set[str]:
    """Words and their beginnings, which inflected and compound forms share."""
    return found.union(STEM + word[:n] for word in found for n in STEMS if len(word) >= n)


def features(data: bytes) -> set[str]:
    """Words of a text and their beginnings."""
    return with_beginnings(words(data))


def text_swaps(data: bytes, groups=IDENTITY_TERMS) -> list[tuple[set[str], set[str]]]:
    """(gone, new) features of a text for each swap of a group's name in it.

    A name is swapped for every other name of its groups and for a neutral word, which has no
    features; all names of a text are also swapped for neutral words at once. A feature that
    another word of the text has too is not gone.
    """
    spoken = words(data)
    named = sorted(spoken & {name for group in groups for name in group})
    if not named:
        return []
    times = Counter(feature for word in spoken for feature in with_beginnings({word}))
    found = []
    for name in named:
        own = with_beginnings({name})
        for other in sorted({n for group in groups if name in group for n in group} - {name}):
            put = with_beginnings({other})
            gone = {f for f in own if times[f] == 1} - put
            found.append((gone, {f for f in put if f not in times}))
        found.append(({f for f in own if times[f] == 1}, set()))
    if len(named) > 1:
        theirs = Counter(feature for name in named for feature in with_beginnings({name}))
        found.append(({f for f, n in theirs.items() if times[f] == n}, set()))
    return found


@dataclass
class Swaps:
    """Feature changes of swaps: entry i puts ``signs[i]`` of feature ``ids[i]`` into swap
    ``owner[i]``, and equal swaps are one with its number of ``times``."""

    owner: np.ndarray
    ids: np.ndarray
    signs: np.ndarray
    times: np.ndarray

    def only(self, features: np.ndarray, size: int) -> Swaps:
        """The same swaps over some of ``size`` features; swaps without any are left out."""
        number = np.full(size, -1)
        number[features] = np.arange(len(features))
        kept = number[self.ids] >= 0
        left, owner = np.unique(self.owner[kept], return_inverse=True)
        return Swaps(owner, number[self.ids[kept]], self.signs[kept], self.times[left])

    @property
    def curvature(self) -> float:
        """Bound of the mean square of the change over weights of length 1."""
        return float(self.times[self.owner].sum() / max(1, self.times.sum()))

    def gradient(self, weights: np.ndarray) -> np.ndarray:
        """Gradient of the mean square of the score change."""
        change = np.bincount(self.owner, self.signs * weights[self.ids], len(self.times))
        pull = (2 / max(1, self.times.sum())) * self.times * change
        return np.bincount(self.ids, self.signs * pull[self.owner], len(weights))


def swaps(sample: DataFrame, vocabulary: list[str], groups=IDENTITY_TERMS) -> Swaps:
    """Swaps in the texts of a sample, over the features of the vocabulary.

    Counted in tasks. The pairs of names and the beginnings that other words share bound how many
    differ.
    """
    shared = sample.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(vocabulary)})

    def count(batches):
        import pyarrow as pa

        index, seen = shared.value, Counter()
        for batch in batches:
            for data in batch.column("text").cast(pa.binary()).to_pylist():
                for gone, new in text_swaps(data or b"", groups):
                    change = (
                        tuple(sorted(index[f] for f in gone & index.keys())),
                        tuple(sorted(index[f] for f in new & index.keys())),
                    )
                    if any(change):
                        seen[change] += 1
        yield pa.RecordBatch.from_pydict(
            {
                "gone": pa.array([gone for gone, _ in seen], pa.list_(pa.int32())),
                "new": pa.array([new for _, new in seen], pa.list_(pa.int32())),
                "n": pa.array(list(seen.values()), pa.int64()),
            }
        )

    rows = (
        sample.select("text")
        .mapInArrow(count, "gone array<int>, new array<int>, n long")
        .groupBy("gone", "new")
        .agg(F.sum("n").alias("n"))
        .orderBy("gone", "new")
        .collect()
    )
    lengths = [len(row["gone"]) + len(row["new"]) for row in rows]
    return Swaps(
        np.repeat(np.arange(len(rows)), lengths),
        np.array([i for row in rows for i in (*row["gone"], *row["new"])], dtype=np.int64),
        np.array([s for row in rows for s in (*[1.0] * len(row["gone"]), *[-1.0] * len(row["new"]))]),
        np.array([row["n"] for row in rows], dtype=np.int64),
    )


def fit(
    rows: Rows,
    swapped: Swaps,
    *,
    sparsity: float,
    fairness: float,
    rounds: int,
) -> tuple[np.ndarray, float]:
    """Weights and bias: logistic loss, absolute weights, and squared score changes of swaps.

    Accelerated proximal gradient with a step from the largest row; the bias is not shrunk.
    """
    n, size = len(rows.labels), len(rows.vocabulary)
    ones = int(rows.labels.sum())
    # The rarer class weighs more: each class counts as the root of its number of rows.
    mass = np.where(rows.labels == 1, np.sqrt((n - ones) / ones), 1.0)
    mass /= mass.sum()
    # Bound of the curvature by a few power steps on the squared rows.
    probe = np.ones(size)
    for _ in range(10):
        probe = rows.spread(rows.times(probe))
        norm = np.linalg.norm(probe) or 1.0
        probe /= norm
    step = 1.0 / (0.25 * (norm * mass.max() + 1.0) + 2.0 * fairness * swapped.curvature + 1e-9)
    weights, bias = np.zeros(size), float(np.log(ones / (n - ones))) / 2
    ahead, ahead_bias, momentum = weights.copy(), bias, 1.0
    for _ in range(rounds):
        error = (logistic(rows.times(ahead) + ahead_bias) - rows.labels) * mass
        gradient = rows.spread(error)
        gradient += fairness * swapped.gradient(ahead)
        moved = ahead - step * gradient
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * sparsity, 0.0)
        new_bias = ahead_bias - step * error.sum()
        if np.abs(new - weights).max(initial=0.0) < 1e-5 and abs(new_bias - bias) < 1e-5:
            return new, new_bias
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / following
        ahead, ahead_bias = new + pull * (new - weights), new_bias + pull * (new_bias - bias)
        weights, bias, momentum = new, new_bias, following
    return weights, bias


@dataclass
class Model:
    """Weight of each word, and the bias."""

    weights: dict[str, float]
    bias: float

    def score(self, data: bytes) -> float:
        """Probability of label 1."""
        known = features(data) & self.weights.keys()
        return float(logistic(self.bias + sum(self.weights[f] for f in sorted(known))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "toxic",
    rows: int = 8_000,
    least_docs: int = 5,
    most_features: int = 10_000,
    sparsity: float = 1e-3,
    fairness: float = 0.5,
    rounds: int = 400,
    groups=IDENTITY_TERMS,
) -> Model:
    """Model from at most ``rows`` labelled documents that are not held out.

    With labels of one class only, or none, every text gets the smoothed share of label 1.
    """
    texts = labelled_sample(docs, labels, label, rows)
    sample = indicator_rows(
        texts,
        features,
        least_docs=least_docs,
        most_features=most_features,
        always=tuple(word for group in groups for word in group),
    )
    ones, every = int(sample.labels.sum()), len(sample.labels)
    if ones in (0, every):
        return Model({}, float(np.log((ones + 1) / (every - ones + 1))))
    swapped = swaps(texts, sample.vocabulary, groups)
    weights, _ = fit(sample, swapped, sparsity=sparsity, fairness=fairness, rounds=rounds)
    # The penalty that picks the features also shrinks their weights: fit those anew with less.
    chosen = np.flatnonzero(weights)
    swapped, sample = swapped.only(chosen, len(weights)), sample.only(chosen)
    weights, bias = fit(sample, swapped, sparsity=sparsity / 10, fairness=fairness, rounds=rounds)
    return Model({f: float(w) for f, w in zip(sample.vocabulary, weights) if w}, float(bias))


def score_column(docs: DataFrame, model: Model, text: Column) -> Column:
    """Score of a text; the model travels as a broadcast of bounded size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = shared.value
        return lambda data: (own.score(data),)

    return per_text({"score": "double"}, make)(text)["score"]


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    threshold: float = 0.7,
    model: Model | None = None,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts have no words and get the score of the bias. Rows without an id count as
    held out. Repeated rows stay repeated; other columns are not read.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model = model or train(plain, labels)
    return plain.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        score_column(docs, model, F.col("text")).alias("score"),
    ).select("*", (F.col("score") >= threshold).cast("int").alias("predicted"))
