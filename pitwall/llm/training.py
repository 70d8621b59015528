"""Bounded labelled samples as sparse indicator rows, for classifiers fitted on the driver."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import held_out, per_text, written

Features = Callable[[bytes], set[str]]


@dataclass
class Rows:
    """Indicator rows in compressed form: the features of row i are ``ids[ends[i-1]:ends[i]]``."""

    vocabulary: list[str]
    labels: np.ndarray
    ids: np.ndarray
    starts: np.ndarray

    @cached_property
    def owner(self) -> np.ndarray:
        """Row of each entry of ``ids``."""
        lengths = np.diff(np.append(self.starts, len(self.ids)))
        return np.repeat(np.arange(len(self.labels)), lengths)

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each row."""
        return np.bincount(self.owner, weights[self.ids], len(self.labels)).astype(float)

    def spread(self, values: np.ndarray) -> np.ndarray:
        """Sum over rows of the row's value for each feature."""
        return np.bincount(self.ids, values[self.owner], len(self.vocabulary)).astype(float)

    def only(self, features: np.ndarray) -> Rows:
        """The same rows over some of the features."""
        number = np.full(len(self.vocabulary), -1)
        number[features] = np.arange(len(features))
        kept = number[self.ids] >= 0
        lengths = np.bincount(self.owner[kept], minlength=len(self.labels))
        return Rows(
            [self.vocabulary[i] for i in features],
            self.labels,
            number[self.ids[kept]],
            np.cumsum(lengths) - lengths,
        )


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows: int,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(label, text) of at most ``rows`` labelled documents, stored.

    Labels of held-out ids, other values than 0 and 1 and null ids are not used. The sample is the
    first ``rows`` label rows by a hash of the id. A document with several labels counts as 1; of
    several texts under one id one is taken.
    """
    usable = labels.select(
        F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")
    ).filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    # Both hashed keys come before ties of equal hashes, so that the choice is the same every time.
    chosen = (
        usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    texts = (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # at most ``rows`` rows
        .groupBy("doc_id", "label")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    return written(texts.select("label", "text"), "sample")


def indicator_rows(
    sample: DataFrame, features: Features, *, least_docs: int, most_features: int,
    always: tuple[str, ...] = (),
) -> Rows:
    """Rows over the ``most_features`` features that go most with the label.

    Features of fewer than ``least_docs`` texts are left out; the others are ordered by the
    gradient of their weight in a model without any (share of label 1 among their texts against
    that of all texts, times their number). Features named in ``always`` are in any case.
    """

    def count(batches):
        import pyarrow as pa

        seen: dict[str, list[int]] = {}
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for label, data in zip(batch.column("label").to_pylist(), texts):
                for feature in features(data or b""):
                    own = seen.setdefault(feature, [0, 0])
                    own[0] += 1
                    own[1] += label
        yield pa.RecordBatch.from_pydict(
            {
                "feature": pa.array(list(seen), pa.string()),
                "n": pa.array([n for n, _ in seen.values()], pa.int64()),
                "ones": pa.array([ones for _, ones in seen.values()], pa.int64()),
            }
        )

    base = sample.agg(F.avg("label")).first()[0] or 0.0
    counted = (
        sample.mapInArrow(count, "feature string, n long, ones long")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
        .filter(F.col("n") >= least_docs)
        .orderBy(F.desc(F.abs(F.col("ones") - F.col("n") * F.lit(base))), "feature")
        .limit(most_features)
        .collect()  # at most ``most_features`` short rows
    )
    vocabulary = list(dict.fromkeys([row["feature"] for row in counted] + list(always)))
    shared = sample.sparkSession.sparkContext.broadcast(
        {feature: i for i, feature in enumerate(vocabulary)}
    )

    def make():
        index = shared.value

        def known(data: bytes) -> tuple:
            return (sorted(index[f] for f in features(data) & index.keys()),)

        return known

    numbered = per_text({"ids": "array<int>"}, make)
    collected = sample.select("label", numbered(F.col("text"))["ids"].alias("ids")).collect()
    arrays = [np.array(row["ids"], dtype=np.int64) for row in collected]
    lengths = np.array([len(a) for a in arrays], dtype=np.int64)
    return Rows(
        vocabulary,
        np.array([row["label"] for row in collected], dtype=np.int64),
        np.concatenate([np.zeros(0, np.int64), *arrays]),
        np.cumsum(lengths) - lengths,
    )


def logistic(value):
    """Logistic function without overflow."""
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(value, dtype=float)))
