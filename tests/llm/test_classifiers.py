"""Classifiers: held-out accuracy, and what the methods promise."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.llm import quality_classifier, toxicity
from pitwall.llm.common import bounded_batches, held_out
from pitwall.llm.training import Rows, labelled_sample


def test_held_out_is_the_checksum(spark):
    ids = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    for row in ids.select("doc_id", held_out(F.col("doc_id")).alias("out")).collect():
        key = row["doc_id"]
        assert row["out"] == (key is None or zlib.crc32(str(key).encode()) % 3 == 1)


@pytest.fixture(scope="module")
def large(spark):
    """Documents and labels of a size at which models can learn."""
    bounded_batches(spark)
    folder = "/root/testdata/sf0.1"
    return (
        spark.read.parquet(f"{folder}/documents.parquet"),
        spark.read.parquet(f"{folder}/labels.parquet"),
    )


def test_quality_held_out(large):
    docs, labels = large
    rows = quality_classifier.quality_scores(docs, labels).join(labels, "doc_id").collect()
    unseen = [r for r in rows if r["held_out"]]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in unseen) >= 0.98 * len(unseen)
    good = [r for r in unseen if r["quality"] == 1]
    assert sum(r["predicted"] for r in good) >= 0.99 * len(good)


def test_toxicity_held_out(large):
    docs, labels = large
    rows = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").collect()
    unseen = [r for r in rows if r["held_out"]]
    toxic = sorted(r["score"] for r in unseen if r["toxic"] == 1)
    clean = sorted(r["score"] for r in unseen if r["toxic"] == 0)
    below = np.searchsorted(clean, toxic).sum()
    assert below >= 0.97 * len(toxic) * len(clean)  # area under the curve
    assert sum(s >= 0.7 for s in clean) <= 0.01 * len(clean)
    assert sum(s >= 0.7 for s in toxic) >= 0.6 * len(toxic)


def _labelled(spark, texts):
    docs = spark.createDataFrame(
        [(i, text) for i, (text, _) in enumerate(texts)], "doc_id long, text string"
    )
    labels = spark.createDataFrame(
        [(i, label) for i, (_, label) in enumerate(texts)], "doc_id long, toxic int"
    )
    return docs, labels


def test_counterfactuals_clear_group_names(spark):
    """A group named mostly in toxic texts carries no weight of its own."""
    texts = []
    for i in range(400):
        texts.append((f"you muslims are vile trash number{i % 7}", 1))
        texts.append((f"the christians met at the river number{i % 7}", 0))
    docs, labels = _labelled(spark, texts)
    fair = toxicity.train(docs, labels, fairness=5.0)
    plain = toxicity.train(docs, labels, fairness=0.0)
    mention = b"the muslims met at the river"
    assert abs(fair.weights.get("muslims", 0.0)) < abs(plain.weights.get("muslims", 0.0)) / 2
    assert fair.score(mention) < plain.score(mention)
    assert fair.score(b"you are vile trash") > 0.5


def test_neutral_mentions_score_alike(spark):
    """At the fairness in use, no name keeps weight in itself or in its beginnings."""
    insults = [f"{a}{b}" for a in ("vile", "scum", "filth", "trash") for b in "abcde"]
    remarks = [f"{a}{b}" for a in ("river", "garden", "supper", "letter") for b in "abcde"]
    texts = []
    for i in range(600):
        name = ("muslims", "gay", "black", "immigrants")[i % 4]
        other = ("christians", "straight", "white", "citizens")[i % 4]
        texts.append((f"those {name} and their {insults[i // 4 % 20]}", 1))
        texts.append((f"those {other} and their {remarks[i // 4 % 20]}", 0))
    model = toxicity.train(*_labelled(spark, texts))
    scores = {
        name: model.score(f"those {name} and their rivera".encode())
        for group in toxicity.IDENTITY_TERMS for name in group
    }
    assert max(scores.values()) < 0.7, scores
    assert max(scores.values()) - min(scores.values()) < 0.1, scores
    assert model.score(b"those people and their vilea") >= 0.7


def test_swaps_change_whole_feature_sets():
    """A beginning that another word keeps alive is not gone; all names also go at once."""
    groups = (("muslim", "hindu"),)
    swapped = toxicity.text_swaps(b"a muslim must hindu", groups)
    hindu, muslim = {"hindu", "^hin", "^hind", "^hindu"}, {"muslim", "^musl", "^musli", "^muslim"}
    assert swapped == [(hindu, set())] * 2 + [(muslim, set())] * 2 + [(hindu | muslim, set())]
    alone = toxicity.text_swaps(b"a muslim", groups)
    before, after = toxicity.features(b"a muslim"), toxicity.features(b"a hindu")
    assert alone[0] == (before - after, after - before)
    assert toxicity.text_swaps(b"nobody", groups) == []


def test_dual_coordinate_descent_solves_the_dual():
    """At the end no single coordinate of the dual can still move."""
    draw = np.random.default_rng(0)
    lists = [np.sort(draw.choice(12, 5, replace=False)) for _ in range(60)]
    labels = np.array([int(row[0] < 2) for row in lists])
    rows = Rows([str(i) for i in range(12)], labels, np.concatenate(lists), np.arange(60) * 5)
    scale = quality_classifier.class_ratios(rows)
    weights, bias = quality_classifier.fit_hinge(rows, scale, 1.0, 500)
    margins = (rows.times(weights * scale) + bias) * np.where(labels == 1, 1, -1)
    primal = 0.5 * (weights @ weights + bias**2) + np.maximum(0, 1 - margins).sum()
    for _ in range(200):
        other = weights + draw.normal(0, 0.05, 12)
        moved = (rows.times(other * scale) + bias) * np.where(labels == 1, 1, -1)
        assert 0.5 * (other @ other + bias**2) + np.maximum(0, 1 - moved).sum() >= primal - 1e-2


@pytest.mark.parametrize("module", [quality_classifier, toxicity])
def test_awkward_and_empty(spark, awkward, nothing, module):
    score = getattr(module, "quality_scores", None) or module.toxicity_scores
    name = "quality" if module is quality_classifier else "toxic"
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, None), (None, 1), (5, 0), (5, 1), (6, 7), (7, 0)],
        f"doc_id long, {name} int",
    )
    rows = score(awkward, labels).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] for r in rows if r["doc_id"] is None)
    assert score(nothing, labels).count() == 0
    without_labels = score(awkward, labels.limit(0)).collect()
    assert len({r["score"] for r in without_labels}) == 1


def test_sample_is_bounded_and_repeatable(spark):
    docs, labels = _labelled(spark, [(f"text {i}", i % 2) for i in range(300)])
    first = labelled_sample(docs.union(docs), labels, "toxic", 40).collect()
    again = labelled_sample(docs, labels.repartition(7), "toxic", 40).collect()
    assert len(first) == 40 and sorted(first) == sorted(again)
