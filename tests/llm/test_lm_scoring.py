"""The Pitman-Yor model against plain versions of its parts and of the whole."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.llm import lm_scoring, pitman_yor
from tests.llm.conftest import texts_of

TEXTS = [
    "the cat sat on the mat", "the cat ran", "The dog sat on the cat", "a rare one here", None,
    "", "the cat sat on the mat", "zig zag zig zag zig zag", "novel words only", "the the the the",
]


def words_of(text):
    """Words between ASCII white space, only A-Z lower-cased."""
    return (text or "").encode().lower().split()


def learned(spark, texts=TEXTS, every=4):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return frame, F.col("doc_id") % every == every - 1


def plain_base(rows, held):
    """doc_id -> (tokens, known, base score), and the training tokens, from the definition."""
    tokens = {key: [*words_of(text), None] for key, text in rows}
    counts = Counter(w for key, words in tokens.items() if not held(key) for w in words)
    total, distinct = sum(counts.values()), len(counts)
    return {
        key: (len(words), sum(counts[w] > 0 for w in words),
              sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words))
        for key, words in tokens.items()
    }, total


@pytest.mark.parametrize("coded", [0, 3])
def test_base_scores_equal_brute_force(spark, coded):
    frame, held = learned(spark)
    expected, total = plain_base(list(enumerate(TEXTS)), lambda key: key % 4 == 3)
    rows = lm_scoring.lm_scores(frame, held, coded=coded).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        n_tokens, known, base = expected[row["doc_id"]]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (n_tokens, known, total)
        assert row["base_score"] == pytest.approx(base)
        assert row["held_out"] == (row["doc_id"] % 4 == 3)
        assert row["perplexity"] == pytest.approx(10 ** (-row["score"] / n_tokens))


def plain_scores(rows, held, coded, burn_in=2, samples=3, strength=1.0):
    """Scores by the same draws, one cell at a time."""
    chosen = sorted({w for _, text in rows for w in words_of(text)}) if coded else []
    codes = {w: lm_scoring.FIRST + i for i, w in enumerate(chosen)}

    def tokens(text):
        words = [codes.get(w) or lm_scoring.hashed_code(w) for w in words_of(text)]
        return [lm_scoring.START, *words, lm_scoring.END]

    texts = {key: tokens(text) for key, text in rows}
    pairs = Counter(p for k, t in texts.items() if not held(k) for p in zip(t, t[1:]))
    counts = Counter(w for k, t in texts.items() if not held(k) for w in t[1:])
    customers = Counter(u for k, t in texts.items() if not held(k) for u in t[:-1])
    sizes = Counter(pairs.values())
    discount = pitman_yor.discount_of(sizes[1], sizes[2])
    ones = Counter(counts.values())
    top = pitman_yor.discount_of(ones[1], ones[2])
    base, total_tables = 1 / (len(counts) + 1), len(counts)

    def draw(code, word, n, weight, sweep, own):
        bits = pitman_yor.noise(np.array([code]), np.array([word]), sweep)
        logs = pitman_yor.log_arrangements(own)
        return int(pitman_yor.sample_tables(np.array([n]), np.array([weight]), bits, logs, own)[0])

    tables = {pair: 1 for pair in pairs}
    states = []
    for sweep in range(burn_in + samples + 1):
        if sweep:
            by, parent, _ = states[-1][1:]
            tables = {
                (u, w): draw(u, w, n, (strength + discount * by[u]) * parent[w], sweep, discount) if n > 1 else 1
                for (u, w), n in pairs.items()
            }
        by, served = Counter(), Counter()
        for (u, w), t in tables.items():
            by[u] += t
            served[w] += t
        weight = (strength + top * total_tables) * base
        seated = {w: draw(w, w, n, weight, sweep, top) for w, n in served.items()}
        total_tables = sum(seated.values())
        total = strength + sum(served.values())
        unknown = (strength + top * total_tables) / total * base
        parent = {w: (served[w] - top * seated[w]) / total + unknown for w in served}
        states.append((tables, by, parent, unknown))

    def probability(u, w):
        found = []
        for tables, by, parent, unknown in states[burn_in + 1 :]:
            above = parent.get(w, unknown)
            if customers[u]:
                own = pairs[u, w] - discount * tables.get((u, w), 0)
                above = (own + (strength + discount * by[u]) * above) / (strength + customers[u])
            found.append(above)
        return sum(found) / len(found)

    scores = {k: sum(math.log10(probability(*p)) for p in zip(t, t[1:])) for k, t in texts.items()}
    mass = {
        u: sum(probability(u, w) for w in counts) + probability(u, -1) for u in [*customers, -2]
    }
    return scores, mass


@pytest.mark.parametrize("coded", [0, 1000])
def test_scores_equal_brute_force(spark, data, coded, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BUCKET_TOKENS", 2000)
    monkeypatch.setattr(lm_scoring, "HELD_TOKENS", 300)
    docs = spark.read.parquet(f"{data}/documents.parquet").filter("doc_id < 5")
    rows = [*texts_of(docs), *((100 + i, text) for i, text in enumerate(TEXTS))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if coded:
        coded = 10**6
    expected, mass = plain_scores(rows, lambda key: key % 4 == 3, coded)
    for row in lm_scoring.lm_scores(frame, F.col("doc_id") % 4 == 3, coded=coded).collect():
        assert row["score"] == pytest.approx(expected[row["doc_id"]]), row["doc_id"]
    # Over all known words and an unknown one, probabilities add up to one in every context.
    assert all(total == pytest.approx(1) for total in mass.values())


def test_where_work_is_done_hardly_matters(spark, documents):
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    few, many = (
        {r["doc_id"]: r for r in lm_scoring.lm_scores(documents, held, coded=n).collect()}
        for n in (200, 10**6)
    )
    assert few.keys() == many.keys()
    tokens = sum(r["n_tokens"] for r in few.values())
    # Draws depend on codes, so scores differ as two runs of the sampler do.
    assert sum(abs(few[k]["score"] - many[k]["score"]) for k in few) / tokens < 0.01
    for key, row in few.items():
        assert row["base_score"] == pytest.approx(many[key]["base_score"])
        assert row["n_known"] == many[key]["n_known"]
    out = [r for r in many.values() if r["held_out"]]
    # Held-out texts are likelier than under the add-one unigram model.
    assert sum(r["score"] for r in out) > 0.92 * sum(r["base_score"] for r in out)


def test_awkward_rows(spark, awkward, nothing):
    rows = lm_scoring.lm_scores(awkward, F.col("doc_id") % 5 == 4, coded=4).collect()
    assert len(rows) == awkward.count()
    by_id = {row["doc_id"]: row for row in rows}
    for key in (2, 3, 4):
        assert by_id[key]["n_tokens"] == 1
    assert by_id[7]["n_tokens"] == 20_001
    assert by_id[None]["held_out"]
    twice = [row for row in rows if row["doc_id"] == 5]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert all(math.isfinite(row["score"]) and row["score"] < 0 for row in rows)
    assert lm_scoring.lm_scores(nothing, F.lit(False)).count() == 0
    unseen = lm_scoring.lm_scores(awkward, F.lit(True), coded=4).collect()
    assert {row["train_tokens"] for row in unseen} == {0}
    assert all(row["n_known"] == 0 and row["base_score"] == 0 for row in unseen)


def test_block_of_customers_follows_its_law():
    discount, weight, count = 0.4, 0.7, 5
    logs = pitman_yor.log_arrangements(discount)
    # All ways to seat five customers of one word, one after another.
    law = Counter()

    def seat(sizes, p):
        if sum(sizes) == count:
            law[len(sizes)] += p
            return
        seat([*sizes, 1], p * weight)
        for i, size in enumerate(sizes):
            seat([*sizes[:i], size + 1, *sizes[i + 1 :]], p * (size - discount))

    seat([1], weight)
    total = sum(law.values())
    bits = pitman_yor.mixed(np.arange(200_000))
    drawn = pitman_yor.sample_tables(
        np.full(200_000, count), np.full(200_000, weight), bits, logs, discount
    )
    for t in range(1, count + 1):
        assert np.mean(drawn == t) == pytest.approx(law[t] / total, abs=0.005)


def test_many_customers_open_tables_at_the_rule():
    discount, weight, size, rows = 0.5, 3.0, 3000, 400
    logs = pitman_yor.log_arrangements(discount)
    bits = pitman_yor.mixed(np.arange(rows))
    drawn = pitman_yor.sample_tables(np.full(rows, size), np.full(rows, weight), bits, logs, discount)
    first = pitman_yor.sample_tables(
        np.full(rows, pitman_yor.BLOCK), np.full(rows, weight), bits, logs, discount
    )
    draw = np.random.default_rng(1)
    expected = []
    for t in first:
        for n in range(pitman_yor.BLOCK, size):
            t += draw.random() < weight / (n - discount * t + weight)
        expected.append(t)
    assert np.mean(drawn) == pytest.approx(np.mean(expected), rel=0.05)
    assert (drawn <= size).all()


def test_packed_arrays_come_back():
    arrays = [np.array([1, -5, 2**62]), np.zeros(0, np.int32), np.array([0, 1], np.uint8)]
    for before, after in zip(arrays, lm_scoring.unpacked(lm_scoring.packed(*arrays)), strict=True):
        assert before.dtype == after.dtype and before.tolist() == after.tolist()


def test_cells_and_pairs_stay_packed(spark, documents, monkeypatch):
    rows, written = {}, lm_scoring._written

    def counted(frame, name, *more):
        table = written(frame, name, *more)
        rows[name] = max(rows.get(name, 0), table.count())
        return table

    monkeypatch.setattr(lm_scoring, "_written", counted)
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    lm_scoring.lm_scores(documents, held, coded=10**6).collect()
    # Of one bucket: texts and two packed rows a task, and a few rows for all cells and sweeps.
    assert rows["tokens"] <= documents.count() + 2 * 8
    assert rows["counted"] <= 20 and rows["swept"] <= 20
    lm_scoring.lm_scores(documents, held, coded=200).collect()
    assert rows["tokens"] <= documents.count() + 2 * 8
    assert rows["counted"] <= 20


@pytest.mark.parametrize("coded", [5, 60])
def test_some_words_coded_in_many_buckets_equal_brute_force(spark, data, coded, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BUCKET_TOKENS", 150)
    monkeypatch.setattr(lm_scoring, "HELD_TOKENS", 300)
    docs = spark.read.parquet(f"{data}/documents.parquet").filter("doc_id < 5")
    # Repeated texts repeat pairs of rare words, also across buckets and out of training.
    texts = [text for _, text in texts_of(docs)]
    rows = list(enumerate([*texts, *TEXTS, *texts[:2], "only held out twice held out twice", *texts]))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    codes, chosen, hashed = {}, lm_scoring.coded_words, lm_scoring.hashed_code

    def remembered(words, most):
        found = chosen(words, most)
        codes.update({word: lm_scoring.FIRST + i for i, word in enumerate(found[0])})
        return found

    monkeypatch.setattr(lm_scoring, "coded_words", remembered)
    scored = lm_scoring.lm_scores(frame, F.col("doc_id") % 4 == 3, coded=coded).collect()
    assert 0 < len(codes) <= coded
    monkeypatch.setattr(lm_scoring, "hashed_code", lambda word: codes.get(word) or hashed(word))
    expected, _ = plain_scores(rows, lambda key: key % 4 == 3, 0)
    assert len(scored) == len(rows)
    for row in scored:
        assert row["score"] == pytest.approx(expected[row["doc_id"]]), row["doc_id"]
