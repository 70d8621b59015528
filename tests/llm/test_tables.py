"""Operators that relate rows, and the pipeline, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from datetime import date

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from pitwall.llm import decontamination, quality_classifier, simhash, url_filters
from pitwall.llm.common import bounded_batches
from pitwall.llm.queries import ORACLES, QUERIES
from tests import oracle
from tests.llm.conftest import AWKWARD, texts_of
from tests.llm.test_texts import plain_secrets


def plain_fingerprint(text):
    """Fingerprint, bit by bit."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(" ".join(run).encode(), 42).intdigest() for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    """doc_id -> smallest doc_id reachable, from (doc_id, fingerprint) pairs."""
    left, found = list(range(len(pairs))), {}
    while left:
        group, waiting = [], [left.pop()]
        while waiting:
            i = waiting.pop()
            group.append(i)
            near = [j for j in left if (pairs[i][1] ^ pairs[j][1]).bit_count() <= 3]
            left = [j for j in left if j not in near]
            waiting += near
        ids = [pairs[i][0] for i in group if pairs[i][0] is not None]
        for i in group:
            found[i] = min(ids, default=None)
    return found


def test_simhash_equals_brute_force(spark, data):
    texts = texts_of(spark.read.parquet(f"{data}/documents.parquet"))
    pairs = [(key, plain_fingerprint(text)) for key, text in texts]
    expected = plain_components(pairs)
    rows = {r["doc_id"]: r for r in QUERIES["op4_simhash"](spark, data).collect()}
    for i, (key, value) in enumerate(pairs):
        assert rows[key]["fingerprint"] == f"{value:016x}"
        assert rows[key]["component_id"] == expected[i]


def test_golay_code_is_perfect():
    words = np.random.default_rng(2).integers(0, 1 << 23, 500)
    codes = np.arange(4096) << 11 | simhash._PARITY
    counts = np.array([int(c).bit_count() for c in codes])
    assert counts[counts > 0].min() == 7
    for word, index in zip(words, simhash.decode(words)):
        assert int(codes[index] ^ word).bit_count() <= 3


def test_keys_miss_no_link():
    draw = random.Random(4)
    ours = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 4000, dtype=np.int64)
    theirs = ours.view(np.uint64).copy()
    for i in range(len(theirs)):
        for bit in draw.sample(range(64), draw.choice([0, 1, 2, 3, 3, 3])):
            theirs[i] ^= np.uint64(1 << bit)
    keys = [set() for _ in ours]
    for row, key in zip(*simhash.search_keys(ours)):
        keys[row].add(key)
    hit = set()
    for row, key in zip(*simhash.stored_keys(theirs.view(np.int64))):
        if key in keys[row]:
            hit.add(row)
    assert len(hit) == len(ours)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(1, i) for i in range(2, 40)] + [(50, 39)]
    pairs = spark.createDataFrame([(min(p), max(p)) for p in chain + star], "low long, high long")
    for edges in (pairs, simhash.spanning_forest(pairs.repartition(3)), pairs.union(pairs)):
        found = dict(map(tuple, simhash.components(edges).collect()))
        assert {v for k, v in found.items() if k >= 100} == {100}
        assert {v for k, v in found.items() if k < 100} == {1}
    assert simhash.components(pairs.limit(0)).count() == 0


def test_simhash_awkward(awkward, nothing):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD)
    empty = [r for r in rows if r["doc_id"] in (2, 3, 4)]
    assert {(r["fingerprint"], r["component_id"]) for r in empty} == {("0" * 16, 2)}
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_one(nothing).columns == nothing.columns


def test_keep_one_of_each_component(spark):
    base = " ".join(f"word{i}" for i in range(400))
    other = " ".join(f"term{i}" for i in range(400))
    rows = [(7, base), (3, base), (3, base), (9, base), (None, base), (4, other), (4, base), (None, "x y")]
    docs = spark.createDataFrame([(*r, "keep") for r in rows], "doc_id long, text string, fp string")
    kept = simhash.keep_one(docs).collect()
    assert sorted((r["doc_id"] or -1, r["text"][:4], r["fp"]) for r in kept) == [
        (-1, "x y", "keep"), (3, "word", "keep"), (4, "term", "keep"),
    ]


ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "the of and the of and the of and the of and"),
    (3, "Short item"),
    (4, None),
    (5, "!!! ..."),
    (None, "nameless item words"),
    (10, "short ITEM"),
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
]
PASSAGES = [
    (1, "x ALPHA beta-gamma delta. epsilon zeta eta theta iota, kappa y"),
    (2, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"),
    (3, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (4, "the of and " * 8),
    (5, "a short item, a nameless item: words; short items"),
    (6, "kappa iota theta eta zeta epsilon delta gamma beta alpha"),
    (7, "Élan short\x00item ÉCLAIR"),
]


def plain_contamination(text, items):
    """n_words, n_hit and item ids of a text."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(value):
        return word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), value or ""))

    own, hit, named = words(text), set(), set()
    for item, value in items:
        terms = words(value)
        n = min(10, len(terms))
        for begin in range(len(terms) - n + 1) if n else ():
            gram = terms[begin : begin + n]
            for at in range(len(own) - n + 1):
                if own[at : at + n] == gram:
                    hit |= set(range(at, at + n))
                    if item is not None:
                        named.add(str(item))
    return len(own), len(hit), sorted(named)


@pytest.mark.parametrize("block", [50_000, 3])
def test_contamination_equals_brute_force(spark, block):
    docs = spark.createDataFrame(PASSAGES + AWKWARD, "doc_id long, text string")
    docs = docs.withColumn("n_words", F.lit(0)).withColumn("items", F.lit("x"))
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontamination.contamination(docs, benchmark, block=block).collect()
    texts = [(k, t) for k, t in PASSAGES + AWKWARD if t is None or len(t) < 1000]
    expected = []
    for key, text in texts:
        n_words, n_hit, named = plain_contamination(text, ITEMS)
        digest = hashlib.sha256(",".join(named).encode()).hexdigest()
        expected.append((key or -1, n_words, n_hit, len(named), digest, n_hit > 0))
    got = [(r["doc_id"] or -1, *r[1:6]) for r in rows if r["n_words"] < 1000 and r["doc_id"] != 6]
    assert sorted(got) == sorted(e for e in expected if e[0] != 6)
    assert len(rows) == docs.count()
    # The same words in another order are near, not exact.
    assert [(r["n_hit"], r["n_near"]) for r in rows if r["doc_id"] == 6 and r["n_words"] == 10] == [(0, 1)]


def plain_near(texts, items):
    """Items with a near match or phrase in each text: all words around the rarest one."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(value):
        return word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), value or ""))

    spoken = [words(text) for text in texts]
    often = Counter(term for own in spoken for term in own)
    near = [set() for _ in texts]
    for item, value in items:
        terms = words(value)
        n = min(10, len(terms))
        for begin in range(len(terms) - n + 1) if n and item is not None else ():
            gram = terms[begin : begin + n]
            rarest = min(gram, key=lambda term: (often[term], term))
            for own, found in zip(spoken, near):
                if any(
                    term == rarest and set(gram) <= set(own[max(0, at - 14) : at + 15])
                    for at, term in enumerate(own)
                ):
                    found.add(item)
    return [len(found) for found in near]


def test_near_matches_are_returned(spark, tmp_path):
    """The query names documents whose words are reordered or interspersed, too."""
    mixed = "alpha x beta y gamma delta z epsilon zeta eta theta iota kappa"
    texts = [text for _, text in PASSAGES] + [mixed, None, "nothing here"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    rows = sorted(QUERIES["op10_near_matches"](spark, str(tmp_path)).collect())
    assert [row["n_near"] for row in rows] == plain_near(texts, ITEMS)
    assert (rows[7]["n_hit"], rows[7]["n_near"]) == (0, 1)


def test_contamination_of_nothing(spark, nothing, awkward):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.contamination(nothing, benchmark).count() == 0
    rows = decontamination.contamination(awkward, benchmark.limit(0)).collect()
    assert len(rows) == len(AWKWARD) and not any(r["contaminated"] for r in rows)
    assert decontamination.clean_documents(awkward, benchmark.limit(0)).columns == awkward.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, data, name):
    difference = oracle.compare(spark, oracle.connect(data), data, QUERIES[name], ORACLES[name])
    assert difference is None, difference


ENTRIES = [
    ("Example.com", "block", "2024-01-10"),
    ("example.com", "remove", "2024-02-01"),
    ("example.com", "block", "2024-03-01"),
    ("example.com", "block", "2024-03-01"),
    ("news.example.com", "allow", "2024-01-15"),
    ("news.example.com", "block", "2024-01-15"),
    ("news.example.com/ads", "block", "2024-01-20"),
    (None, "block", "2024-01-01"),
    ("x.org", "other", "2024-01-01"),
    ("y.org", "block", None),
]
CAPTURES = [
    (1, "http://example.com/a", "2024-01-09"),
    (2, "http://WWW.Example.com:8080/a?b#c", "2024-01-10"),
    (3, "https://user:pw@example.com./", "2024-02-01"),
    (4, "https://example.com", "2024-03-01"),
    (5, "https://news.example.com/story", "2024-01-15"),
    (6, "https://news.example.com/ads/1", "2024-01-20"),
    (6, "https://news.example.com/ads/1", "2024-01-20"),
    (7, "https://badexample.com/", "2024-01-20"),
    (8, None, "2024-01-20"),
    (9, "mailto:someone", "2024-01-20"),
    (None, "http://example.com/", None),
    (10, "http://x.org/" + "a/" * 5000, "2024-01-20"),
]


def test_url_filters_as_of(spark):
    entries = spark.createDataFrame(ENTRIES, "pattern string, action string, since string")
    captures = spark.createDataFrame(CAPTURES, "page_id long, url string, fetched string")
    captures = captures.withColumn("verdict", F.lit("mine")).withColumn("site", F.lit(1))
    intervals = url_filters.validity_intervals(entries)
    rows = url_filters.filter_urls(captures, intervals).collect()
    got = sorted((r["page_id"] or -1, r["verdict"], r["pattern"]) for r in rows)
    assert got == sorted([
        (1, "none", None), (2, "block", "example.com"), (3, "none", None),
        (4, "block", "example.com"), (5, "allow", "news.example.com"),
        (6, "block", "news.example.com/ads"), (6, "block", "news.example.com/ads"),
        (7, "none", None), (8, "none", None), (9, "none", None), (-1, "none", None),
        (10, "none", None),
    ], key=lambda row: (row[0], row[1]))
    held = {(r["pattern"], r["valid_from"], r["valid_to"]) for r in intervals.collect()}
    assert ("example.com", date(2024, 1, 10), date(2024, 2, 1)) in held
    assert url_filters.filter_urls(captures.limit(0), intervals).count() == 0
    assert {r["verdict"] for r in url_filters.filter_urls(captures, intervals.limit(0)).collect()} == {"none"}


def test_native_queries_have_no_python(spark, data):
    for name in ("op9_url_filters", "op10_decontamination"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline_equals_brute_force(spark, data):
    bounded_batches(spark)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    model = quality_classifier.train(docs, labels)
    items = texts_of(spark.read.parquet(f"{data}/benchmark.parquet"), "text", "item_id")
    kept = [(k, t) for k, t in sorted(texts_of(docs)) if model.score((t or "").encode()) >= 0.5]
    groups = plain_components([(k, plain_fingerprint(t)) for k, t in kept])
    kept = [pair for i, pair in enumerate(kept) if groups[i] == pair[0]]
    kept = [(k, t) for k, t in kept if not plain_contamination(t, items)[1]]
    expected = {}
    for key, text in kept:
        done, parts = 0, []
        for start, end in sorted(tuple(map(int, s.split(":")[1:])) for s in plain_secrets(text)):
            if start >= done:
                parts += [text[done:start], "[SECRET]"]
            done = max(done, end)
        expected[key] = hashlib.sha256("".join([*parts, text[done:]]).encode()).hexdigest()
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.run(spark, data).collect()}
    assert got == expected and 0 < len(got) < docs.count()


def test_stages_keep_columns_and_survive_awkward_rows(spark, tmp_path, awkward):
    docs = awkward.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
    spark.createDataFrame([(1, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, str(tmp_path))
            assert out.columns == frame.columns, name
            assert out.count() <= frame.count()
        assert corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).count() == frame.count()
