"""Periodic runs and source divergence against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from pitwall.llm import periodic_runs, source_divergence
from pitwall.llm.queries import QUERIES, planted_repeats
from tests.llm.conftest import texts_of


def plain_runs(words, least=6, times=4):
    """Runs by trying every period at every place."""
    found = []
    for q in range(1, len(words) // times + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            part = words[start : end + q]
            smaller = (
                p for p in range(1, q) if all(a == b for a, b in zip(part, part[p:]))
            )
            if len(part) >= max(least, times * q) and next(smaller, None) is None:
                found.append((start, len(part), q))
            start = end + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def test_runs_equal_brute_force():
    draw, seen = random.Random(7), 0
    for _ in range(1500):
        letters, count = draw.choice([1, 2, 2, 3, 5]), draw.randint(0, 60)
        words = [draw.randrange(letters) for _ in range(count)]
        for _ in range(draw.randint(0, 3) if words else 0):
            at, unit = draw.randrange(len(words)), words[draw.randrange(len(words)) :]
            words[at:at] = (unit[: draw.randint(1, 9)] * draw.randint(2, 8))[: draw.randint(1, 50)]
        expected = plain_runs(words)
        assert periodic_runs.find_runs(np.array(words, dtype=np.int64)) == expected
        seen += len(expected)
    assert seen > 500


def test_runs_of_long_periods_and_long_texts():
    unit = np.random.default_rng(1).integers(0, 3, 4001)
    words = np.concatenate([[7, 8], np.tile(unit, 5), [9]])
    assert (2, 20005, 4001) in periodic_runs.find_runs(words)
    assert periodic_runs.find_runs(np.zeros(300_000, dtype=np.int64)) == [(0, 300_000, 1)]
    with pytest.raises(ValueError):
        periodic_runs.find_runs(words, least_times=3)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_row(key, text):
    """The row of the query, from its definition."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = None if key is None else zlib.crc32(str(key).encode())
    if h is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return (
        key, len(runs), *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query_equals_brute_force(spark, data):
    texts = [(k, t) for k, t in texts_of(spark.read.parquet(f"{data}/documents.parquet"))]
    short = [row for row in texts if len(row[1] or "") < 6000]
    assert len(short) > 150
    rows = {row["doc_id"]: tuple(row) for row in QUERIES["op13_periodic_runs"](spark, data).collect()}
    assert len(rows) == len(texts)
    for key, text in short:
        assert rows[key] == plain_row(key, text)
    assert sum(row[1] > 0 for row in rows.values()) > 10


def test_runs_of_awkward_rows(spark, awkward, nothing):
    rows = periodic_runs.periodic_runs(awkward, prepare=planted_repeats).collect()
    assert len(rows) == awkward.count()
    by_id = {row["doc_id"]: row for row in rows}
    for key in (2, 3, 4):
        assert (by_id[key]["runs"], by_id[key]["collapsed"]) == ([], "")
    assert [tuple(run) for run in by_id[7]["runs"]] == [(0, 20_000, 1)]
    assert by_id[7]["collapsed"] == "word"
    assert sum(row["doc_id"] == 5 for row in rows) == 2
    assert by_id[None]["collapsed"] == "no id here but words"
    assert periodic_runs.periodic_runs(nothing).count() == 0


def plain_divergence(docs, least=3, most=200):
    """Rows of the operator from its definition."""
    groups, texts = {}, {}
    for text, lang, source in ((a or "", b or "", c or "") for a, b, c in docs):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        own = groups.setdefault(lang, {}).setdefault(source, {})
        for term in terms:
            own[term] = own.get(term, 0) + 1
        for term in set(terms):
            texts[lang, term] = texts.get((lang, term), 0) + 1
    rows = []
    for lang, sources in groups.items():
        kept = sorted(t for (own, t), n in texts.items() if own == lang and n >= least)
        whole = {t: sum(c.get(t, 0) for c in sources.values()) for t in kept}

        def share(counts):
            total = sum(counts.get(t, 0) for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts.get(t, 0) + 1) // total for t in kept}

        shares = {source: share(counts) for source, counts in sources.items()}
        everyone = share(whole)
        for source, p in shares.items():
            pairs = [
                (sum((p[t] - q[t]) ** 2 // q[t] for t in kept), other)
                for other, q in shares.items() if other != source
            ]
            terms = [
                ((p[t] - everyone[t]) ** 2 // everyone[t], t)
                for t in kept if sources[source].get(t, 0) and p[t] > everyone[t]
            ]
            for part, items, limit in (("pair", pairs, None), ("term", terms, most)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit]
                rows += [(lang, source, part, i, v, r) for r, (v, i) in enumerate(ranked, 1)]
    return sorted(rows)


def rows_of(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_divergence_equals_brute_force(spark, monkeypatch):
    draw = random.Random(3)
    words = ["the", "The", "ÄB", "äb", "É", "日本", "a-b", "x1y", "zz", "😀", *(f"w{c}" for c in "abcdefgh")]
    docs = [
        (" ".join(draw.choices(words, k=draw.randint(0, 30))), draw.choice(["en", "de", ""]),
         f"s{int(draw.expovariate(0.5))}")
        for _ in range(200)
    ]
    docs += [(None, "en", "silent"), ("the the", None, None), ("only once here", "xx", "a"),
             ("", "xx", "b"), ("", "yy", "single")]
    docs += docs[:20]
    frame = spark.createDataFrame(docs, "text string, lang string, source string")
    expected = plain_divergence(docs)
    assert ("xx", "a", "pair", "b", 0, 1) in expected
    assert rows_of(source_divergence.source_divergence(frame)) == expected
    # Narrow blocks, chunks and buffers change nothing.
    monkeypatch.setattr(source_divergence, "BLOCK_TERMS", 3)
    monkeypatch.setattr(source_divergence, "CHUNK_SOURCES", 2)
    monkeypatch.setattr(source_divergence, "HELD_TERMS", 20)
    narrow = source_divergence.source_divergence(frame, most_terms=4)
    assert rows_of(narrow) == plain_divergence(docs, most=4)


def test_divergence_of_awkward_tables(spark, awkward, nothing):
    frame = awkward.selectExpr("*", "string(null) AS lang", "string(doc_id % 2) AS source")
    docs = [(r["text"], r["lang"], r["source"]) for r in frame.collect()]
    assert rows_of(source_divergence.source_divergence(frame)) == plain_divergence(docs)
    empty = nothing.selectExpr("*", "lang AS source")
    assert source_divergence.source_divergence(empty).count() == 0


def test_shares_are_exact_for_large_counts():
    counts = np.array([0, 5, 3 * 10**12])
    expected = [1 + 10**9 * (c + 1) // 7_000_000_000_001 for c in counts.tolist()]
    assert source_divergence.shares(counts, 7_000_000_000_001).tolist() == expected


def test_equal_subtrees_are_one_node():
    half = np.array([1, 0, 2, 2])
    forest = source_divergence.Forest(np.stack([np.r_[half, half], np.r_[half, 0 * half]]))
    assert forest.sizes() == [3, 3, 2, 2]
    assert forest.places[2][0, 0] == forest.places[2][0, 1] == forest.places[2][1, 0]
