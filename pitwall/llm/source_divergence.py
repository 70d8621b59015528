"""Divergence of sources within a language, over hash-consed segment trees of term counts.

Every source of a language has a segment tree over term ids whose leaves are its counts. Trees
are hash-consed: a node is known by its two children, a leaf by its count, so subtrees with the
same counts are one node, whichever sources and places hold them. Two trees are priced by walking
down both at once; a pair of nodes that was met before has its price already, and a price is the
sum of those of the two pairs of children.

Term ids are dealt into blocks by hash, in each block the most frequent terms first, so that rare
terms, whose counts are mostly zero, share subtrees. A block is a subtree of the whole tree; Spark
prices blocks in parallel, for chunks of sources against chunks of sources, and adds up. No task
holds more than the terms of a block for two chunks of sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.common import small_side, written
from pitwall.operators.ranges import keep_top

#: Bytes of terms, A-Z as a-z; all others part terms.
_LETTERS = bytes(
    byte | 32 if 65 <= byte <= 90 else byte if 97 <= byte <= 122 or byte >= 128 else 32
    for byte in range(256)
)
#: Parts per thousand million, to which all shares are rounded.
UNIT = 10**9
#: Terms of one block, and sources of one chunk.
BLOCK_TERMS = 512
CHUNK_SOURCES = 64
#: Terms of texts that a task holds before it passes their counts on.
HELD_TERMS = 4_000_000
_ROWS = 50_000
_PADDING = -1

PARTIAL = "lang string, source string, term string, n long, texts long"
PRICED = "lang string, source string, part string, item string, value long"
_PARTIAL = pa.schema(
    [(name, pa.string()) for name in ("lang", "source", "term")]
    + [(name, pa.int64()) for name in ("n", "texts")]
)
_PRICED = pa.schema(
    [(name, pa.string()) for name in ("lang", "source", "part", "item")] + [("value", pa.int64())]
)


class _Counts:
    """Occurrences and texts of terms by group, of the texts of one task so far."""

    def __init__(self) -> None:
        self.terms = _Numbers()
        self.groups = _Numbers()
        self.keys: list[np.ndarray] = []
        self.held = self.texts = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        terms = text.translate(_LETTERS).split()
        ids = np.fromiter(map(self.terms.__getitem__, terms), np.int64, len(terms))
        # Group, term and text in one number each; texts stay apart by their order.
        self.keys.append(self.groups[lang, source] << 32 | ids)
        self.held += len(terms)
        self.texts += 1

    def batches(self) -> Iterator[pa.RecordBatch]:
        """Rows of ``PARTIAL``."""
        key = np.concatenate([np.zeros(0, np.int64), *self.keys])
        text = np.repeat(np.arange(len(self.keys)), [len(own) for own in self.keys])
        order = np.argsort(key, kind="stable")
        key, text = key[order], text[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        # Within a key texts ascend, so each change of text is one more text.
        new_text = new.copy()
        new_text[1:] |= text[1:] != text[:-1]
        first = np.flatnonzero(new)
        n = np.diff(np.r_[first, len(key)])
        texts = np.add.reduceat(new_text.astype(np.int64), first) if len(first) else n
        group, term = key[first] >> 32, key[first] & 0xFFFFFFFF
        langs, sources = zip(*self.groups) if self.groups else ((), ())
        columns = [
            pa.array(langs, pa.string()).take(pa.array(group)),
            pa.array(sources, pa.string()).take(pa.array(group)),
            pa.array(list(self.terms), pa.binary()).cast(pa.string()).take(pa.array(term)),
            pa.array(n),
            pa.array(texts),
        ]
        rows = pa.RecordBatch.from_arrays(columns, schema=_PARTIAL)
        for at in range(0, len(rows), _ROWS):
            yield rows.slice(at, _ROWS)


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        return number


def term_counts(docs: DataFrame, *, text: str, lang: str, source: str) -> DataFrame:
    """Occurrences and texts of each term by (lang, source), summed within tasks only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counts()
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for row in zip(langs, sources, texts, strict=True):
                held.add(*row)
                if held.held > HELD_TERMS:
                    yield from held.batches()
                    held = _Counts()
        yield from held.batches()

    columns = [F.coalesce(F.col(name), F.lit("")) for name in (lang, source, text)]
    named = docs.select(*[c.alias(n) for c, n in zip(columns, ("lang", "source", "text"))])
    return named.mapInArrow(count, PARTIAL)


def kept_counts(partial: DataFrame, least_texts: int) -> DataFrame:
    """(lang, source, term, n, whole, first) of terms in enough texts of their language.

    ``whole`` is the count in the language, ``first`` holds for one row of each term. All sums
    need one shuffle by (lang, term); tasks have added up before it, so a frequent term has a row
    for each task and source at most.
    """
    # The hash comes first, so that sorting rarely compares strings.
    term = Window.partitionBy("key", "lang", "term")
    by_source = (
        partial.withColumn("key", F.xxhash64("lang", "term"))
        .repartition("key")
        .groupBy("key", "lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    )
    return (
        by_source.withColumn("in_texts", F.sum("texts").over(term))
        .withColumn("whole", F.sum("n").over(term))
        .withColumn("first", F.min("source").over(term) == F.col("source"))
        .filter(F.col("in_texts") >= least_texts)
        .select("lang", "source", "term", "n", "whole", "first")
    )


def shares(counts: np.ndarray, divisor: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / divisor), exact for counts of any size."""
    if len(counts) and int(counts.max()) >= (1 << 63) // UNIT - 1:
        counts = counts.astype(object)
    return (1 + UNIT * (counts + 1) // divisor).astype(np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); shares are at most UNIT + 1, so the square fits."""
    return (p - q) * (p - q) // q


class Forest:
    """Hash-consed segment trees over equally many leaves, a power of two.

    ``counts`` has a row of leaves for each tree. ``levels[k]`` are the nodes over 2**k leaves: the
    node of each tree at each place, and the children of each node. Leaves past the last term are
    ``_PADDING`` and cost nothing.
    """

    def __init__(self, counts: np.ndarray) -> None:
        trees, terms = counts.shape
        width = 1 << max(0, terms - 1).bit_length()
        leaves = np.full((trees, width), _PADDING, dtype=np.int64)
        leaves[:, :terms] = counts
        self.values, node = np.unique(leaves, return_inverse=True)
        node = node.reshape(leaves.shape)
        self.places, self.children = [node], []
        while node.shape[1] > 1:
            base = int(node.max()) + 1
            pairs = node[:, 0::2] * base + node[:, 1::2]
            known, node = np.unique(pairs, return_inverse=True)
            node = node.reshape(pairs.shape)
            self.children.append((known // base, known % base))
            self.places.append(node)
        # Whether any leaf below a node has a count.
        self.filled = [self.values > 0]
        for left, right in self.children:
            self.filled.append(self.filled[-1][left] | self.filled[-1][right])

    def sizes(self) -> list[int]:
        """Distinct nodes of each level, leaves first."""
        return [len(self.values)] + [len(left) for left, _ in self.children]

    def prices(
        self, first: np.ndarray, second: np.ndarray, divisors: list[int]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Price of tree ``first[i]`` against ``second[i]``, and the other way round, for all i.

        All walks go down level by level together. On each level a pair of nodes is kept once for
        each pair of trees, however many places it stands for.
        """
        pair = np.arange(len(first))
        a, b = self.places[-1][first, 0], self.places[-1][second, 0]
        ways = []
        for level in range(len(self.children) - 1, -1, -1):
            left, right = self.children[level]
            size = self.sizes()[level]
            wanted = np.concatenate([
                (pair * size + left[a]) * size + left[b],
                (pair * size + right[a]) * size + right[b],
            ])
            known, way = np.unique(wanted, return_inverse=True)
            ways.append(way.reshape(2, -1))
            b, known = known % size, known // size
            a, pair = known % size, known // size
        # The share of each count in each tree, for as many counts as the trees have.
        share = np.stack([shares(np.maximum(self.values, 0), divisor) for divisor in divisors])
        p, q = share[first[pair], a], share[second[pair], b]
        counted = (self.values[a] != _PADDING).astype(np.int64)
        there, back = price(p, q) * counted, price(q, p) * counted
        for way in reversed(ways):
            there, back = there[way].sum(axis=0), back[way].sum(axis=0)
        return there, back

    def leaves_against(self, whole: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tree, place, count, count in tree ``whole``) of every leaf with a count.

        Walks down each other tree beside ``whole`` and turns back at subtrees without counts.
        """
        trees = np.array([i for i in range(len(self.places[0])) if i != whole], dtype=np.int64)
        place = np.zeros(len(trees), dtype=np.int64)
        node = self.places[-1][trees, 0] if len(trees) else trees
        for level in range(len(self.children), -1, -1):
            seen = self.filled[level][node]
            trees, place, node = trees[seen], place[seen], node[seen]
            if level:
                left, right = self.children[level - 1]
                node = np.concatenate([left[node], right[node]])
                place = np.concatenate([2 * place, 2 * place + 1])
                trees = np.concatenate([trees, trees])
        # At the leaves: nodes are counts.
        return trees, place, self.values[node], self.values[self.places[0][whole, place]]


def priced_block(rows: dict[str, list], most_terms: int) -> dict[str, list]:
    """Prices within one block for two chunks of sources.

    ``rows`` has a row without a term for each source (``n`` and ``whole`` are then the totals of
    source and language, ``terms`` the number of kept terms), a row without a source for each term
    of the block (``whole`` is its count in the language) and a row for each count. Sources of
    the first chunk are compared with those of the second; within one chunk, sources are compared
    with each other and each with the language, of which the ``most_terms`` dearest terms stay.
    """
    heads = [i for i, term in enumerate(rows["term"]) if term is None]
    out: dict[str, list] = {"source": [], "part": [], "item": [], "value": []}
    if not heads:
        return out  # terms for two chunks that hold no source
    number = {rows["source"][i]: at for at, i in enumerate(heads)}
    names = list(number)
    terms = rows["terms"][heads[0]]
    divisors = [rows["n"][i] + terms for i in heads] + [rows["whole"][heads[0]] + terms]
    whole = {
        term: rows["whole"][i] for i, term in enumerate(rows["term"]) if rows["source"][i] is None
    }
    order = sorted(whole, key=lambda term: (-whole[term], term.encode()))
    place = {term: at for at, term in enumerate(order)}
    counts = np.zeros((len(names) + 1, max(1, len(order))), dtype=np.int64)
    if not order:
        counts[:] = _PADDING
    for source, term, n in zip(rows["source"], rows["term"], rows["n"], strict=True):
        if source is not None and term is not None:
            counts[number[source], place[term]] = n
    for term, at in place.items():
        counts[-1, at] = whole[term]
    forest = Forest(counts)

    def add(part: str, sources: list[str], items: list[str], values: np.ndarray) -> None:
        out["source"] += sources
        out["part"] += [part] * len(sources)
        out["item"] += items
        out["value"] += values.tolist()

    one, two = rows["one"][0], rows["two"][0]
    chunk = np.array([rows["chunk"][i] for i in heads])
    if one == two:
        first, second = np.triu_indices(len(names), 1)
    else:
        grid = np.meshgrid(np.flatnonzero(chunk == one), np.flatnonzero(chunk == two))
        first, second = grid[0].ravel(), grid[1].ravel()
    if len(first):
        there, back = forest.prices(first, second, [max(1, d) for d in divisors])
        left, right = [names[i] for i in first], [names[i] for i in second]
        add("pair", left, right, there)
        add("pair", right, left, back)
    if one == two and order:
        tree, at, count, in_whole = forest.leaves_against(len(names))
        q = shares(in_whole, divisors[-1])
        p = np.empty_like(q)
        for i in np.unique(tree):
            p[tree == i] = shares(count[tree == i], divisors[i])
        over = p > q
        tree, at, value = tree[over], at[over], price(p[over], q[over])
        by_name = np.argsort(np.argsort([term.encode() for term in order]))
        ranked = np.lexsort((by_name[at], -value, tree))
        tree, at, value = tree[ranked], at[ranked], value[ranked]
        start = np.searchsorted(tree, tree)
        top = np.arange(len(tree)) - start < most_terms
        add("term", [names[i] for i in tree[top]], [order[i] for i in at[top]], value[top])
    return out


def source_divergence(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_texts: int = 3,
    most_terms: int = 200,
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others and from whom.

    Terms are runs of letters (ASCII letters and all characters beyond ASCII, A-Z lower-cased).
    A language keeps those in ``least_texts`` or more of its texts. Part ``pair`` prices a source
    against each other source of its language over all kept terms, part ``term`` lists its
    ``most_terms`` dearest terms among those that it has relatively more of than the language.
    Shares, prices and sums are exact integers. Ranks go by value, then by item as UTF-8.

    Null texts, languages and sources count as empty ones. Sources without kept terms are priced
    like any other; a language with one source has no pairs, and without kept terms all its pairs
    cost zero. Repeated rows count again. An empty table gives no rows. Other columns are not read.
    """
    counts = written(
        kept_counts(term_counts(docs, text=text, lang=lang, source=source), least_texts),
        "kept-terms",
    )
    groups = docs.select(
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
    ).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    placed = written(groups.join(totals, ["lang", "source"], "left").fillna(0, ["n"]), "groups")
    languages = written(
        placed.groupBy("lang")
        .agg(F.count("*").alias("sources"), F.sum("n").alias("whole"))
        .join(counts.groupBy("lang").agg(F.count_if("first").alias("terms")), "lang", "left")
        .fillna(0, ["terms"])
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK_TERMS)))
        .withColumn("chunks", F.ceil(F.col("sources") / CHUNK_SOURCES)),
        "languages",
    )
    sides = small_side(languages)
    chunk = F.pmod(F.xxhash64("source"), F.col("chunks"))
    heads = placed.join(sides, "lang").select(
        "lang", "source", chunk.alias("chunk"), "chunks", F.lit(None).cast("string").alias("term"),
        "n", "whole", "terms",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
    )
    leaves = counts.join(sides.drop("whole"), "lang").select(
        "lang", "source", chunk.alias("chunk"), "chunks", "term", "n", "whole", "terms",
        F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "first",
    )
    named = leaves.filter("first").withColumn("source", F.lit(None).cast("string"))
    columns = ["lang", "block", "pair.one", "pair.two", "chunk", "source", "term", "n", "whole", "terms"]
    sent = (
        heads.unionByName(leaves.drop("first"))
        .withColumn("pair", F.explode(_chunk_pairs()))
        .select(*columns)
        .unionByName(
            named.drop("first").withColumn("pair", F.explode(_all_chunk_pairs())).select(*columns)
        )
    )

    def block(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        out = priced_block(rows, most_terms)
        out["lang"] = [rows["lang"][0]] * len(out["part"])
        return pa.table({name: out[name] for name in _PRICED.names}, schema=_PRICED)

    priced = written(
        sent.groupBy("lang", "block", "one", "two").applyInArrow(block, PRICED), "priced"
    )
    pairs = (
        priced.filter("part = 'pair'")
        .groupBy("lang", "source", "part", "item")
        .agg(F.sum("value").alias("value"))
    )
    # Of each block the dearest terms are here; the limit holds before rows are shuffled.
    order = [F.col("value").desc(), F.col("item")]
    terms = keep_top(priced.filter("part = 'term'"), ["lang", "source"], order, most_terms)
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(*order))
    return pairs.unionByName(terms).withColumn("rank", rank)


def _all_chunk_pairs() -> Column:
    """All pairs of chunks (one <= two) of a language."""
    last = F.col("chunks") - 1
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0).cast("long"), last),
            lambda one: F.transform(
                F.sequence(one, last), lambda two: F.struct(one.alias("one"), two.alias("two"))
            ),
        )
    )


def _chunk_pairs() -> Column:
    """Pairs of chunks (one <= two) that need the sources of a row's chunk."""
    return F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda other: F.struct(
            F.least(F.col("chunk"), other).alias("one"),
            F.greatest(F.col("chunk"), other).alias("two"),
        ),
    )
