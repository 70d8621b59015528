"""Benchmark decontamination over a positional inverted index, in DataFrame operations only.

Every window of ten words of a benchmark item is found by its rarest term: corpus frequencies come
from all documents, and the postings of the chosen terms are stored with their position and the
words around them. Lining the stored neighbourhood up with the offset of the term in the window
intersects the offset-adjusted postings of all other terms of the window at once, so candidates
come only from the rarest list. Exact phrases and words that merely lie close by are both reported.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import small_side, without, written

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Words that a near match may spread beyond the length of a window.
SLOP = 5
#: Windows that one pass broadcasts; more of them take further passes.
BLOCK = 50_000


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case; null and empty texts have none."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    # Text of ASCII only can be lowered as a whole; elsewhere other letters keep their case.
    lowered = F.when(F.octet_length(whole) == F.length(whole), F.lower(whole)).otherwise(
        F.translate(whole, CAPITALS, CAPITALS.lower())
    )
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def item_windows(
    benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", window: int = WINDOW
) -> DataFrame:
    """Distinct windows (``gram``) with the ids of the items that have them (``items``)."""
    items = benchmark.select(F.col(item_id).alias("item"), words_of(F.col(text)).alias("words"))
    begins = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    return (
        items.filter(F.size("words") > 0)
        .select("item", "words", F.explode(begins).alias("begin"))
        .select("item", F.slice("words", F.col("begin"), window).alias("gram"))
        .groupBy("gram")
        .agg(F.collect_set("item").alias("items"))
    )


def term_frequencies(docs: DataFrame, windows: DataFrame, *, text: str = "text") -> DataFrame:
    """(term, frequency) over all documents for every term of the windows that occurs."""
    terms = written(windows.select(F.explode("gram").alias("term")).distinct(), "terms")
    spoken = docs.select(F.explode_outer(words_of(F.col(text))).alias("term"))
    return (
        spoken.join(small_side(terms), "term", "left_semi")
        .groupBy("term")
        .agg(F.count("*").alias("frequency"))
    )


def anchored(windows: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Windows with their rarest term: term, shift (its offset), gram, items.

    A window with a term that no document has cannot occur and is left out.
    """
    places = windows.select("gram", "items", F.posexplode("gram").alias("shift", "term"))
    # A very common term stands in many windows: the counted terms are sent to all of them.
    counted = small_side(written(frequencies, "frequencies"))
    rarest = F.struct(
        F.coalesce("frequency", F.lit(0)).alias("frequency"), F.col("term"), F.col("shift")
    )
    return (
        places.join(counted, "term", "left")
        .groupBy("gram")
        .agg(F.min(rarest).alias("rarest"), F.first("items").alias("items"))
        .filter(F.col("rarest.frequency") > 0)
        .select("rarest.term", "rarest.shift", "gram", "items")
    )


def positional_index(
    docs: DataFrame,
    terms: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    reach: int = WINDOW - 1 + SLOP,
) -> DataFrame:
    """Postings of the given terms, and one row for each document.

    Columns: doc_id, digest (of the text), n_words, pos, term, near. ``pos`` counts words from 1;
    ``near`` holds the words from ``pos - reach`` to ``pos + reach``. The row of the document
    itself has pos 0 and an empty term. ``terms`` must be small enough to be broadcast.
    """
    # The empty word in front makes the document's own row; positions then count from 1.
    split = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("digest"),
        F.concat(F.array(F.lit("")), words_of(F.col(text))).alias("words"),
    )
    placed = split.select("doc_id", "digest", "words", F.posexplode_outer("words").alias("pos", "term"))
    wanted = terms.select("term").union(docs.sparkSession.range(1).select(F.lit("").alias("term")))
    begin = F.greatest(F.col("pos") - reach, F.lit(1))
    return placed.join(F.broadcast(wanted), "term", "left_semi").select(
        "doc_id",
        "digest",
        (F.size("words") - 1).alias("n_words"),
        "pos",
        "term",
        F.when(
            F.col("pos") > 0,
            F.slice("words", begin + 1, F.col("pos") + reach - begin + 1),
        ).alias("near"),
    )


def matches(index: DataFrame, windows: DataFrame, *, reach: int = WINDOW - 1 + SLOP) -> DataFrame:
    """Windows that occur in the indexed documents.

    ``windows`` are those of ``anchored``. Columns: doc_id, digest, n_words, begin, n (length of
    the window), items, exact. ``exact`` rows are phrases at word ``begin``; in the others all
    words of the window lie within ``reach`` words of its rarest term, in any order.
    """
    first = F.greatest(F.col("pos") - reach, F.lit(1))  # position of the first word of ``near``
    begin = F.col("pos") - F.col("shift")
    length = F.size("gram")
    phrase = F.when(
        begin >= 1, F.slice("near", begin - first + 1, length) == F.col("gram")
    ).otherwise(False)
    close = F.size(F.array_except("gram", "near")) == 0
    return (
        index.filter(F.col("pos") > 0)
        .join(F.broadcast(windows), "term")
        .select("doc_id", "digest", "n_words", begin.alias("begin"), length.alias("n"), "items",
                phrase.alias("exact"), close.alias("close"))
        .filter(F.col("exact") | F.col("close"))
        .drop("close")
    )


def _searched(
    docs: DataFrame, benchmark: DataFrame, text: str, doc_id: str, item_text: str, item_id: str,
    window: int, slop: int, block: int,
) -> tuple[DataFrame, list[DataFrame]]:
    """A row for each document row, and the matches of each block of windows."""
    reach = window - 1 + slop
    grams = written(
        item_windows(benchmark, text=item_text, item_id=item_id, window=window), "windows"
    )
    known = written(anchored(grams, term_frequencies(docs, grams, text=text)), "anchors")
    n_blocks = max(1, -(-known.count() // block))
    found = []
    for number in range(n_blocks):
        part = known.filter(F.pmod(F.xxhash64("gram"), F.lit(n_blocks)) == number)
        index = written(
            positional_index(
                docs, part.select("term").distinct(), text=text, doc_id=doc_id, reach=reach
            ),
            "postings",
        )
        found.append(
            matches(index, part, reach=reach).select(
                "doc_id", "digest", "n_words", F.lit(0).alias("own"), "begin", "n", "items", "exact"
            )
        )
        if number == 0:
            kinds = found[0].schema
            rows = index.filter(F.col("pos") == 0).select(
                "doc_id", "digest", "n_words", F.lit(1).alias("own"),
                *[F.lit(None).cast(kinds[name].dataType).alias(name)
                  for name in ("begin", "n", "items", "exact")],
            )
    return rows, found


def clean_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    block: int = BLOCK,
) -> DataFrame:
    """Rows of ``docs`` in which no window of the benchmark occurs, with all columns."""
    _, found = _searched(
        docs, benchmark, text, doc_id, item_text, item_id, window, 0, block
    )
    hit = reduce(DataFrame.union, found).filter("exact").select("doc_id", "digest").distinct()
    key = {"doc_id": F.col(doc_id), "digest": F.xxhash64(F.col(text))}
    return without(docs, written(hit, "contaminated"), key)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    slop: int = SLOP,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near.

    ``n_hit`` counts words inside an occurrence of a window, ``n_items`` the items with one and
    ``n_near`` the items with at least a near match. Null texts have no words; items without words
    have no window, and an item of fewer words than ``window`` is one window. Windows of items
    without an id count as hits but name no item. Repeated rows stay repeated, repeated items count
    once; other columns are not read. Beyond ``block`` windows the documents are read once more for
    each further block of windows, so what is broadcast never grows.
    """
    rows, found = _searched(
        docs, benchmark, text, doc_id, item_text, item_id, window, slop, block
    )
    hit = F.when(F.col("exact"), F.struct("begin", "n"))
    spans = F.flatten(
        F.transform("spans", lambda s: F.sequence(s["begin"], s["begin"] + s["n"] - 1))
    )
    named = F.array_sort(
        F.array_distinct(F.transform(F.flatten("exact_items"), lambda i: i.cast("string")))
    )
    return (
        reduce(DataFrame.union, found, rows)
        .groupBy("doc_id", "digest", "n_words")
        .agg(
            F.sum("own").alias("copies"),
            F.collect_set(hit).alias("spans"),
            F.collect_set(F.when(F.col("exact"), F.col("items"))).alias("exact_items"),
            F.collect_set("items").alias("near_items"),
        )
        .select(
            "doc_id",
            F.col("n_words").cast("long").alias("n_words"),
            F.size(F.array_distinct(spans)).cast("long").alias("n_hit"),
            F.size(named).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", named), 256).alias("items_sha256"),
            (F.size("spans") > 0).alias("contaminated"),
            F.size(F.array_distinct(F.flatten("near_items"))).cast("long").alias("n_near"),
            F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"),
        )
        .drop("copy")
    )
