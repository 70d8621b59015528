"""URL filters whose lists change over time, in DataFrame operations only.

A list is a set of dated entries: a pattern (a domain, or a host with the beginning of a path) is
blocked, allowed or removed from a day on. Entries become validity intervals; every capture is
judged by an as-of join against the entries that were active on the day of its fetch. The most
specific active pattern decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.common import small_side, written

#: A day after all entries: the end of intervals that are still open.
FOREVER = "9999-12-31"
#: An authority: user part and port are not captured.
AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Host of a URL in lower case without a final dot; null if there is none."""
    host = F.rtrim(F.lower(F.regexp_extract(url, AUTHORITY, 1)), F.lit("."))
    return F.when(host != "", host)


def path_of(url: Column, depth: int) -> Column:
    """The first ``depth`` non-empty segments of the path, as an array."""
    segments = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), "/+")
    return F.slice(F.array_remove(segments, ""), 1, depth) if depth else F.array().cast("array<string>")


def validity_intervals(
    entries: DataFrame,
    *,
    pattern: str = "pattern",
    action: str = "action",
    since: str = "since",
) -> DataFrame:
    """(pattern, action, valid_from, valid_to) of every blocking or allowing entry.

    An entry holds from its day on, up to the day before the next entry of the pattern. Of several
    entries of a pattern on one day ``allow`` beats ``block`` and that beats ``remove``; repeated
    entries are one. Entries without a pattern or day, or with another action, are ignored.
    Patterns are compared in lower case up to the first slash.
    """
    rank = F.array_position(F.array(*map(F.lit, ("remove", "block", "allow"))), F.col("action"))
    name = F.col(pattern).cast("string")
    host = F.lower(F.substring_index(name, "/", 1))
    clean = entries.select(
        F.concat(host, F.expr(f"substr(`{pattern}`, length(substring_index(`{pattern}`, '/', 1)) + 1)"))
        .alias("pattern"),
        F.lower(F.col(action)).alias("action"),
        F.col(since).cast("date").alias("valid_from"),
    ).filter("pattern <> '' AND valid_from IS NOT NULL AND action IN ('remove', 'block', 'allow')")
    # One entry for each pattern and day, so a pattern has no more rows than days.
    daily = clean.groupBy("pattern", "valid_from").agg(F.max_by("action", rank).alias("action"))
    later = Window.partitionBy("pattern").orderBy("valid_from")
    until = F.coalesce(F.lead("valid_from").over(later), F.lit(FOREVER).cast("date"))
    return daily.select("pattern", "action", "valid_from", until.alias("valid_to")).filter(
        F.col("action") != "remove"
    )


def _candidates(host: Column, segments: Column) -> Column:
    """Patterns that can match: the host and its parent domains, and the host with path parts."""
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    paths = F.transform(
        segments,
        lambda _, i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i + 1), "/")),
    )
    return F.array_distinct(F.concat(domains, paths))


def filter_urls(
    captures: DataFrame,
    intervals: DataFrame,
    *,
    url: str = "url",
    fetched: str = "fetched",
    id_columns: tuple[str, ...] = ("page_id",),
) -> DataFrame:
    """One row per capture: id columns, url, host, fetched, verdict, pattern, valid_from, valid_to.

    ``intervals`` are those of ``validity_intervals``. ``verdict`` is ``block``, ``allow``, or
    ``none`` where no entry was active, the URL has no host or the day is unknown; the other
    columns are then null. The longest active pattern decides; at one day a pattern has one entry,
    so there are no ties. Captures of one site and day are judged once, which takes care of hot
    hosts, and the verdict is joined back to all of them. Repeated rows stay repeated; other
    columns are not read.
    """
    stored = written(intervals, "intervals")
    # Patterns deeper than any in the list need not be formed.
    depth = stored.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0

    seen = captures.select(
        *id_columns,
        F.col(url).alias("url"),
        F.col(fetched).cast("date").alias("fetched"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url), depth).alias("segments"),
    ).withColumn(
        "site", F.when(F.col("host").isNotNull(), F.concat_ws("/", "host", F.col("segments")))
    )
    sites = (
        seen.filter(F.col("site").isNotNull() & F.col("fetched").isNotNull())
        .select("site", "fetched", "host", "segments")
        .distinct()
    )
    tried = sites.select(
        "site", "fetched", F.explode(_candidates(F.col("host"), F.col("segments"))).alias("pattern")
    )
    active = (F.col("fetched") >= F.col("valid_from")) & (F.col("fetched") < F.col("valid_to"))
    judged = (
        tried.join(small_side(stored), "pattern")
        .filter(active)
        .groupBy("site", "fetched")
        .agg(
            F.max(
                F.struct(F.length("pattern").alias("n"), "pattern", "action", "valid_from", "valid_to")
            ).alias("best")
        )
    )
    return seen.join(judged, ["site", "fetched"], "left").select(
        *id_columns,
        "url",
        "host",
        "fetched",
        F.coalesce("best.action", F.lit("none")).alias("verdict"),
        "best.pattern",
        "best.valid_from",
        "best.valid_to",
    )
