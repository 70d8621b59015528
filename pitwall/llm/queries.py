"""Registered queries of the package: each operator with production parameters on its table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import (
    bpe,
    decontamination,
    html_extract,
    lm_scoring,
    oracles,
    periodic_runs,
    quality_classifier,
    quality_rules,
    secret_scan,
    simhash,
    source_divergence,
    token_counts,
    toxicity,
    url_filters,
)
from pitwall.llm.common import bounded_batches

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: First day of the year in which the pages count as fetched.
YEAR = "2024-01-01"
PATTERN = public_tokenizers.PATTERN


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the shared tables."""
    bounded_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and divergence verdict of every document."""
    return quality_rules.quality_rules(table(spark, folder, "documents"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under the 32k piece model."""
    return token_counts.token_counts(table(spark, folder, "documents"), PIECE_MODEL)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.toxicity_scores(docs, labels)


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of every document and of the decoded bytes."""
    docs = table(spark, folder, "documents")
    return bpe.round_trip(docs, BYTE_RANKS, PATTERN)


def op6_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.scan_texts(table(spark, folder, "documents"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality_classifier.quality_scores(docs, labels)


def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.main_text(table(spark, folder, "pages"))


def url_entries(captures: DataFrame) -> DataFrame:
    """A dated list (pattern, action, since) made from the hosts of the captures.

    The shared tables have no filter list. Digests of hosts, parent domains and first path parts
    decide which of them are listed, and on which days of 2024 they come and go.
    """

    def dated(source: DataFrame, action: str, listed: Column, day: Column) -> DataFrame:
        number = F.conv(F.substring(F.md5("pattern"), 1, 6), 16, 10).cast("long")
        return source.withColumn("v", number).filter(listed).select(
            "pattern",
            F.lit(action).alias("action"),
            F.date_add(F.lit(YEAR).cast("date"), day.cast("int")).alias("since"),
        )

    v = F.col("v")
    host = url_filters.host_of(F.col("url"))
    first = url_filters.path_of(F.col("url"), 1)
    hosts = captures.select(host.alias("pattern")).filter("pattern IS NOT NULL").distinct()
    paths = (
        captures.select(host.alias("host"), first.alias("first"))
        .filter("host IS NOT NULL AND size(first) > 0")
        .select(F.concat_ws("/", "host", F.col("first")[0]).alias("pattern"))
        .distinct()
    )
    parents = (
        hosts.filter(F.col("pattern").contains("."))
        .select(F.regexp_replace("pattern", r"^[^.]*[.]", "").alias("pattern"))
        .distinct()
    )
    return (
        dated(hosts, "block", v % 3 == 0, v % 300)
        .union(dated(hosts, "remove", v % 6 == 0, v % 300 + 10 + v % 60))
        .union(dated(hosts, "block", v % 12 == 0, v % 300 + 90))
        .union(dated(paths, "allow", v % 4 == 1, v % 350))
        .union(dated(parents, "block", v % 5 == 0, v % 350))
    )


def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict of every page by the entries that were active when it was fetched."""
    captures = table(spark, folder, "pages").select(
        "page_id",
        "url",
        F.date_add(F.lit(YEAR).cast("date"), (F.col("page_id") % 366).cast("int")).alias("fetched"),
    )
    intervals = url_filters.validity_intervals(url_entries(captures))
    return url_filters.filter_urls(captures, intervals)


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark words and items found in every document."""
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontamination.contamination(docs, benchmark).drop("n_near")


def op10_near_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The full result of the method: phrases as in op10_decontamination, and near matches."""
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontamination.contamination(docs, benchmark)


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Distance of every source to the others of its language, and its dearest terms."""
    return source_divergence.source_divergence(table(spark, folder, "documents"))


def op12_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every document under a Pitman-Yor model of six sevenths of them."""
    docs = table(spark, folder, "documents")
    return lm_scoring.lm_scores(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def planted_repeats(words: list[bytes], key: bytes | None) -> list[bytes]:
    """In texts that the checksum of the id chooses, the words repeat from some place on."""
    checksum, count = zlib.crc32(key or b""), len(words)
    if key is None or checksum % 10 or not count:
        return words
    drawn = checksum // 10
    start = drawn % count
    period = 1 + (count - start) // (3 + drawn % 8)
    cycle, left = words[start : start + period], count - start
    return words[:start] + (cycle * (left // period + 1))[:left]


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document: the strongest one, and digests of all and of the rest."""
    found = periodic_runs.periodic_runs(table(spark, folder, "documents"), prepare=planted_repeats)
    run = "struct<start: bigint, length: bigint, period: bigint>"
    # Runs come by start and period, so of equals the first one stays.
    best = F.aggregate(
        "runs",
        F.lit(None).cast(run),
        lambda kept, other: F.when(
            kept.isNull()
            | (other["length"] * kept["period"] > kept["length"] * other["period"]),
            other,
        ).otherwise(kept),
    )
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    every = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(every, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_simhash": op4_simhash,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_secret_scans": op6_secret_scans,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_html_extraction": op8_html_extraction,
    "op9_url_filters": op9_url_filters,
    "op10_decontamination": op10_decontamination,
    "op10_near_matches": op10_near_matches,
    "op11_source_divergence": op11_source_divergence,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op9_url_filters": oracles.URL_FILTERS,
    "op10_decontamination": oracles.DECONTAMINATION,
    "op11_source_divergence": oracles.SOURCE_DIVERGENCE,
}
