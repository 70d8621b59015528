"""Quality rules by distribution divergence.

Each document has two histograms: bytes by character class, and common words of each language with
one bin for all other words. The reference of a language is the mean histogram of its documents
that pass the base rules. A document is rejected if the Jensen-Shannon distance to the reference of
its own language is too large; histograms of too little text, and documents whose language is not
known or has no reference, are not judged.
"""

from __future__ import annotations

import json
from collections import Counter
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import per_row, written

# Common words per language.
COMMON_WORDS = {
    "en": "the of and to in is that for it as was with be by on not he his but at are this have "
    "from or had an they which one you were all her she there would their",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch "
    "es an werden aus er hat dass sie nach wird bei einer um am sind noch wie",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce "
    "il sont avec son aux ou mais on cette ses elle nous comme",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus "
    "le ya o este sí porque esta entre cuando muy sin sobre",
}
# Symbols counted by the base rules.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

CLASSES = ("lower", "upper", "digit", "space", "stop", "mark", "symbol", "other", "wide")
_PUNCTUATION = b" .,;:!?\"'()"


def _class_of_byte() -> np.ndarray:
    """Character class of every byte; continuation bytes have none (the last index)."""
    kind = np.full(256, CLASSES.index("other"))
    kind[list(b"abcdefghijklmnopqrstuvwxyz")] = CLASSES.index("lower")
    kind[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = CLASSES.index("upper")
    kind[list(b"0123456789")] = CLASSES.index("digit")
    kind[list(SPACES)] = CLASSES.index("space")
    kind[list(b".,")] = CLASSES.index("stop")
    kind[list(b";:!?\"'()-")] = CLASSES.index("mark")
    kind[list(SYMBOLS)] = CLASSES.index("symbol")
    kind[0xC0:] = CLASSES.index("wide")
    kind[0x80:0xC0] = len(CLASSES)
    return kind


_KIND = _class_of_byte()
_IS_SPACE = np.isin(np.arange(256), list(SPACES))
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_STARTS = (np.arange(256) < 0x80) | (np.arange(256) >= 0xC0)


def base_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of one text."""
    words = data.split()
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    word_chars = int(seen[_STARTS & ~_IS_SPACE].sum())
    symbols = int(seen[_IS_SYMBOL].sum())
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that occurs twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    total, covered = 0, 0  # words before ``covered`` have been counted
    for i, window in enumerate(windows):
        if times[window] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def fails_base(n_words: int, n_repeat_words: int) -> bool:
    """The base rule: too short, or mostly repetition."""
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def class_histogram(data: bytes) -> np.ndarray:
    """Share of each character class."""
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    counts = np.bincount(_KIND, weights=seen, minlength=len(CLASSES) + 1)[: len(CLASSES)]
    return counts / max(1.0, counts.sum())


def word_bins() -> dict[bytes, int]:
    """Bin of each common word of any language."""
    words = sorted(set(chain.from_iterable(text.split() for text in COMMON_WORDS.values())))
    return {word.encode(): i for i, word in enumerate(words)}


_BINS = word_bins()
N_WORDS = len(_BINS) + 1


def word_histogram(data: bytes) -> np.ndarray:
    """Share of each common word, other words in the last bin; A-Z count as small letters."""
    counts = np.zeros(N_WORDS)
    for word, times in Counter(data.lower().split()).items():
        bin_ = _BINS.get(word)
        if bin_ is None:
            bin_ = _BINS.get(word.strip(_PUNCTUATION), N_WORDS - 1)
        counts[bin_] += times
    return counts / max(1.0, counts.sum())


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of ``p`` to each row of ``q``."""
    q = np.atleast_2d(q)
    middle = (p + q) / 2

    def divergence(x: np.ndarray) -> np.ndarray:
        ratio = np.where(x > 0, x / np.where(middle > 0, middle, 1.0), 1.0)
        return (x * np.log2(ratio)).sum(axis=1)

    total = divergence(np.broadcast_to(p, q.shape)) / 2 + divergence(q) / 2
    return np.sqrt(np.clip(total, 0.0, 1.0))


def language_references(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """Mean histograms per language over all documents that pass the base rules.

    One row per language that has such a document: lang, n_docs, classes and words (array<double>).
    Documents without a language are not used. Sums are built before the shuffle, one row per
    language and task.
    """

    def partial(batches):
        import pyarrow as pa

        sums: dict[str, list] = {}
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for language, data in zip(batch.column("lang").to_pylist(), texts, strict=True):
                words = (data or b"").split()
                if language is None or fails_base(len(words), repeated_words(words)):
                    continue
                own = sums.setdefault(language, [0, np.zeros(len(CLASSES)), np.zeros(N_WORDS)])
                own[0] += 1
                own[1] += class_histogram(data)
                own[2] += word_histogram(data)
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array(list(sums), pa.string()),
                "n": pa.array([own[0] for own in sums.values()], pa.int64()),
                "bins": pa.array(
                    [np.concatenate(own[1:]).tolist() for own in sums.values()],
                    pa.list_(pa.float64()),
                ),
            }
        )

    width = len(CLASSES) + N_WORDS
    parts = docs.select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    ).mapInArrow(partial, "lang string, n long, bins array<double>")
    summed = parts.groupBy("lang").agg(
        F.sum("n").alias("n_docs"),
        *[F.sum(F.col("bins")[i]).alias(f"b{i}") for i in range(width)],
    )
    means = [F.col(f"b{i}") / F.col("n_docs") for i in range(width)]
    return summed.filter("n_docs > 0").select(
        "lang",
        "n_docs",
        F.array(*means[: len(CLASSES)]).alias("classes"),
        F.array(*means[len(CLASSES) :]).alias("words"),
    )


def quality_rules(
    docs: DataFrame,
    references: DataFrame | None = None,
    *,
    text: str = "text",
    id_columns: tuple[str, ...] = ("doc_id",),
    lang: str = "lang",
    most_languages: int = 1000,
    class_limit: float = 0.25,
    word_limit: float = 0.25,
    word_slack: float = 0.8,
    least_chars: int = 200,
    least_words: int = 50,
) -> DataFrame:
    """Base counts and verdict per input row.

    Columns: the id columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, class_distance, word_distance, nearest_lang. ``references`` has the columns
    of ``language_references`` and is built from ``docs`` if absent. The distances are those to the
    reference of the document's own language, however few documents it was built from; they are null
    where the document has no language or its language no reference, and where the text has fewer
    than ``least_chars`` bytes or ``least_words`` words. A null distance never rejects. The word
    distance may reach ``word_limit`` plus ``word_slack`` over the root of the number of words, as
    the histogram of a short text is far from its own source's by chance. nearest_lang has the least
    word distance among the ``most_languages`` largest languages and the own one; it decides
    nothing. The references of those languages go to the tasks as one table; those of further
    languages are joined to their documents, with the same verdicts. Null and empty texts have no
    words and fail the base rules. Repeated rows stay repeated; other columns are not read.
    """
    if references is None:
        references = written(language_references(docs, text=text, lang=lang), "references")
    known = (
        references.filter("lang IS NOT NULL")
        .orderBy(F.desc("n_docs"), "lang")
        .limit(most_languages + 1)
        .collect()  # one short row per language
    )
    further = len(known) > most_languages
    known = known[:most_languages]
    names = [row["lang"].encode() for row in known]
    place = {name: i for i, name in enumerate(names)}
    classes = np.array([row["classes"] for row in known])
    words = np.array([row["words"] for row in known])

    def make():
        @lru_cache(maxsize=256)
        def unpacked(reference: bytes) -> tuple[np.ndarray, np.ndarray]:
            both = json.loads(reference)
            return np.array(both["classes"]), np.array(both["words"])

        def judge(data: bytes | None, own: bytes | None, reference: bytes | None = None) -> tuple:
            data = data or b""
            n_words, word_chars, symbols, dup_lines, repeat = base_counts(data)
            base_failed = fails_base(n_words, repeat)
            target = None
            if own in place:
                target = classes[place[own]], words[place[own]]
            elif reference is not None:
                target = unpacked(reference)
            by_class = by_word = nearest = None
            if target is not None and len(data) >= least_chars:
                by_class = float(jensen_shannon(class_histogram(data), target[0])[0])
            if n_words >= least_words and (names or target is not None):
                seen = word_histogram(data)
                if target is not None:
                    by_word, nearest = float(jensen_shannon(seen, target[1])[0]), own
                if names:
                    distances = jensen_shannon(seen, words)
                    best = int(distances.argmin())
                    if by_word is None or distances[best] < by_word:
                        nearest = names[best]
            kept = (
                not base_failed
                and (by_class is None or by_class <= class_limit)
                and (by_word is None or by_word <= word_limit + word_slack / n_words**0.5)
            )
            return (
                n_words, word_chars, symbols, dup_lines, repeat, base_failed, kept,
                by_class, by_word, None if nearest is None else nearest.decode(),
            )

        return judge

    fields = {
        "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
        "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean",
        "class_distance": "double", "word_distance": "double", "nearest_lang": "string",
    }
    rule = per_row(fields, make)
    # Apart from the id columns, names are the operator's own and cannot clash.
    ids = F.struct(*[F.col(name) for name in id_columns]).alias("_ids")
    given = docs.select(
        ids, F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang")
    )
    if further:
        in_table = F.coalesce(F.col("_lang").isin([row["lang"] for row in known]), F.lit(True))
        rest = references.filter(~F.col("lang").isin([row["lang"] for row in known])).select(
            F.col("lang").alias("_lang"), F.to_json(F.struct("classes", "words")).alias("_reference")
        )
        others = given.filter(~in_table).join(rest, "_lang", "left")
        judged = given.filter(in_table).select("_ids", rule("_text", "_lang").alias("_rule"))
        judged = judged.unionByName(
            others.select("_ids", rule("_text", "_lang", "_reference").alias("_rule"))
        )
    else:
        judged = given.select("_ids", rule("_text", "_lang").alias("_rule"))
    return judged.select("_ids.*", *[f"_rule.{name}" for name in fields])
