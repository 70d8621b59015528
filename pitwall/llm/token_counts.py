"""Token counts by a two-tier lookup of pre-tokens on the map side.

A sentencepiece BPE never merges across the start of a word (a run of word marks followed by other
characters), so the tokens of a text are the tokens of its words, one after another. The length of
a word comes from a compact table of frequent words, broadcast to all workers, else from the
worker's bounded cache, else from the library. Pre-tokens are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import per_text

#: Characters that often end a word and are part of its pre-token.
ENDINGS = ("", ",", ".")
MARK = "▁"


class _Lengths(dict):
    """Word -> number of tokens; misses are encoded and kept while there is room."""

    def __init__(self, frequent: dict[str, int], encoder, room: int, longest: int) -> None:
        super().__init__(frequent)
        self.frequent, self.encoder = frequent, encoder
        self.most, self.longest = len(frequent) + room, longest

    def __missing__(self, word: str) -> int:
        length = len(self.encoder.encode(word, num_threads=1))
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.clear()
                self.update(self.frequent)
            self[word] = length
        return length


def check_model(encoder) -> None:
    """Refuse models whose pieces cross word starts or whose text is normalised first."""
    probe = " Åﬁ  é "
    surface = "".join(encoder.encode(probe, out_type=str)).replace(MARK, " ")
    if surface != " " + probe:
        raise ValueError("the model normalises texts or adds no word mark in front")
    pieces = (encoder.id_to_piece(i) for i in range(encoder.get_piece_size()))
    if any(MARK in piece.lstrip(MARK) for piece in pieces):
        raise ValueError("the model has pieces that cross a word start")


def frequent_lengths(encoder, limit: int) -> dict[str, int]:
    """Lengths of at most ``limit`` frequent words.

    The vocabulary of a tokenizer is its list of frequent words: every piece that starts a word is
    taken, alone and with a common ending, and encoded by the library.
    """
    pieces = (encoder.id_to_piece(i) for i in range(encoder.get_piece_size()))
    words = (piece[1:] for piece in pieces if piece[:1] == MARK and len(piece) > 1)
    chosen = [word + end for word in words if word[0] != MARK for end in ENDINGS][:limit]
    return dict(zip(chosen, map(len, encoder.encode(chosen, num_threads=1)), strict=True))


def count_tokens(text: str, lengths, encode: Callable[[str], list]) -> int:
    """Tokens of one text, equal to ``len(encode(text))``."""
    if not text:
        return 0
    words = text.replace(MARK, " ").split(" ")
    if "" not in words:
        return sum(map(lengths.__getitem__, words))
    # Runs of spaces belong to the word after them; the last one stands alone.
    total, start, last = 0, 0, len(words) - 1
    for i, word in enumerate(words):
        if word:
            if start == i:
                total += lengths[word]
            else:
                total += len(encode(" " * (i - start) + word))
            start = i + 1
        elif i == last:
            total += len(encode(" " * (i - start))) if i > start else 1
    return total


def token_counts(
    docs: DataFrame,
    model_file: str,
    *,
    text: str = "text",
    id_columns: tuple[str, ...] = ("doc_id",),
    limit: int = 4096,
    table_size: int = 100_000,
    cache_size: int = 200_000,
    longest_cached: int = 64,
) -> DataFrame:
    """One row per input row: the id columns, n_bytes, n_tokens, over_limit.

    Null and empty texts have no bytes and no tokens. Repeated rows stay repeated. Other columns
    are not read, so their names cannot clash. ``limit`` is the number of tokens beyond which
    ``over_limit`` holds; ``table_size`` bounds the broadcast table and ``cache_size`` each
    worker's cache (words over ``longest_cached`` characters are encoded without being kept).
    The model file is read by the driver only and travels with the broadcast.
    """
    spark: SparkSession = docs.sparkSession
    with open(model_file, "rb") as file:
        model = file.read()
    encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
    check_model(encoder)
    shared = spark.sparkContext.broadcast((model, frequent_lengths(encoder, table_size)))

    def make():
        own_model, frequent = shared.value
        own = sentencepiece.SentencePieceProcessor(model_proto=own_model)
        lengths = _Lengths(frequent, own, cache_size, longest_cached)

        def encode(words: str) -> list:
            return own.encode(words, num_threads=1)

        def count(data: bytes) -> tuple:
            return len(data), count_tokens(data.decode(), lengths, encode)

        return count

    counted = per_text({"n_bytes": "long", "n_tokens": "long"}, make)
    return docs.select(*id_columns, counted(F.col(text)).alias("_count")).select(
        *id_columns,
        "_count.n_bytes",
        "_count.n_tokens",
        (F.col("_count.n_tokens") > limit).alias("over_limit"),
    )
