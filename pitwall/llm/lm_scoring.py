"""Scores of texts under a hierarchical Pitman-Yor model of word pairs, learned on Spark.

A first pass counts words. The most frequent ones, at most ``coded``, get small codes, and what
the model knows of them travels as broadcast arrays of bounded size; every other word is known by
a 62-bit hash of its bytes. A second pass stores the tokens of all texts as pairs (context, word),
packed by bucket: pairs of coded words by a hash of the pair, so that no frequent word makes a
large bucket, pairs with an uncoded word by that word. The few pairs of two uncoded words are in
the buckets of both, so that each uncoded word is counted in one place.

Counting, sampling and scoring then work on buckets in parallel. A sweep of the sampler seats all
cells (pairs seen twice or more; a lone customer has a table of its own) at once, given the table
counts and the parent of the sweep before; tables are summed by context and by word, and the
parent is seated anew. What a bucket knows of its uncoded words is packed in one row, which the
bucket's next sweep reads again; a row of its own has only what one bucket must tell another of a
word that they share a pair of. Each sample kept gives a probability to every pair, and the score
of a text is the sum of the logarithms of the mean probabilities.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import common
from pitwall.llm.pitman_yor import (
    discount_of,
    log_arrangements,
    noise,
    predictive,
    sample_tables,
)

#: Codes: the context of a first word, the word that ends a text, and the first coded word.
START, END, FIRST = 0, 1, 2
#: Codes from here on are hashes of uncoded words.
HASHED = 1 << 62
#: Tokens that a task holds before it packs them, and tokens of one bucket at most, about.
HELD_TOKENS = 2_000_000
BUCKET_TOKENS = 3_000_000
_HELD_WORDS = 1_000_000
#: Rows of an Arrow batch of numbers; batches of texts are smaller.
BATCH_NUMBERS = 50_000
_ROWS = 50_000
#: Texts that are turned into codes at once.
_TEXTS = 32
#: Bins of one doubling in the histogram that finds the most frequent words.
_BINS = 64

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

TOKENS = """kind int, rid long, bucket int, payload binary, held boolean, n_tokens long,
    n_known long, base double"""
_TOKENS = pa.schema(
    [
        ("kind", pa.int32()), ("rid", pa.int64()), ("bucket", pa.int32()),
        ("payload", pa.binary()), ("held", pa.bool_()), ("n_tokens", pa.int64()),
        ("n_known", pa.int64()), ("base", pa.float64()),
    ]
)
#: Kinds of rows of ``TOKENS``: a text, packed pairs of coded words, packed pairs with an uncoded
#: word (``rid`` is then the first text that was packed with them).
TEXT, CODED, MIXED = 0, 1, 2
_WORDS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("train", pa.int64())])
CELLS = "role int, bucket int, code long, n long, m long, payload binary"
_CELLS = pa.schema(
    [
        ("role", pa.int32()), ("bucket", pa.int32()), ("code", pa.int64()), ("n", pa.int64()),
        ("m", pa.int64()), ("payload", pa.binary()),
    ]
)
#: Roles of rows of ``CELLS``: packed cells of a bucket of coded words; packed sums by context and
#: by word for a block (``bucket``) of coded words; the packed uncoded words and cells of a bucket,
#: and their state after a sweep; what a bucket is told of a context (``n`` customers, ``m``
#: tables) and of a word (``n`` customers and ``m`` tables under the parent) of another one.
PAIRS, BY_CONTEXT, BY_WORD, WORDS, STATE, TOLD, TOLD_WORD = range(7)
#: Roles that are a number, ``n``: cells seen twice, lone cells of uncoded words seen again, uncoded
#: words seen once, and customers and tables of uncoded words under the parent.
TWOS, ONES, LONE, SERVED, SEATED = range(7, 12)
#: Coded words whose sums are packed in one row.
BLOCK_CODES = 1 << 14


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session for a while."""
    names = {"cleanup": _CLEANUP, "batch": "spark.sql.execution.arrow.maxRecordsPerBatch"}
    before = {name: spark.conf.get(names[name], None) for name in values}
    for name, value in values.items():
        spark.conf.set(names[name], value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(names[name]) if value is None else spark.conf.set(names[name], value)


def _written(frame: DataFrame, name: str, batch: int = BATCH_NUMBERS) -> DataFrame:
    """A table in the shared folder; the shuffle files of its job go when it is there."""
    with _settings(frame.sparkSession, cleanup="true", batch=str(batch)):
        return common.written(frame, name)


def _collected(frame: DataFrame) -> pa.Table:
    """A table of bounded size at the driver."""
    with _settings(frame.sparkSession, cleanup="true"):
        return frame.toArrow()


def tokens_of(text: bytes) -> list[bytes]:
    """Words of a text, A-Z as a-z."""
    return text.lower().split()


def hashed_code(word: bytes) -> int:
    """Code of a word outside the coded ones."""
    return HASHED | xxhash.xxh64_intdigest(word) >> 2


def is_coded(code: Column) -> Column:
    """True for codes of coded words."""
    return code < HASHED


# Words -------------------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n, train) of all texts and of those not held out; the empty word ends a text."""

    def passed_on(out: Counter, learned: Counter) -> Iterator[pa.RecordBatch]:
        words = list(out.keys() | learned.keys())
        for at in range(0, len(words), _ROWS):
            part = words[at : at + _ROWS]
            train = np.fromiter(map(learned.__getitem__, part), np.int64, len(part))
            other = np.fromiter(map(out.__getitem__, part), np.int64, len(part))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array(train + other),
                    pa.array(train),
                ],
                schema=_WORDS,
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, learned = Counter(), Counter()
        for batch in batches:
            held, data = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for held_out, text in zip(held, data, strict=True):
                counts = out if held_out else learned
                counts.update(tokens_of(text))
                counts[b""] += 1
            if len(out) + len(learned) > _HELD_WORDS:
                yield from passed_on(out, learned)
                out, learned = Counter(), Counter()
        yield from passed_on(out, learned)

    partial = texts.select("held", "text").mapInArrow(count, "word string, n long, train long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"), F.sum("train").alias("train"))


def _bin(n: Column) -> Column:
    return F.floor(F.log2(n) * _BINS).cast("int")


def coded_words(words: DataFrame, most: int) -> tuple[list[bytes], np.ndarray]:
    """The most frequent words, at most ``most``, and their training counts.

    A histogram of logarithmic bins tells which counts to collect, so no ranking is needed.
    """
    real = words.filter("word <> ''").withColumn("bin", _bin(F.col("n")))
    bins = sorted(((r[0], r[1]) for r in real.groupBy("bin").count().collect()), reverse=True)
    least, taken = 1 << 30, 0
    for number, size in bins:
        if taken + size > most:
            break
        least, taken = number, taken + size
    rows = _collected(real.filter(F.col("bin") >= least).select("word", "train").orderBy("word"))
    chosen = rows.column(0).cast(pa.binary()).to_pylist()
    return chosen, rows.column(1).to_numpy().astype(np.int64)


# Tokens ------------------------------------------------------------------------------------


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, compressed with the like bytes of all numbers together."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    out = []
    for array in arrays:
        planes = array.view(np.uint8).reshape(-1, array.itemsize).T.copy()
        data = squeeze(planes.tobytes())
        out.append(struct.pack("<2sII", array.dtype.str[1:].encode(), len(array), len(data)) + data)
    return b"".join(out)


def unpacked(data: bytes) -> list[np.ndarray]:
    """The arrays of :func:`packed`."""
    arrays, at, head = [], 0, struct.calcsize("<2sII")
    expand = zstandard.ZstdDecompressor().decompress
    while at < len(data):
        kind, count, size = struct.unpack_from("<2sII", data, at)
        dtype = np.dtype("<" + kind.decode())
        planes = np.frombuffer(expand(data[at + head : at + head + size]), np.uint8)
        values = planes.reshape(dtype.itemsize, count).T.copy()
        arrays.append(values.view(dtype).reshape(-1))
        at += head + size
    return arrays


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each pair or code, whichever task holds it."""
    return (noise(key, key, 0) % np.uint64(buckets)).astype(np.int32)


class _Codes(dict):
    """Word -> code; words outside are hashed."""

    def __missing__(self, word: bytes) -> int:
        return hashed_code(word)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """First positions of runs of equal rows."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = False
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _spans(column: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, start, end) of each value of a sorted column."""
    values, starts = np.unique(column, return_index=True)
    ends = np.append(starts, len(column))[1:]
    return list(zip(values.tolist(), starts.tolist(), ends.tolist(), strict=True))


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """Numbers from zero on, in as few bytes as the largest needs."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))


class _Tokens:
    """Pairs of the texts of one task so far.

    A pair with an uncoded word is that word, and a side: the code of its partner in the upper
    bits and whether it is the word. A pair of two uncoded words is stored for both.
    """

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(
        self, rids: np.ndarray, out: np.ndarray, lengths: np.ndarray, u: np.ndarray, w: np.ndarray
    ) -> None:
        self.parts.append((rids, out, lengths, u, w))
        self.held += len(u)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """One packed row for each kind and bucket: pair, text and repeats, and the texts' ids."""
        if not self.held:
            return
        rids, out, lengths, u, w = map(np.concatenate, zip(*self.parts, strict=True))
        text = np.repeat(np.arange(len(rids), dtype=np.int32), lengths)
        u_coded, w_coded = u < HASHED, w < HASHED
        both = u_coded & w_coded
        key, texts = u[both] << 32 | w[both], text[both]
        order = np.argsort(key, kind="stable")
        key, texts = key[order], texts[order]
        first = _runs(key, texts)
        times = np.diff(np.r_[first, len(key)])
        key = key[first]
        bucket = bucket_of(key, self.buckets)
        yield from self._by_bucket(CODED, bucket, rids, out, texts[first], times, key)
        code = np.r_[w[~w_coded], u[~u_coded]]
        # The shift of an uncoded partner fills the sign bit.
        side = np.r_[u[~w_coded] << 1 | 1, w[~u_coded] << 1]
        texts = np.r_[text[~w_coded], text[~u_coded]]
        order = np.lexsort((texts, side, code))
        code, side, texts = code[order], side[order], texts[order]
        first = _runs(code, side, texts)
        times = np.diff(np.r_[first, len(code)])
        code, side = code[first], side[first]
        bucket = bucket_of(code, self.buckets)
        yield from self._by_bucket(MIXED, bucket, rids, out, texts[first], times, code, side)

    def _by_bucket(
        self, kind: int, bucket: np.ndarray, rids: np.ndarray, out: np.ndarray,
        text: np.ndarray, times: np.ndarray, key: np.ndarray, *more: np.ndarray,
    ) -> Iterator[pa.RecordBatch]:
        order = np.argsort(_narrow(bucket), kind="stable")
        bucket, text, times, key, *more = (c[order] for c in (bucket, text, times, key, *more))
        for number, start, end in _spans(bucket):
            here = np.zeros(len(rids), bool)
            here[text[start:end]] = True
            own = (np.cumsum(here) - 1)[text[start:end]]
            payload = packed(
                np.diff(key[start:end], prepend=0),
                _narrow(own),
                _narrow(times[start:end]),
                np.diff(rids[here], prepend=0),
                out[here],
                *[column[start:end] for column in more],
            )
            yield _rows(
                _TOKENS, kind=[kind], rid=[int(rids[0])], bucket=[number], payload=[payload]
            )


def stored_tokens(texts: DataFrame, shared, buckets: int) -> DataFrame:
    """Rows of ``TOKENS``, written, with the id of the text in rows of texts.

    The row of a text counts its tokens, and of its coded tokens how many are known and the sum
    of their base logarithms. ``shared`` holds the coded words and the base logarithm and
    training count of each code.
    """
    doc_id = texts.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, base, train = shared.value
        lookup = _Codes(zip(words, range(FIRST, FIRST + len(words)), strict=True)).__getitem__
        rid = TaskContext.get().partitionId() << 40
        held = _Tokens(buckets)
        for batch in batches:
            for at in range(0, len(batch), _TEXTS):
                ids, out, data = batch.slice(at, _TEXTS).columns
                tokens = [tokens_of(text) for text in data.cast(pa.binary()).to_pylist()]
                lengths = np.array([len(own) + 1 for own in tokens])
                ends = np.cumsum(lengths) - 1
                starts = np.r_[0, ends[:-1] + 1]
                is_word = np.ones(ends[-1] + 1, bool)
                is_word[ends] = False
                w = np.full(len(is_word), END, np.int64)
                w[is_word] = np.fromiter(
                    map(lookup, chain.from_iterable(tokens)), np.int64, len(w) - len(ends)
                )
                u = np.r_[START, w[:-1]]
                u[starts] = START
                coded = w < HASHED
                code = np.where(coded, w, 0)
                rids = rid + 1 + np.arange(len(ids))
                out = out.to_numpy(zero_copy_only=False)
                docs = _rows(
                    _TOKENS,
                    kind=np.full(len(ids), TEXT, np.int32),
                    rid=rids,
                    held=out,
                    n_tokens=lengths,
                    n_known=np.add.reduceat(coded & (train[code] > 0), starts, dtype=np.int64),
                    base=np.add.reduceat(np.where(coded, base[code], 0.0), starts),
                )
                yield from with_ids([docs], ids)
                rid += len(ids)
                held.add(rids, out.astype(np.uint8), lengths, u, w)
                if held.held > HELD_TOKENS:
                    yield from with_ids(held.batches(), None)
                    held = _Tokens(buckets)
        yield from with_ids(held.batches(), None)

    def with_ids(batches, ids) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.nulls(len(batch), id_type) if ids is None else ids
            yield pa.RecordBatch.from_arrays([own, *batch.columns], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(texts.schema["doc_id"].dataType)
    schema = pa.schema([("doc_id", id_type), *_TOKENS])
    rows = texts.select("doc_id", "held", "text").mapInArrow(read, f"doc_id {doc_id}, {TOKENS}")
    return _written(rows, "tokens", common.BATCH_ROWS)


# Cells -------------------------------------------------------------------------------------


def _rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """Rows of a schema; columns not given are null."""
    count = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type)
            for f in schema
        ],
        schema=schema,
    )


def _summed(code: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code, inverse = np.unique(code, return_inverse=True)
    return code, np.bincount(inverse, values, len(code)).astype(np.int64)


def _sum_rows(role: int, code: np.ndarray, n: np.ndarray) -> list[pa.RecordBatch]:
    """Sums by code of coded words, packed by block."""
    code, n = _summed(code, n)
    return [
        _rows(
            _CELLS, role=[role], bucket=[block],
            payload=[packed((code[start:end] % BLOCK_CODES).astype(np.int32), n[start:end])],
        )
        for block, start, end in _spans(code // BLOCK_CODES)
    ]


def _numbers(numbers: dict[int, int]) -> pa.RecordBatch:
    """A row for each role that is a number."""
    return _rows(_CELLS, role=list(numbers), n=[int(n) for n in numbers.values()])


def totals(rows: DataFrame, *roles: int) -> list[int]:
    """Sums of the numbers of some roles."""
    found = rows.filter(F.col("role").isin(*roles)).groupBy("role").agg(F.sum("n")).collect()
    by_role = {role: int(n) for role, n in found}
    return [by_role.get(role, 0) for role in roles]


def coded_sums(rows: DataFrame, size: int) -> dict[int, np.ndarray]:
    """Arrays by code of the packed sums of each role, added up on the way to the driver."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK_CODES, np.int64)
        for payload in table.column("payload").to_pylist():
            code, n = unpacked(payload)
            total[code] += n
        role, block = table.column("role")[0].as_py(), table.column("bucket")[0].as_py()
        code = np.flatnonzero(total)
        return pa.Table.from_batches(
            _sum_rows(role, code + block * BLOCK_CODES, total[code]), schema=_CELLS
        )

    sums = rows.filter(F.col("role").isin(BY_CONTEXT, BY_WORD))
    arrays = {role: np.zeros(size, np.int64) for role in (BY_CONTEXT, BY_WORD)}
    added = _collected(sums.groupBy("role", "bucket").applyInArrow(add, CELLS))
    for row in added.select(["role", "bucket", "payload"]).to_pylist():
        code, n = unpacked(row["payload"])
        arrays[row["role"]][code + row["bucket"] * BLOCK_CODES] = n
    return arrays


def _bucket(table: pa.Table) -> list[tuple[np.ndarray, ...]]:
    """(key, text, times, rid, held out, ...) of each packed row of a bucket."""
    parts = []
    for payload in table.column("payload").to_pylist():
        key, text, times, rids, out, *more = unpacked(payload)
        parts.append((np.cumsum(key), text, times, np.cumsum(rids), out, *more))
    return parts


def _in_training(parts: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """Repeats of each entry in its text, none for texts held out."""
    return np.concatenate([np.where(out[text] > 0, 0, n) for _, text, n, _, out, *_ in parts])


def _by_text(
    table: pa.Table, parts: list[tuple[np.ndarray, ...]], *values: np.ndarray
) -> pa.Table:
    """Rows of ``SCORED``: packed sums of ``values`` over each text's entries."""
    firsts, sums, at = table.column("rid").to_pylist(), [], 0
    for first, (key, text, times, rid, *_) in zip(firsts, parts, strict=True):
        own = [np.bincount(text, value[at : at + len(key)] * times, len(rid)) for value in values]
        sums.append(packed((rid - first).astype(np.int32), *own))
        at += len(key)
    return pa.table({"rid": pa.array(firsts, pa.int64()), "payload": pa.array(sums, pa.binary())})


def added_up(scored: DataFrame) -> DataFrame:
    """(rid, score, base, known) from packed sums: one row for each text."""

    def add(table: pa.Table) -> pa.Table:
        parts = [unpacked(payload) for payload in table.column("payload").to_pylist()]
        size = 1 + max(int(part[0].max(initial=0)) for part in parts)
        sums = np.zeros((3, size))
        for text, *values in parts:
            for total, value in zip(sums, values):
                total[text] += value
        rid = table.column("rid")[0].as_py() + np.arange(size)
        columns = [rid, sums[0], sums[1], sums[2].astype(np.int64)]
        return pa.Table.from_arrays([*map(pa.array, columns)], names=["rid", "score", "base", "known"])

    return scored.groupBy("rid").applyInArrow(add, "rid long, score double, base double, known long")


def _split(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return key >> 32, key & 0xFFFFFFFF


def _by_bucket(tokens: DataFrame, kind: int, buckets: int):
    rows = tokens.filter(F.col("kind") == kind).select("bucket", "rid", "payload")
    # Packed rows are small beside the work in them, so partitions are not to be merged by size.
    return rows.repartition(buckets, "bucket").groupBy("bucket")


def coded_cells(tokens: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``CELLS`` of pairs of coded words: cells of two or more, and sums of the lone ones."""

    def count(table: pa.Table) -> pa.Table:
        parts = _bucket(table)
        key, n = _summed(np.concatenate([part[0] for part in parts]), _in_training(parts))
        u, w = _split(key)
        several, once = n > 1, n == 1
        cells = packed(np.diff(key[several], prepend=0), n[several])
        return pa.Table.from_batches([
            _rows(_CELLS, role=[PAIRS], bucket=[table.column("bucket")[0].as_py()], payload=[cells]),
            *_sum_rows(BY_CONTEXT, u[once], n[once]),
            *_sum_rows(BY_WORD, w[once], n[once]),
            _numbers({TWOS: (n == 2).sum()}),
        ])

    return _by_bucket(tokens, CODED, buckets).applyInArrow(count, CELLS)


def _partner(side: np.ndarray) -> np.ndarray:
    """Code of the partner; that of an uncoded one has filled the sign bit."""
    return (side >> 1) & ((1 << 63) - 1)


class _Mixed:
    """A bucket of pairs with uncoded words; a pair of two is in the buckets of both."""

    def __init__(self, table: pa.Table) -> None:
        self.parts = _bucket(table)
        code = np.concatenate([part[0] for part in self.parts])
        side = np.concatenate([part[5] for part in self.parts])
        self.is_word = side & 1 == 1
        training = _in_training(self.parts)
        #: Uncoded words, their counts in training, and the one of each entry.
        self.codes, self.own = np.unique(code, return_inverse=True)
        self.train = np.bincount(
            self.own[self.is_word], training[self.is_word], len(self.codes)
        ).astype(np.int64)
        #: Words seen again in training.
        self.again = np.flatnonzero(self.train > 1)
        #: Distinct cells: word, partner, whether the uncoded one is the word; the one of each entry.
        order = np.lexsort((side, self.own))
        first = _runs(self.own[order], side[order])
        self.cell = np.empty(len(order), np.int64)
        self.cell[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
        self.cell_own, self.cell_side = self.own[order][first], side[order][first]
        self.cell_partner, self.cell_is_word = _partner(self.cell_side), self.cell_side & 1 == 1
        self.cell_n = np.bincount(self.cell, training, len(first)).astype(np.int64)
        self.coded_partner = self.cell_partner < HASHED
        #: Where a cell is scored and counted: of two uncoded words, by the word.
        self.scored = self.cell_is_word | self.coded_partner

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Context and word of each cell."""
        code = self.codes[self.cell_own]
        return (
            np.where(self.cell_is_word, self.cell_partner, code),
            np.where(self.cell_is_word, code, self.cell_partner),
        )


def mixed_cells(tokens: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``CELLS`` of pairs with uncoded words, and of the uncoded words themselves."""

    def count(table: pa.Table) -> pa.Table:
        mixed = _Mixed(table)
        n, is_word, partner = mixed.cell_n, mixed.cell_is_word, mixed.cell_partner
        once, several = n == 1, n > 1
        place = np.full(len(mixed.codes), -1, np.int32)
        place[mixed.again] = np.arange(len(mixed.again))
        # A word seen once has one cell, a lone one, and needs no state.
        lone_context, lone_word = (
            np.bincount(mixed.cell_own[once & side], minlength=len(place))[mixed.again]
            for side in (~is_word, is_word)
        )
        known = mixed.train[mixed.cell_own] > 0
        asked = np.flatnonzero(~mixed.scored & known)
        owner, target, asked_several = _asked(mixed, asked, several, buckets)
        told = np.flatnonzero(several & is_word & ~mixed.coded_partner)
        teller, listener, _ = _asked(mixed, told, several, buckets)
        words = packed(
            np.diff(mixed.codes[mixed.again], prepend=0), lone_context, lone_word,
            place[mixed.cell_own[several]], mixed.cell_side[several], n[several],
            mixed.codes[owner], place[owner], mixed.train[owner], target, asked_several,
            place[teller], listener,
        )
        by_context, by_word = (once & mixed.coded_partner & side for side in (is_word, ~is_word))
        return pa.Table.from_batches([
            _rows(_CELLS, role=[WORDS], bucket=[table.column("bucket")[0].as_py()], payload=[words]),
            *_sum_rows(BY_CONTEXT, partner[by_context], n[by_context]),
            *_sum_rows(BY_WORD, partner[by_word], n[by_word]),
            _numbers({
                TWOS: (mixed.scored & (n == 2)).sum(),
                ONES: lone_word.sum(),
                LONE: (mixed.train == 1).sum(),
            }),
        ])

    return _by_bucket(tokens, MIXED, buckets).applyInArrow(count, CELLS)


def _asked(
    mixed: _Mixed, cells: np.ndarray, several: np.ndarray, buckets: int
) -> tuple[np.ndarray, ...]:
    """Words of some cells, each bucket of a partner of theirs, and if such a cell is repeated."""
    to = mixed.cell_own[cells] * buckets + bucket_of(mixed.cell_partner[cells], buckets)
    to, inverse = np.unique(to, return_inverse=True)
    repeated = np.bincount(inverse, several[cells], len(to)) > 0
    return to // buckets, (to % buckets).astype(np.int32), repeated.astype(np.uint8)


# Sampling ----------------------------------------------------------------------------------


@dataclass
class Model:
    """What is known of coded words, as arrays by code, and of all others by rule.

    ``tables`` and ``parent`` have a row for each sweep kept: tables of each word's restaurant, and
    its probability under the parent. ``customers`` are those of the parent and the strength,
    ``unknown`` is the probability of a word never seen.
    """

    train: np.ndarray
    tables: list[np.ndarray]
    parent: list[np.ndarray]
    customers: list[float]
    unknown: list[float]
    discount: float
    parent_discount: float
    strength: float
    first_sweep: int

    def last(self) -> Model:
        """The state after the last sweep only."""
        names = ("tables", "parent", "customers", "unknown")
        return replace(self, **{name: getattr(self, name)[-1:] for name in names})

    def served(self, sample: int, served: np.ndarray, seated: np.ndarray) -> np.ndarray:
        """Probability under the parent of words with so many customers and tables there."""
        own = (served - self.parent_discount * seated) / self.customers[sample]
        return own + self.unknown[sample]

    def cell_tables(
        self, sweep: int, u: np.ndarray, w: np.ndarray, count: np.ndarray,
        tables: np.ndarray, parent: np.ndarray, logs: np.ndarray,
    ) -> np.ndarray:
        """Tables of cells in a sweep, given those of their contexts and their parents before it."""
        weight = (self.strength + self.discount * tables) * parent
        return sample_tables(count, weight, noise(u, w, sweep), logs, self.discount)


def _mean(
    model: Model, logs: np.ndarray, u: np.ndarray, w: np.ndarray, count: np.ndarray,
    customers: np.ndarray, tables: Callable[[int], np.ndarray], parent: Callable[[int], np.ndarray],
) -> np.ndarray:
    """Mean probability of cells over the samples; the first sweep kept only starts them."""
    total = np.zeros(len(u))
    several = np.flatnonzero(count > 1)
    for sample in range(1, len(model.tables)):
        own = np.minimum(count, 1)
        before, above = tables(sample - 1)[several], parent(sample - 1)[several]
        own[several] = model.cell_tables(
            model.first_sweep + sample, u[several], w[several], count[several], before, above, logs
        )
        total += predictive(
            count, own, customers, tables(sample), parent(sample), model.discount, model.strength
        )
    return total / (len(model.tables) - 1)


def _drawn(pairs: DataFrame, shared, sweep: int) -> DataFrame:
    """Tables of all cells of coded words in a sweep, summed by context and by word.

    In the first sweep each cell has one table. Sums are made in tasks before rows are shuffled.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        logs = log_arrangements(model.discount)
        sums = {role: np.zeros(len(model.train)) for role in (BY_CONTEXT, BY_WORD)}
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                key, n = unpacked(payload)
                u, w = _split(np.cumsum(key))
                t = np.ones(len(n), np.int64)
                if sweep:
                    before, above = model.tables[-1][u], model.parent[-1][w]
                    t = model.cell_tables(sweep, u, w, n, before, above, logs)
                for role, code in ((BY_CONTEXT, u), (BY_WORD, w)):
                    sums[role] += np.bincount(code, t, len(model.train))
        for role, total in sums.items():
            code = np.flatnonzero(total)
            yield from _sum_rows(role, code, total[code])

    return pairs.select("payload").mapInArrow(draw, CELLS)


def _of_role(table: pa.Table, role: int) -> pa.Table:
    return table.filter(pa.array(table.column("role").to_numpy() == role))


def _told_of(table: pa.Table, role: int) -> list[np.ndarray]:
    rows = _of_role(table, role)
    return [rows.column(name).to_numpy() for name in ("code", "n", "m")]


def _looked_up(
    code: np.ndarray, by_code: np.ndarray, names: np.ndarray, values: np.ndarray
) -> np.ndarray:
    """Values of coded words from their array, of others by their place in ``names``."""
    out = np.zeros(len(code))
    coded = code < HASHED
    out[coded] = by_code[code[coded]]
    if not coded.all():
        order = np.argsort(names)
        out[~coded] = values[order][np.searchsorted(names, code[~coded], sorter=order)]
    return out


def _seated(
    rows: DataFrame, buckets: int, shared, sweep: int, weight: float, all_asked: bool
) -> DataFrame:
    """Seats the cells of uncoded words in a sweep and the parent's tables of these words.

    ``rows`` are the buckets' words and what the sweep before says of them. A cell of two uncoded
    words is drawn in both buckets, alike, since each was told what the other knows.
    """

    def seat(table: pa.Table) -> pa.Table:
        model = shared.value
        (payload,) = _of_role(table, WORDS).column("payload").to_pylist()
        (
            codes, lone_context, lone_word, place, side, n,
            ask_code, ask_place, ask_train, ask_target, ask_several, tell_place, tell_target,
        ) = unpacked(payload)
        codes, is_word, partner = np.cumsum(codes), side & 1 == 1, _partner(side)
        t = np.ones(len(n), np.int64)
        if sweep:
            (payload,) = _of_role(table, STATE).column("payload").to_pylist()
            tables, served, seated = unpacked(payload)
            before, above = tables[place].astype(float), model.served(-1, served, seated)[place]
            # A partner that is uncoded too is in another bucket, which has told of it.
            name, _, told = _told_of(table, TOLD)
            before[is_word] = _looked_up(partner[is_word], model.tables[-1], name, told)
            name, *told = _told_of(table, TOLD_WORD)
            told = model.served(-1, *told)
            above[~is_word] = _looked_up(partner[~is_word], model.parent[-1], name, told)
            own = codes[place]
            u, w = np.where(is_word, partner, own), np.where(is_word, own, partner)
            t = model.cell_tables(sweep, u, w, n, before, above, log_arrangements(model.discount))
        tables, served = (
            (lone + np.bincount(place[own], t[own], len(codes))).astype(np.int64)
            for lone, own in ((lone_context, ~is_word), (lone_word, is_word))
        )
        seated = sample_tables(
            served, np.full(len(codes), weight), noise(codes, codes, sweep),
            log_arrangements(model.parent_discount), model.parent_discount,
        )
        coded = partner < HASHED
        by_context, by_word = is_word & coded, ~is_word & coded
        # The tables of a word seen once are known: one.
        ask_tables = np.ones(len(ask_code), np.int64)
        ask_tables[ask_place >= 0] = tables[ask_place[ask_place >= 0]]
        sent = np.flatnonzero(ask_several | all_asked)
        bucket = [table.column("bucket")[0].as_py()]
        state = packed(tables, served, seated)
        return pa.Table.from_batches([
            _rows(_CELLS, role=[STATE], bucket=bucket, payload=[state]),
            _rows(
                _CELLS, role=np.full(len(sent), TOLD, np.int32), bucket=ask_target[sent],
                code=ask_code[sent], n=ask_train[sent], m=ask_tables[sent],
            ),
            _rows(
                _CELLS, role=np.full(len(tell_place), TOLD_WORD, np.int32), bucket=tell_target,
                code=codes[tell_place], n=served[tell_place], m=seated[tell_place],
            ),
            *_sum_rows(BY_CONTEXT, partner[by_context], t[by_context]),
            *_sum_rows(BY_WORD, partner[by_word], t[by_word]),
            _numbers({SERVED: served.sum(), SEATED: seated.sum()}),
        ])

    # A bucket's words come again in each sweep; they are packed.
    return rows.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(seat, CELLS)


class _Sampler:
    """Sweeps over all restaurants: arrays for coded words, packed buckets for uncoded ones."""

    def __init__(
        self, spark: SparkSession, model: Model, counted: DataFrame, buckets: int,
        fixed: dict[int, np.ndarray], lone_words: int, distinct: int, burn_in: int,
    ) -> None:
        self.spark, self.model, self.buckets, self.burn_in = spark, model, buckets, burn_in
        self.pairs = counted.filter(F.col("role") == PAIRS)
        self.words = counted.filter(F.col("role") == WORDS)
        self.fixed, self.lone_words = fixed, lone_words
        self.base = 1.0 / (distinct + 1)
        self.top_logs = log_arrangements(model.parent_discount)
        self.total_tables = float(distinct)
        self.codes = np.arange(len(model.train))
        #: What each sweep says of uncoded words.
        self.swept: list[DataFrame] = []

    def sweep(self, number: int) -> None:
        """Seat all cells, sum their tables, seat the parent, and keep the state."""
        model = self.model
        shared = self.spark.sparkContext.broadcast(model.last())
        weight = (model.strength + model.parent_discount * self.total_tables) * self.base
        rows = self.words
        if number:
            before = F.col("role").isin(STATE, TOLD, TOLD_WORD)
            rows = rows.unionByName(self.swept[-1].filter(before))
        swept = _written(
            _seated(rows, self.buckets, shared, number, weight, number >= self.burn_in), "swept"
        )
        drawn = coded_sums(_drawn(self.pairs, shared, number).unionByName(swept), len(model.train))
        customers, occupied = totals(swept, SERVED, SEATED)
        tables, served = (self.fixed[role] + drawn[role] for role in (BY_CONTEXT, BY_WORD))
        seated = sample_tables(
            served, np.full(len(self.codes), weight), noise(self.codes, self.codes, number),
            self.top_logs, model.parent_discount,
        )
        self.total_tables = float(seated.sum()) + occupied + self.lone_words
        total = model.strength + customers + float(served.sum()) + self.lone_words
        model.customers.append(total)
        model.unknown.append(
            (model.strength + model.parent_discount * self.total_tables) / total * self.base
        )
        model.tables.append(tables.astype(np.float64))
        model.parent.append(model.served(-1, served, seated))
        self.swept.append(swept)
        shared.destroy()


# Scores ------------------------------------------------------------------------------------

SCORED = "rid long, payload binary"


def coded_scores(tokens: DataFrame, shared, buckets: int) -> DataFrame:
    """Rows of ``SCORED``: what the pairs of coded words add to the texts of a packed row."""

    def score(table: pa.Table) -> pa.Table:
        model = shared.value
        parts = _bucket(table)
        key, inverse = np.unique(np.concatenate([part[0] for part in parts]), return_inverse=True)
        count = np.bincount(inverse, _in_training(parts), len(key)).astype(np.int64)
        u, w = _split(key)
        mean = _mean(
            model, log_arrangements(model.discount), u, w, count, model.train[u],
            lambda s: model.tables[s][u], lambda s: model.parent[s][w],
        )
        return _by_text(table, parts, np.log10(mean)[inverse])

    return _by_bucket(tokens, CODED, buckets).applyInArrow(score, SCORED)


def mixed_scores(
    tokens: DataFrame, swept: list[DataFrame], shared, buckets: int, divisor: int
) -> DataFrame:
    """Rows of ``SCORED``: what pairs with uncoded words add, and the base logarithms of these words.

    ``swept`` has, of each sweep kept, the states of uncoded words and what their buckets were told.
    """

    def score(table: pa.Table, states: pa.Table) -> pa.Table:
        if not len(table):
            return _by_text(table, [])
        model, mixed = shared.value, _Mixed(table)
        size = len(model.tables)
        # A word seen once has one table; one never seen has the base probability.
        tables, parents = np.ones((len(mixed.codes), size)), np.empty((len(mixed.codes), size))
        parents[:] = [model.served(s, 1, 1) for s in range(size)]
        parents[mixed.train == 0] = model.unknown
        for row in _of_role(states, STATE).select(["sweep", "payload"]).to_pylist():
            s, (own_tables, served, seated) = row["sweep"], unpacked(row["payload"])
            tables[mixed.again, s] = own_tables
            parents[mixed.again, s] = model.served(s, served, seated)
        told = _of_role(states, TOLD)
        sweep, code, n, m = (told.column(c).to_numpy() for c in ("sweep", "code", "n", "m"))
        names, place = np.unique(code, return_inverse=True)
        # The last row stands for contexts without customers.
        context_train, context_tables = np.zeros(len(names) + 1), np.zeros((len(names) + 1, size))
        context_train[place], context_tables[place, sweep] = n, m

        u, w = mixed.pairs()
        u, w, word, own, coded = (
            c[mixed.scored]
            for c in (u, w, mixed.cell_is_word, mixed.cell_own, mixed.coded_partner)
        )
        u_code, w_code = np.where(word & coded, u, 0), np.where(word, 0, w)
        by_told = word & ~coded
        at = np.full(len(u), len(names))
        at[by_told] = np.searchsorted(names, u[by_told])
        at[(np.append(names, -1)[at] != u) & by_told] = len(names)

        def of_context(coded_ones, told_ones, own_ones):
            return np.select([by_told, word], [told_ones[at], coded_ones[u_code]], own_ones[own])

        mean = np.ones(len(mixed.scored))
        mean[mixed.scored] = _mean(
            model, log_arrangements(model.discount), u, w, mixed.cell_n[mixed.scored],
            of_context(model.train, context_train, mixed.train),
            lambda s: of_context(model.tables[s], context_tables[:, s], tables[:, s]),
            lambda s: np.where(word, parents[own, s], model.parent[s][w_code]),
        )
        base = np.where(mixed.is_word, np.log10((mixed.train + 1) / divisor)[mixed.own], 0.0)
        known = mixed.is_word & (mixed.train[mixed.own] > 0)
        return _by_text(table, mixed.parts, np.log10(mean)[mixed.cell], base, known)

    states = [
        rows.filter(F.col("role").isin(STATE, TOLD)).withColumn("sweep", F.lit(sweep))
        for sweep, rows in enumerate(swept)
    ]
    known = reduce(DataFrame.unionByName, states).repartition(buckets, "bucket")
    return (
        _by_bucket(tokens, MIXED, buckets)
        .cogroup(known.groupBy("bucket"))
        .applyInArrow(score, SCORED)
    )


def lm_scores(
    docs: DataFrame,
    held: Column,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    coded: int = 400_000,
    burn_in: int = 2,
    samples: int = 3,
    strength: float = 1.0,
) -> DataFrame:
    """Scores of all texts under a model learned from those that ``held`` does not hold out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity.
    Tokens are the words of a text and one end, so a null or blank text has one token. n_known
    counts tokens seen in training; base_score is their add-one unigram log10 probability and
    ``score`` that of the model, the mean over ``samples`` sweeps after ``burn_in``; perplexity is
    10 to the power of -score / n_tokens. Words never seen share the base probability of one.

    Rows where ``held`` is null are held out. Repeated rows are learned from and scored one by
    one. Without training texts all words are unknown and base_score is 0. Other columns are not
    read. ``coded`` bounds what is broadcast; it changes where work is done and no more.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(held, F.lit(True)).alias("held"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    words = _written(word_counts(texts), "words", common.BATCH_ROWS)
    seen = words.agg(
        F.sum("train"), F.count_if(F.col("train") > 0), F.sum("n"),
        F.count_if(F.col("train") == 1), F.count_if(F.col("train") == 2),
        F.sum(F.when(F.col("word") == "", F.col("train"))),
    ).first()
    n_train, distinct, n_all, ones, twos, ends = (int(x or 0) for x in seen)
    chosen, counts = coded_words(words, coded)
    train = np.concatenate([[ends, ends], counts]).astype(np.int64)
    base_logs = np.log10((train + 1) / (n_train + distinct + 1))
    buckets = max(1, -(-n_all // BUCKET_TOKENS))
    sent = spark.sparkContext.broadcast((chosen, base_logs, train))
    tokens = stored_tokens(texts, sent, buckets)
    sent.destroy()

    counted = _written(
        coded_cells(tokens, buckets).unionByName(mixed_cells(tokens, buckets)), "counted"
    )
    fixed = coded_sums(counted, len(train))
    cell_twos, lone_cells, lone_words = totals(counted, TWOS, ONES, LONE)
    cell_ones = int(fixed[BY_WORD].sum()) + lone_cells + lone_words
    model = Model(
        train, [], [], [], [], discount_of(cell_ones, cell_twos), discount_of(ones, twos),
        strength, 0,
    )
    sampler = _Sampler(spark, model, counted, buckets, fixed, lone_words, distinct, burn_in)
    for number in range(burn_in + samples + 1):
        sampler.sweep(number)
    # The state before the first sample starts it; earlier ones are done with.
    for states in (model.tables, model.parent, model.customers, model.unknown, sampler.swept):
        del states[:burn_in]
    model.first_sweep = burn_in
    shared = spark.sparkContext.broadcast(model)
    divisor = n_train + distinct + 1
    of_coded = _written(coded_scores(tokens, shared, buckets), "coded-scores")
    of_mixed = _written(
        mixed_scores(tokens, sampler.swept, shared, buckets, divisor), "mixed-scores"
    )
    shared.destroy()
    added = _written(added_up(of_coded.unionByName(of_mixed)), "added")
    added = added.withColumnsRenamed({"base": "base_added", "known": "known_added"})
    scored = tokens.filter(F.col("kind") == TEXT).join(added, "rid", "left")
    return scored.select(
        "doc_id",
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known_added", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_added", F.lit(0.0))).alias("base_score"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.pow(F.lit(10.0), -F.coalesce("score", F.lit(0.0)) / F.col("n_tokens")).alias("perplexity"),
    )
