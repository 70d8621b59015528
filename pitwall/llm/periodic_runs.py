"""Periodic runs of words, proposed by a dictionary of basic factors.

The basic factors of a text are its stretches of 1, 2, 4, 8, ... words. Level by level each one
gets a name: two factors of one length have the same name if they are equal, and a name of the
next level is a pair of names half as long. A factor that occurs once has no name, and neither
has any longer factor that holds it, so that plain prose is done after a few levels.

In a run of period q the factors of length between q and 2q recur at distance q exactly, since a
nearer copy would give a smaller period. So on each level the next occurrence of a factor within
twice its length proposes a period where it starts an arithmetic progression of three or more
occurrences. Neighbouring proposals of one period are one stretch, which is then extended over the
words themselves as far as the period holds. Several levels, and multiples of a period, may find
one stretch; it is kept once, with its smallest period.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import per_row

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

# (words of a text, its id or None) -> the words to search
Prepare = Callable[[list[bytes], "bytes | None"], list[bytes]]


def _levels(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(length, distance) of each level: from each position to the next equal factor, or 0."""
    count, length = len(ids), 1
    at, names = np.arange(count), ids
    while len(at) > 1 and 2 * length <= count:
        order = np.argsort(names, kind="stable")
        names, at = names[order], at[order]
        equal = names[1:] == names[:-1]
        distance = np.zeros(count, dtype=np.int64)
        distance[at[:-1]] = np.where(equal, at[1:] - at[:-1], 0)
        yield length, distance
        # Names of factors that recur; all others stay without one.
        again = np.zeros(len(at), dtype=bool)
        again[1:] = equal
        again[:-1] |= equal
        rank = np.zeros(len(at), dtype=np.int64)
        rank[1:] = np.cumsum(~equal)
        named = np.full(count, -1, dtype=np.int64)
        named[at[again]] = rank[again]
        halves = named[: count - length], named[length:]
        at = np.flatnonzero((halves[0] >= 0) & (halves[1] >= 0))
        names = halves[0][at] * (rank[-1] + 1) + halves[1][at]
        length *= 2


def _proposals(length: int, distance: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of stretches in which neighbours start a progression of a period."""
    at = np.flatnonzero((distance > 0) & (distance <= 2 * length))
    at = at[distance[at + distance[at]] == distance[at]]
    if not len(at):
        return
    period = distance[at]
    cut = np.flatnonzero((at[1:] != at[:-1] + 1) | (period[1:] != period[:-1])) + 1
    first, last = np.r_[0, cut], np.r_[cut, len(at)] - 1
    # Sure so far are the words under the first two occurrences; extension finds the third.
    ends = at[last] + period[last] + length
    yield from zip(at[first].tolist(), ends.tolist(), period[first].tolist(), strict=True)


def _extended(ids: np.ndarray, start: int, end: int, period: int) -> tuple[int, int]:
    """The longest stretch around ``start`` to ``end`` in which the period holds."""
    step = 16
    while start:
        low = max(0, start - step)
        differ = np.flatnonzero(ids[low:start] != ids[low + period : start + period])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start, step = low, 2 * step
    step = 16
    while end < len(ids):
        high = min(len(ids), end + step)
        differ = np.flatnonzero(ids[end:high] != ids[end - period : high - period])
        if len(differ):
            end += int(differ[0])
            break
        end, step = high, 2 * step
    return start, end


def find_runs(
    ids: np.ndarray, least_length: int = 6, least_times: int = 4
) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period.

    ``ids`` numbers the words, equal words alike. A run is as long as its smallest period holds,
    and at least ``least_length`` words and ``least_times`` periods (four or more, which the
    progressions of three occurrences need).
    """
    if least_times < 4:
        raise ValueError("runs of fewer than four periods need not show three occurrences")
    periods: dict[tuple[int, int], int] = {}
    seen: dict[int, tuple[list[int], list[int]]] = {}
    for length, distance in _levels(ids):
        for start, end, period in _proposals(length, distance):
            starts, ends = seen.setdefault(period, ([], []))
            before = bisect_right(starts, start) - 1
            if before >= 0 and ends[before] >= end:
                continue
            run = _extended(ids, start, end, period)
            place = bisect_right(starts, run[0])
            starts.insert(place, run[0])
            ends.insert(place, run[1])
            periods[run] = min(period, periods.get(run, period))
    return sorted(
        ((start, end - start, period) for (start, end), period in periods.items()
         if end - start >= max(least_length, least_times * period)),
        key=lambda run: (run[0], run[2]),
    )


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words outside all runs, and the first period of each run unless another run drops it."""
    if not runs:
        return words
    stays = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(stays)]


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal words alike."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def periodic_runs(
    docs: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    least_length: int = 6,
    least_times: int = 4,
    prepare: Prepare | None = None,
) -> DataFrame:
    """``doc_id``, ``runs`` (start, length and period in words) and ``collapsed`` of every row.

    Words are what ASCII white space parts. ``collapsed`` holds the kept words joined by one
    space. ``prepare`` may change the words of a text first. Null and blank texts have no runs and
    an empty collapsed text. Rows stay as many as they are, repeated ones too; other columns are
    not read. A text is searched whole, in memory in proportion to its words.
    """

    def make():
        def search(key: bytes | None, data: bytes | None) -> tuple:
            words = (data or b"").split()
            if prepare is not None:
                words = prepare(words, key)
            runs = find_runs(numbered(words), least_length, least_times)
            named = [{"start": s, "length": n, "period": p} for s, n, p in runs]
            return named, b" ".join(kept_words(words, runs)).decode()

        return search

    found = per_row({"runs": (RUNS, pa.list_(_RUN)), "collapsed": "string"}, make)
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        found(F.col(doc_id).cast("string"), F.col(text)).alias("_found"),
    ).select("doc_id", "_found.runs", "_found.collapsed")
