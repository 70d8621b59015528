"""Secret scans: fixed rules, and formats learned by grammar inference.

Three fixed rules find assigned values, access keys and long hexadecimal numbers. Further secrets
are found by their format: labelled credentials of a kind form a prefix tree, whose states are
merged where a Hoeffding bound sees no difference between their distributions. The result is a
small probabilistic automaton per kind. Every run of credential characters is tried from its start
and from behind each mark in it, up to its end and up to each mark, so that assigned values and
parts of URLs and paths are found. A candidate is scored by its likelihood under each automaton
against that of random text, and added where one is convincing.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import per_text

KINDS = ("assign", "access", "hex")
LEARNED = "format"

_ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE,
)
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{32,}")
_IS_HEX = bytes(1 if chr(i) in "0123456789abcdef" else 0 for i in range(256))
_HEX_RUN = b"\x01" * 32

#: Candidates are this long at least, or as long as the shortest labelled credential of a kind.
SHORTEST = 16
_RUN = r"[A-Za-z0-9+/_.=-]{%d,}"
#: A candidate starts behind no letter or digit, or behind an escape, and ends before a mark.
_OPENING = re.compile(
    rb"(?<![A-Za-z0-9])[A-Za-z0-9+/_.=-]|(?:(?<=%[0-9A-Fa-f]{2})|(?<=\\[nrt]))[A-Za-z0-9+/_.=-]"
)
_MARKS = b"+/_.=-"
_CLOSING = b".=-"
_ALPHABET = 64

# Public credential formats as (kind, prefix, characters, length after the prefix).
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
FORMATS = (
    ("access", "AKIA", _UPPER + _DIGITS, 16),
    ("access", "ASIA", _UPPER + _DIGITS, 16),
    ("forge", "ghp_", _LOWER + _UPPER + _DIGITS, 36),
    ("forge", "gho_", _LOWER + _UPPER + _DIGITS, 36),
    ("forge", "glpat-", _LOWER + _UPPER + _DIGITS + "_", 20),
    ("chat", "xoxb-", _DIGITS + _LOWER + _UPPER, 40),
    ("payment", "sk_live_", _LOWER + _UPPER + _DIGITS, 24),
    ("map", "AIza", _LOWER + _UPPER + _DIGITS + "_", 35),
    ("web", "eyJhbGciOi", _LOWER + _UPPER + _DIGITS + "_", 60),
)


def default_credentials(per_format: int = 300, seed: int = 7) -> list[tuple[str, str]]:
    """Labelled credentials (kind, value) drawn from the public formats."""
    draw = random.Random(seed)
    return [
        (kind, prefix + "".join(draw.choices(characters, k=length)))
        for kind, prefix, characters, length in FORMATS
        for _ in range(per_format)
    ]


def symbol(octet: int) -> int:
    """Character class that an automaton reads after the first characters of a value."""
    if 0x30 <= octet <= 0x39:
        return -1
    if 0x41 <= octet <= 0x5A:
        return -2
    if 0x61 <= octet <= 0x7A:
        return -3
    return octet


#: Characters of a class, for the likelihood of one of them.
_CLASS_SIZE = {-1: 10, -2: 26, -3: 26}
UNSEEN = 1e-3


class Automaton:
    """Deterministic probabilistic automaton learned by merging states of a prefix tree.

    The first ``literal`` characters of a value are read as they are, so that prefixes are learned;
    the rest is read as character classes, within which characters count as equally likely.
    """

    def __init__(self, values: Iterable[bytes], alpha: float = 0.05, literal: int = 4) -> None:
        self.literal = literal
        self.alpha = alpha
        self.next: list[dict[int, int]] = [{}]
        self.seen: list[dict[int, int]] = [{}]
        self.ends: list[int] = [0]
        self.total: list[int] = [0]
        self.shortest = SHORTEST
        for value in values:
            self._insert(value)
            self.shortest = min(self.shortest, max(1, len(value)))
        self.alphabet = {mark for seen in self.seen for mark in seen if mark < 0 or mark in b"+/_.=-"}
        self._merge_states()

    def read(self, value: bytes) -> list[int]:
        """Symbols of a value."""
        return [*value[: self.literal], *map(symbol, value[self.literal :])]

    def _insert(self, value: bytes) -> None:
        state = 0
        self.total[0] += 1
        for mark in self.read(value):
            following = self.next[state].get(mark)
            if following is None:
                following = len(self.next)
                self.next.append({})
                self.seen.append({})
                self.ends.append(0)
                self.total.append(0)
                self.next[state][mark] = following
            self.seen[state][mark] = self.seen[state].get(mark, 0) + 1
            self.total[following] += 1
            state = following
        self.ends[state] += 1

    def _differ(self, count_a: int, total_a: int, count_b: int, total_b: int) -> bool:
        bound = math.sqrt(math.log(2 / self.alpha) / 2) * (
            1 / math.sqrt(total_a) + 1 / math.sqrt(total_b)
        )
        return abs(count_a / total_a - count_b / total_b) > bound

    def _compatible(self, a: int, b: int) -> bool:
        """True if no pair of states reached from a and b on equal symbols differs."""
        waiting, done = [(a, b)], set()
        while waiting:
            a, b = waiting.pop()
            if a == b or (a, b) in done:
                continue
            done.add((a, b))
            if self._differ(self.ends[a], self.total[a], self.ends[b], self.total[b]):
                return False
            for mark in self.seen[a].keys() | self.seen[b].keys():
                in_a, in_b = self.seen[a].get(mark, 0), self.seen[b].get(mark, 0)
                if self._differ(in_a, self.total[a], in_b, self.total[b]):
                    return False
                if in_a and in_b:
                    waiting.append((self.next[a][mark], self.next[b][mark]))
        return True

    def _fold(self, into: int, state: int) -> None:
        """Add the counts of a subtree to the states that it matches."""
        waiting = [(into, state)]
        while waiting:
            into, state = waiting.pop()
            if into == state:
                continue
            self.ends[into] += self.ends[state]
            self.total[into] += self.total[state]
            for mark, times in self.seen[state].items():
                self.seen[into][mark] = self.seen[into].get(mark, 0) + times
                if mark in self.next[into]:
                    waiting.append((self.next[into][mark], self.next[state][mark]))
                else:
                    self.next[into][mark] = self.next[state][mark]

    def _merge_states(self) -> None:
        """Red-blue order: a state joins the first kept one that it is compatible with."""
        kept, position = [0], 0
        while position < len(kept):
            source = kept[position]
            for mark in sorted(self.next[source]):
                state = self.next[source][mark]
                if state in kept:
                    continue
                for red in kept:
                    if self._compatible(red, state):
                        self.next[source][mark] = red
                        self._fold(red, state)
                        break
                else:
                    kept.append(state)
            position += 1
        self.states = len(kept)

    def log_likelihood(self, value: bytes) -> float:
        """Natural logarithm of the probability of the value; minus infinity if it has none.

        Behind the literal beginning, a known symbol that a state has not seen, and an unseen end,
        have the probability ``UNSEEN``; the state then stays.
        """
        state, total = 0, 0.0
        for i, mark in enumerate(self.read(value)):
            times = self.seen[state].get(mark, 0)
            if times:
                total += math.log(times / self.total[state])
                state = self.next[state][mark]
            elif i >= self.literal and mark in self.alphabet:
                total += math.log(UNSEEN)
            else:
                return -math.inf
            total -= math.log(_CLASS_SIZE.get(mark, 1))
        return total + math.log(max(UNSEEN, self.ends[state] / self.total[state]))

    def longest_end(self, data: bytes, begin: int, stop: int, least: float) -> int:
        """End of the longest convincing candidate from ``begin``, in a run that ends at ``stop``.

        Convincing is a likelihood that beats random text by ``least``. A candidate ends with the
        run or before a mark, not behind closing punctuation, and is no plain word. Without any,
        the result is ``begin``.
        """
        state, ratio, found = 0, 0.0, begin
        for i in range(stop - begin):
            octet = data[begin + i]
            mark = octet if i < self.literal else symbol(octet)
            times = self.seen[state].get(mark, 0)
            if times:
                ratio += math.log(times / self.total[state])
                state = self.next[state][mark]
            elif i >= self.literal and mark in self.alphabet:
                ratio += math.log(UNSEEN)
            else:
                break
            ratio += math.log(_ALPHABET / _CLASS_SIZE.get(mark, 1))
            end = begin + i + 1
            if (
                i + 1 >= self.shortest
                and (end == stop or data[end] in _MARKS)
                and octet not in _CLOSING
                and ratio + math.log(max(UNSEEN, self.ends[state] / self.total[state])) >= least
                and not _plain(data[begin:end])
            ):
                found = end
        return found


def _plain(value: bytes) -> bool:
    """True for a plain word: no digit, mark or inner capital."""
    return value.isalpha() and (value.islower() or value.istitle())


def learn(credentials: Iterable[tuple[str, str]], alpha: float = 0.05) -> dict[str, Automaton]:
    """An automaton for each kind of labelled credentials."""
    by_kind: dict[str, list[bytes]] = {}
    for kind, value in credentials:
        by_kind.setdefault(kind, []).append(value.encode())
    return {kind: Automaton(values, alpha) for kind, values in sorted(by_kind.items())}


def base_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) in bytes of what the fixed rules find, ordered."""
    found = []
    low = data.lower()
    if any(word in low for word in _KEYWORDS):
        found += [(*m.span(), 0) for m in _ASSIGN.finditer(data) if len(m[2]) >= 8]
    if b"AKIA" in data:
        found += [(*m.span(), 1) for m in _ACCESS.finditer(data) if len(m[0]) >= 16]
    if _HEX_RUN in data.translate(_IS_HEX):
        found += [(*m.span(), 2) for m in _HEX.finditer(data)]
    return sorted(found, key=lambda span: (span[0], span[2]))


def learned_spans(
    data: bytes, automata: Iterable[Automaton], base: list[tuple[int, int, int]], least: float
) -> list[tuple[int, int, int]]:
    """Candidates whose likelihood beats random text by ``least`` (natural logarithm).

    Random text picks each of 64 characters alike. At a start the longest convincing candidate
    counts, and the search goes on behind it. Candidates inside a span of the fixed rules are left
    to those.
    """
    automata = list(automata)
    shortest = min((a.shortest for a in automata), default=SHORTEST)
    first = {octet for a in automata for octet in a.seen[0]}
    found = []
    for match in _runs(shortest).finditer(data):
        stop, done = match.end(), match.start()
        for opening in _OPENING.finditer(data, match.start(), stop):
            begin = opening.start()
            if begin < done or data[begin] not in first:
                continue
            end = max(a.longest_end(data, begin, stop, least) for a in automata)
            if end > begin and not any(s <= begin and end <= e for s, e, _ in base):
                found.append((begin, end, len(KINDS)))
                done = end
    return found


@cache
def _runs(shortest: int) -> re.Pattern[bytes]:
    """Runs of credential characters of a least length."""
    return re.compile((_RUN % shortest).encode())


def _named(data: bytes, spans: list[tuple[int, int, int]]) -> list[str]:
    """``kind:start:end`` with positions in code points."""
    names = (*KINDS, LEARNED)
    if not spans:
        return []
    if data.isascii():
        return [f"{names[kind]}:{begin}:{end}" for begin, end, kind in spans]
    at, passed, points = {}, 0, 0
    for place in sorted({p for begin, end, _ in spans for p in (begin, end)}):
        points += len(data[passed:place].decode())
        passed, at[place] = place, points
    return [f"{names[kind]}:{at[begin]}:{at[end]}" for begin, end, kind in spans]


def _scanner(credentials, alpha: float, least: float):
    automata = list(learn(credentials or default_credentials(), alpha).values())

    def scan(data: bytes) -> tuple[list, list]:
        base = base_spans(data)
        every = base + learned_spans(data, automata, base, least)
        return base, sorted(every, key=lambda span: (span[0], span[2]))

    return scan


def scan_texts(
    docs: DataFrame,
    credentials: list[tuple[str, str]] | None = None,
    *,
    text: str = "text",
    id_columns: tuple[str, ...] = ("doc_id",),
    alpha: float = 0.05,
    least: float = 6.0,
) -> DataFrame:
    """Per input row: id columns, n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` is ``kind:start:end`` of everything found, by start and kind, comma-joined, in code
    points with the end excluded; ``base_sha256`` is the SHA-256 of the same of the fixed rules.
    ``credentials`` are labelled values (kind, value) to learn formats from, a list that the caller
    bounds; without it values of public formats are drawn. ``alpha`` is the level of the merge
    test and ``least`` the log-likelihood ratio against random text from which on a word is a
    secret. Null and empty texts have no spans. Repeated rows stay repeated; other columns are
    not read.
    """

    def make():
        scan = _scanner(credentials, alpha, least)

        def digest(data: bytes) -> tuple:
            base, every = scan(data)
            kinds = [kind for _, _, kind in base]
            joined = ",".join(_named(data, base)).encode()
            return (
                *(kinds.count(number) for number in range(len(KINDS))),
                hashlib.sha256(joined).hexdigest(),
                ",".join(_named(data, every)),
            )

        return digest

    fields = {
        "n_assign": "long", "n_access": "long", "n_hex": "long",
        "base_sha256": "string", "spans": "string",
    }
    return docs.select(*id_columns, per_text(fields, make)(F.col(text)).alias("_scan")).select(
        *id_columns, *[f"_scan.{name}" for name in fields]
    )


def redacted(
    text: Column,
    credentials: list[tuple[str, str]] | None = None,
    *,
    alpha: float = 0.05,
    least: float = 6.0,
    mask: str = "[SECRET]",
) -> Column:
    """The text with every found span replaced by ``mask``; overlapping spans become one mask.

    A text without secrets comes back unchanged, a null text as null.
    """

    def make():
        scan = _scanner(credentials, alpha, least)

        def clean(data: bytes) -> tuple:
            out, done = [], 0
            for begin, end, _ in scan(data)[1]:
                if begin >= done:
                    out += [data[done:begin], mask.encode()]
                done = max(done, end)
            return (b"".join([*out, data[done:]]).decode(),)

        return clean

    return F.when(text.isNotNull(), per_text({"text": "string"}, make)(text)["text"])
