"""Byte-level BPE over overlapping chunks, and decoding by joining raw bytes.

A long text is cut into chunks that overlap. Threads pre-tokenise the chunks side by side, each
from its own start. In the overlap the pre-tokens of a chunk and of the next one fall into step at
some position: a match depends on what follows its start only, so from a common start on both
agree. The first common start is a seam; the pieces between seams are encoded one by one, and the
ids are passed on as they come. A chunk without a seam (one pre-token fills the overlap) is joined
with the next one, so results never depend on the chunk width; one scan then goes on from the last
seam until the next is found, so that no character is scanned more than three times. The pattern may look ahead behind
white space only, and at most three characters further than a match; it must not look back.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from concurrent.futures import Executor, ThreadPoolExecutor

import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import per_text

#: Characters of a chunk and of what it shares with the next one.
CHUNK = 32_768
OVERLAP = 512
THREADS = 2
#: Characters behind a pre-token that can decide where it ends (an apostrophe and two letters).
AHEAD = 3


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Byte strings and their ranks from the text of a rank file."""
    pairs = (line.split() for line in data.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def starts(pattern, text: str, begin: int, end: int, after: int) -> set[int]:
    """Starts of pre-tokens from ``after`` on, of ``text[begin:end]`` scanned from its beginning.

    A pre-token near the end may go on behind it, so its end is no sure start unless the text
    ends there.
    """
    sure = end == len(text)
    found = {begin} if begin >= after else set()
    for match in pattern.finditer(text[begin:end], concurrent=True):
        at = begin + match.end()
        if at >= after and (at + AHEAD <= end or sure):
            found.add(at)
    return found


def seams(
    pattern, text: str, chunk: int, overlap: int, threads: Executor
) -> list[int]:
    """Positions at which the text can be cut without changing its pre-tokens, ends included."""
    size = len(text)
    cuts = list(range(0, size, chunk)) or [0]

    def scan(begin: int) -> tuple[set[int], set[int]]:
        """Starts in the overlap with the chunk before, and in that with the chunk after."""
        end = min(size, begin + chunk + overlap)
        own = starts(pattern, text, begin, end, begin)
        head = {at for at in own if at < begin + overlap}
        return head, {at for at in own if at >= begin + chunk}

    scanned = list(threads.map(scan, cuts))
    found = [0]
    walk, at = None, 0  # scan that goes on from the last seam, and how far it has come
    for i in range(1, len(cuts)):
        tail = scanned[i - 1][1]
        if walk:  # the chunk before may be out of step
            tail = set()
            while at < cuts[i] + overlap:
                if at >= cuts[i]:
                    tail.add(at)
                match = next(walk, None)
                at = match.end() if match else size + overlap
        # A cut behind white space would change what a look-ahead of the pattern sees.
        common = {at for at in tail & scanned[i][0] if not text[at - 1].isspace()}
        if common:
            found.append(min(common))
            walk = None
        elif not walk:
            walk, at = pattern.finditer(text, found[-1], concurrent=True), found[-1]
            while at < cuts[i] + overlap:
                match = next(walk, None)
                at = match.end() if match else size + overlap
    if found[-1] != size:
        found.append(size)
    return found


def pieces(
    pattern, text: str, threads: Executor, chunk: int = CHUNK, overlap: int = OVERLAP
) -> Iterator[str]:
    """The text in parts that can be encoded one after another."""
    if len(text) <= chunk:
        yield text
        return
    ends = seams(pattern, text, chunk, overlap, threads)
    for begin, end in zip(ends, ends[1:]):
        yield text[begin:end]


class Codec:
    """Encoder and decoder for one table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.library = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.pattern = regex.compile(pattern)
        self.threads = ThreadPoolExecutor(THREADS)
        size = max(ranks.values(), default=-1) + 1
        self.decimal = [str(i) for i in range(size)]
        self.raw = [b""] * size
        for token, rank in ranks.items():
            self.raw[rank] = token

    def encode(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[int]]:
        """Ids of the text, piece by piece; no special tokens."""
        for piece in pieces(self.pattern, text, self.threads, chunk, overlap):
            yield self.library.encode_ordinary(piece)

    def decode(self, ids: list[int]) -> bytes:
        """Raw bytes of the ids; a character may be split over two calls."""
        return b"".join(map(self.raw.__getitem__, ids))

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids and of the decoded bytes, built up by piece."""
        total, named, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.encode(text):
            if not ids:
                continue
            numbers = " ".join(map(self.decimal.__getitem__, ids))
            named.update((" " + numbers if total else numbers).encode())
            decoded.update(self.decode(ids))
            total += len(ids)
        return total, named.hexdigest(), decoded.hexdigest()


def _shared_codec(docs: DataFrame, ranks_file: str, pattern: str) -> Callable[[], Codec]:
    with open(ranks_file, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    return lambda: Codec(read_ranks(shared.value), pattern)


def encode_texts(
    docs: DataFrame,
    ranks_file: str,
    pattern: str,
    *,
    text: str = "text",
    id_columns: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Id columns and ``ids`` (array<int>) of every row; null and empty texts have no ids.

    Repeated rows stay repeated; other columns are not read.
    """
    codec = _shared_codec(docs, ranks_file, pattern)

    def make():
        own = codec()
        return lambda data: ([i for ids in own.encode(data.decode()) for i in ids],)

    encoded = per_text({"ids": "array<int>"}, make)
    return docs.select(*id_columns, encoded(F.col(text)).alias("_code")).select(
        *id_columns, "_code.ids"
    )


def decode_ids(
    encoded: DataFrame, ranks_file: str, *, ids: str = "ids", id_columns: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Id columns and ``bytes`` (binary): the raw bytes of the ids joined; null ids give none."""
    with open(ranks_file, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())

    def decode(batches):
        import pyarrow as pa

        raw = {rank: token for token, rank in read_ranks(shared.value).items()}
        for batch in batches:
            rows = [b"".join(raw[i] for i in row or ()) for row in batch.to_pylist()]
            yield pa.array(rows, pa.binary())

    decode.__annotations__ = _array_iterators()
    return encoded.select(*id_columns, F.arrow_udf(decode, "binary")(F.col(ids)).alias("bytes"))


def _array_iterators() -> dict:
    import pyarrow as pa

    return {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}


def round_trip(
    docs: DataFrame,
    ranks_file: str,
    pattern: str,
    *,
    text: str = "text",
    id_columns: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Per input row: id columns, n_tokens, ids_sha256, decoded_sha256.

    The ids are hashed as decimal numbers joined by one space, and decoded again from the ids.
    Null texts count as empty: no ids, both digests those of no bytes. Repeated rows stay
    repeated; other columns are not read.
    """
    codec = _shared_codec(docs, ranks_file, pattern)

    def make():
        own = codec()
        return lambda data: own.digests(data.decode())

    fields = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    return docs.select(*id_columns, per_text(fields, make)(F.col(text)).alias("_code")).select(
        *id_columns, *[f"_code.{name}" for name in fields]
    )
