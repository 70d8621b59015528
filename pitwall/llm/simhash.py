"""Near duplicates by SimHash fingerprints, found with Golay-code keys.

Fingerprints of 64 bits link at three or fewer differing bits. They are cut into three segments of
at most 22 bits, each seen as a word of the perfect binary Golay code (23 bits, 12 of them free).
Every word lies within three bits of exactly one code word, whose 12-bit index is its key. A
segment and all words one bit away from it decode to one to six indices; two segments that differ
in one bit at most share the index of either one among the several of the other.

Three errors over three segments leave two cases: one segment without error and another with one
at most, or one error in each. The first gives keys of one exact and one decoded segment, the
second keys of three decoded segments. Keys have 33 to 36 bits, so unrelated fingerprints rarely
meet; pairs that do are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import one_of_each, per_text, without, written

#: Widths of the segments, lowest bits first, and their first bits.
WIDTHS = (22, 21, 21)
SHIFTS = (0, 22, 43)
LINK_BITS = 3
SHINGLE_WORDS = 3
HASH_SEED = 42
#: Generator polynomial of the Golay code.
GENERATOR = 0b110001110101

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def _parities() -> np.ndarray:
    """The 11 check bits of each 12-bit message."""
    rest = np.arange(4096, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return rest


_PARITY = _parities()


def _leaders() -> np.ndarray:
    """Error of at most three bits for each syndrome; the code is perfect, so all have one."""
    flips = [1 << i for i in range(23)]
    errors = [0, *flips]
    errors += [a ^ b for i, a in enumerate(flips) for b in flips[:i]]
    errors += [
        a ^ b ^ c for i, a in enumerate(flips) for j, b in enumerate(flips[:i]) for c in flips[:j]
    ]
    words = np.array(errors, dtype=np.int64)
    leader = np.empty(2048, dtype=np.int64)
    leader[(words & 2047) ^ _PARITY[words >> 11]] = words
    return leader


_LEADER = _leaders()


def decode(words: np.ndarray) -> np.ndarray:
    """12-bit index of the code word nearest to each 23-bit word."""
    free = words >> 11
    return free ^ (_LEADER[(words & 2047) ^ _PARITY[free]] >> 11)


def nearby(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indices of the words one bit away at most: (row, index) arrays by row."""
    flips = np.array([0, *(1 << i for i in range(width))], dtype=np.int64)
    found = np.sort(decode(words[:, None] ^ flips), axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    rows, _ = np.nonzero(new)
    return rows, found[new]


def segments(fingerprints: np.ndarray) -> list[np.ndarray]:
    """The three segments of each fingerprint (signed 64-bit)."""
    bits = fingerprints.view(np.uint64)
    return [
        ((bits >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
        for shift, width in zip(SHIFTS, WIDTHS)
    ]


def search_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the searching side: nearby indices of the segments that may differ."""
    parts = segments(fingerprints)
    near = [nearby(part, width) for part, width in zip(parts, WIDTHS)]
    rows, keys = [], []
    for kind, (exact, other) in enumerate(permutations(range(3), 2)):
        at, index = near[other]
        rows.append(at)
        keys.append(_key(kind, parts[exact][at], index))
    # One error in each: nearby indices of two segments on this side, of the third on the other.
    (at0, index0), (at1, index1) = near[0], near[1]
    first = np.searchsorted(at1, np.arange(len(fingerprints)))
    times = np.bincount(at1, minlength=len(fingerprints))
    repeat = times[at0]
    row = np.repeat(at0, repeat)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
    both = np.repeat(index0, repeat) << 12 | index1[first[row] + offset]
    rows.append(row)
    keys.append(_key(6, both, decode(parts[2])[row]))
    return np.concatenate(rows), np.concatenate(keys)


def stored_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the stored side."""
    parts = segments(fingerprints)
    own = [decode(part) for part in parts]
    every = np.arange(len(fingerprints))
    rows, keys = [], []
    for kind, (exact, other) in enumerate(permutations(range(3), 2)):
        rows.append(every)
        keys.append(_key(kind, parts[exact], own[other]))
    at, index = nearby(parts[2], WIDTHS[2])
    rows.append(at)
    keys.append(_key(6, (own[0] << 12 | own[1])[at], index))
    return np.concatenate(rows), np.concatenate(keys)


def _key(kind: int, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (np.int64(kind) << 40) | (high << 12) | low


def fingerprint(data: bytes) -> int:
    """SimHash of the word shingles of a text as a signed 64-bit number."""
    words = data.lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE_WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(run) for run in zip(*(words[i:] for i in range(SHINGLE_WORDS)))]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, HASH_SEED) for s in shingles), "<u8", len(shingles))
    octets = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    bits = np.packbits(2 * ones > len(shingles), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``digest`` (a hash of the text) and ``fp`` (long) of every row, stored."""
    hashed = per_text({"fp": "long"}, lambda: lambda data: (fingerprint(data),))
    return written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(F.col(text)).alias("digest"),
            hashed(F.col(text)).alias("_hash"),
        ).select("doc_id", "digest", "_hash.fp"),
        "fingerprints",
    )


def fingerprint_classes(hashed: DataFrame) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint, stored.

    ``root`` is the smallest fingerprint of the component, ``component_id`` its smallest doc_id.
    """
    nodes = written(hashed.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "nodes")
    roots = components(spanning_forest(links(nodes)))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root")
    )
    # Stored, so that the join below stands between two shuffles and large roots can be split.
    named = written(placed.groupBy("root").agg(F.min("smallest").alias("component_id")), "named")
    return written(placed.join(named, "root").select("fp", "root", "component_id"), "classes")


def hexadecimal(fp: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _keyed(nodes: DataFrame, keys) -> DataFrame:
    """One row (key, fp) for each key of each fingerprint."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for start in range(0, len(own), 4096):
                part = own[start : start + 4096]
                rows, found = keys(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(part[rows])], names=["key", "fp"]
                )

    return nodes.select("fp").mapInArrow(expand, "key long, fp long")


def links(nodes: DataFrame) -> DataFrame:
    """Pairs ``low < high`` of distinct fingerprints within three bits of each other.

    A pair comes once for each key that it shares.
    """
    search = _keyed(nodes, search_keys).select("key", F.col("fp").alias("low"))
    stored = _keyed(nodes, stored_keys).select("key", F.col("fp").alias("high"))
    near = F.bit_count(F.col("low").bitwiseXOR(F.col("high"))) <= LINK_BITS
    return search.join(stored, "key").filter(near & (F.col("low") < F.col("high"))).select(
        "low", "high"
    )


def spanning_forest(pairs: DataFrame) -> DataFrame:
    """Fewer links with the same components: each task keeps a link per newly joined node.

    Memory grows with the nodes of one task, not with its links.
    """

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(node: int) -> int:
            top = node
            while (up := parent.get(top, top)) != top:
                top = up
            while node != top:
                parent[node], node = top, parent.get(node, node)
            return top

        for batch in batches:
            kept = []
            for low, high in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(low), root(high)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    parent.setdefault(min(a, b), min(a, b))
                    kept.append((low, high))
            if kept:
                low, high = zip(*kept)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["low", "high"]
                )

    return pairs.select("low", "high").mapInArrow(contract, "low long, high long")


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; ``root`` is the smallest of its component.

    Alternates large-star and small-star steps until nothing changes; each round is a written
    table, so lost executors cost one round at most. Neighbourhoods are reduced by aggregates and
    joins, never gathered.
    """
    edges = written(pairs.select("low", "high").distinct(), "edges")
    state = _state(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "edges")
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))


def _state(edges: DataFrame) -> tuple:
    """Count and order-free digest of the links."""
    mixed = F.xxhash64("low", "high")
    row = edges.agg(F.count("*"), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 20))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node is linked to the smallest of the neighbourhood."""
    both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")).union(
        edges.select(F.col("high").alias("u"), F.col("low").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.filter(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("m").alias("low"), F.col("v").alias("high"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each neighbour below a node, and the node, are linked to the smallest neighbour."""
    least = edges.groupBy("high").agg(F.min("low").alias("m"))
    moved = edges.join(least, "high").filter(F.col("low") != F.col("m"))
    return (
        moved.select(F.col("m").alias("low"), F.col("low").alias("high"))
        .union(least.select(F.col("m").alias("low"), "high"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    ``component_id`` is the smallest doc_id reachable over links of at most three differing bits;
    equal fingerprints are one node, so copies are never expanded into pairs. Null and empty texts
    have fingerprint zero and link like any other. Rows without an id get a component through
    their fingerprint and never name one (null if no row of it has an id). Repeated rows stay
    repeated; other columns are not read.
    """
    hashed = fingerprints(docs, text=text, doc_id=doc_id)
    return hashed.join(fingerprint_classes(hashed), "fp").select(
        "doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each component of near duplicates, with all columns.

    The row with the smallest doc_id stays (rows without an id come last); of several texts under
    that id the one with the smallest hash, and of equal rows any one.
    """
    hashed = fingerprints(docs, text=text, doc_id=doc_id)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")
    placed = hashed.join(fingerprint_classes(hashed), "fp").select("root", order.alias("row"))
    best = placed.groupBy("root").agg(F.min("row").alias("best"), F.count("*").alias("n"))
    # Stored, so that the join below stands between two shuffles and large roots can be split.
    several = written(best.filter("n > 1").select("root", "best"), "best")
    judged = written(
        placed.join(several, "root")
        .groupBy("row.doc_id", "row.digest")
        .agg(F.first(F.col("row") == F.col("best")).alias("stays"), F.count("*").alias("n")),
        "judged",
    )
    key = {"doc_id": F.col(doc_id), "digest": F.xxhash64(F.col(text))}
    kept = without(docs, judged.filter("NOT stays"), key)
    repeated = judged.filter("stays AND n > 1")
    if not repeated.limit(1).count():
        return kept
    # Only rows that stay and are repeated are shuffled to be reduced to one each.
    return without(kept, repeated, key).unionByName(one_of_each(kept, repeated, key))
