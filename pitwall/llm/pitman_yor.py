"""Pitman-Yor restaurants for word pairs: seating, and the probabilities that follow from it.

Each context word has a restaurant whose customers are the tokens seen behind it. Customers of one
word sit at tables that serve it; every table sends one customer to the parent, a restaurant that
all contexts share, and whose own tables draw words from a uniform base. With ``c`` customers and
``t`` tables of word w in context u, of ``n`` and ``T`` in all,

    P(w | u) = (c - d t) / (s + n) + (s + d T) / (s + n) * P(w)

for discount d and strength s. Only the numbers of tables are unknown; they are sampled.
"""

from __future__ import annotations

import numpy as np

#: Customers of one word and context that are seated as a block; the others follow in turn.
BLOCK = 64
#: Cells whose choices are laid out at once.
_ROWS = 20_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit mix of 64-bit numbers (the finaliser of SplitMix64)."""
    z = np.asarray(values).astype(np.uint64) + _GOLDEN
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def noise(context: np.ndarray, word: np.ndarray, sweep: int) -> np.ndarray:
    """64 random bits for each cell and sweep; a repeated task draws the same ones."""
    return mixed(mixed(mixed(context) ^ np.asarray(word).astype(np.uint64)) + np.uint64(sweep))


def uniform(bits: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64 random bits each."""
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def log_arrangements(discount: float, most: int = BLOCK) -> np.ndarray:
    """``[c, t]``: log weight of all ways to seat c customers at t tables of one word.

    The next customer opens a table, or joins one of t tables with a weight of c - discount * t.
    """
    logs = np.full((most + 1, most + 1), -np.inf)
    logs[1, 1] = 0.0
    for c in range(1, most):
        t = np.arange(1, c + 1)
        logs[c + 1, 1 : c + 1] = logs[c, 1 : c + 1] + np.log(c - discount * t)
        logs[c + 1, 2 : c + 2] = np.logaddexp(logs[c + 1, 2 : c + 2], logs[c, 1 : c + 1])
    return logs


def sample_tables(
    count: np.ndarray, weight: np.ndarray, bits: np.ndarray, logs: np.ndarray, discount: float
) -> np.ndarray:
    """Gibbs step for the number of tables of each cell, given all that is not in the cell.

    ``weight`` is what a new table weighs: (s + d T) P(w) of the parent. All of a cell's customers
    leave and the first ``BLOCK`` return together: t tables have the weight of their arrangements
    times ``weight ** t``. Any others follow in turn, in groups of a tenth of those present, at
    the rule of the restaurant; a group's expected number of tables is rounded up or down at
    random. So a cell costs the logarithm of its customers.
    """
    tables = (count > 0).astype(np.int64)
    if not len(count):
        return tables
    first = np.minimum(count, BLOCK)
    log_weight = np.log(weight)
    chance = uniform(bits)
    order = np.argsort(first, kind="stable")
    sizes, starts = np.unique(first[order], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, starts[1:]), strict=True):
        if size < 2:
            continue
        t = np.arange(1, size + 1)
        for at in range(0, len(rows), _ROWS):
            part = rows[at : at + _ROWS]
            logits = logs[size, 1 : size + 1] + t * log_weight[part, None]
            sums = np.exp(logits - logits.max(axis=1, keepdims=True)).cumsum(axis=1)
            tables[part] = 1 + (sums < chance[part, None] * sums[:, -1:]).sum(axis=1)
    more = np.flatnonzero(count > BLOCK)
    seated, present, turn = np.full(len(more), BLOCK), tables[more].astype(np.float64), 0
    while len(more):
        group = np.minimum(np.maximum(1, seated // 10), count[more] - seated)
        new = weight[more] / (seated - discount * present + weight[more])
        turn += 1
        shift = uniform(mixed(bits[more] + np.uint64(turn)))
        present = present + np.minimum(group, np.floor(group * new + shift))
        seated = seated + group
        tables[more] = present.astype(np.int64)
        left = seated < count[more]
        more, seated, present = more[left], seated[left], present[left]
    return tables


def discount_of(ones: int, twos: int) -> float:
    """Discount from how many words were seen once and twice: n1 / (n1 + 2 n2), within bounds."""
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


def predictive(
    count: np.ndarray,
    tables: np.ndarray,
    customers: np.ndarray,
    all_tables: np.ndarray,
    parent: np.ndarray,
    discount: float,
    strength: float,
) -> np.ndarray:
    """Probability of each cell; contexts without customers leave it to the parent."""
    known = customers > 0
    total = strength + customers
    own = np.where(known, (count - discount * tables) / total, 0.0)
    rest = np.where(known, (strength + discount * all_tables) / total, 1.0)
    return own + rest * parent
