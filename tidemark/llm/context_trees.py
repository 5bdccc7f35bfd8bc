"""Context-tree weighting over bytes, with block counts instead of a sequential pass.

A text has a space before and after it, and after each of its spaces a choice between going on and the end.
A byte is eight binary decisions; each of its 255 decision nodes has a context tree of its own over the bytes
before it in the text (the space before the text included), nearest first, ``DEPTH`` deep. Contexts run
across spaces, so the end of one word speaks for the begin of the next. Every tree node holds
zeros and ones seen there. Its block probability is half the Krichevsky-Trofimov estimate of its counts
and half the product of its children's block probabilities, so every pruning of the tree is weighed; a
prediction mixes the estimates along the path with the weights that follow. A context never seen in
training adds nothing: the nearest one that was seen speaks for it.

Contexts and the byte after them are packed in a 64-bit key, the nearest byte highest.
"""

from __future__ import annotations

import numpy as np

DEPTH = 5
FREE = np.uint64(0xFFFFFFFFFFFFFFFF)  # keys have six bytes
LOG_HALF = np.log(0.5)
_LOG_PI = np.log(np.pi)


def keys_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every byte of the texts and of the space after each, and the number of keys of each text."""
    line = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    n = len(line) - 1
    keys = line[1:].astype(np.uint64)
    for distance in range(1, min(DEPTH, n) + 1):
        keys[distance - 1 :] |= line[: n + 1 - distance].astype(np.uint64) << np.uint64(8 * (DEPTH + 1 - distance))
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes) - sizes
    for p in range(DEPTH - 1):  # the space before a text is the last of its context; beyond it there is nothing
        keys[starts[sizes > p] + p] &= ~np.uint64((1 << 8 * (DEPTH - p)) - (1 << 8))
    return keys, sizes


def distinct(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and how often each is there or the sum of its counts."""
    order = None if counts is None else np.argsort(keys)
    keys = np.sort(keys) if order is None else keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    sums = np.diff(np.append(first, len(keys))) if order is None else np.add.reduceat(counts[order], first) if len(keys) else counts
    return keys[first], sums


class KeyCounts:
    """Counts of keys, added slice by slice and merged when as many are waiting as were merged before."""

    def __init__(self, least: int = 1 << 20):
        self.least, self.parts, self.waiting, self.merged = least, [], 0, 0

    def add(self, keys: np.ndarray, learns: bool) -> None:
        keys, counts = distinct(keys)
        self.parts.append((keys, counts if learns else np.zeros(len(keys), np.int64)))
        self.waiting += len(keys)
        if self.waiting > max(self.least, self.merged):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            self.parts = [distinct(np.concatenate([k for k, _ in self.parts]), np.concatenate([n for _, n in self.parts]))]
        self.waiting, self.merged = 0, sum(len(k) for k, _ in self.parts)
        return self.parts[0] if self.parts else (np.empty(0, np.uint64), np.empty(0, np.int64))


class CostTable:
    """Costs by key in a hash table of arrays with linear probing; a key that is not there costs NaN."""

    def __init__(self, keys: np.ndarray, costs: np.ndarray):
        self.size = len(keys) + len(keys) // 2 + 1
        self.keys, self.costs = np.full(self.size, FREE), np.full(self.size, np.nan)
        left, at = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = np.flatnonzero(self.keys[at] == FREE)
            slots, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[slots], self.costs[slots] = keys[left[placed]], costs[left[placed]]
            rest = np.ones(len(left), bool)
            rest[placed] = False
            left, at = left[rest], at[rest] + 1
            at[at == self.size] = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        spread = keys * np.uint64(0x9E3779B97F4A7C15)
        spread = (spread ^ (spread >> np.uint64(32))) * np.uint64(0xD1342543DE82EF95)
        return ((spread >> np.uint64(32)) * np.uint64(self.size) >> np.uint64(32)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._slots(keys)
        held = self.keys[at]
        left = np.flatnonzero((held != keys) & (held != FREE))
        while len(left):
            moved = at[left] + 1
            moved[moved == self.size] = 0
            at[left] = moved
            held = self.keys[moved]
            left = left[(held != keys[left]) & (held != FREE)]
        return self.costs[at]


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x >= 0.5, by Stirling's series six steps further on."""
    y = x + 6.0
    product = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    inverse = 1 / y
    series = inverse * (1 / 12 - inverse**2 * (1 / 360 - inverse**2 * (1 / 1260 - inverse**2 / 1680)))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov block probability."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - _LOG_PI - log_gamma(zeros + ones + 1.0)


class Level:
    """All nodes of one depth and one binary decision: node names, counts, estimates and block probabilities."""

    def __init__(self, names: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: Level | None):
        self.names, self.zeros, self.ones = names, zeros, ones
        self.estimate = log_estimate(zeros, ones)
        if below is None:
            self.block = self.estimate
        else:
            parent = np.searchsorted(names, below.parents)
            self.children = np.bincount(parent, below.block, len(names))
            self.block = np.logaddexp(LOG_HALF + self.estimate, LOG_HALF + self.children)

    parents: np.ndarray


def _decisions(keys: np.ndarray, counts: np.ndarray, depth: int, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node names at a depth and decision, with zeros and ones; a name is the context, a leading one and the bits so far."""
    names = _names(keys, depth, bit)
    ones = (keys >> np.uint64(7 - bit)) & np.uint64(1)
    unique, where = np.unique(names, return_inverse=True)
    return unique, np.bincount(where, counts * (1 - ones.astype(float)), len(unique)), np.bincount(where, counts * ones.astype(float), len(unique))


def _names(keys: np.ndarray, depth: int, bit: int) -> np.ndarray:
    context = keys >> np.uint64(8 * (DEPTH + 1 - depth))
    prefix = ((keys & np.uint64(0xFF)) | np.uint64(0x100)) >> np.uint64(8 - bit)
    return (context << np.uint64(8)) | prefix


def levels(keys: np.ndarray, counts: np.ndarray, top: int, bit: int) -> dict[int, Level]:
    """Nodes of all depths from ``DEPTH`` up to ``top`` for one decision, from whole subtrees at ``top``."""
    out: dict[int, Level] = {}
    below = None
    for depth in range(DEPTH, top - 1, -1):
        level = Level(*_decisions(keys, counts, depth, bit), below)
        context = level.names >> np.uint64(8)
        if depth:
            level.parents = ((context >> np.uint64(8)) << np.uint64(8)) | (level.names & np.uint64(0xFF))
        out[depth] = below = level
    return out


def mixed_ones(keys: np.ndarray, found: dict[int, Level], bit: int, inner: np.ndarray | None = None, seen_inner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Probability of a one at a decision for every key, mixed from the deepest level of ``found`` to its top, and whether the top was seen.

    ``inner`` and ``seen_inner`` are the results of the levels below those of ``found``.
    """
    probability, seen = inner, seen_inner
    for depth in sorted(found, reverse=True):
        level = found[depth]
        at = np.searchsorted(level.names, _names(keys, depth, bit))
        total = level.zeros[at] + level.ones[at]
        own = (level.ones[at] + 0.5) / (total + 1)
        if probability is None:
            probability = own
        else:
            weight = np.where(seen, np.exp(LOG_HALF + level.estimate[at] - level.block[at]), 1.0)
            probability = weight * own + (1 - weight) * probability
        seen = total > 0
    return probability, seen


def code_lengths(keys: np.ndarray, counts: np.ndarray, top: dict[int, dict[int, Level]]) -> np.ndarray:
    """log10 probability of the byte of every key, given the keys of whole subtrees at depth 2 and the levels above."""
    total = np.zeros(len(keys))
    for bit in range(8):
        probability, seen = mixed_ones(keys, levels(keys, counts, 2, bit), bit)
        probability, _ = mixed_ones(keys, top[bit], bit, probability, seen)
        one = ((keys >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        total += np.log10(np.where(one, probability, 1 - probability))
    return total


def top_levels(names: np.ndarray, bits: np.ndarray, zeros: np.ndarray, ones: np.ndarray, blocks: np.ndarray) -> dict[int, dict[int, Level]]:
    """Levels 1 and 0 of every decision from the nodes of depth 1: their counts, and the summed blocks of their children."""
    out: dict[int, dict[int, Level]] = {}
    for bit in range(8):
        at = np.flatnonzero(bits == bit)
        at = at[np.argsort(names[at])]
        first = Level(names[at], zeros[at], ones[at], None)
        first.block = np.logaddexp(LOG_HALF + first.estimate, LOG_HALF + blocks[at])
        first.parents = first.names & np.uint64(0xFF)
        roots, where = np.unique(first.parents, return_inverse=True)
        root = Level(roots, np.bincount(where, first.zeros, len(roots)), np.bincount(where, first.ones, len(roots)), first)
        out[bit] = {1: first, 0: root}
    return out
