"""Texts as byte arrays: word positions and 64-bit hashes for whole batches at once.

A word is a longest run of bytes outside ``[\\x20\\x09-\\x0D]``. All those bytes are ASCII, so words of
UTF-8 text never cut a character.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

SLICE_BYTES = 1_000_000
STEP = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD1342543DE82EF95)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BYTE_VALUES = np.random.Generator(np.random.PCG64(2024)).integers(1, 1 << 63, 256, dtype=np.uint64)
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers = np.ones((2, 1), np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> np.ndarray:
    """Powers of BASE and of its inverse, at least ``n`` of them."""
    global _powers
    if _powers.shape[1] < n:
        factors = np.empty((2, n), np.uint64)
        factors[:, 0] = 1
        factors[0, 1:], factors[1, 1:] = BASE, BASE_INVERSE
        _powers = np.cumprod(factors, axis=1, dtype=np.uint64)
    return _powers


@dataclass
class Words:
    """Words of a slice of texts: byte positions, the text each word is in, where each text's words begin."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first: np.ndarray  # one more entry than texts

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        powers = _power_tables(len(self.buffer) + 1)
        sums = np.zeros(len(self.buffer) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[self.buffer] * powers[0, : len(self.buffer)], out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * powers[1, self.starts]
        return mixed(raw + STEP * (self.ends - self.starts).astype(np.uint64))


def words_of(texts: list[bytes], lower: bool = False) -> Words:
    """Words of every text; ``lower`` maps A-Z to a-z first."""
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        buffer = LOWER[buffer]
    inside = IS_WORD[buffer]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))  # the last byte is outside
    starts, ends = edges[0::2], edges[1::2]
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    first = np.searchsorted(starts, begins)
    return Words(buffer, starts, ends, np.repeat(np.arange(len(texts)), np.diff(first)), first)


def windows(hashes: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words inside one text, and the position of their first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * BASE + hashes[k : k + n]
    at = np.flatnonzero(text[:n] == text[width - 1 :])
    return mixed(total[at] + np.uint64(width)), at


def slices(texts: Iterable[bytes], most: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``most`` bytes with the position of their first; a longer text is a run of its own."""
    start, size, held = 0, 0, []
    for i, text in enumerate(texts):
        if held and size + len(text) > most:
            yield start, held
            start, size, held = i, 0, []
        held.append(text)
        size += len(text)
    if held:
        yield start, held


def utf8(column) -> list[bytes]:
    """Values of an Arrow string column as bytes; null is empty."""
    import pyarrow as pa

    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]
