"""Static range asymmetric numeral system over numpy lanes.

A block interleaves up to ``LANES`` coders (one for 64 symbols): symbol ``i`` belongs to lane ``i mod lanes`` and all lanes move in
step, so a step is a handful of array operations. Lane states are 64 bits wide, ``SCALE_BITS`` of them
address the shared frequency table, and 32-bit words leave a state that would overflow. A block starts
with a header and its lane states; checkpoints repeat the states every ``CHECKPOINT_STEPS`` steps, so
parts of a block can be decoded side by side. CRC-32 sums guard the block and the symbols in it.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

MAGIC = b"RANS"
SCALE_BITS = 20
LANES = 2048
CHECKPOINT_STEPS = 64
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
SCALE = np.uint64(SCALE_BITS)
SLOT_MASK = np.uint64((1 << SCALE_BITS) - 1)
HEADER = struct.Struct("<4sIIIIII")  # magic, symbols, lanes, checkpoints, words, CRC of symbols, CRC of the rest


@dataclass
class Frequencies:
    """Slots of every symbol out of ``2**SCALE_BITS``; symbols that never occur have none."""

    slots: np.ndarray

    def __post_init__(self):
        self.slots = self.slots.astype(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(self.slots)[:-1]]).astype(np.uint64)

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Frequencies:
        """Scale counts so that they fill all slots and every symbol that occurs has one."""
        total, room = int(counts.sum()), 1 << SCALE_BITS
        if total == 0:
            return cls(np.zeros(len(counts), np.uint64))
        seen = counts > 0
        if seen.sum() > room:
            raise ValueError("more symbols than slots")
        slots = np.where(seen, np.maximum(1, np.floor(counts / total * room)), 0).astype(np.int64)
        order = np.argsort(-counts, kind="stable")
        while (rest := room - int(slots.sum())) != 0:
            if rest > 0:
                slots[order[0]] += rest
            else:  # take from the largest, which keeps its lead
                give = order[slots[order] > 1]
                take = np.minimum(slots[give] - 1, -(-(-rest) // len(give)))
                take = np.minimum(take, np.maximum(0, -rest - (np.cumsum(take) - take)))
                slots[give] -= take
        return cls(slots)

    def symbols(self) -> np.ndarray:
        """The symbol of every slot."""
        return np.repeat(np.arange(len(self.slots), dtype=np.uint32), self.slots.astype(np.int64))


def encode(symbols: np.ndarray, table: Frequencies) -> bytes:
    """One block."""
    n, lanes = len(symbols), max(1, min(LANES, len(symbols) // 64))
    symbols = np.ascontiguousarray(symbols, np.uint32)
    states = np.full(lanes, LOW, np.uint64)
    slots, before = table.slots[symbols], table.before[symbols]
    if n and not slots.all():
        raise ValueError("a symbol is missing in the frequency table")
    steps = -(-n // lanes)
    words: list[np.ndarray] = []
    kept: list[tuple[int, np.ndarray]] = []  # words still to be read, states
    written = 0
    for step in range(steps - 1, -1, -1):
        at, to = step * lanes, min(n, (step + 1) * lanes)
        x, f = states[: to - at], slots[at:to]
        full = x >= f << np.uint64(63 - SCALE_BITS)
        if full.any():
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            written += len(words[-1])
            x[full] >>= WORD
        whole = x // f
        x[:] = (whole << SCALE) + (x - whole * f) + before[at:to]
        if step and step % CHECKPOINT_STEPS == 0:
            kept.append((written, states.copy()))
    body = [states.astype("<u8").tobytes()]
    for left, at_states in reversed(kept):
        body += [struct.pack("<I", written - left), at_states.astype("<u8").tobytes()]
    body += [w.tobytes() for w in reversed(words)]
    rest = b"".join(body)
    return HEADER.pack(MAGIC, n, lanes, len(kept), written, zlib.crc32(symbols.astype("<u4").tobytes()), zlib.crc32(rest)) + rest


class Decoder:
    """Decodes blocks of one frequency table."""

    def __init__(self, table: Frequencies):
        self.table, self.of_slot = table, table.symbols()

    def _run(self, states: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        lanes, read, out = len(states), 0, np.empty(n, np.uint32)
        for at in range(0, n, lanes):
            x = states[: min(lanes, n - at)]
            slot = x & SLOT_MASK
            got = self.of_slot[slot]
            out[at : at + len(x)] = got
            x[:] = self.table.slots[got] * (x >> SCALE) + slot - self.table.before[got]
            low = np.flatnonzero(x < LOW)
            if len(low):
                x[low] = (x[low] << WORD) | words[read : read + len(low)].astype(np.uint64)
                read += len(low)
        return out

    def parts(self, block: bytes) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """States, words and number of symbols from each checkpoint to the next; each can be decoded alone."""
        magic, n, lanes, checkpoints, written, _, checksum = HEADER.unpack_from(block)
        rest = memoryview(block)[HEADER.size :]
        if magic != MAGIC or zlib.crc32(rest) != checksum:
            raise ValueError("damaged block")
        starts = [(0, np.frombuffer(rest, "<u8", lanes).copy())]
        at = 8 * lanes
        for _ in range(checkpoints):
            starts.append((struct.unpack_from("<I", rest, at)[0], np.frombuffer(rest, "<u8", lanes, at + 4).copy()))
            at += 4 + 8 * lanes
        words = np.frombuffer(rest, "<u4", written, at)
        size, out = CHECKPOINT_STEPS * lanes, []
        for k, (word, states) in enumerate(starts):
            out.append((states, words[word:], min(size, n - k * size) if k < checkpoints else n - k * size))
        return out

    def decode(self, block: bytes) -> np.ndarray:
        """All symbols of a block, checked."""
        got = [self._run(*part) for part in self.parts(block)]
        out = got[0] if len(got) == 1 else np.concatenate(got)
        if zlib.crc32(out.astype("<u4").tobytes()) != HEADER.unpack_from(block)[5]:
            raise ValueError("decoded symbols differ")
        return out
