"""Byte-level BPE by stretches of text that the library encodes alike alone and in place.

The pre-tokenizer always cuts before a space that a non-space follows, whatever surrounds it. So a text
is cut into chunks there. A chunk that is no word is cut again where a cut is as certain (before a mark
that ends it, and by ``SAFE``), since words recur more often than words with their punctuation; workers
keep the ids of words. A word of Latin letters needs merges only: tiktoken does these over the ranks of
the same vocabulary file, the tokenizers library encodes everything else. Texts that hold a special string
go to that library whole, because it cuts those strings out before anything else.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from functools import lru_cache

import numpy as np

from tidemark.llm.workers import keeps

# The published pattern of byte-level pre-tokenizers; runs are possessive, which cuts alike and scans faster.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
CACHED_CHUNKS = 300_000
CACHED_PARTS = 50_000
CACHED_LENGTH = 64
AMBIGUOUS = re.compile(r" (?:\s|$)")
CUT = re.compile(r" (?=\S)")
_LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
LETTERS = frozenset(c for c in map(chr, range(0x100)) if re.match(_LETTER, c))
WORD = re.compile(rf"{_LETTER}+\Z")
# Between a Latin letter and an ASCII character that is none, after a lone line break before a Latin
# letter, and between ASCII punctuation and a line break.
SAFE = re.compile(rf"(?<={_LETTER})(?=[\x00-@\[-`{{-\x7f])|(?<=\S\n)(?={_LETTER})|(?<=[!-/:-@])(?=\n)")


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


BYTE_OF = _byte_alphabet()


class Recent:
    """A cache of two generations: values in use move from the older to the newer, the rest is forgotten."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def put(self, key: str, value: bytes) -> None:
        if len(self.new) >= self.size:
            self.new, self.old = {}, self.new
        self.new[key] = value

    def find(self, key: str) -> bytes | None:
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value


class ChunkEncoder:
    """Encodes texts through bounded caches; make one per worker with ``encoder``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.ranks = ranks = {bytes(map(BYTE_OF.__getitem__, t)): i for t, i in self.library.get_vocab(with_added_tokens=False).items()}
        self.merges = tiktoken.Encoding("merges", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.width = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.width.itemsize == 2 else "I"
        self.chunk_ids, self.part_ids = Recent(CACHED_CHUNKS), Recent(CACHED_PARTS)
        self.mark_ids = dict(zip(string.punctuation, self.whole(list(string.punctuation)), strict=True))

    def chunks(self, text: str) -> list[str] | None:
        """Chunks in order, all but the first without the space before them; None: not to be cut."""
        if self.special is not None and self.special.search(text):
            return None
        return CUT.split(text) if AMBIGUOUS.search(text) else text.split(" ")

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids as the library gives them, as little-endian integers of ``width``."""
        return [np.array(e.ids, self.width).tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _kept(self, cache: Recent, key: str, ids: bytes) -> bytes:
        if len(key) <= CACHED_LENGTH:
            cache.put(key, ids)
        return ids

    def _part(self, part: str) -> bytes:
        """Ids of a part; one that begins with a space and is a word is a chunk of its own."""
        if part[0] == " " and WORD.match(part, 1):
            return self.chunk_ids.new.get(part[1:]) or self.chunk(part[1:])
        ids = self.part_ids.find(part)
        if ids is None:
            ids = self._merged(part) if WORD.match(part) else self.whole([part])[0]
            self._kept(self.part_ids, part, ids)
        return ids

    def _merged(self, word: str) -> bytes:
        return array(self.code, self.merges.encode_ordinary(word)).tobytes()

    def chunk(self, chunk: str) -> bytes:
        """Ids of a chunk with the space before it. Words are kept, and words with a mark after them if the word was known."""
        mark = self.mark_ids.get(chunk[-1])
        if mark is None:
            if WORD.match(chunk):
                ids = self.chunk_ids.find(chunk)
                return self._kept(self.chunk_ids, chunk, self._merged(" " + chunk)) if ids is None else ids
        elif chunk[-2:-1] in LETTERS:  # the cut before the mark is certain, whatever stands before the letter
            stem = self.chunk_ids.new.get(chunk[:-1])
            if stem is not None:
                return self._kept(self.chunk_ids, chunk, stem + mark)
            return self.chunk(chunk[:-1]) + mark
        return b"".join(map(self._part, SAFE.split(" " + chunk)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian integers of ``width``."""
        cut = [self.chunks(t) for t in texts]
        heads = self.whole([t if chunks is None else chunks[0] for t, chunks in zip(texts, cut, strict=True)])
        out = []
        for head, chunks in zip(heads, cut, strict=True):
            if chunks is None:
                out.append(head)
                continue
            chunks[0] = ""
            ids = list(map(self.chunk_ids.new.get, chunks))
            ids[0] = head
            if None in ids:
                for at in [i for i, found in enumerate(ids) if found is None]:
                    ids[at] = self.chunk(chunks[at])
            out.append(b"".join(ids))
        return out


class TextEncoder:
    """Encodes whole texts: tiktoken with the vocabulary file's merges and the pre-tokenizer's pattern.

    Both libraries class every code point alike, and so cut alike (tests compare them). Texts that hold a special
    string go to the tokenizers library, which cuts those out first.
    """

    def __init__(self, path: str):
        import tiktoken

        tool = ChunkEncoder(path)
        self.special, self.whole, self.width = tool.special, tool.whole, tool.width
        self.library = tiktoken.Encoding("texts", pat_str=PATTERN, mergeable_ranks=tool.ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian integers of ``width``."""
        if self.special is not None and self.special.search(text):
            return self.whole([text])[0]
        return self.library.encode_to_numpy(text, disallowed_special=()).astype(self.width).tobytes()


@lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    """The whole-text encoder of this worker process."""
    return TextEncoder(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """The encoder of this worker process."""
    return ChunkEncoder(path)


keeps("texts", text_encoder.cache_clear)
keeps("chunks", encoder.cache_clear)
