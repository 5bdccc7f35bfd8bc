"""SentencePiece BPE encoding by a table of prefixes, and decoding.

Merges pick the adjacent pair whose joined piece scores highest, the leftmost on ties. Which merges
happen inside a run of text doesn't depend on text beyond a border that no merge crosses. So a row of
pieces is the encoding of its text exactly if each neighbouring pair is (``compatible``), and every
prefix of a text has one last token: the piece ending there that encodes to itself and is compatible
with the last token of the prefix before it. ``Automaton`` matches give the candidates; the ids are
then read from the end of the text backwards.

Spaces become U+2581. A text is cut before every space that follows another character, which no piece of
such a vocabulary spans (checked at loading), and a worker encodes each distinct cut once.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np

from tidemark.llm.workers import keeps

SPACE = "▁"
CUT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
CACHED_WORDS = 100_000
CACHED_LENGTH = 64
CACHED_PAIRS = 150_000
NEVER = float("inf")


class PieceTokenizer:
    """Vocabulary, merge histories and caches of one model; make one per worker with ``tokenizer``."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.byte_ids = [0] * 256
        self.rank: dict[str, float] = {}  # of the merge that makes a piece: low ranks first
        self.id_of: dict[str, int] = {}
        self.surface: list[bytes] = [b""] * size
        self.is_byte = np.zeros(size, bool)
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.surface[i], self.is_byte[i] = i, bytes([value]), True
            elif model.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
            elif not model.is_control(i):
                if model.is_unused(i) or SPACE in piece.lstrip(SPACE):
                    raise ValueError(f"piece {piece!r} is outside what this encoder covers")
                self.id_of[piece], self.rank[piece] = i, -model.get_score(i)
                self.surface[i] = piece.replace(SPACE, " ").encode()
        self.history: dict[str, tuple[list[float], list[str], list[str]]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in self.id_of:
            merges = self._merges(piece)
            if merges is not None:  # pieces that don't encode to themselves never come out
                self.history[piece] = merges
                self.automaton.add_word(piece, (piece, len(piece)))
        self.automaton.make_automaton()
        self.joined = {piece[i : i + 2] for piece in self.id_of for i in range(len(piece) - 1)}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}  # two generations: words in use move from the older to the newer
        self.older_words: dict[str, bytes] = {}
        self.lengths = np.array([len(s) for s in self.surface], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.pool = np.frombuffer(b"".join(self.surface), np.uint8)
        ends = np.zeros(size, bool)
        ends[[i for i in (self.begin, self.end) if i >= 0]] = True
        self.is_control = ends

    def _merges(self, piece: str) -> tuple[list[float], list[str], list[str]] | None:
        """Ranks of a piece's merges in order, and its first and last symbol before and after each; None if they don't end in the piece."""
        parts, ranks, firsts, lasts = list(piece), [], [piece[0]], [piece[-1]]
        while len(parts) > 1:
            best, at = min((self.rank.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if best == NEVER:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            ranks.append(best)
            firsts.append(parts[0])
            lasts.append(parts[-1])
        return [*ranks, NEVER], firsts, lasts

    def compatible(self, left: str, right: str) -> bool:
        """Whether no merge crosses the border of two tokens: their merges interleave by rank, the left ones first on ties."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        (ours, _, last), (theirs, first, _) = self._history(left), self._history(right)
        i = j = 0
        result = True
        while True:
            crossing = self.rank.get(last[i] + first[j], NEVER)
            if crossing < ours[i] and crossing <= theirs[j]:
                result = False
                break
            if ours[i] == theirs[j] == NEVER:
                break
            if ours[i] <= theirs[j]:
                i += 1
            else:
                j += 1
        self.pairs[left, right] = result
        return result

    def _history(self, token: str) -> tuple[list[float], list[str], list[str]]:
        return self.history.get(token) or ([NEVER], [token], [token])  # a character without a piece

    def tokens(self, word: str) -> list[str]:
        """Tokens of one cut; characters without a piece stand for themselves."""
        last: list[str | None] = [None] * (len(word) + 1)
        pairs = self.pairs
        for at, (piece, size) in self.automaton.iter(word):  # the longest match of an end comes first
            if last[at + 1] is not None:
                continue
            if before := at + 1 - size:
                left = last[before]
                if left is None:  # no piece ends there
                    left = last[before] = word[before - 1]
                fits = pairs.get((left, piece))
                if fits is None:
                    fits = self.compatible(left, piece)
                if not fits:
                    continue
            last[at + 1] = piece
        out, at = [], len(word)
        while at:
            token = last[at] or word[at - 1]
            out.append(token)
            at -= len(token)
        return out[::-1]

    def _ids(self, word: str) -> bytes:
        ids: list[int] = []
        for token in self.tokens(word):
            known = self.id_of.get(token)
            if known is not None:
                ids.append(known)
            else:
                ids.extend(self.byte_ids[b] for b in token.encode())
        return np.array(ids, "<u4").tobytes()

    def _parts(self, word: str) -> list[str]:
        """A word cut between neighbours that no piece holds side by side, such as a letter and a line break."""
        joined, parts, begin = self.joined, [], 0
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in joined:
                parts.append(word[begin:i])
                begin = i
        return [*parts, word[begin:]]

    def _word_ids(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = self.older_words.get(word)
            if ids is None:
                parts = self._parts(word)
                ids = self._ids(word) if len(parts) == 1 else b"".join(map(self._word_ids, parts))
            if len(word) <= CACHED_LENGTH:
                if len(self.words) >= CACHED_WORDS:
                    self.words, self.older_words = {}, self.words
                self.words[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            body = b""
        elif "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            body = b"".join(map(self._word_ids, CUT.findall(SPACE + text.replace(" ", SPACE))))
        else:
            words = [SPACE + w for w in text.split(" ")]
            found = list(map(self.words.get, words))
            if None in found:
                found = [ids or self._word_ids(w) for w, ids in zip(words, found, strict=True)]
            body = b"".join(found)
        ids = np.empty(len(body) // 4 + 2, "<u4")
        ids[0], ids[-1] = self.begin, self.end
        ids[1:-1] = np.frombuffer(body, "<u4")
        return ids

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of ids in UTF-8: surfaces joined, without the space that encoding puts first.

        Runs of byte tokens that are not valid UTF-8 become U+FFFD, one for each byte that fits no character.
        """
        ids = np.asarray(ids, np.int64)
        ids = ids[~self.is_control[ids]]
        sizes = self.lengths[ids]
        total = int(sizes.sum())
        starts = np.cumsum(sizes) - sizes
        data = self.pool[np.repeat(self.offsets[ids] - starts, sizes) + np.arange(total)].tobytes()
        if len(ids) and not self.is_byte[ids[0]] and data[:1] == b" ":
            data = data[1:]
        try:
            data.decode()
        except UnicodeDecodeError:
            return _repaired(data).encode()
        return data


def _repaired(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> PieceTokenizer:
    """The tokenizer of this worker process."""
    return PieceTokenizer(path)


keeps("pieces", tokenizer.cache_clear)
