"""Line-first cleaning: rules judge each line, failing lines go, documents that lose too much text are rejected.

A line fails by the first rule that holds:

- ``punctuation``: it neither ends in a closing mark nor holds a finished sentence, or more than
  ``marks_share`` of its words end in two or more exclamation or question marks;
- ``navigation``: separators between labels make up ``separator_share`` of its words and are at least
  ``separators``, or it is short and holds a phrase of menus and links;
- ``boilerplate``: it is short and holds a phrase of notices, or symbols are in more than
  ``symbol_share`` of its words.

Lines without a word stay as they are and count for nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import mixed, slices, utf8, windows, words_of
from tidemark.llm.workers import claim

ENDS = r"""[.!?:;…"'”’»)\]][\x20\x09-\x0D]*$"""
SENTENCE = r"[.!?…][\x20\x09-\x0D]"
MARKS = r"[!?]{2,}[.,;:]*$"
SEPARATOR = r"^[|»›·•>]+$"
SYMBOL = r"[#*$%&|<>]"
NAVIGATION = r"(?i)skip to (main )?content|read more|click here|sign (in|up)|log ?in|subscribe|share (this|on)|(next|previous) page|back to top"
BOILERPLATE = r"(?i)javascript|cookie|privacy policy|terms of (use|service)|all rights reserved|copyright|lorem ipsum|licen[sc]ed under"
RULES = ("punctuation", "navigation", "boilerplate")
REPEAT_WIDTH = 5
ROWS = 512


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules."""

    marks_share: float = 0.3
    separators: int = 3
    separator_share: float = 0.1
    short_line: int = 30
    symbol_share: float = 0.3
    max_lost: float = 0.5
    min_words: int = 10
    max_repeated_percent: int = 20


_ends, _sentence, _marks, _separator, _symbol, _navigation, _boilerplate = map(
    re.compile, (ENDS, SENTENCE, MARKS, SEPARATOR, SYMBOL, NAVIGATION, BOILERPLATE)
)
_blank = " \t\n\v\f\r"
_split = re.compile(r"[^\x20\x09-\x0D]+")


def failing_rule(line: str, rules: LineRules) -> tuple[int, int]:
    """Words of a line, and the position of the rule it fails (-1: none)."""
    words = _split.findall(line)
    n = len(words)
    if not n:
        return 0, -1
    if not (_ends.search(line) or _sentence.search(line)):
        return n, 0
    if ("!!" in line or "??" in line or "!?" in line or "?!" in line) and sum(map(bool, map(_marks.search, words))) > rules.marks_share * n:
        return n, 0
    symbols = _symbol.search(line) is not None
    if symbols or "»" in line or "›" in line or "·" in line or "•" in line:
        separators = sum(map(bool, map(_separator.search, words)))
        if separators >= rules.separators and separators >= rules.separator_share * n:
            return n, 1
    if n <= rules.short_line and _navigation.search(line):
        return n, 1
    if n <= rules.short_line and _boilerplate.search(line):
        return n, 2
    if symbols and sum(map(bool, map(_symbol.search, words))) > rules.symbol_share * n:
        return n, 2
    return n, -1


def cleaned(text: str, rules: LineRules) -> tuple[str, int, list[int], int]:
    """The text without failing lines, words kept, lines removed by each rule, repeats of earlier lines."""
    kept, words, removed, seen, repeats = [], 0, [0] * len(RULES), set(), 0
    verdicts: dict[str, tuple[int, int]] = {}
    for line in text.split("\n"):
        verdict = verdicts.get(line)
        if verdict is None:
            verdict = verdicts[line] = failing_rule(line, rules)
        n, rule = verdict
        if n:
            repeats += line in seen
            seen.add(line)
        if rule < 0:
            kept.append(line)
            words += n
        else:
            removed[rule] += 1
    return "\n".join(kept), words, removed, repeats


def _counts(texts: list[bytes]) -> np.ndarray:
    """Words, characters in words, symbols, and words inside repeated windows, of each text."""
    out = np.zeros((4, len(texts)), np.int64)
    for start, part in slices(texts):
        words = words_of(part)
        n, at = len(part), slice(start, start + len(part))
        out[0, at] = np.diff(words.first)
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in part])])
        symbols = np.isin(words.buffer, np.frombuffer(b"#*$%&|<>", np.uint8))
        out[2, at] = np.diff(np.concatenate([[0], np.cumsum(symbols)])[begins])
        characters = np.concatenate([[0], np.cumsum((words.buffer & 0xC0) != 0x80)])
        if not len(words.starts):
            continue
        out[1, at] = np.bincount(words.text, characters[words.ends] - characters[words.starts], n).astype(np.int64)
        keys, first = windows(words.hashes(), words.text, REPEAT_WIDTH)
        keys = mixed(keys + words.text[first].astype(np.uint64))  # equal windows of different texts differ
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        repeated = np.zeros(len(keys), bool)
        repeated[order[1:][same]] = repeated[order[:-1][same]] = True
        cover = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(cover, first[repeated], 1)
        np.add.at(cover, first[repeated] + REPEAT_WIDTH, -1)
        inside = np.cumsum(cover[:-1]) > 0
        out[3, at] = np.bincount(words.text[inside], minlength=n)
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept_words", *(f"lines_{r}" for r in RULES))


def clean_lines(docs: DataFrame, rules: LineRules | None = None, text: str = "text", keep: tuple[str, ...] | None = None, with_text: bool = True) -> DataFrame:
    """Columns ``keep`` (default: all), ``cleaned`` (unless left out), the counts, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or too many words inside repeated five-word windows.
    ``kept``: not so, and at most ``max_lost`` of the words went with failing lines. A null text counts as
    empty, has no words and is rejected. Rows are judged alone, so repeated rows get the same verdict;
    columns of ``docs`` named like a result are replaced.
    """
    rules = rules or LineRules()
    named = {"cleaned", *COUNTS, "base_failed", "kept"}
    kept_columns = [c for c in (docs.columns if keep is None else keep) if c not in named]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = utf8(batch.column(at_text))
                n, chars, symbols, repeated = _counts(texts)
                lines = [cleaned(t.decode(), rules) for t in texts]
                left = np.array([x[1] for x in lines], np.int64)
                failed = (n < rules.min_words) | (100 * repeated > rules.max_repeated_percent * n)
                verdict = ~failed & (n - left <= rules.max_lost * n)
                counts = [n, chars, symbols, np.array([x[3] for x in lines]), repeated, left, *np.array([x[2] for x in lines]).T]
                out = [*batch.columns[: len(kept_columns)], *([pa.array([x[0] for x in lines], pa.string())] if with_text else [])]
                out += [pa.array(c, pa.int64()) for c in counts] + [pa.array(failed), pa.array(verdict)]
                yield pa.record_batch(out, names=[*kept_columns, *["cleaned"] * with_text, *COUNTS, "base_failed", "kept"])

    # The text is handed over once, whether it is kept or not.
    at_text = kept_columns.index(text) if text in kept_columns else len(kept_columns)
    selected = docs.select(*[F.col(f"`{c}`") for c in kept_columns], *([] if text in kept_columns else [F.col(f"`{text}`").alias("_text")]))
    schema = docs.select(*[F.col(f"`{c}`") for c in kept_columns]).schema
    for name in ["cleaned"] * with_text:
        schema = schema.add(name, "string")
    for name in COUNTS:
        schema = schema.add(name, "long")
    return selected.mapInArrow(run, schema.add("base_failed", "boolean").add("kept", "boolean"))
