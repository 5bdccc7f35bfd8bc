"""Repair of conversations' structure by a grammar-compressed dynamic programme.

The turns of a conversation become a sequence of symbols, one for each role and fault. Roles must read
``(s?(ua)+)?``: a turn is kept, given the role user or assistant, or deleted, and empty turns are inserted.
A symbol is a min-plus matrix over the four states of that pattern; its entries are the least cost between two
states and the audit (one letter an edit) that has it, least in ASCII order among equals.

Re-Pair finds the digrams that occur most in all conversations and makes each a rule. A rule's matrix is the
product of those of its two symbols, with audits as ropes; rules are evaluated once, bottom-up, and shared by
all conversations, whose own product is over the few symbols left of them.

Sequences are cut into segments of ``SEGMENT`` turns, and a conversation's segments are multiplied 16 by 16,
so a conversation of any length is spread over tasks. Two audits of equal cost over the same turns are never
one the beginning of the other (the longer one would have more edits that cost), so choosing the least inside
a segment and then joining gives the least of the whole.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.ordering import join_hot, placed
from tidemark.llm.tables import stored

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
FINAL = (START, ASSISTANT)
INITIALS = "sua"
STEPS = {"s": ((START, SYSTEM),), "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
FOLLOWS = {("s", "u"), ("u", "a"), ("a", "u")}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE, DELETE, INSERT, TRUNCATED_COST = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

SEGMENT_BITS = 12
SEGMENT = 1 << SEGMENT_BITS
RULES = 256
ROUND_RULES = 64
RULE_BASE = 0xF0000  # private-use characters name rules
FOLD_BITS = 4
FOLD = 64
SHORT = 512
KEY = 64
ROWS = 512
PART = "conv_id long, segment long, costs array<long>, audits array<string>, faults array<long>, illegal long, first int, last int"


class Rope:
    """A long audit as the join of two."""

    __slots__ = ("left", "right")

    def __init__(self, left: Rope | str, right: Rope | str):
        self.left, self.right = left, right


def pieces(rope: Rope | str) -> Iterator[str]:
    """The texts a rope is made of."""
    waiting = [rope]
    while waiting:
        top = waiting.pop()
        if isinstance(top, Rope):
            waiting += (top.right, top.left)
        elif top:
            yield top


def flat(rope: Rope | str) -> str:
    """A rope as one text."""
    return rope if isinstance(rope, str) else "".join(pieces(rope))


def joined(left: Rope | str, right: Rope | str) -> Rope | str:
    """Two ropes, one after the other; short ones become one text."""
    if isinstance(left, str) and isinstance(right, str) and len(left) + len(right) <= SHORT:
        return left + right
    return Rope(left, right)


def less(a: Rope | str, b: Rope | str) -> bool:
    """Whether one rope is before another in ASCII order."""
    if isinstance(a, str) and isinstance(b, str):
        return a < b
    left, right, x, y = pieces(a), pieces(b), "", ""
    while True:
        x, y = x or next(left, ""), y or next(right, "")
        if not x or not y:
            return bool(y)
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


Matrix = list[list[tuple[int, Rope | str] | None]]


def empty_matrix() -> Matrix:
    return [[None] * STATES for _ in range(STATES)]


def offer(matrix: Matrix, p: int, q: int, cost: int, audit: Rope | str) -> None:
    """Keep an audit if it is the best so far between two states."""
    held = matrix[p][q]
    if held is None or cost < held[0] or (cost == held[0] and less(audit, held[1])):
        matrix[p][q] = (cost, audit)


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product; audits follow the choice."""
    out = empty_matrix()
    for p in range(STATES):
        for k in range(STATES):
            first = a[p][k]
            if first is None:
                continue
            for q in range(STATES):
                second = b[k][q]
                if second is None:
                    continue
                cost, held = first[0] + second[0], out[p][q]
                if held is None or cost <= held[0]:
                    offer(out, p, q, cost, joined(first[1], second[1]))
    return out


def insertions() -> Matrix:
    """Any number of inserted turns; more than two never pay."""
    none = empty_matrix()
    for q in range(STATES):
        none[q][q] = (0, "")
    one = [list(row) for row in none]
    for role in "ua":
        for p, q in STEPS[role]:
            offer(one, p, q, INSERT, "I")
    return product(one, one)


INSERTED = insertions()


def symbol(role: int, fault: int) -> str:
    """The character of a role (0 to 2 by initial, 3: any other) and a fault."""
    return chr(ord("A") + 4 * role + fault)


@dataclass(frozen=True)
class Part:
    """What a run of turns comes to: its matrix, its faults, adjacent roles that may not follow each other, and its outer roles."""

    matrix: Matrix
    faults: tuple[int, int, int]
    illegal: int
    first: int
    last: int


def follows(a: int, b: int) -> bool:
    """Whether a role may come after another."""
    return a < 3 and b < 3 and (INITIALS[a], INITIALS[b]) in FOLLOWS


def together(a: Part, b: Part) -> Part:
    """Two neighbouring runs as one."""
    faults = tuple(x + y for x, y in zip(a.faults, b.faults, strict=True))
    return Part(product(a.matrix, b.matrix), faults, a.illegal + b.illegal + (not follows(a.last, b.first)), a.first, b.last)


def terminal(char: str) -> Part:
    """One turn, after any insertions."""
    role, fault = divmod(ord(char) - ord("A"), 4)
    edits = empty_matrix()
    for q in range(STATES):
        edits[q][q] = (DELETE, "D")
    if fault in (SOUND, TRUNCATED):
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for p, q in STEPS[INITIALS[role]] if role < 3 else ():
            offer(edits, p, q, extra, "K")
        for new in "ua":
            for p, q in STEPS[new]:
                offer(edits, p, q, REROLE + extra, "R")
    counts = tuple(int(fault == f) for f in (BLANK, DUPLICATE, TRUNCATED))
    return Part(product(INSERTED, edits), counts, 0, role, role)


class Grammar:
    """Rules (each a digram of earlier symbols) and their parts, evaluated bottom-up when first used."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.parts: dict[str, Part] = {}

    def name(self, rule: int) -> str:
        """The character that stands for a rule."""
        return chr(RULE_BASE + rule)

    def compressed(self, text: str) -> str:
        """A text of symbols with all rules applied in their order."""
        for i, digram in enumerate(self.rules):
            text = text.replace(digram, self.name(i))
        return text

    def part(self, char: str) -> Part:
        """The part of one symbol."""
        if char not in self.parts:
            rule = ord(char) - RULE_BASE
            self.parts[char] = terminal(char) if rule < 0 else together(self.part(self.rules[rule][0]), self.part(self.rules[rule][1]))
        return self.parts[char]

    def whole(self, text: str) -> Part:
        """The part of a compressed sequence of at least one symbol."""
        out = self.part(text[0])
        for char in text[1:]:
            out = together(out, self.part(char))
        return out


def digram_counts(text: str) -> Counter:
    """Neighbouring symbols of a text of sequences, one a line."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    inside = (codes[:-1] != ord("\n")) & (codes[1:] != ord("\n"))
    values, counts = np.unique((codes[:-1] << 32 | codes[1:])[inside], return_counts=True)
    return Counter(dict(zip(values.tolist(), counts.tolist(), strict=True)))


def chosen(ranked: list[tuple[str, int]], most: int) -> list[str]:
    """The most frequent digrams that can't overlap one another, so that all can be replaced in one round."""
    out, firsts, seconds = [], set(), set()
    for digram, n in ranked:
        if n >= 2 and len(out) < most and digram[0] not in seconds and digram[1] not in firsts and (digram[0] != digram[1] or digram[0] not in firsts):
            out.append(digram)
            firsts.add(digram[0])
            seconds.add(digram[1])
    return out


def repair_rules(segments: DataFrame, most: int = RULES) -> list[str]:
    """Re-Pair over the column ``symbols`` of all segments: rounds of rules until no digram occurs twice or ``most`` are made.

    A round counts digrams in every task, and its most frequent ones that do not overlap become rules. The
    number of rules bounds the size of the grammar; sequences keep whatever symbols no rule took.
    """
    rules: list[str] = []
    while len(rules) < most:
        grammar = Grammar(list(rules))

        def run(batches: Iterator[pa.RecordBatch], grammar: Grammar = grammar) -> Iterator[pa.RecordBatch]:
            counts: Counter = Counter()
            for batch in batches:
                counts.update(digram_counts(grammar.compressed("\n".join(batch.column(0).to_pylist()))))
            rows = [(chr(v >> 32) + chr(v & 0xFFFFFFFF), n) for v, n in counts.items()]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["digram", "n"])

        counted = segments.select("symbols").mapInArrow(run, "digram string, n long").groupBy("digram").agg(F.sum("n").alias("n"))
        ranked = [(r.digram, r.n) for r in counted.orderBy(F.desc("n"), "digram").limit(4 * ROUND_RULES).collect()]
        found = chosen(ranked, min(ROUND_RULES, most - len(rules)))
        if not found:
            break
        rules += found
    return rules


def ordered_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns in order and written, with role class (``kind``), own ``fault`` and a ``digest`` of conversation, role and text.

    Turns go by ``turn``, nulls first; equal ones by role and text, as far as their first ``KEY`` characters, then
    by digest. A null role or text is empty.
    """
    given = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(end == "", BLANK).when(F.right(end, F.lit(1)).isin(*ENDS), SOUND).otherwise(TRUNCATED)
    initial = F.left(F.col("role"), F.lit(1))
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    named = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.octet_length("role").cast("string"), "role", "text")
    keys = [F.left(F.col(c), F.lit(KEY)).alias(f"_{c}") for c in ("role", "text")]
    return placed(given.select("*", kind.alias("kind"), fault.alias("fault"), F.unhex(F.sha2(named, 256)).alias("digest"), *keys), "conv_id", "turn", "_role", "_text", "digest")


def symbol_segments(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``segment`` (rising along a conversation) and ``symbols`` of at most ``SEGMENT`` turns."""
    filled = turns.where(F.col("fault") != BLANK)
    again = filled.groupBy("digest").agg(F.min("_at").alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    judged = join_hot(turns.select("conv_id", "_at", "kind", "fault", "digest"), stored(again, "repair-repeated"), "digest", "n")
    fault = F.when((F.col("fault") != BLANK) & (F.col("_at") > F.col("earliest")), DUPLICATE).otherwise(F.col("fault"))
    char = F.char((F.lit(ord("A")) + 4 * F.col("kind") + fault).cast("long"))
    runs = judged.select("conv_id", "_at", char.alias("symbol")).groupBy("conv_id", F.shiftright("_at", SEGMENT_BITS).alias("segment"))
    symbols = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "symbol"))), lambda x: x["symbol"]), "")
    return stored(runs.agg(symbols.alias("symbols")), "repair-segments")


def part_columns(parts: list[Part]) -> list[pa.Array]:
    """Parts as the columns after ``segment`` in ``PART``."""
    entries = [[e for row in p.matrix for e in row] for p in parts]
    return [
        pa.array([[None if e is None else e[0] for e in m] for m in entries], pa.list_(pa.int64())),
        pa.array([[None if e is None else flat(e[1]) for e in m] for m in entries], pa.list_(pa.string())),
        pa.array([list(p.faults) for p in parts], pa.list_(pa.int64())),
        pa.array([p.illegal for p in parts], pa.int64()),
        pa.array([p.first for p in parts], pa.int32()),
        pa.array([p.last for p in parts], pa.int32()),
    ]


PART_NAMES = ["costs", "audits", "faults", "illegal", "first", "last"]


def read_part(row: dict) -> Part:
    """A part from its columns."""
    entries = [None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"], strict=True)]
    matrix = [entries[i : i + STATES] for i in range(0, STATES * STATES, STATES)]
    return Part(matrix, tuple(row["faults"]), row["illegal"], row["first"], row["last"])


def segment_parts(segments: DataFrame, rules: list[str]) -> DataFrame:
    """The part of every segment (columns of ``PART``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, seen = Grammar(rules), {}
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                lines = grammar.compressed("\n".join(batch.column(2).to_pylist())).split("\n")
                if len(seen) > 20_000:
                    seen.clear()
                for line in lines:
                    if line not in seen:
                        seen[line] = grammar.whole(line)
                yield pa.record_batch([batch.column(0), batch.column(1), *part_columns([seen[line] for line in lines])], names=["conv_id", "segment", *PART_NAMES])

    return segments.select("conv_id", "segment", "symbols").mapInArrow(run, PART)


def folded(parts: DataFrame, by: Column) -> DataFrame:
    """Neighbouring parts of a conversation multiplied wherever ``by``, the new segment, is equal; a bounded number each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                out = []
                for members in batch.column(2).to_pylist():
                    part = read_part(members[0])
                    for member in members[1:]:
                        part = together(part, read_part(member))
                    out.append(part)
                yield pa.record_batch([batch.column(0), batch.column(1), *part_columns(out)], names=["conv_id", "segment", *PART_NAMES])

    groups = parts.groupBy("conv_id", by.alias("_by")).agg(F.array_sort(F.collect_list(F.struct("segment", *PART_NAMES))).alias("members"))
    return groups.mapInArrow(run, PART)


def conversation_parts(parts: DataFrame) -> DataFrame:
    """One part a conversation: segments are multiplied 16 by 16 until none has more than ``FOLD``."""
    parts = stored(parts, "repair-parts")
    while (parts.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0) > FOLD:
        parts = stored(folded(parts, F.shiftright("segment", FOLD_BITS)), "repair-parts")
    return folded(parts, F.lit(0).cast("long"))


def best_edits(parts: DataFrame) -> DataFrame:
    """``conv_id``, ``cost``, ``audit`` and the fault counts of whole conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                best = []
                for row in batch.to_pylist():
                    ends = product(read_part(row).matrix, INSERTED)[START]
                    out = empty_matrix()
                    for q in FINAL:
                        if ends[q] is not None:
                            offer(out, START, START, *ends[q])
                    best.append((out[START][START][0], flat(out[START][START][1])))
                given = [pa.array([b[0] for b in best], pa.int64()), pa.array([b[1] for b in best], pa.string())]
                yield pa.record_batch([batch.column("conv_id"), *given, batch.column("faults"), batch.column("illegal")], names=["conv_id", "cost", "audit", "faults", "illegal"])

    found = parts.mapInArrow(run, "conv_id long, cost long, audit string, faults array<long>, illegal long")
    counts = [F.col("faults")[i].alias(name) for i, name in enumerate(("blank", "duplicate", "truncated"))]
    return found.select("conv_id", *counts, "illegal", "cost", "audit")


@dataclass(frozen=True)
class Repair:
    """Ordered turns (``conv_id``, ``turn``, ``role``, ``text``, ``_at``) and, for each conversation that has any, its ``plan``."""

    turns: DataFrame
    plan: DataFrame


def repair(turns: DataFrame, **columns: str) -> Repair:
    """Find the cheapest edits of every conversation.

    The plan has one row a conversation: ``conv_id``, ``gaps`` (turn numbers missing between the least and the
    largest), ``blank``, ``duplicate``, ``truncated`` (turns by first fault), ``illegal`` (neighbours that may not
    follow each other), ``cost`` and ``audit``. A null id is a conversation of its own; null turns come first and
    are no gaps; repeated rows are turns of their own. An audit has a letter a turn, so a conversation must
    have fewer than two billion.
    """
    rows = ordered_turns(turns, **columns)
    segments = symbol_segments(rows)
    found = best_edits(conversation_parts(segment_parts(segments, repair_rules(segments))))
    numbers = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    spans = rows.groupBy("conv_id").agg(F.coalesce(numbers, F.lit(0)).alias("gaps"))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    both = found.withColumn("gaps", F.lit(None).cast("long")).unionByName(spans, allowMissingColumns=True)
    return Repair(rows, stored(both.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in names]), "repair-plan"))


def _next_role(state: int) -> tuple[str, int]:
    return ("assistant", ASSISTANT) if state == USER else ("user", USER)


class Editor:
    """Applies one conversation's audit to its turns as they come."""

    def __init__(self, conv_id: int | None, audit: str):
        self.conv_id, self.audit = conv_id, audit
        self.place, self.state = 0, START

    def inserted(self) -> Iterator[tuple]:
        """The turns inserted here: conversation, role, text, edit."""
        while self.audit[self.place : self.place + 1] == "I":
            self.place += 1
            role, self.state = _next_role(self.state)
            yield self.conv_id, role, "", "I"

    def turn(self, role: str, text: str) -> Iterator[tuple]:
        """The turns inserted before the next turn, and what becomes of it."""
        yield from self.inserted()
        edit = self.audit[self.place]
        self.place += 1
        if edit == "R":
            role, self.state = _next_role(self.state)
        elif edit == "K":
            self.state = (SYSTEM, USER, ASSISTANT)[INITIALS.index(role[0])]
        if edit != "D":
            yield self.conv_id, role, text, edit


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Repaired turns in lists of bounded length from sorted turns with the audit first; a conversation ends with (id, None, None, None)."""
    editor = None
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            out: list[tuple] = []
            for row in whole.slice(start, ROWS).to_pylist():
                if row["_at"] >= 0:
                    out += editor.turn(row["role"], row["text"])
                    continue
                if editor:
                    out += [*editor.inserted(), (editor.conv_id, None, None, None)]
                editor = Editor(row["conv_id"], row["text"])
            yield out
    if editor:
        yield [*editor.inserted(), (editor.conv_id, None, None, None)]


def _with_audits(found: Repair) -> DataFrame:
    """Turns and audits, each conversation together and its audit first."""
    audits = found.plan.select("conv_id", F.lit(-1).cast("long").alias("_at"), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = audits.unionByName(found.turns.select("conv_id", "_at", "role", "text"))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "_at")


def repaired_turns(found: Repair) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``position``, ``role``, ``text`` and ``edit`` (K, R or I)."""
    kinds = {"conv_id": pa.int64(), "position": pa.int64(), "role": pa.string(), "text": pa.string(), "edit": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position = 0
        for turns in _edited(batches):
            rows = []
            for conv_id, role, text, edit in turns:
                if role is None:
                    position = 0
                else:
                    rows.append((conv_id, position, role, text, edit))
                    position += 1
            yield pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], names=list(kinds))

    return _with_audits(found).mapInArrow(run, "conv_id long, position long, role string, text string, edit string")


def repaired_digests(found: Repair) -> DataFrame:
    """``conv_id`` and ``repaired_sha256`` of the repaired ``role:text`` of each conversation, joined by line breaks.

    A digest is one chain over its conversation, so it is taken while the sorted turns pass; no text is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, empty = hashlib.sha256(), True
        for turns in _edited(batches):
            done = []
            for conv_id, role, text, _ in turns:
                if role is None:
                    done.append((conv_id, chain.hexdigest()))
                    chain, empty = hashlib.sha256(), True
                else:
                    chain.update((("" if empty else "\n") + role + ":" + text).encode())
                    empty = False
            yield pa.record_batch([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["conv_id", "repaired_sha256"])

    return _with_audits(found).mapInArrow(run, "conv_id long, repaired_sha256 string")
