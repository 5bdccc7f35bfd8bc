"""Conversation repair against plain programmes."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import conversation_repair as cr, queries

GOOD = re.compile(r"(s?(ua)+)?")
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}


def plain_faults(turns):
    seen, faults = set(), []
    for role, text in turns:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    return faults


def plain_repair(turns):
    """Cheapest edits from left to right: (cost, audit) by state, with insertions before each turn and at the end."""

    def inserted(best):
        for _ in range(3):
            for q, (cost, audit) in list(best.items()):
                for role in "ua":
                    if q in STEPS[role]:
                        to, new = STEPS[role][q], (cost + 3, audit + "I")
                        best[to] = min(best.get(to, new), new)
        return best

    best = {0: (0, "")}
    for (role, _), fault in zip(turns, plain_faults(turns), strict=True):
        after = {}
        for q, (cost, audit) in inserted(best).items():
            options = [(q, cost + 4, audit + "D")]
            if fault in ("", "truncated"):
                more = 3 * (fault == "truncated")
                options += [(STEPS[r][q], cost + more, audit + "K") for r in [role[:1]] if r in STEPS and q in STEPS[r]]
                options += [(STEPS[r][q], cost + more + 3, audit + "R") for r in "ua" if q in STEPS[r]]
            for to, c, a in options:
                after[to] = min(after.get(to, (c, a)), (c, a))
        best = after
    return min(v for q, v in inserted(best).items() if q in (0, 3))


def applied(turns, audit):
    out, left = [], list(turns)
    for edit in audit:
        role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit == "I":
            out.append((role, ""))
        else:
            old, text = left.pop(0)
            if edit != "D":
                out.append((old if edit == "K" else role, text))
    assert not left and GOOD.fullmatch("".join(r[:1] for r, _ in out))
    return out


def test_plain_programme_is_the_least_of_all_scripts():
    texts = {"": "x.", "t": "x", "b": " "}
    for n in (1, 2, 3):
        for kinds in itertools.product("suao", ("", "t", "b"), repeat=n):
            turns = [(kinds[2 * i] + "x", texts[kinds[2 * i + 1]] if kinds[2 * i + 1] == "b" else f"{i}{texts[kinds[2 * i + 1]]}") for i in range(n)]
            if n == 3 and hash(kinds) % 40:
                continue
            faults, best = plain_faults(turns), None
            for letters in itertools.chain(*(itertools.product("DIKR", repeat=k) for k in range(n, n + 4))):
                if sum(c != "I" for c in letters) != n:
                    continue
                audit, at, cost, roles = "".join(letters), 0, 0, ""
                for c in letters:
                    nxt = "a" if roles[-1:] == "u" else "u"
                    if c == "I":
                        cost, roles = cost + 3, roles + nxt
                        continue
                    if c == "D":
                        cost += 4
                    elif faults[at] in ("blank", "duplicate"):
                        break
                    else:
                        cost += (3 if c == "R" else 0) + 3 * (faults[at] == "truncated")
                        roles += turns[at][0][0] if c == "K" else nxt
                    at += 1
                else:
                    if GOOD.fullmatch(roles):
                        best = min(best or (cost, audit), (cost, audit))
            assert plain_repair(turns) == best


def conversations(seed, n):
    pick = random.Random(seed)
    found = {}
    for conv in range(n):
        size = pick.choice([1, 2, 3, 5, 8, 8, 40])
        roles = [pick.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]) for _ in range(size)]
        found[conv] = [(role, pick.choice([" ", "", "One.", "Two!", "three", f"{i}?", f"{i} and on", "é…", "Yes. \n"])) for i, role in enumerate(roles)]
    found[n] = [("user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(130)] + [("user", f"{i}") for i in range(60)]
    return found


@pytest.mark.parametrize("segment_bits, fold", [(12, 64), (2, 3)])
def test_repair_equals_the_plain_programme(spark, monkeypatch, segment_bits, fold):
    monkeypatch.setattr(cr, "SEGMENT_BITS", segment_bits)
    monkeypatch.setattr(cr, "FOLD", fold)
    found = conversations(segment_bits, 60)
    data = [(c, t, role, text, "x", 7) for c, turns in found.items() for t, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(data)
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, audit string, cost int").repartition(5)
    repair = cr.repair(frame)
    plans = {r.conv_id: r for r in repair.plan.collect()}
    assert len(plans) == len(found)
    repaired = {}
    for r in cr.repaired_turns(repair).orderBy("conv_id", "position").collect():
        repaired.setdefault(r.conv_id, []).append((r.role, r.text))
    digests = {r.conv_id: r.repaired_sha256 for r in cr.repaired_digests(repair).collect()}
    for conv, turns in found.items():
        row, faults = plans[conv], plain_faults(turns)
        assert (row.cost, row.audit) == plain_repair(turns)
        assert (row.blank, row.duplicate, row.truncated, row.gaps) == tuple(faults.count(f) for f in ("blank", "duplicate", "truncated")) + (0,)
        assert row.illegal == sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(turns))
        expected = applied(turns, row.audit)
        assert repaired.get(conv, []) == expected
        assert digests[conv] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in expected).encode()).hexdigest()


def test_nulls_ties_and_repeated_rows(spark):
    data = [
        (None, 1, "user", "Hi."),
        (None, 2, "assistant", "Yes."),
        (1, None, "system", "Be."),
        (1, None, "assistant", "A."),
        (1, 5, "user", "Q?"),
        (1, 9, "assistant", None),
        (2, 3, None, "x."),
        (3, 1, "user", "Same."),
        (3, 1, "user", "Same."),
        (4, None, "user", "a."),
    ]
    plans = {r.conv_id: r for r in cr.repair(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).plan.collect()}
    assert (plans[None].audit, plans[None].cost, plans[None].gaps) == ("KK", 0, 0)
    # Null turns first, of those the lesser role first: a, s, u, and an assistant without text.
    turns = [("assistant", "A."), ("system", "Be."), ("user", "Q?"), ("assistant", "")]
    assert (plans[1].cost, plans[1].audit) == plain_repair(turns) and plans[1].gaps == 3
    assert (plans[2].cost, plans[2].audit) == plain_repair([("", "x.")])
    assert (plans[3].duplicate, plans[3].gaps) == (1, 0)
    assert plans[4].gaps == 0
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    repair = cr.repair(empty)
    assert rows(repair.plan) == [] and rows(cr.repaired_turns(repair)) == [] and rows(cr.repaired_digests(repair)) == []


def test_rules_cover_what_recurs(spark):
    segments = spark.createDataFrame([(i, 0, "EIEIEI") for i in range(50)] + [(99, 0, "B")], "conv_id long, segment long, symbols string")
    rules = cr.repair_rules(segments)
    grammar = cr.Grammar(rules)
    assert rules[0] in ("EI", "IE") and len(grammar.compressed("EIEIEI")) == 1
    part, plain = grammar.whole(grammar.compressed("EIEIEIB")), cr.Grammar([]).whole("EIEIEIB")
    assert cr.part_columns([part]) == cr.part_columns([plain])
    assert cr.repair_rules(segments.where("false")) == []


def test_long_audits_are_compared_as_ropes():
    a = cr.joined(cr.joined("K" * 400, "K" * 400), "I" * 3)
    b = cr.joined("K" * 500, cr.joined("K" * 300, "K" * 5))
    assert isinstance(a, cr.Rope) and cr.less(a, b) and not cr.less(b, a) and not cr.less(a, a)
    assert cr.flat(a) == "K" * 800 + "III"


def test_damage(spark):
    data = [(i // 7, i % 7, None if i == 3 else "assistant", None if i == 5 else f"Text {i}. Yes!") for i in range(200)]
    import zlib

    expected = []
    for conv, turn, role, text in data:
        kind, role, text = zlib.crc32(f"{conv}:{turn}".encode()) % 20, role or " ", text or " "
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            expected += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    assert rows(queries.damaged(frame)) == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert queries.damaged(frame.select("*", F.lit(1).alias("copy"))).columns == ["conv_id", "turn", "role", "text"]
