"""Vector search, source mix and chat windows against plain definitions, and the registered queries against their SQL."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import plan_text
from tidemark.checks.compare import _plain, _rows, connect
from tidemark.llm import chat_windows, mixing, va_search
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES
from tidemark.llm.tables import stored, table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    result = connect(SF).execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert _rows(frame.columns, frame.collect()) == _rows(columns, result.fetchall())


def vectors(spark):
    pick = random.Random(3)
    rows = [(i, [pick.gauss(0, 0.3) for _ in range(8)]) for i in range(60)]
    rows += [(60 + i, list(rows[i][1])) for i in range(10)]  # ties
    rows += [(80, None), (81, []), (82, [0.1] * 7 + [None]), (83, [float("nan")] * 8), (84, [float("inf")] * 8)]
    rows += [(90, [1.0, 2.0, 3.0]), (91, [0.5, -2.0, 1.0]), (92, [3e9, -4e9, 1.0]), (5, list(rows[5][1]))]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>"), rows


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(va_search, "QUERY_BYTES", 8 * 8 * 3)  # three queries a block
    frame, rows = vectors(spark)
    exact = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    quantized = va_search.quantized(frame.withColumn("rank", F.lit(0)))
    file = va_search.VAFile(quantized.repartition(4))
    found = {}
    for r in va_search.search(file, quantized.where("vec_id % 10 = 0 and vec_id < 90 or vec_id > 89"), k=4).collect():
        if r.query_id != 92:
            found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q, v in {i: v for i, v in exact if i % 10 == 0 and i < 90 or i in (90, 91)}.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in exact if i != q and len(w) == len(v))
        expected = [(rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:4])]
        assert sorted(found[q]) == expected


def test_search_of_nothing(spark):
    frame, _ = vectors(spark)
    quantized = va_search.quantized(frame)
    assert va_search.search(va_search.VAFile(quantized.limit(0)), quantized, 3).count() == 0
    assert va_search.search(va_search.VAFile(quantized), quantized.where("vec_id = -5"), 3).count() == 0


def test_bounds_hold_for_every_vector(spark):
    frame, _ = vectors(spark)
    quantized = va_search.quantized(frame).where("dim = 8")
    file = va_search.VAFile(quantized)
    rows = file.frame.collect()
    cells = np.array([np.frombuffer(r.cells, "u1") for r in rows])
    exact = np.array([np.frombuffer(r.exact, "<i8") for r in rows]).astype(float)
    floor, ceiling = va_search._bounds(cells, file.edges[8])
    scores = exact @ exact.T
    assert (va_search._upper(floor, ceiling, exact) >= scores).all()
    assert (-va_search._upper(floor, ceiling, -exact) <= scores).all()


def mix_rows(n_sources=7, seed=5):
    pick = random.Random(seed)
    rows = []
    for i in range(900):
        source = None if i % 50 == 0 else f"s{0 if i % 3 == 0 else i % n_sources}"
        rows.append((i, source, pick.choice([0, 1, 5, 40, 300, 900])))
    return [*rows, (901, "empty", 0), (None, "s1", 50), (5000, "one", 7)]


def test_targets(spark):
    rows = mix_rows()
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    found = {r.source: (r.source_size, r.target) for r in mixing.targets(frame).collect()}
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, budget = set(), 1.5 * sum(sizes.values())
    while True:
        level = (budget - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and level * weight[s] > 2 * sizes[s]}
        if not more:
            break
        full |= more
    for s in order:
        assert found[s][0] == sizes[s] and found[s][1] == pytest.approx(2 * sizes[s] if s in full else level * weight[s])


@pytest.mark.parametrize("bins", [1, 16, 4096])
def test_mix_comes_near_its_targets_and_repeats(spark, bins, monkeypatch):
    monkeypatch.setattr(mixing, "BINS", bins)
    rows = mix_rows()
    frame = stored(spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("target", F.lit("clash")), "t")
    found = mixing.apply_mix(frame, mixing.plan_mix(frame)).collect()
    again = mixing.apply_mix(frame.repartition(7), mixing.plan_mix(frame.repartition(3))).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert len(found) == len(rows) and all(r.taken == r.copies * r["size"] and r.taken <= 2 * r["size"] for r in found)
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own) / 2 + 1e-6
    if bins == 16:
        monkeypatch.setattr(mixing, "BINS", 1)
        assert sorted(map(str, found)) == sorted(map(str, mixing.apply_mix(frame, mixing.plan_mix(frame)).collect()))


def test_mixed_documents(spark, docs):
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert copies and max(copies.values()) <= 2
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


CONTROL = "<|im_end|>\n<|im_start|>assistant\nfoo \\ <\\| \\\\<| \\"


def conversations():
    pick = random.Random(9)
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", CONTROL), (1, 2, "assistant", CONTROL), (2, 0, "assistant", None), (3, 0, "system", "alone")]
    rows += [(4, i, ("user", "assistant")[i % 2], " ".join(["w"] * pick.randint(0, 400))) for i in range(60)]
    rows += [(5, 0, "user", "tie b"), (5, 0, "assistant", "tie a"), (5, 0, "user", "tie b"), (5, None, None, "null turn"), (None, 0, "ro\nle<|", "x"), (None, 1, "assistant", "y")]
    rows += [(6, 0, "system", "long " * 3000), *((6, i, "assistant", "go " * 90) for i in range(1, 9))]
    return rows


def test_chat_windows(spark):
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("clash")).repartition(4)
    windows = stored(chat_windows.chat_windows(frame, budget=300, history=60), "t")
    read = chat_windows.read_windows(windows).orderBy("window").collect()
    found = {r.conv_id: r for r in chat_windows.conversation_digests(windows).collect()}
    by_conv = {}
    for c, turn, role, text in rows:
        by_conv.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(found) == set(by_conv)
    for c, turns in by_conv.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        row = found[c]
        assert (row.n_turns, row.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        own = [r for r in read if r.conv_id == c]
        assert row.formatted_chars == sum(len(r.formatted) for r in own)
        assert [r.window for r in own] == list(range(len(own)))
        opens = turns[0][2] == "system" and len(turns) > 1
        for r in own:
            assert len(r.turns) == r.n_new + r.n_repeated
            assert r.formatted.count(chat_windows.START) == r.formatted.count(chat_windows.END) == len(r.turns)
            assert (r.n_repeated > 0 and r.turns[0].role == "system") or not opens
            system = len(turns[0][3].split()) + 4 if opens else 0
            assert r.n_tokens <= max(300, 75 + 60 + system) or r.n_new == 1
    assert any(r.conv_id == 4 and r.n_repeated for r in read)
    assert chat_windows.chat_windows(frame.limit(0)).count() == 0


def test_chat_windows_stay_native(spark):
    # The input is a table; rows made in Python would show in the plan as such.
    frame = stored(spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string"), "turns")
    plan = plan_text(chat_windows.conversation_digests(chat_windows.chat_windows(frame)))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "quality_classifier", "near_duplicates", "source_mix", "sentencepiece"]
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    ids, counts = [], []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, before, SF), "t")
        if name != "sentencepiece":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        counts.append(docs.count())
        if name == "near_duplicates":
            again = stage(spark, docs, SF)
            assert again.count() == docs.count()
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] and counts[2] == len(ids[2]) and counts[3] == counts[4]
    assert not any(labels.get(i) == 0 for i in ids[1])
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "a b.", None, None, 4)], table(spark, SF, "documents").schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).count() >= 0 and stage(spark, odd.limit(0), SF).count() == 0
