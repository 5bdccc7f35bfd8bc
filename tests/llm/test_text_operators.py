"""Line rules, classifier, language model and Jaccard join against plain definitions."""

import contextlib
import math
import os
import random
import re
import threading
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import sentence
from tidemark.llm import context_trees, jaccard_join, language_model, quality_model, rare_lookups
from tidemark.llm.jaccard_join import CountTree, Join, jaccard_components
from tidemark.llm.line_rules import LineRules, clean_lines, failing_rule
from tidemark.session import session_conf, shared_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("Boats lay along the shore.", -1),
        ("A heading without an end", 0),
        ("WOW!! SO!! CHEAP!! NOW!!", 0),
        ("Home | News | Sports | About us.", 1),
        ("Click here to go on.", 1),
        ("All rights reserved by the lake.", 2),
        ("the### cold*** moon%%% rose&&& slowly.", 2),
        ("It was late. And then the line breaks off", -1),
        ("  \t", -1),
    ],
)
def test_line_rules(line, rule):
    assert failing_rule(line, LineRules())[1] == rule


def test_clean_lines(spark, docs, texts):
    found = {r.doc_id: r for r in clean_lines(docs).collect()}
    for i, text in enumerate(texts):
        text = text or ""
        words = WORD.findall(text)
        seen = Counter(tuple(words[p : p + 5]) for p in range(len(words) - 4))
        repeated = {q for p in range(len(words) - 4) if seen[tuple(words[p : p + 5])] > 1 for q in range(p, p + 5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        row = found[i]
        assert (row.n_words, row.word_chars, row.n_repeat_words) == (len(words), sum(map(len, words)), len(repeated))
        assert (row.n_symbols, row.n_dup_lines) == (len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)))
        assert row.base_failed == (len(words) < 10 or 100 * len(repeated) > 20 * len(words))
        kept = [x for x in text.split("\n") if failing_rule(x, LineRules())[1] < 0]
        left = len(WORD.findall("\n".join(kept)))
        assert (row.cleaned, row.kept_words) == ("\n".join(kept), left)
        assert row.kept == (not row.base_failed and len(words) - left <= 0.5 * len(words))
        assert (row.score, row.source) == (0.5, docs.where(F.col("doc_id") == i).first().source)
    assert clean_lines(docs.limit(0)).count() == 0


def quality_rows():
    good = [(i, sentence(i, 40 + i % 30) + ".", 1) for i in range(120)]
    bad = [(200 + i, " ".join([f"odd{i}a"] * 15 + [f"odd{i}b###"] * 15), 0) for i in range(60)]
    return good + bad


def test_classifier_separates_held_out_rows(spark):
    rows = quality_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 3] + [(None, 1), (5000, 0), (1, None)], "doc_id long, quality int")
    settings = quality_model.Settings(bits=14)
    sample = quality_model.sample_labelled(docs, labels, "quality", 100)
    assert sample.count() <= 100
    weights = quality_model.train(sample, settings=settings)
    assert (weights == quality_model.train(sample, settings=settings)).all()
    scored = {r.doc_id: r for r in quality_model.score(docs, weights, ("doc_id",), settings=settings).collect()}
    assert all(scored[i].predicted == q for i, _, q in rows if i % 3 == 0)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in scored.values())


def test_classifier_on_odd_texts_and_without_labels(spark, docs, texts):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    weights = quality_model.train(quality_model.sample_labelled(docs, labels, "quality", 10))
    rows = quality_model.score(docs, weights, ("doc_id", "lang")).collect()
    assert len(rows) == len(texts) and {r.score for r in rows} == {0.5}
    assert quality_model.score(docs.limit(0), weights, ("doc_id",)).count() == 0


def test_updates_equal_plain_loops():
    """The update of each coordinate written out over dictionaries."""
    settings = quality_model.Settings(bits=6, alpha=0.3, beta=0.7, l1=0.05, l2=0.2)
    pick, learner, z, n, bias = random.Random(4), quality_model.Learner(settings), Counter(), Counter(), 1 << 6

    def weight(i):
        if abs(z[i]) <= settings.l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * settings.l1) / ((settings.beta + math.sqrt(n[i])) / settings.alpha + settings.l2)

    for _ in range(200):
        row = {i: pick.random() for i in pick.sample(range(1 << 6), pick.randint(0, 6))}
        label = pick.randint(0, 1)
        learner.learn(np.array(list(row), np.int64), np.array(list(row.values())), label)
        row[bias] = 1.0
        old = {i: weight(i) for i in row}
        p = 1 / (1 + math.exp(-sum(old[i] * x for i, x in row.items())))
        for i, x in row.items():
            g = (p - label) * x
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / settings.alpha
            z[i] += g - sigma * old[i]
            n[i] += g * g
    assert np.allclose(learner.weights(slice(None)), [weight(i) for i in range(bias + 1)], atol=1e-12)


def test_scores_are_dot_products_of_plain_counts(spark):
    """Weights of single buckets, met by counting tokens, neighbours and distances in dictionaries."""
    texts, bits = ["a b a!", "", "b b b c.", "x"], 10
    settings = quality_model.Settings(bits=bits)
    weights = np.random.default_rng(2).normal(size=(1 << bits) + 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.score for r in quality_model.score(docs, weights, ("doc_id",), settings=settings).collect()}
    for i, text in enumerate(texts):
        owner, buckets, values = quality_model.features([text.encode()], bits)
        tokens = re.findall(r"[a-z]+|[!.]", text)
        margin = weights[-1]
        if tokens:
            assert abs((values**2).sum() - 1) < 1e-9
            margin += sum(weights[b] * v for b, v in zip(buckets.tolist(), values.tolist(), strict=True))
        assert abs(found[i] - 1 / (1 + math.exp(-margin))) < 1e-9


def test_sample_has_one_text_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "other"), (3, "third")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    found = quality_model.sample_labelled(docs, labels, "quality", 10).collect()
    assert sorted((r.text, r.label) for r in found) == [("other", 0), ("text 0", 1), ("third", 1)]
    assert quality_model.sample_labelled(docs, labels, "quality", 2).count() == 2


def test_features_are_unit_vectors_and_see_repetition():
    owner, buckets, values = quality_model.features([b"a b a", b"", b"a b c"], 12)
    assert set(owner.tolist()) == {0, 2}
    assert all(abs((values[owner == t] ** 2).sum() - 1) < 1e-9 for t in (0, 2))
    owner, buckets, _ = quality_model.features([b"a b a", b"c d c", b"a b e", b"c d f"], 16)
    shared = [len(np.intersect1d(buckets[owner == i], buckets[owner == i + 1])) for i in (0, 2)]
    assert shared == [2, 1]  # "not seen before", and "two tokens back"


def sequential_kt(bits):
    zeros = ones = 0
    total = 0.0
    for b in bits:
        total += math.log(((ones if b else zeros) + 0.5) / (zeros + ones + 1))
        zeros, ones = zeros + (not b), ones + b
    return total


def test_block_estimate_is_the_sequential_one():
    pick = random.Random(1)
    for n in (0, 1, 2, 7, 40):
        bits = [pick.random() < 0.3 for _ in range(n)]
        found = context_trees.log_estimate(np.array([float(n - sum(bits))]), np.array([float(sum(bits))]))[0]
        assert abs(found - sequential_kt(bits)) < 1e-9


def plain_trees(chunks, keys):
    """The same mixture by recursion over dictionaries."""
    depth = context_trees.DEPTH
    counts = {}
    for chunk in chunks:
        line = b" " + chunk + b" "
        for p in range(1, len(line)):
            context = [line[p - 1 - i] if p - 1 - i >= 0 else 0 for i in range(depth)]  # across spaces
            for d in range(depth + 1):
                for bit in range(8):
                    node = (tuple(context[:d]), (line[p] | 256) >> (8 - bit))
                    counts.setdefault(node, [0, 0])[(line[p] >> (7 - bit)) & 1] += 1
    children = {}
    for context, v in counts:
        if context:
            children.setdefault((context[:-1], v), set()).add((context, v))

    def estimate(node):
        return float(context_trees.log_estimate(*(np.array([float(x)]) for x in counts.get(node, (0, 0))))[0])

    def block(node):
        if len(node[0]) == depth:
            return estimate(node)
        return np.logaddexp(math.log(0.5) + estimate(node), math.log(0.5) + sum(map(block, children.get(node, ()))))

    out = []
    for key in keys:
        symbol = int(key) & 255
        context = tuple((int(key) >> (8 * (depth - i))) & 255 for i in range(depth))
        total = 0.0
        for bit in range(8):
            v, p, seen = (symbol | 256) >> (8 - bit), None, False
            for d in range(depth, -1, -1):
                node = (context[:d], v)
                zeros, ones = counts.get(node, (0, 0))
                own = (ones + 0.5) / (zeros + ones + 1)
                if p is None or not seen:
                    p = own
                else:
                    w = math.exp(math.log(0.5) + estimate(node) - block(node))
                    p = w * own + (1 - w) * p
                seen = zeros + ones > 0
            total += math.log10(p if (symbol >> (7 - bit)) & 1 else 1 - p)
        out.append(total)
    return np.array(out)


def test_context_trees_equal_the_plain_recursion(spark):
    training = [b"lake", b"lakes", b"take", b"", b"a", b"at the lake", b"a lake", b"  two  gaps ", b"the lakes at"]
    keys, sizes = context_trees.keys_of([*training, b"lane at", b"zoo"])
    counts = np.repeat([1] * len(training) + [0, 0], sizes)
    unique, where = np.unique(keys, return_inverse=True)
    rows = list(zip(unique.view(np.int64).tolist(), np.bincount(where, counts).astype(int).tolist(), strict=True))
    found = {r.key: r.cost for r in language_model.fit_contexts(spark.createDataFrame(rows, "key long, n long")).collect()}
    expected = plain_trees(training, unique)
    assert np.allclose([found[k] for k, _ in rows], expected, atol=1e-9)


def test_predictions_of_a_context_add_up_to_one(spark):
    keys, sizes = context_trees.keys_of([b"lake", b"late"])
    context = int(keys[2]) & ~255  # after "la"
    every = [(context | s, 0) for s in range(256)]
    known = Counter(int(k) for k in keys)
    rows = [(k, known.get(k, 0)) for k in {*known, *(k for k, _ in every)}]
    found = {r.key: r.cost for r in language_model.fit_contexts(spark.createDataFrame(rows, "key long, n long")).collect()}
    assert abs(sum(10 ** found[k] for k, _ in every) - 1) < 1e-9


@pytest.mark.parametrize("most_keys", [0, 10**6])
def test_language_model(spark, docs, texts, most_keys):
    training = (F.col("doc_id") % 3 != 1)
    rows = {r.doc_id: r for r in language_model.score_texts(docs, training, most_keys=most_keys, frequent=7).collect()}
    tokens = {i: (t or "").encode().lower().split() for i, t in enumerate(texts)}
    counts = Counter(w for i, ws in tokens.items() if i % 3 != 1 for w in ws)
    ends = sum(i % 3 != 1 for i in tokens)
    n, v = sum(counts.values()) + ends, len(counts) + 1
    for i, ws in tokens.items():
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws) + math.log10((ends + 1) / (n + v + 1))
        row = rows[i]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(ws) + 1, sum(counts[w] > 0 for w in ws) + 1, n)
        assert abs(row.base_score - base) < 1e-6 and row.score < 0
    assert rows[4].score == pytest.approx(rows[5].score)  # equal texts
    if most_keys:
        joined = {r.doc_id: r.score for r in language_model.score_texts(docs, training, most_keys=0).collect()}
        assert all(abs(rows[i].score - joined[i]) < 1e-6 for i in tokens)
    assert language_model.score_texts(docs.limit(0), training).count() == 0


def plain_components(pairs, width=4, percent=85):
    sets = {}
    for i, text in pairs:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[p : p + width]) for p in range(max(1, len(words) - width + 1))} if words else set()
    ids = sorted(sets)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in ids}


def near_copies():
    """Groups around the threshold, chains, sizes from one word to hundreds, and copies."""
    pick = random.Random(7)
    texts = []
    for group in range(12):
        n = pick.choice([1, 3, 5, 8, 12, 20, 45, 90, 300])
        base = [f"g{group}w{pick.randint(0, 400)}" for _ in range(n)]
        for _ in range(9):
            copy = list(base)
            for _ in range(pick.randint(0, max(1, n // 50))):
                copy[pick.randrange(len(copy))] = f"x{pick.randint(0, 10**6)}"
            if pick.random() < 0.3:
                copy = copy[: max(1, n - pick.randint(0, n // 10 + 1))]
            texts.append(" ".join(copy).upper() if pick.random() < 0.2 else "\t".join(copy))
            base = copy if pick.random() < 0.3 else base
    return list(enumerate([*texts, None, "", "  ", texts[0], texts[0]]))


@pytest.mark.parametrize("block", [4, 1024])
def test_components_equal_brute_force(spark, block):
    pairs = near_copies()
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in pairs], "doc_id long, text string, node string, component int").repartition(5)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs, block=block).collect()}
    assert found == plain_components(pairs)


def test_components_of_nothing_and_without_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_components(empty).count() == 0
    some = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (1, "A b c d e")], "doc_id long, text string")
    found = sorted(((r.doc_id, r.component_id) for r in jaccard_components(some).collect()), key=str)
    assert found == [(1, 1), (3, 1), (None, None)]


@pytest.mark.parametrize("size", [6, 7, 13, 40, 41, 200])
def test_similar_sets_always_meet(size):
    join, pick = Join(), np.random.default_rng(size)
    tops = join.classes(1000)
    for _ in range(150):
        common = pick.integers(1, 2**63, size, dtype=np.uint64)
        others = pick.integers(1, 2**63, join.differences(size), dtype=np.uint64)
        cut = int(pick.integers(0, len(others) + 1))
        a, b = (np.unique(np.concatenate([common, x])) for x in (others[:cut], others[cut:]))
        if join.reaches(len(np.intersect1d(a, b)), len(a), len(b)):
            assert len(np.intersect1d(jaccard_join.meeting_keys(a, join, tops), jaccard_join.meeting_keys(b, join, tops)))


def test_sets_with_empty_groups_deal_again(monkeypatch):
    join = Join()
    monkeypatch.setattr(Join, "groups", lambda self, top: self.differences(top) + 40)  # most groups stay empty
    tops = join.classes(100)
    pick = np.random.default_rng(2)
    for _ in range(50):
        common = pick.integers(1, 2**63, 14, dtype=np.uint64)
        a, b = np.unique(common), np.unique(np.append(common, pick.integers(1, 2**63, 2, dtype=np.uint64)))
        assert join.reaches(14, 14, 16)
        assert len(np.intersect1d(jaccard_join.meeting_keys(a, join, tops), jaccard_join.meeting_keys(b, join, tops)))


def test_counts_in_bytes_never_lower_a_bound():
    vector = np.zeros(jaccard_join.AXES, np.int64)
    vector[:4] = 0, 7, 254, 4000
    found = jaccard_join._read([jaccard_join._shown(vector)], np.array([vector.sum()]))[0]
    assert found[:4].tolist() == [0, 7, 254, 4261] and (found >= vector).all()


@pytest.mark.parametrize(("n", "m"), [(1, 1), (40, 3), (300, 200)])
def test_tree_join_equals_all_pairs(n, m):
    pick, join = np.random.default_rng(n), Join()
    base = pick.poisson(2, (12, 16))

    def points(k):
        return base[pick.integers(0, 12, k)] + pick.integers(0, 2, (k, 16)) * (pick.random((k, 16)) < 0.1)

    p, q = points(n), points(m)
    a, b = CountTree(p, p.sum(axis=1)).join(CountTree(q, q.sum(axis=1)), join)
    bound = np.minimum(p[:, None], q[None]).sum(axis=2)
    expected = np.argwhere(join.reaches(bound, p.sum(axis=1)[:, None], q.sum(axis=1)[None]))
    assert {*zip(a.tolist(), b.tolist(), strict=True)} == {*map(tuple, expected.tolist())}


def test_contexts_run_across_spaces_and_stay_in_their_text():
    texts = [b"a lake by", b"", b"x", b" two  gaps "]
    keys, sizes = context_trees.keys_of(texts)
    expected = []
    for text in texts:
        line = bytes(context_trees.DEPTH) + b" " + text + b" "
        for p in range(context_trees.DEPTH + 1, len(line)):
            expected.append(int.from_bytes(line[p - context_trees.DEPTH : p][::-1] + line[p : p + 1], "big"))
    assert keys.tolist() == expected and sizes.tolist() == [len(t) + 1 for t in texts]


def test_key_counts_and_costs():
    pick = np.random.Generator(np.random.PCG64(4))
    rounds = [pick.integers(0, 500, 300).astype(np.uint64) << np.uint64(40) for _ in range(8)]
    counts = context_trees.KeyCounts(least=400)
    for i, keys in enumerate(rounds):
        counts.add(keys, i % 2 == 0)
    found, n = counts.merge()
    known = Counter(np.concatenate(rounds[::2]).tolist())
    assert found.tolist() == sorted(set(np.concatenate(rounds).tolist())) and n.tolist() == [known[k] for k in found.tolist()]
    table = context_trees.CostTable(found[::-1], np.arange(len(found))[::-1].astype(float))
    at = pick.integers(0, len(found), 5000)
    assert (table.find(found[at]) == at).all() and len(table.find(found[:0])) == 0


@pytest.mark.parametrize("most_keys", [0, 10**6])
def test_fluent_text_costs_less_than_the_same_words_shuffled(spark, most_keys):
    words = [f"{c}{d}" for c in "abcdefgh" for d in "klmn"]
    fluent = " ".join(words * 4)
    shuffled = fluent.split()
    random.Random(1).shuffle(shuffled)
    rows = [(i, fluent, True) for i in range(20)] + [(90, fluent, False), (91, " ".join(shuffled), False)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, learns boolean")
    found = {r.doc_id: r.score for r in language_model.score_texts(frame, F.col("learns"), most_keys=most_keys).collect()}
    assert found[90] > found[91] + 20


def paired_words(spark, n):
    """Texts whose words follow each other in any order, so that most contexts across a space are rare; null and blank ones, and some that training doesn't see."""
    pick = random.Random(5)
    words = ["".join(pick.choices("abcdefgh", k=pick.randint(3, 8))) for _ in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    made = [" ".join(pick.choices(words, weights, k=600)) for _ in range(n)]
    rows = [(i, t, i % 5 != 0) for i, t in enumerate([None, "", " ", "zz", made[0], *made])]
    return spark.createDataFrame(rows, "doc_id long, text string, learns boolean").repartition(6)


@pytest.mark.parametrize("block", [1 << 21, 700])
def test_costs_of_rare_contexts_are_the_broadcast_ones(spark, monkeypatch, block):
    def scores(most):
        return {r.doc_id: r.score for r in language_model.score_texts(frame, F.col("learns"), most_keys=most).collect()}

    monkeypatch.setattr(rare_lookups, "BIN_KEYS", 900)
    monkeypatch.setattr(rare_lookups, "BLOCK_KEYS", block)
    frame = paired_words(spark, 40).localCheckpoint()
    whole = scores(10**6)
    for most in (3000, 0):
        found = scores(most)
        assert found.keys() == whole.keys() and all(abs(found[i] - whole[i]) < 1e-7 for i in whole)


def test_blocks_hand_out_every_missed_key_of_a_text():
    keys = np.array([7, 5, 7, 1 << 40, 5, 9 << 30], np.uint64)
    rows = np.array([3, 3, 3, 8, 8, 11], np.int64)
    blocks = rare_lookups.Blocks(5, most=4)
    assert blocks.take() == []
    blocks.add(rows[:3], keys[:3])
    assert not blocks.full()
    blocks.add(rows[3:], keys[3:])
    assert blocks.full()
    *bins, (kind, block, none, (texts, sizes, places)) = blocks.take()
    held = np.concatenate([np.cumsum(rare_lookups.unpacked(p[0], np.uint64)) for *_, p in bins])
    assert (kind, block, none) == ("key", 3, None) and [b for _, _, b, _ in bins] == sorted({*rare_lookups.bins_of(keys, 5).tolist()})
    assert np.repeat(np.cumsum(rare_lookups.unpacked(texts, np.int64)), rare_lookups.unpacked(sizes, np.int64)).tolist() == rows.tolist()
    assert held[rare_lookups.unpacked(places, np.int32)].tolist() == keys.tolist() and blocks.held == 0


def test_blocks_hand_out_every_missed_word_of_a_text():
    blocks = rare_lookups.WordBlocks(3, most=12)
    given = {4: [b"moon", b"lake", b"moon"], 9: [b"\xc3\xa9t\xc3\xa9", b"lake"]}
    for row, words in given.items():
        assert not blocks.full()
        blocks.add(row, words)
    assert blocks.full()
    *bins, (kind, block, none, (texts, sizes, places)) = blocks.take()
    held = [w for *_, p in bins for w in rare_lookups.unpacked(p[0], np.uint8).tobytes().split(b" ")]
    assert (kind, block, none) == ("word", 4, None) and [b for _, _, b, _ in bins] == sorted({zlib.crc32(w) % 3 for w in held})
    assert np.cumsum(rare_lookups.unpacked(texts, np.int64)).tolist() == [4, 9] and rare_lookups.unpacked(sizes, np.int64).tolist() == [3, 2]
    assert [held[i] for i in rare_lookups.unpacked(places, np.int32)] == [w for words in given.values() for w in words]
    assert blocks.take() == [] and not blocks.full()


def test_a_large_table_of_contexts_takes_little_disk(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders, sizes, over = [*manager.localDirsString(), shared_dir(spark).removeprefix("file:")], {}, threading.Event()

    def look():
        for path in (os.path.join(d, f) for folder in folders for d, _, names in os.walk(folder) for f in names):
            with contextlib.suppress(OSError):  # shuffles go when nothing refers to them any more
                sizes[path] = max(sizes.get(path, 0), os.path.getsize(path))

    def watch():
        while not over.wait(0.05):
            look()

    frame = paired_words(spark, 400).localCheckpoint()
    size = frame.agg(F.sum(F.octet_length("text"))).first()[0]
    look()
    before, watcher = {*sizes}, threading.Thread(target=watch)
    watcher.start()
    try:
        with session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
            assert language_model.score_texts(frame, F.col("learns"), most_keys=5000).where("score < 0").count() == 405
    finally:
        over.set()
        watcher.join()
    look()
    assert sum(n for f, n in sizes.items() if f not in before) < 2 * size
