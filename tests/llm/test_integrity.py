"""The manifest and the fingerprint join against plain definitions."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import merkle, ordering, simhash_trie as trie
from tidemark.llm.tables import stored


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves):
    """Root of a list of digests, and the (left, right) texts of the siblings of each, level by level."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    proofs = []
    for i in range(len(leaves)):
        steps = []
        for level in levels[:-1]:
            start = i // 16 * 16
            run = level[start : start + 16]
            steps.append(("".join(run[: i - start]), "".join(run[i - start + 1 :])))
            i //= 16
        proofs.append(steps)
    return levels[-1][0], proofs


def test_proofs_of_trees_of_several_sweeps(spark):
    # The large tree needs two sweeps; the others have one leaf, one run, and one leaf more than a run.
    sizes = {"big": 4096 * 2 + 77, "one": 1, "run": 16, "more": 17, None: 3}
    data = [(f"{source}-{i}", source, i, sha(f"{source}/{i}"), -1) for source, n in sizes.items() for i in range(n)]
    random.Random(5).shuffle(data)
    records = spark.createDataFrame(data, "name string, source string, place long, leaf string, n int")
    got = {r.name: r for r in merkle.merkle_proofs(records, "source", "place").withColumn("folded", merkle.folded(F.col("leaf"))).collect()}
    assert len(got) == len(data)
    order = sorted(sizes, key=lambda s: (s is not None, s or ""))
    trees = {s: plain_tree([sha(f"{s}/{i}") for i in range(sizes[s])]) for s in sizes}
    root, above = plain_tree([trees[s][0] for s in order])
    for name, source, i, leaf, n in data:
        row, steps = got[name], trees[source][1][i] + above[order.index(source)]
        assert (row.subroot, row.root, row.leaf, row.n) == (trees[source][0], root, leaf, n)
        assert list(zip(row.left, row.right, strict=True)) == steps
        assert row.folded == root


def test_proofs_of_repeated_null_and_no_records(spark):
    data = [("s", None, sha("a")), ("s", 7, sha("b")), ("s", 7, sha("b")), ("s", 7, sha("0"))]
    records = spark.createDataFrame(data, "source string, place long, leaf string")
    got = merkle.merkle_proofs(records, "source", "place").collect()
    root, proofs = plain_tree([sha("a"), *sorted([sha("b"), sha("b"), sha("0")])])
    assert {r.root for r in got} == {root} and {r.subroot for r in got} == {root}
    assert sorted(r.left[0] + r.right[0] for r in got) == sorted(a + b for p in proofs for a, b in p)
    assert merkle.merkle_proofs(records.where("false"), "source", "place").count() == 0
    lone = merkle.merkle_proofs(records.limit(1), "source", "place").first()
    assert (lone.root, lone.left, lone.right) == (lone.leaf, [], [])


def test_record_text(spark):
    frame = spark.createDataFrame([(1, None, "é:-", "")], "a long, b string, c string, d string")
    assert frame.select(merkle.record_text([F.col(c) for c in "abcd"])).first()[0] == "1:1-4:é:-0:"


def test_numbering_of_large_and_equal_groups(spark):
    data = [("a", 1)] * 500 + [("a", 0)] * 3 + [("b", 5)]
    got = rows(ordering.numbered(stored(spark.createDataFrame(data, "g string, v long").repartition(7), "t"), "g", "v"))
    assert sorted((g, i, v, n) for g, v, n, i in got) == sorted([("a", i, 0 if i < 3 else 1, 503) for i in range(503)] + [("b", 0, 5, 1)])


def plain_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_components(prints):
    """Smallest position reachable from each position."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_fingerprints(texts, monkeypatch):
    assert [trie.fingerprint((t or "").encode()) for t in texts] == [plain_print(t) for t in texts]
    monkeypatch.setattr(trie.word_parts, "__defaults__", (7,))  # parts that cut between nearly all words
    assert [trie.fingerprint((t or "").encode()) for t in texts] == [plain_print(t) for t in texts]


def test_spark_hash_is_the_same(spark):
    # The contract's hash is also the engine's own.
    assert spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0] == np.uint64(xxhash.xxh64_intdigest(b"one two three", 42)).view(np.int64)


def near_copies(seed, n):
    """Fingerprints: random ones, and chains and dense groups of near ones."""
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n // 10):
        value = rng.choice(prints)
        for _ in range(rng.choice([1, 3, 30])):
            near = value
            for _ in range(rng.choice([1, 2, 2, 3])):
                near ^= 1 << rng.randrange(64)
            prints.append(near)
            value = near if rng.random() < 0.3 else value
    return prints


@pytest.mark.parametrize("seed", range(4))
def test_walk_spans_all_links(seed, monkeypatch):
    monkeypatch.setattr(trie, "PAIRS", 50)
    monkeypatch.setattr(trie, "PRODUCTS", 300)
    paths = np.array(sorted(set(near_copies(seed, 300))), np.uint64)
    forest = trie.Forest(len(paths))
    for a, b in trie.walk(paths, None, 0, 2):
        assert (int(paths[a]) ^ int(paths[b])).bit_count() <= 2
        forest.link(np.array([a]), np.array([b]))
    assert forest.roots().tolist() == plain_components(paths.tolist())
    # Two sides under nodes that differ in one bit.
    left, right = paths[paths < 1 << 63], paths[paths >= 1 << 63]
    links = trie.walk(left, right, 1, 2)
    joined = trie.Forest(len(paths))
    for a, b in links:
        joined.link(np.array([a]), np.array([b]))
    plain = trie.Forest(len(paths))
    for i in range(len(left)):
        j = np.flatnonzero(np.bitwise_count(left[i] ^ right) <= 2)
        plain.link(np.full(len(j), i), j + len(left))
    assert joined.roots().tolist() == plain.roots().tolist()


@pytest.mark.parametrize("leaves", [4, 40, 10**6])
def test_trie_links_by_rounds(spark, leaves):
    prints = sorted(set(near_copies(9, 200)))
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    paths = stored(spark.createDataFrame([(p,) for p in signed], "path long"), "t")
    forest = trie.Forest(len(prints))
    place = {p: i for i, p in enumerate(signed)}
    for r in trie.trie_links(paths, leaves=leaves).collect():
        forest.link(np.array([place[r.a]]), np.array([place[r.b]]))
    assert forest.roots().tolist() == plain_components(prints)


def test_dense_group_gives_few_links():
    # All values of 12 bits: 4,096 neighbours in one group, but a spanning forest of links.
    paths = np.arange(1 << 12, dtype=np.uint64) << np.uint64(20)
    assert len(trie.walk(paths, None, 0, 2)) == len(paths) - 1


def test_components_of_documents(spark, docs, texts):
    extra = [(100, texts[4].replace("lake", "pond")), (101, None), (None, texts[4]), (102, texts[7]), (7, texts[7])]
    more = docs.select("doc_id", "text", F.lit("x").alias("print"), F.lit(1).alias("component_id")).unionByName(
        spark.createDataFrame([(i, t, "x", 1) for i, t in extra], "doc_id long, text string, print string, component_id int")
    )
    given = [(r.doc_id, r.text) for r in more.collect()]
    named = sorted((x for x in given if x[0] is not None), key=lambda x: x[0])
    prints = [plain_print(t) for _, t in named]
    smallest = plain_components(prints)
    expected = [(i, f"{p:016x}", named[c][0]) for (i, _), p, c in zip(named, prints, smallest, strict=True)] + [(None, f"{plain_print(texts[4]):016x}", None)]
    got = rows(trie.simhash_components(more, leaves=3))
    assert got == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows(trie.simhash_components(more.where("false"))) == []
