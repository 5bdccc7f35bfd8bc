"""Scoring texts with a word model and with context trees, both learned from the corpus itself.

One pass counts words and context keys in every task, adds up equal ones there, and hands the counts to a shuffle, so what moves grows with the vocabulary of a task and not with its text. Trees are
fitted by ranges of the two nearest context bytes; only their two top depths (bounded by 256 contexts) meet
on the driver. The result is one number for each distinct context and byte. Those most frequent in the corpus are
broadcast as a table of bounded size; the others are looked up once for each block of texts (``rare_lookups``). So are
words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import rare_lookups
from tidemark.llm.arrays import slices, utf8
from tidemark.llm.context_trees import CostTable, KeyCounts, Level, code_lengths, keys_of, levels, top_levels
from tidemark.llm.tables import stored

ROWS = 512
HELD = 1_000_000
FREQUENT_WORDS = 60_000
MOST_KEYS = 3_000_000


def _counts(docs: DataFrame, training: Column, text: str) -> DataFrame:
    """Partial counts: rows with ``word`` (training words), or ``key`` (context keys of all texts, ``n`` from training ones), or neither (texts, spaces)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, keys, texts, spaces = Counter(), KeyCounts(), 0, 0

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal keys, texts, spaces
            known = sorted(words)  # sorted, they take less room
            yield _record(words=known, n=[words[w] for w in known])
            found, n = keys.merge()
            yield _record(keys=found.view(np.int64), n=n)
            yield _record(texts=texts, spaces=spaces)
            words.clear()
            keys, texts, spaces = KeyCounts(), 0, 0

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                values = [v.lower() for v in utf8(batch.column(0))]
                learns = batch.column(1).to_pylist()
                for chosen in (True, False):
                    for _, part in slices(v for v, x in zip(values, learns, strict=True) if x is chosen):
                        keys.add(keys_of(part)[0], chosen)
                        if chosen:
                            for value in part:
                                words.update(value.split())
                            texts += len(part)
                            spaces += sum(v.count(b" ") for v in part)
                if len(words) + keys.merged > HELD:
                    yield from rows()
        yield from rows()

    chosen = docs.select(F.col(text), F.coalesce(training, F.lit(False)).alias("learns"))
    return chosen.mapInArrow(run, "word binary, key long, texts long, n long")


def _record(words=(), keys=(), n=(), texts=None, spaces=None) -> pa.RecordBatch:
    size = max(len(words), len(keys), int(texts is not None))
    columns = [
        pa.array(words, pa.binary()) if len(words) else pa.nulls(size, pa.binary()),
        pa.array(keys, pa.int64()) if len(keys) else pa.nulls(size, pa.int64()),
        pa.array([texts], pa.int64()) if texts is not None else pa.nulls(size, pa.int64()),
        pa.array([spaces] if texts is not None else n, pa.int64()),
    ]
    return pa.record_batch(columns, names=["word", "key", "texts", "n"])


def _subtrees(keys: DataFrame) -> DataFrame:
    """Keys dealt so that all keys with the same two nearest bytes are in one partition."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.withColumn("subtree", F.shiftrightunsigned("key", 32)).repartition(parts, "subtree").select("key", "n")


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not held:
        return np.empty(0, np.uint64), np.empty(0)
    keys = np.concatenate([k for k, _ in held]).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.concatenate([n for _, n in held])[order].astype(float)


def _fit_top(dealt: DataFrame) -> dict[int, dict[int, Level]]:
    """The two top depths of all trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = _gathered(batches)
        for bit in range(8):
            level = levels(keys, counts, 2, bit)[2]
            nodes, where = np.unique(level.parents, return_inverse=True)
            sums = [np.bincount(where, x, len(nodes)) for x in (level.zeros, level.ones, level.block)]
            yield pa.record_batch(
                [pa.array(np.full(len(nodes), bit)), pa.array(nodes.view(np.int64)), *map(pa.array, sums)], names=["bit", "node", "zeros", "ones", "block"]
            )

    parts = dealt.mapInArrow(run, "bit long, node long, zeros double, ones double, block double")
    rows = parts.groupBy("bit", "node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "block")]).toArrow()  # 256 contexts of 255 nodes at most
    nodes, bits, zeros, ones, blocks = (rows[c].to_numpy() for c in ("node", "bit", "zeros", "ones", "block"))
    return top_levels(nodes.view(np.uint64), bits, zeros, ones, blocks)


def fit_contexts(keys: DataFrame) -> DataFrame:
    """Rows ``key``, ``cost``, ``n``: the log10 probability of a byte in its context, for every key of ``keys`` (``key``, ``n``)."""
    dealt = stored(_subtrees(keys), "ctw-keys")
    dealt = _subtrees(dealt)
    top = dealt.sparkSession.sparkContext.broadcast(_fit_top(dealt))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, counts = _gathered(batches)
        costs = code_lengths(found, counts, top.value)
        yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(costs), pa.array(counts.astype(np.int64))], names=["key", "cost", "n"])

    return dealt.mapInArrow(run, "key long, cost double, n long")


def _costs(frame: DataFrame) -> CostTable:
    got = frame.select("key", "cost").toArrow()
    return CostTable(got["key"].to_numpy().view(np.uint64), got["cost"].to_numpy())


def _by_frequency(costs: DataFrame, most: int) -> tuple[DataFrame, DataFrame, int]:
    """The most frequent keys, ``most`` at most, the others, and the number of those; keys of like counts stay together."""
    like = F.floor(F.log2(F.col("n") + 1) * 8)
    sizes = sorted(((r.like, r.n) for r in costs.groupBy(like.alias("like")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)  # 8 for each doubling
    taken = np.cumsum([n for _, n in sizes]) <= most
    least = min((k for (k, _), fits in zip(sizes, taken, strict=True) if fits), default=float("inf"))
    return costs.where(like >= least), costs.where(like < least), sum(n for (_, n), fits in zip(sizes, taken, strict=True) if not fits)


def score_texts(docs: DataFrame, training: Column, text: str = "text", doc_id: str = "doc_id", most_keys: int = MOST_KEYS, frequent: int = FREQUENT_WORDS) -> DataFrame:
    """One row a document: ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``n_bytes``, ``bits_per_byte``.

    Both models learn from the rows where ``training`` holds (null: not) and score all rows. A-Z are
    lower-cased; null texts count as empty. The costs of ``most_keys`` keys at most are broadcast. ``base_score`` is the add-one log10 probability of the words and
    an end; ``score`` is the log10 probability of the text under the context trees. Repeated rows and ids are
    scored row by row. Without training rows the base model knows one outcome and each byte costs eight bits.
    """
    spark = docs.sparkSession
    counts = stored(_counts(docs, training, text), "lm-counts")
    words = stored(counts.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    keys = counts.where("key is not null").groupBy("key").agg(F.sum("n").alias("n"))
    costs = stored(fit_contexts(keys), "lm-costs")
    texts, spaces = counts.where("texts is not null").agg(F.sum("texts"), F.sum("n")).first()
    texts, spaces = texts or 0, spaces or 0
    distinct, total = words.agg(F.count(F.lit(1)), F.sum("n")).first()
    train_tokens = (total or 0) + texts
    outcomes = train_tokens + distinct + (texts > 0) + 1
    ends = (texts + 0.5) / (texts + spaces + 1)
    top = words.orderBy(F.col("n").desc(), "word").limit(frequent).toArrow()  # bounded by ``frequent``
    table = dict(zip(top["word"].to_pylist(), np.log10((top["n"].to_numpy() + 1) / outcomes).tolist(), strict=True))
    common, others, n_others = _by_frequency(costs, most_keys)
    bins, block = 1 + n_others // rare_lookups.BIN_KEYS, rare_lookups.BLOCK_KEYS
    word_bins = 1 + counts.where("word is not null").count() // rare_lookups.BIN_WORDS
    shared = spark.sparkContext.broadcast((table, _costs(common)))
    stops = float(np.log10(1 - ends)), float(np.log10(ends))
    end_score = float(np.log10((texts + 1) / outcomes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, model = shared.value
        number = TaskContext.get().partitionId() << 40
        blocks, word_blocks = rare_lookups.Blocks(bins, block), rare_lookups.WordBlocks(word_bins, block)
        names = ["doc_id", "row", "n_tokens", "known", "base", "score", "n_bytes"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]

        def missed(rows: rare_lookups.Rows, ids: pa.DataType) -> Iterator[pa.RecordBatch]:
            if rows:
                empty = [pa.nulls(len(rows), t) for t in (ids, *kinds)]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), rare_lookups.COLUMNS.values(), strict=True)]
                yield pa.record_batch([*empty, *columns], names=[*names, *rare_lookups.COLUMNS])

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                values = [v.lower() for v in utf8(batch.column(1))]
                prices = [0.0] * len(values)
                for start, part in slices(values):
                    keys, sizes = keys_of(part)
                    each, last = model.find(keys), np.cumsum(sizes)
                    lacking = np.flatnonzero(np.isnan(each))
                    if len(lacking):
                        each[lacking] = 0
                        blocks.add(number + start + np.searchsorted(last, lacking, "right"), keys[lacking])
                    prices[start : start + len(part)] = np.add.reduceat(each, last - sizes).tolist()
                    if blocks.full():
                        yield from missed(blocks.take(), batch.column(0).type)
                out: list[tuple] = []
                for value, price in zip(values, prices, strict=True):
                    own = value.split()
                    found = list(map(known.get, own))
                    rare = [w for w, p in zip(own, found, strict=True) if p is None] if None in found else []
                    base = sum(p for p in found if p is not None) if rare else sum(found)
                    score = price + value.count(b" ") * stops[0] + stops[1]
                    if rare:
                        word_blocks.add(number, rare)
                    out.append((number, len(own) + 1, len(own) - len(rare) + (texts > 0), base + end_score, score, len(value)))
                    number += 1
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                empty = [pa.nulls(len(out), t) for t in rare_lookups.COLUMNS.values()]
                yield pa.record_batch([batch.column(0), *columns, *empty], names=[*names, *rare_lookups.COLUMNS])
                if word_blocks.full():
                    yield from missed(word_blocks.take(), batch.column(0).type)
        for rest in (blocks, word_blocks):
            if rest.rows:
                yield from missed(rest.take(), whole.column(0).type)

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    ddl = f"doc_id {kind}, row long, n_tokens long, known long, base double, score double, n_bytes long, {rare_lookups.DDL}"
    rows = stored(chosen.mapInArrow(run, ddl), "lm-rows")
    missing = rows.where("kind is not null").select(*rare_lookups.COLUMNS)
    rare = rare_lookups.added_words(missing, words, word_bins, outcomes)
    joined = rows.where("kind is null").drop(*rare_lookups.COLUMNS).join(rare, "row", "left")
    if n_others:
        added = rare_lookups.added_costs(missing, others, bins)
        joined = joined.join(added, "row", "left").withColumn("score", F.col("score") + F.coalesce("added", F.lit(0.0)))
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score",
        "n_bytes",
        (F.col("score") / F.when(F.col("n_bytes") > 0, F.col("n_bytes")) * F.lit(float(-np.log2(10)))).alias("bits_per_byte"),
    )
