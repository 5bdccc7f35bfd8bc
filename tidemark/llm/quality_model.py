"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are runs of letters and digits and runs of ASCII punctuation. Features are single tokens, pairs of
neighbours, and for each token how far back the same token stood (in classes of doubling distance), so
that repetition shows in words never seen before. All are hashed into ``2**bits`` buckets; a text is the
unit vector of its bucket counts. Learning takes a bounded sample of the labelled rows and runs in one
task; scores are sparse dot products in every task, with the weights (bounded by the buckets) broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import BASE, Words, mixed, slices, utf8
from tidemark.llm.workers import claim

ROWS = 512
_SPACE, _WORD, _PUNCTUATION = 0, 1, 2
_CLASSES = np.full(256, _WORD, np.uint8)
_CLASSES[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = _PUNCTUATION
_CLASSES[: 0x21] = _SPACE


@dataclass(frozen=True)
class Settings:
    """Size of the model, bound of the sample and the constants of the update."""

    bits: int = 18
    sample: int = 12_000
    epochs: int = 2
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.01


def _tokens(texts: list[bytes]) -> Words:
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    classes = _CLASSES[buffer]
    edges = np.flatnonzero(np.diff(classes, prepend=np.uint8(0)))
    starts = edges[classes[edges] > 0]
    before = np.concatenate([[0], classes[:-1]])
    ends = edges[before[edges] > 0]
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    first = np.searchsorted(starts, begins)
    return Words(buffer, starts, ends, np.repeat(np.arange(len(texts)), np.diff(first)), first)


def features(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all texts: text number, bucket and value of every non-zero entry, in order of text and bucket."""
    tokens = _tokens(texts)
    hashes, text = tokens.hashes(), tokens.text
    if not len(hashes):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    pair = np.flatnonzero(text[1:] == text[:-1])
    pairs = mixed(hashes[pair] * BASE + hashes[pair + 1])
    order = np.argsort(mixed(hashes + text.astype(np.uint64)), kind="stable")  # equal tokens of a text together, in order
    same = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    distance = np.zeros(len(hashes), np.int64)
    distance[order[1:][same]] = order[1:][same] - order[:-1][same]
    steps = np.where(distance > 0, np.frexp(distance.astype(float))[1], 0)
    back = mixed(steps.astype(np.uint64) + np.uint64(0xB0))
    buckets = (np.concatenate([hashes, pairs, back]) >> np.uint64(64 - bits)).astype(np.int64)
    owners = np.concatenate([text, text[pair], text])
    keys, counts = np.unique((owners << bits) | buckets, return_counts=True)
    owner = keys >> bits
    norm = np.sqrt(np.bincount(owner, counts.astype(float) ** 2, len(texts)))
    return owner, keys & ((1 << bits) - 1), counts / norm[owner]


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


class Learner:
    """Per-coordinate state of the update; the last coordinate is the bias."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self.z = np.zeros((1 << settings.bits) + 1)
        self.n = np.zeros_like(self.z)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        s, z = self.settings, self.z[at]
        step = (s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2
        return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / step)

    def learn(self, buckets: np.ndarray, values: np.ndarray, label: int) -> None:
        at, x = np.append(buckets, len(self.z) - 1), np.append(values, 1.0)
        w = self.weights(at)
        g = (_probability(w @ x) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.settings.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train(labelled: DataFrame, text: str = "text", label: str = "label", order: str = "_order", settings: Settings | None = None) -> np.ndarray:
    """Weights (buckets, then the bias) from labelled rows in the order of column ``order``.

    ``labelled`` must already be the bounded sample. One task turns it
    into sparse arrays, a batch at a time, and learns from them. Without rows all weights are 0.
    """
    settings = settings or Settings()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        rows = []
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                labels = batch.column(1).to_pylist()
                for start, part in slices(utf8(batch.column(0))):
                    owner, buckets, values = features(part, settings.bits)
                    cut = np.searchsorted(owner, np.arange(len(part) + 1))
                    for i in range(len(part)):
                        own = slice(cut[i], cut[i + 1])
                        rows.append((buckets[own].astype(np.int32), values[own].astype(np.float32), labels[start + i]))
        learner = Learner(settings)
        for epoch in range(settings.epochs):
            turn = np.random.Generator(np.random.PCG64(epoch)).permutation(len(rows))
            for i in turn:
                learner.learn(*rows[i])
        weights = learner.weights(slice(None))
        used = np.flatnonzero(weights)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(weights[used], pa.float64())], names=["bucket", "weight"])

    frame = labelled.select(F.col(text), F.col(label).cast("int"), F.col(order)).repartition(1).sortWithinPartitions(order, text)
    weights = np.zeros((1 << settings.bits) + 1)
    used = frame.mapInArrow(run, "bucket long, weight double").toArrow()  # one row a bucket at most
    weights[used["bucket"].to_numpy()] = used["weight"].to_numpy()
    return weights


def sample_labelled(docs: DataFrame, labels: DataFrame, target: str, most: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """At most ``most`` labelled texts (``text``, ``label``, ``_order``), chosen by a hash of the id.

    Ids are chosen before texts are read, so the join side is bounded by ``most``. An id labelled more
    than once has the mean label, 0.5 counting as 1; null labels and ids without a text row are left out. Of
    the texts of one id the least one is taken, so that ``most`` bounds rows too.
    """
    ids = labels.where(F.col(target).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.avg(target).alias("label"))
    ids = ids.select(doc_id, (F.col("label") >= 0.5).cast("int").alias("label"), F.xxhash64(doc_id).alias("_order"))
    chosen = F.broadcast(ids.orderBy("_order", doc_id).limit(most))
    joined = docs.select(F.col(doc_id), F.col(text).alias("text")).join(chosen, doc_id)
    return joined.groupBy(doc_id, "label", "_order").agg(F.min("text").alias("text")).select("text", "label", "_order")


def score(docs: DataFrame, weights: np.ndarray, keep: tuple[str, ...], text: str = "text", settings: Settings | None = None) -> DataFrame:
    """Columns ``keep`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on); a null text counts as empty."""
    settings = settings or Settings()
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        w = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = utf8(batch.column(at_text))
                margin = np.full(len(texts), w[-1])
                for start, part in slices(texts):
                    owner, buckets, values = features(part, settings.bits)
                    margin[start : start + len(part)] += np.bincount(owner, w[buckets] * values, len(part))
                got = _probability(margin)
                out = [*batch.columns[: len(keep)], pa.array(got), pa.array((got >= 0.5).astype(np.int32))]
                yield pa.record_batch(out, names=[*keep, "score", "predicted"])

    kept = [c for c in keep if c not in ("score", "predicted")]
    if len(kept) != len(keep):
        raise ValueError("score and predicted are results")
    # The text is handed over once, whether it is kept or not.
    at_text = keep.index(text) if text in keep else len(keep)
    selected = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if text in keep else [F.col(f"`{text}`").alias("_text")]))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add("score", "double").add("predicted", "integer")
    return selected.mapInArrow(run, schema)
