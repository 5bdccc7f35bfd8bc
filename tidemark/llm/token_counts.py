"""Token counts by a map-side two-tier lookup.

Tier 1 is a broadcast table from frequent chunks of text to their token counts. Every task counts the
chunks of all its texts in a bounded counter and gives the most frequent ones; their sums fill the table,
which holds at most ``table_size`` entries, so its size is bounded. It changes the speed and never a count. Tier 2 is a bounded cache in every worker for the chunks the table lacks. No chunk
is ever shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.byte_bpe import CACHED_LENGTH, encoder
from tidemark.llm.tables import stored
from tidemark.llm.workers import claim

TABLE_SIZE = 65_536
COUNTED = 200_000
ROWS = 256


def frequent_lengths(docs: DataFrame, tokenizer: str, text: str = "text", table_size: int = TABLE_SIZE, counted: int = COUNTED) -> dict[str, int]:
    """Token counts of the chunks that are most frequent in all texts.

    A task holds at most ``counted`` chunks: when there are more, the rarer half is forgotten. It gives at most
    ``table_size`` of them, seen twice or more.
    """

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("chunks")
        tool, seen = encoder(tokenizer), Counter()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                for value in whole.column(0).slice(at, ROWS).to_pylist():
                    seen.update((tool.chunks(value) or ())[1:] if value else ())
                if len(seen) > counted:
                    seen = Counter(dict(seen.most_common(counted // 2)))
        top = [(p, n) for p, n in seen.most_common(table_size) if n > 1 and len(p) <= CACHED_LENGTH]
        yield pa.record_batch([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["chunk", "n"])

    summed = docs.select(F.col(text)).mapInArrow(frequent, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))
    # Written first: a collected limit would bring that many rows of every partition to the driver.
    rows = stored(summed.orderBy(F.desc("n"), "chunk").limit(table_size), "frequent-chunks").collect()
    tool = encoder(tokenizer)
    return {r["chunk"]: len(tool.chunk(r["chunk"])) // tool.width.itemsize for r in rows}


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int, text: str = "text", keep: tuple[str, ...] = ("doc_id",), table_size: int = TABLE_SIZE
) -> DataFrame:
    """Columns ``keep`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Counts equal those of the library without added special tokens. A null or empty text has 0 of both.
    Rows are independent, so repeated rows repeat and hot sources cost nothing; other columns are not read.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, tokenizer, text, table_size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("chunks")
        tool, first_tier = encoder(tokenizer), table.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
                cut = [tool.chunks(t) for t in texts]
                got = [[] if chunks is None else list(map(first_tier.get, chunks[1:])) for chunks in cut]
                missed = [[c for c, n in zip(chunks[1:], own, strict=True) if n is None] if None in own else [] for chunks, own in zip(cut, got, strict=True)]
                second_tier = tool.chunk_ids.new
                heads = tool.whole([t if chunks is None else chunks[0] for t, chunks in zip(texts, cut, strict=True)])
                counts = []
                for head, own, rest in zip(heads, got, missed, strict=True):
                    encoded = len(head) + sum(len(second_tier.get(c) or tool.chunk(c)) for c in rest)
                    counts.append(encoded // tool.width.itemsize + sum(filter(None, own)))
                out = [batch.column(i) for i in range(len(keep))]
                sizes = [len(t.encode()) for t in texts]
                out += [pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())]
                yield pa.record_batch(out, names=[*keep, "n_bytes", "n_tokens", "over_limit"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    selected = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("_text"))
    return selected.mapInArrow(run, f"{schema}, n_bytes long, n_tokens long, over_limit boolean")
