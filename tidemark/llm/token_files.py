"""Token ids of documents as files of independent compressed blocks.

A folder holds ``frequencies`` (one shared table: symbol, slots) and ``blocks``: rows of a part number,
a block number, the ids before the block in its part, the documents in it, and a self-checking payload
(see ``rans``). Parts follow ascending ``doc_id`` and blocks ascend inside a part. A block ends before
the document that would not fit; only a document longer than a block spans several. Documents with the
same id follow each other by text; a null id comes first.

Writing deals the texts by ranges of ``doc_id``, packs their ids into blocks (kept in the shared folder),
counts the ids of all blocks for the shared table, and then compresses each block alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.byte_bpe import text_encoder
from tidemark.llm.rans import Decoder, Frequencies, encode
from tidemark.llm.tables import stored
from tidemark.llm.workers import claim

BLOCK_TOKENS = 1 << 18
ROWS = 256
IDS = "<u2"
BLOCKS = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
        ("piece", pa.int32()),
        ("pieces", pa.int32()),
        ("payload", pa.binary()),
    ]
)
BLOCKS_DDL = "part int, block int, start long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, piece int, pieces int, payload binary"
PIECES = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)
PIECES_DDL = "part int, block int, piece int, start long, doc_id long, n_tokens long, ids_crc32 long, ids binary"


def _packed(docs: DataFrame, tokenizer: str, end_id: int, text: str, doc_id: str, block_tokens: int) -> DataFrame:
    """Blocks in order, with the plain ids as payload; at the end of each part a row of block -1 counts its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("texts")
        tool, part, start = text_encoder(tokenizer), TaskContext.get().partitionId(), 0
        if tool.width.itemsize > np.dtype(IDS).itemsize:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        end, counts = np.array([end_id], IDS).tobytes(), np.zeros(1 << 16, np.int64)

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(at, ROWS)
                    for one, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                        yield one, tool.encode(value or "")

        def row(*values) -> pa.RecordBatch:
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, BLOCKS.types, strict=True)], schema=BLOCKS)

        for number, (ids, lengths, piece, pieces, payload) in enumerate(_blocks(documents(), end, block_tokens)):
            n = sum(lengths)
            counts += np.bincount(np.frombuffer(payload, IDS), minlength=len(counts))
            yield row(part, number, start, n, ids, lengths, piece, pieces, payload)
            start += n
        seen = np.flatnonzero(counts)
        yield row(part, -1, 0, 0, seen, counts[seen], 0, 0, b"")

    # As many parts as the session deals; the further keys split an id that many rows share.
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("_key"), F.monotonically_increasing_id().alias("_row"))
    dealt = chosen.repartitionByRange("doc_id", "_key", "_row").sortWithinPartitions("doc_id", "_key", "_row")
    return dealt.select("doc_id", "text").mapInArrow(run, BLOCKS_DDL)


def id_counts(blocks: DataFrame) -> np.ndarray:
    """Occurrences of every id over all plain blocks, from the counts of the parts."""
    pairs = F.explode(F.arrays_zip("doc_ids", "doc_tokens")).alias("pair")
    rows = blocks.where("block = -1").select(pairs).groupBy("pair.doc_ids").agg(F.sum("pair.doc_tokens").alias("n")).collect()  # vocabulary-sized
    counts = np.zeros(max([0, *(r["doc_ids"] for r in rows)]) + 1, np.int64)
    for r in rows:
        counts[r["doc_ids"]] = r["n"]
    return counts


def _blocks(docs: Iterator[tuple[int | None, bytes]], end: bytes, most: int) -> Iterator[tuple[list, list, int, int, bytes]]:
    """Documents and an end each packed into blocks: doc ids, lengths, which piece of how many of a long document, token ids."""
    width = len(end)
    ids, lengths, held, size = [], [], [], 0
    for doc_id, tokens in docs:
        n = len(tokens) // width + 1
        if ids and size + n > most:
            yield ids, lengths, 0, 1, b"".join(held)
            ids, lengths, held, size = [], [], [], 0
        if n > most:
            whole = tokens + end
            for piece, at in enumerate(range(0, n, most)):
                yield [doc_id], [min(most, n - at)], piece, -(-n // most), whole[width * at : width * (at + most)]
            continue
        ids.append(doc_id)
        lengths.append(n)
        held += (tokens, end)
        size += n
    if ids:
        yield ids, lengths, 0, 1, b"".join(held)


def write_token_files(
    docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, text: str = "text", doc_id: str = "doc_id", block_tokens: int = BLOCK_TOKENS
) -> None:
    """Encode the texts (null: empty) and write a folder; ``path`` must not exist. Other columns are not read.

    Ids must fit 16 bits, as those of the vocabularies at hand do.
    """
    spark = docs.sparkSession
    plain = stored(_packed(docs, tokenizer, end_id, text, doc_id, block_tokens), "token-blocks", compression="zstd")
    table = Frequencies.of_counts(id_counts(plain))
    used = np.flatnonzero(table.slots)
    frequencies = spark.createDataFrame([(int(s), int(table.slots[s])) for s in used], "symbol int, slots int")
    frequencies.coalesce(1).write.parquet(f"{path}/frequencies")
    shared = spark.sparkContext.broadcast(table.slots.astype(np.uint32))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, last = Frequencies(shared.value), len(BLOCKS) - 1
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                payload = encode(np.frombuffer(row.column(last)[0].as_buffer(), IDS), slots)
                yield pa.record_batch([*row.columns[:last], pa.array([payload], pa.binary())], names=BLOCKS.names)

    plain.where("block >= 0").mapInArrow(compress, BLOCKS_DDL).write.parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of a folder: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    ``with_ids`` adds ``ids`` (little-endian unsigned 32-bit integers). Blocks are decoded side by side;
    the pieces of documents longer than a block meet again, by the block their document began in.
    """
    table = spark.read.schema("symbol int, slots int").parquet(f"{path}/frequencies").collect()  # vocabulary-sized
    slots = np.zeros(max([0, *(r["symbol"] for r in table)]) + 1, np.uint32)
    for r in table:
        slots[r["symbol"]] = r["slots"]
    shared = spark.sparkContext.broadcast(slots)
    blocks = spark.read.schema(BLOCKS_DDL).parquet(f"{path}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Frequencies(shared.value))
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                symbols, at, out = decoder.decode(row["payload"]).astype("<u4"), 0, []
                for doc, n in zip(row["doc_ids"], row["doc_tokens"], strict=True):
                    data = symbols[at : at + n].tobytes()
                    kept = data if with_ids or row["pieces"] > 1 else None
                    out.append((row["part"], row["block"], row["piece"], row["start"] + at, doc, n, zlib.crc32(data), kept))
                    at += n
                yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*out, strict=True), PIECES.types, strict=True)], schema=PIECES)

    whole = blocks.where("pieces = 1").mapInArrow(run, PIECES_DDL).select("part", "start", "doc_id", "n_tokens", "ids_crc32", "ids")
    # Each piece in hexadecimal, so that a document is put together once and not copied for every piece.
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda x: F.hex(x["ids"]))
    joined = F.unhex(F.array_join(pieces, ""))
    long = (
        blocks.where("pieces > 1")
        .mapInArrow(run, PIECES_DDL)
        .groupBy("part", (F.col("block") - F.col("piece")).alias("first"))  # one document each
        .agg(F.min("start").alias("start"), F.first("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), joined.alias("ids"))
        .select("part", "start", "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), "ids")
    )
    sizes = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}  # a row a part
    offsets, total = [], 0
    for part in sorted(sizes):
        offsets.append((part, total))
        total += sizes[part]
    before = F.broadcast(spark.createDataFrame(offsets, "part int, before long"))  # a row a part
    placed = whole.unionByName(long).join(before, "part")
    return placed.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
