"""SentencePiece ids of documents, and texts from ids, at scale."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tidemark.llm.piece_bpe import tokenizer
from tidemark.llm.workers import claim

ROWS = 256


def encode_pieces(docs: DataFrame, model: str, text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """All columns and ``ids``: little-endian unsigned 32-bit integers with begin and end.

    A null or empty text has begin and end only. Rows are independent; a column named ``ids`` is replaced.
    """
    kept = [c for c in docs.columns if c != ids]
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("pieces")
        tool = tokenizer(model)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                got = [tool.encode(t or "").tobytes() for t in batch.column(at).to_pylist()]
                yield pa.record_batch([*batch.columns, pa.array(got, pa.binary())], names=[*kept, ids])

    selected = docs.select(*[F.col(f"`{c}`") for c in kept])
    return selected.mapInArrow(run, StructType([*selected.schema.fields, StructField(ids, BinaryType())]))


def decode_pieces(encoded: DataFrame, model: str, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """All columns and ``text``: the text of ``ids`` (null: null)."""
    kept = [c for c in encoded.columns if c != text]
    at = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        claim("pieces")
        tool = tokenizer(model)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                got = [None if v is None else tool.decode(np.frombuffer(v, "<u4")).decode() for v in batch.column(at).to_pylist()]
                yield pa.record_batch([*batch.columns, pa.array(got, pa.string())], names=[*kept, text])

    selected = encoded.select(*[F.col(f"`{c}`") for c in kept])
    return selected.mapInArrow(run, StructType([*selected.schema.fields, StructField(text, StringType())]))


def round_trip(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: str = "piece_ids", decoded: str = "decoded") -> DataFrame:
    """Columns ``keep`` with ``ids`` as ``encode_pieces`` gives them and ``decoded`` as ``decode_pieces`` makes it of them.

    Both happen in one worker, so that a task needs one tokenizer instead of two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("pieces")
        tool = tokenizer(model)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                got = [tool.encode(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
                columns = [pa.array([g.tobytes() for g in got], pa.binary()), pa.array([tool.decode(g).decode() for g in got], pa.string())]
                yield pa.record_batch([*batch.columns[: len(keep)], *columns], names=[*keep, ids, decoded])

    selected = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    fields = selected.schema.fields[: len(keep)]
    return selected.mapInArrow(run, StructType([*fields, StructField(ids, BinaryType()), StructField(decoded, StringType())]))


def piece_digests(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` (of the text decoded from those ids).

    Encodes and decodes in one pass, so that ids and texts needn't leave the worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("pieces")
        tool = tokenizer(model)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                counts, of_ids, of_texts = [], [], []
                for value in batch.column(batch.num_columns - 1).to_pylist():
                    got = tool.encode(value or "")
                    counts.append(len(got))
                    of_ids.append(hashlib.sha256(got.tobytes()).hexdigest())
                    of_texts.append(hashlib.sha256(tool.decode(got)).hexdigest())
                out = [*batch.columns[: len(keep)], pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]
                yield pa.record_batch(out, names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    selected = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("_text"))
    return selected.mapInArrow(run, f"{schema}, n_tokens long, ids_sha256 string, decoded_sha256 string")
