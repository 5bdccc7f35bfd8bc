"""Token counts, token files and SentencePiece ids against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import rans, token_files
from tidemark.llm.byte_bpe import ChunkEncoder
from tidemark.llm.piece_bpe import PieceTokenizer
from tidemark.llm.pieces import decode_pieces, encode_pieces, piece_digests, round_trip
from tidemark.llm.token_counts import count_tokens

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def sentencepiece():
    return SentencePieceProcessor(model_file=PIECES)


def random_texts(n, seed):
    pick = random.Random(seed)
    parts = [*"aest'é ü中😀\n\t\r.,!?-=1 2|", "  ", " \n", "\n\n", "'s", "'re", "<|endoftext|>", "\xa0", "\x1c", "\x85", "́", "ł", "ing", " the", "▁", "<s>", "\u0000"]
    return ["".join(pick.choice(parts) for _ in range(pick.randint(0, 16))) for _ in range(n)]


def test_chunks_are_encoded_like_whole_texts(library, texts):
    tool = ChunkEncoder(BPE)
    some = [t or "" for t in texts] + random_texts(20_000, 1)
    for start in range(0, len(some), 700):
        part = some[start : start + 700]
        expected = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [np.frombuffer(i, "<u2").tolist() for i in tool.encode(part)] == expected


def test_caches_are_bounded(library):
    tool = ChunkEncoder(BPE)
    tool.chunk_ids.size = tool.part_ids.size = 3
    some = random_texts(300, 2)
    assert [np.frombuffer(i, "<u2").tolist() for i in tool.encode(some)] == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    assert len(tool.chunk_ids.new) <= 3 and len(tool.chunk_ids.old) <= 3


def test_counts(spark, docs, texts, library):
    found = {r.doc_id: r for r in count_tokens(docs, BPE, limit=40, table_size=5).collect()}
    for i, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (found[i].n_bytes, found[i].n_tokens, found[i].over_limit) == (len((text or "").encode()), n, n > 40)
    assert count_tokens(docs.limit(0), BPE, limit=40).count() == 0
    assert count_tokens(docs.union(docs), BPE, limit=40).count() == 2 * len(texts)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 4095, 20_000])
def test_rans_round_trip(n):
    symbols = (np.random.default_rng(n).zipf(1.3, n) % 5000).astype(np.uint32)
    table = rans.Frequencies.of_counts(np.bincount(symbols, minlength=5000))
    block = rans.encode(symbols, table)
    assert (rans.Decoder(table).decode(block) == symbols).all()
    assert int(table.slots.sum()) in (0, 1 << rans.SCALE_BITS)


def test_rans_parts_decode_alone_and_damage_shows(monkeypatch):
    monkeypatch.setattr(rans, "CHECKPOINT_STEPS", 4)
    symbols = np.random.default_rng(3).integers(0, 300, 3000).astype(np.uint32)
    table = rans.Frequencies.of_counts(np.bincount(symbols))
    block, decoder = rans.encode(symbols, table), rans.Decoder(table)
    parts = decoder.parts(block)
    assert len(parts) > 3
    whole = [decoder._run(*part) for part in reversed(parts)][::-1]
    assert (np.concatenate(whole) == symbols).all()
    for at in (rans.HEADER.size + 3, len(block) - 1):
        with pytest.raises(ValueError):
            decoder.decode(block[:at] + bytes([block[at] ^ 1]) + block[at + 1 :])


def test_skewed_counts_fill_all_slots():
    counts = np.array([10**12, *[1] * 5000, 0])
    table = rans.Frequencies.of_counts(counts)
    assert int(table.slots.sum()) == 1 << rans.SCALE_BITS and table.slots[:-1].all() and not table.slots[-1]


@pytest.mark.parametrize("block_tokens", [64, 1 << 18])
def test_token_files(spark, docs, texts, library, tmp_path, block_tokens):
    path = str(tmp_path / "files")
    token_files.write_token_files(docs, BPE, path, block_tokens=block_tokens)
    start = 0
    found = {r.doc_id: r for r in token_files.read_token_files(spark, path, with_ids=True).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        row = found[i]
        assert (row.start, row.n_tokens, row.ids_crc32, bytes(row.ids)) == (start, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes())
        start += len(ids)


def test_token_files_of_nothing_and_of_repeated_rows(spark, docs, tmp_path):
    token_files.write_token_files(docs.limit(0), BPE, str(tmp_path / "none"))
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0
    twice = docs.select("doc_id", "text").where("doc_id < 6").union(spark.createDataFrame([(None, "no id")], "doc_id long, text string"))
    token_files.write_token_files(twice.union(twice), BPE, str(tmp_path / "twice"))
    found = token_files.read_token_files(spark, str(tmp_path / "twice")).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, None, *[i for i in range(6) for _ in range(2)]]


def test_pieces_equal_the_library(sentencepiece, texts):
    tool = PieceTokenizer(PIECES)
    vocabulary = [sentencepiece.id_to_piece(i).replace("▁", " ") for i in range(300, 9000, 7)]
    pick = random.Random(5)
    some = [t or "" for t in texts] + random_texts(8000, 4) + ["".join(pick.choice(vocabulary) for _ in range(pick.randint(1, 5))) for _ in range(8000)]
    for text in some:
        expected = sentencepiece.encode(text, add_bos=True, add_eos=True)
        assert tool.encode(text).tolist() == expected
        assert tool.decode(np.array(expected)).decode() == sentencepiece.decode(expected)


def test_piece_columns(spark, docs, texts, sentencepiece):
    digests = {r.doc_id: r for r in piece_digests(docs, PIECES).collect()}
    encoded = encode_pieces(docs.select("doc_id", "text"), PIECES)
    decoded = {r.doc_id: r for r in decode_pieces(encoded, PIECES).collect()}
    for i, text in enumerate(texts):
        ids = sentencepiece.encode(text or "", add_bos=True, add_eos=True)
        raw, back = np.array(ids, "<u4").tobytes(), sentencepiece.decode(ids)
        assert (digests[i].n_tokens, digests[i].ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert digests[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
        assert (bytes(decoded[i].piece_ids), decoded[i].decoded) == (raw, back)
    assert piece_digests(docs.limit(0), PIECES).count() == 0
    assert encode_pieces(docs, PIECES, ids="n_tokens").schema["n_tokens"].dataType.simpleString() == "binary"


def test_round_trip_equals_encoding_then_decoding(spark, docs):
    both = decode_pieces(encode_pieces(docs, PIECES), PIECES).select("doc_id", "source", "piece_ids", "decoded")
    assert sorted(round_trip(docs, PIECES, keep=("doc_id", "source")).collect(), key=lambda r: r.doc_id) == sorted(both.collect(), key=lambda r: r.doc_id)
