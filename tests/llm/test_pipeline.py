"""Stages of the pipeline against plain definitions."""

import hashlib

import numpy as np
import public_tokenizers
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from tests.llm.test_text_operators import plain_components
from tidemark.llm.tables import table

SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    """Documents from rows of an id and a text."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], table(spark, SF, "documents").schema)


def words(name, n):
    return [f"{name}w{i}" for i in range(n)]


def test_near_duplicates_are_five_words_and_four_fifths(spark):
    rows = []
    for group in range(8):
        base = words(f"g{group}", 100)
        # 5-word Jaccard similarities from 0.76 to 0.86
        for added in (0, 16 + 2 * group):
            rows.append((len(rows), " ".join([*base, *words(f"x{group}", added)])))
        edited = [f"e{i}" if i % 47 == 20 else w for i, w in enumerate(base)]
        rows.append((len(rows), " ".join(edited)))
    groups = plain_components(rows, width=5, percent=80)
    assert groups != plain_components(rows, width=4, percent=85)
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, rows), SF)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({g for _, g in groups.values()})


def test_near_duplicates_decide_by_row(spark):
    one, two, three, four = (" ".join(words(c, 60)) for c in "abcd")
    rows = [(7, one), (7, two), (7, two + " more"), (3, one), (9, three), (9, three), (9, four), (5, None), (5, ""), (None, one), (None, one)]
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, rows).repartition(3), SF).collect()
    found = sorted(((r.doc_id or 0, r.text or "") for r in kept), key=str)
    two = next(t for t in (two, two + " more") if (7, t) in found)
    assert found == sorted([(7, two), (3, one), (9, three), (9, four), (5, ""), (5, ""), (0, one), (0, one)], key=str)


def test_sentencepiece_decodes_what_it_encodes(spark):
    rows = [(1, "The lake was still. déjà vu 中文 😀"), (2, " two  gaps "), (3, ""), (4, None)]
    tool = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in corpus_pipeline.sentencepiece(spark, frame(spark, rows), SF).collect():
        ids = np.frombuffer(r.piece_ids, "<u4").tolist()
        assert len(ids) == r.n_tokens and r.decoded_sha256 == hashlib.sha256(tool.decode(ids).encode()).hexdigest()
