"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import quality_model
from tidemark.llm.chat_windows import chat_windows, conversation_digests
from tidemark.llm.conversation_repair import repair, repaired_digests
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.language_model import score_texts
from tidemark.llm.line_rules import clean_lines
from tidemark.llm.merkle import folded, merkle_proofs, proof_text, record_digest
from tidemark.llm.mixing import apply_mix, plan_mix, word_count
from tidemark.llm.pieces import piece_digests
from tidemark.llm.simhash_trie import simhash_components
from tidemark.llm.tables import stored, table
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.llm.va_search import VAFile, quantized, search
from tidemark.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def held_out_by(parts: int, rest: int) -> Column:
    """Whether the checksum of the id leaves ``rest``; a row without an id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == rest, F.lit(False))


def op1_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector, among all others."""
    vectors = quantized(table(spark, sf_dir, "embeddings"))
    return search(VAFile(vectors), vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the line rules for all documents."""
    judged = clean_lines(table(spark, sf_dir, "documents"), keep=("doc_id",), with_text=False)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labelled rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = held_out_by(3, 1)
    settings = quality_model.Settings()
    sample = quality_model.sample_labelled(docs, labels.where(~held_out), "quality", settings.sample)
    scored = quality_model.score(docs, quality_model.train(sample, settings=settings), ("doc_id",), settings=settings)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a word model and by context trees, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = held_out_by(7, 2)
    scored = score_texts(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded texts of all documents, as digests."""
    return piece_digests(table(spark, sf_dir, "documents"), PIECE_BPE)


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: sources weigh 3, 1, 2, share 150 % of all words, and repeat twice at most."""
    docs = table(spark, sf_dir, "documents")
    sized = stored(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    mixed = apply_mix(sized, plan_mix(sized))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, limit=1024)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents that share 85 % of their four-word shingles."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written to compressed token files and read back."""
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), BYTE_BPE, path)
    return read_token_files(spark, path)


def op10_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings, formatted in windows and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = F.lit("<|im_end|><|im_start|>assistant ok")
    roles = F.array(F.lit("user"), F.lit("assistant"))
    added = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.posexplode(roles).alias("turn", "role"), control.alias("text"))
    windows = stored(chat_windows(turns.unionByName(added)), "chat-windows")
    return conversation_digests(windows)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults by the checksum of ``conv_id:turn``: dropped, emptied, without end marks, repeated, or a user's. Nulls are one space."""
    filled = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return filled.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation after damage."""
    turns = table(spark, sf_dir, "conversations")
    found = repair(damaged(turns))
    ids = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    both = ids.unionByName(found.plan, allowMissingColumns=True).unionByName(repaired_digests(found), allowMissingColumns=True)
    counts = [F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    texts = [F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256")]
    return both.groupBy("conv_id").agg(*counts, *texts)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether lower-casing some texts is noticed."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = [*fields[:4], F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs = table(spark, sf_dir, "documents")
    records = docs.select("doc_id", "source", record_digest(fields).alias("leaf"), F.when(chosen, record_digest(tampered)).alias("shown"))
    proofs = merkle_proofs(records, "source", "doc_id")
    proved = proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(), 256).alias("proof_sha256"), folded(F.coalesce("shown", "leaf")).alias("folded_root"))
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose fingerprints differ in two bits at most."""
    return simhash_components(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_vector_search, op2_quality_rules, op3_quality_classifier, op4_language_model, op5_sentencepiece, op6_source_mix, op7_token_counts, op8_jaccard_join, op9_token_files, op10_chat_windows, op11_conversation_repair, op12_merkle_manifest, op13_simhash_trie)}
