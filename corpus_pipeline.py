"""From raw documents to encoded training text: five stages, each over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import quality_model
from tidemark.llm.jaccard_join import Join
from tidemark.llm.line_rules import clean_lines
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.near_copies import first_of_near_copies
from tidemark.llm.pieces import round_trip
from tidemark.llm.tables import bounded_batches, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Near copies share 80 % of their five-word shingles or more.
NEAR = Join(width=5, percent=80)
# Tokenizers and a classifier are beyond SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without their failing lines; ``n_chars`` follows the text."""
    bounded_batches(spark)
    kept = clean_lines(docs, keep=("doc_id", "lang", "source")).where("kept")
    return kept.withColumnRenamed("cleaned", "text").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by a model of the labelled raw documents.

    It learns from raw documents because most of those labelled 0 no longer are in ``docs``.
    """
    settings = quality_model.Settings()
    sample = quality_model.sample_labelled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", settings.sample)
    weights = quality_model.train(sample, settings=settings)
    return quality_model.score(docs, weights, COLUMNS, settings=settings).where("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked ones: that with the smallest id. Rows without an id stay."""
    bounded_batches(spark)
    return first_of_near_copies(docs, NEAR, COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix of sources, as often as it takes each."""
    return mixed_documents(docs).select(*COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix (``piece_ids``, little-endian unsigned 32-bit integers), their number, and the digest of the text decoded from them."""
    bounded_batches(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    decoded = round_trip(docs, model, keep=("doc_id", "lang", "source"))
    return decoded.select("doc_id", "lang", "source", (F.octet_length("piece_ids") / 4).cast("long").alias("n_tokens"), "piece_ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
