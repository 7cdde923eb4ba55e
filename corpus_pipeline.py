"""A training corpus from raw documents: five stages, each one of the text operators.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents. A null text counts as empty
throughout; an empty table passes every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastermill.llm import bagminhash, decontam, pieces, pii, quality
from rastermill.llm.shared import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts."""
    return quality.keep_accepted(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return bagminhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no window of a benchmark item."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced in the text and n_chars counted anew."""
    clean = pii.sanitised(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, piece_ids, n_pieces and whether decoding gives the text again."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    back = pieces.encode_decode(docs.select("doc_id", "lang", "source", "text"), path)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return back.select("doc_id", "lang", "source", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"), same.alias("round_trip"))


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", pii_stage),
    ("SentencePiece encoding and decoding", sentencepiece_stage),
]

#: The stages use a fitted network and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
