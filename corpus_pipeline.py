"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

1. quality classifier: documents that it rejects go;
2. exact dedup: one document of each group of equal texts stays;
3. n-gram Jaccard join: one document of each near-duplicate component stays;
4. benchmark decontamination: documents that hold a benchmark item go;
5. SentencePiece encoding and decoding: ids of every document left, with the check that they decode to its text.

Stages 1 to 4 return the columns they get. Stages keep rows without an id, and
treat rows that repeat an id as one document. Empty input gives empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.llm.common import read_documents, stored
from clickpulse.llm.decontaminate import decontaminate
from clickpulse.llm.exact_dedup import deduplicate
from clickpulse.llm.ngram_join import keep_one_of_each
from clickpulse.llm.quality import keep_good
from clickpulse.llm.queries import quality_teaches
from clickpulse.llm.sentencepiece_codec import decode_documents, encode_documents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, _table(spark, sf_dir, "labels"), quality_teaches())


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_ids, round_trip``."""
    both = decode_documents(encode_documents(docs.select("doc_id", "text")))
    # U+2581 is the vocabulary's own mark for a space and reads back as one.
    text = F.translate(F.coalesce("text", F.lit("")), "▁", " ")
    return both.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), (F.col("decoded") == text).alias("round_trip")
    )


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", encoding_stage),
]

#: The learned classifier and the tokenizer cannot be written in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
