"""The training-data pipeline: documents through five stages, each written and read again.

``STAGES`` lists the stages in order. A stage takes ``(spark, docs, sf_dir)`` and returns
what it keeps; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from delaykit.llm import mixing, pieces, quality, rules, simhash
from delaykit.llm.shared import send_code, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier learned from ``labels`` rejects go."""
    send_code(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, and all of a host that fails them, go."""
    return rules.keep_passed(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints of three-word shingles lie within 3 bits stays."""
    send_code(spark)
    return simhash.keep_one(docs, words=3, max_bits=3)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought nearer to equal weights by repeating documents of small ones.

    The budget draws every document at least once and none more than twice.
    """
    return mixing.mixed_documents(docs, max_epochs=1.5, budget=None)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as ids of pieces: the id of the document, packed ids, their number and crc32."""
    send_code(spark)
    rows = pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return rows.drop("text")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("encoding", encoding),
]

# A learned classifier decides in the first stage: SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's rows are written once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
