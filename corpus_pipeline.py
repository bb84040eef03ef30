"""Corpus pipeline: stages over ``documents``, each calling one text operator of ``flowlens.llm``."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.common import materialize, table
from flowlens.llm.decontaminate import decontaminate
from flowlens.llm.jaccard_dedup import deduplicate
from flowlens.llm.packing import pack
from flowlens.llm.secret_scan import redact
from flowlens.llm.toxicity import drop_toxic

TOKENIZER = "byte_bpe_50k.json"
#: Documents, and bytes of them, that are handed to Python at a time: a batch of long ones stays small beside a full heap.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def in_batches(stage):
    """``stage`` in a session that hands documents over in small batches."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for k, v in BATCH.items():
            spark.conf.set(k, v)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_batches
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar, fitted on the labels outside the held-out third, rejects go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


@in_batches
def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts with a five-word similarity of 0.8 or more the document with the smallest id stays."""
    return deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark. n_chars follows the text."""
    out = redact(docs)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text")).cast(docs.schema["n_chars"].dataType))


@in_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids, with the ids."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("secret scan", without_secrets),
    ("packing", packed),
]

#: SQL can express neither the learned grammar nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each over what the one before it has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
