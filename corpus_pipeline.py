"""Training-text pipeline: five stages over ``documents``, each written as Parquet and read by the next.

1. language ID: texts the model rejects go;
2. n-gram Jaccard join: one document of each group of near duplicates stays;
3. benchmark decontamination: contaminated documents go;
4. secret scans: secrets are masked, documents stay;
5. byte-level BPE: ids of what is left.
"""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallygrid.functions.scale import checkpoint_dir
from tallygrid.llm import byte_bpe, decontaminate, jaccard, language_id, secrets
from tallygrid.llm.queries import remainder, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accept(docs, language_id.fit(docs, remainder("i", 3) != 1))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", decontaminate_benchmark),
    ("secrets", mask_secrets),
    ("byte_bpe", encode_tokens),
]

#: Models, sets of near duplicates and tokenisation have no SQL form; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every stage's rows stay in the shared folder until the session's owner clears it."""
    docs = table(spark, sf_dir, "documents")
    folder = os.path.join(checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    for number, (name, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{number}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
