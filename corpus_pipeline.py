"""A corpus pipeline of five stages over documents; each stage works on all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Every
stage calls one operator of lexspark.llm, whose docstring states what nulls, repeats and empty tables give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import lexspark
from lexspark.llm import decontaminate, langid, packing, secrets, simhash
from lexspark.llm.common import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language (null, or without a letter). `lang` stays as it came."""
    lexspark.ship(spark)
    model = langid.learn(docs, langid.fold() != 1)
    if not model.langs:  # nothing was learned: every text would be und
        return langid.lettered(docs)
    return langid.known(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id in each group of near copies."""
    lexspark.ship(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more lies in windows of benchmark items."""
    lexspark.ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with its secrets replaced by [SECRET] and n_chars, where there is one, brought up to date."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their token ids, in sequences of 2048 tokens."""
    lexspark.ship(spark)
    return packing.pack(docs, with_ids=True)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secret_scan", secret_scan), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not pack:
            docs = materialize(docs, name)
    return docs
