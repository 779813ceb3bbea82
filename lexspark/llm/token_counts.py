"""Operator 1, token counts: a digest cache.

A text's digest covers its normalised content (ASCII letters lower-cased, runs of ASCII white space made one space and
dropped at the ends: the vocabulary's own normaliser and splitter do the same, so the count stays) together with the tokenizer version. Texts that
hold an added token's string in any case, and all texts of a vocabulary of another kind than 'word', are digested as
they are. Digests are
joined with the cache first; the texts of those that it lacks, and no others, are then fetched, encoded once, and their
counts appended to the cache. With a full cache no text moves.

Null text: empty, 0 tokens. Repeated rows each get a row. Null ids stay null. Extra columns stay out of the result
unless asked for through ``keep``; an empty table gives an empty result and an empty cache file.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.bits import bit_table
from lexspark.llm.bpe import encoder, vocabulary
from lexspark.llm.common import materialize, scratch_path, tidy, unused

_SEEN = 200_000
CACHE_SCHEMA = "version string, digest string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def content_digest(text: bytes, special: list[bytes], kind: str = "word") -> str:
    if kind != "word":  # no normaliser
        return hashlib.sha256(kind.encode() + b":" + text).hexdigest()
    low = text.lower()  # of bytes: A-Z alone
    if any(s in low for s in special):
        return hashlib.sha256(b"raw:" + text).hexdigest()
    return hashlib.sha256(b"norm:" + b" ".join(low.split())).hexdigest()


def _digests(special: list[str], kind: str):
    """The kept columns with digest and n_bytes in place of the text, which comes last."""
    marks = [s.encode().lower() for s in special]

    def run(batches):
        for b in batches:
            given = [t or b"" for t in b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()]
            digests = [content_digest(t, marks, kind) for t in given]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(digests, pa.string()), pa.array([len(t) for t in given], pa.int64())], [*b.schema.names[:-1], "digest", "n_bytes"])

    return run


def _wanted(special: list[str], kind: str, table):
    """digest and text of the texts whose digest the bit table lets through, each digest's first of the task alone."""
    marks = [s.encode().lower() for s in special]

    def run(batches):
        wanted, seen = table.value, set()
        for b in batches:
            digests = [content_digest(t or b"", marks, kind) for t in b.column(0).cast(pa.binary()).to_pylist()]
            fresh = []
            for k, d in enumerate(digests):
                if d not in seen and wanted.holds(int(d[:16], 16)):
                    seen.add(d)
                    fresh.append(k)
            if len(seen) > _SEEN:  # a copy may go out twice: it costs time, no result
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array([digests[k] for k in fresh], pa.string()), b.column(0).take(pa.array(fresh, pa.int64()))], ["digest", "text"])

    return run


def texts_of(docs: DataFrame, missing: DataFrame, special: list[str], kind: str = "word", text_col: str = "text") -> DataFrame:
    """digest and text of the texts with a missing digest (missing: digest, distinct), by digest: a bit table of 8 MB at most keeps nearly all others where they are."""
    table = docs.sparkSession.sparkContext.broadcast(bit_table(missing.select(F.conv(F.substring("digest", 1, 16), 16, -10).cast("long").alias("h"))))
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(tidy(_wanted(special, kind, table)), "digest string, text string")
    # a task sends one text of each digest, so copies are not moved; the shuffle brings a digest's texts to one task
    return texts.repartition("digest").join(missing, "digest", "left_semi")


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache table; empty where nothing was written yet."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(CACHE_SCHEMA).parquet(path) if there else spark.createDataFrame([], CACHE_SCHEMA)


def _count_misses(path: str, kind: str):
    def run(batches):
        enc, seen = encoder(path, kind), set()
        for b in batches:
            fresh = []
            for k, d in enumerate(b.column("digest").to_pylist()):
                if d not in seen:
                    seen.add(d)
                    fresh.append(k)
            if len(seen) > _SEEN:
                seen.clear()
            b = b.take(pa.array(fresh, pa.int64()))
            n = enc.counts(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return run


def token_counts(docs: DataFrame, cache_path: str, vocab: str | None = None, kind: str = "word", id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, n_bytes (UTF-8) and n_tokens of each row of docs; new counts are appended to the cache at cache_path."""
    spark = docs.sparkSession
    vocab = vocab or vocabulary("word_bpe_49k.json")
    version = tokenizer_version(vocab)
    special = encoder(vocab, kind).special
    held = lambda: read_cache(spark, cache_path).where(F.col("version") == version)
    name, text = unused(docs, "digest", "text")
    rows = docs.select(F.col(id_col), *keep, F.col(text_col).alias(text))
    rows = rows.mapInArrow(tidy(_digests(special, kind)), rows.drop(text).schema.add(name, "string").add("n_bytes", "long"))
    rows = materialize(rows, "digests")
    missing = materialize(rows.select(F.col(name).alias("digest")).distinct().join(held().select("digest").distinct(), "digest", "left_anti"), "missing")
    fresh = texts_of(docs, missing, special, kind, text_col).mapInArrow(tidy(_count_misses(vocab, kind)), "digest string, n_tokens long")
    fresh.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache_path)
    # two runs at once may append the same digest; either row has the same count
    counts = materialize(held().groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")  # read afresh, both sides are shuffled for the join alone: Spark may split a digest of many copies
    return rows.join(counts.withColumnRenamed("digest", name), name).select(id_col, *keep, "n_bytes", "n_tokens")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = token_counts(docs, scratch_path(spark, "token-cache"))
    return out.withColumn("over_limit", F.col("n_tokens") > 2048)
