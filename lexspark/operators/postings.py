"""A keyword index of posting blocks: top documents by BM25 without reading every block.

A word's postings (document, occurrences, length) stand in blocks of BLOCK, in the order of documents. A block knows its first and last
document and the best impact in it: the largest score part that any of its postings can have, whatever the weights of
words. A search reads the blocks' heads alone, gets a threshold from the best blocks, and opens those blocks only whose
documents can reach it: the bounds of all words over a block's range of documents must sum to the threshold. Scores are those of
search.keyword_scores.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 128
K1, B = 1.2, 0.75


def _part(tf: Column, length: Column, mean: float, k1: float, b: float) -> Column:
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))


def build(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", k1: float = K1, b: float = B, block: int = BLOCK) -> None:
    """Write path/heads and path/blocks: docs whose ids are distinct whole numbers, words in lower case between blanks, null texts left out."""
    rows = docs.select(F.col(id_col).alias("doc"), F.split(F.lower(text_col), " ").alias("w")).where("doc is not null and w is not null").select("doc", F.size("w").cast("double").alias("len"), F.explode("w").alias("word"))
    counts = rows.groupBy("word", "doc").agg(F.count("*").cast("double").alias("tf"), F.first("len").alias("len"))
    stats = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).agg(F.count("*").cast("double").alias("docs"), F.avg(F.size(F.split(F.lower(text_col), " "))).alias("mean"))
    counts.write.mode("overwrite").parquet(f"{path}/postings")
    stats.write.mode("overwrite").parquet(f"{path}/stats")
    spark = docs.sparkSession
    counts, mean = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/stats").first()["mean"] or 1.0
    # a word of a third of all documents is cut by ranges of documents first: its blocks are made in many tasks. Such words are few
    # (one for each 64 blocks of postings at most), so that postings stay where they are until they are dealt by word and range
    sizes = counts.groupBy("word").agg(F.count("*").alias("df"), F.min("doc").alias("lo"), F.max("doc").alias("hi")).where(F.col("df") > 64 * block)
    range_ = F.floor((F.col("doc") - F.col("lo")) / F.greatest(F.lit(1), F.floor((F.col("hi") - F.col("lo")) * (32.0 * block) / F.col("df"))))
    cut = counts.join(F.broadcast(sizes), "word", "left").withColumn("cut", F.coalesce(range_, F.lit(0)))
    place = Window.partitionBy("word", "cut").orderBy("doc")
    dealt = cut.withColumn("n", F.floor((F.row_number().over(place) - 1) / block))
    made = dealt.groupBy("word", "cut", "n").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.max(_part(F.col("tf"), F.col("len"), mean, k1, b)).alias("best"), F.count("*").alias("size"), F.array_sort(F.collect_list(F.struct("doc", "tf", "len"))).alias("postings"))
    made = made.select("word", F.concat_ws("-", "cut", "n").alias("block"), "first", "last", "best", "size", "postings")
    made.write.mode("overwrite").parquet(f"{path}/made")  # ranges are sampled from here: blocks are made once
    spark.read.parquet(f"{path}/made").repartitionByRange("word", "first").sortWithinPartitions("word", "first").write.mode("overwrite").parquet(f"{path}/blocks")
    spark.read.parquet(f"{path}/blocks").drop("postings").repartitionByRange("word", "first").sortWithinPartitions("word", "first").write.mode("overwrite").parquet(f"{path}/heads")


def top(spark, path: str, words: list[str], k: int = 10, id_col: str = "doc_id", k1: float = K1, b: float = B) -> tuple[DataFrame, DataFrame]:
    """The k best documents for some words (id, score; ties by id), and the blocks that were opened (word, block, size)."""
    words = list(dict.fromkeys(words))
    stats = spark.read.parquet(f"{path}/stats").first()
    heads = spark.read.parquet(f"{path}/heads").where(F.col("word").isin(words))
    df = {r["word"]: r["df"] for r in heads.groupBy("word").agg(F.sum("size").alias("df")).collect()}  # a row a word
    idf = {w: math.log(1 + (stats["docs"] - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    mean = stats["mean"] or 1.0
    if not idf:
        empty = spark.read.parquet(f"{path}/postings").select(F.col("doc").alias(id_col), F.lit(0.0).alias("score")).limit(0)
        return empty, heads.select("word", "block", "size").limit(0)
    weight = reduce(lambda c, w: c.when(F.col("word") == w, idf[w]), list(idf)[1:], F.when(F.col("word") == list(idf)[0], idf[list(idf)[0]]))
    heads = heads.withColumn("bound", weight * F.col("best") * (1 + 1e-9))
    blocks = spark.read.parquet(f"{path}/blocks").where(F.col("word").isin(words)).select("word", "block", "postings")

    def scores(chosen: DataFrame) -> DataFrame:
        flat = blocks.join(chosen.select("word", "block"), ["word", "block"], "left_semi").select("word", F.explode("postings").alias("p"))
        return flat.select(F.col("p.doc").alias("doc"), (weight * _part(F.col("p.tf"), F.col("p.len"), mean, k1, b)).alias("s")).groupBy("doc").agg(F.sum("s").alias("score"))

    # the k-th score within the best blocks is a threshold: no document of the answer scores less
    seeds = heads.orderBy(F.desc("bound"), "word", "first").limit(max(4, 2 * len(words)))
    kth = scores(seeds).orderBy(F.desc("score"), "doc").limit(k).agg(F.min("score").alias("t"), F.count("*").alias("n")).first()
    least = kth["t"] if kth["n"] == k else 0.0
    # over a block's range each other word adds at most the best bound of its blocks that overlap it; both sides are cut at steps of the range
    spans = heads.select("word", "block", "first", "last", "bound", "size")
    other = spans.select(F.col("word").alias("w"), F.col("first").alias("lo"), F.col("last").alias("hi"), F.col("bound").alias("more"))
    reach = spans.agg(F.min("first").alias("a"), F.max("last").alias("z"), F.count("*").alias("n")).first()
    step = max(1, (int(reach["z"]) - int(reach["a"])) // max(1, int(reach["n"])))
    slots = lambda lo, hi: F.explode(F.sequence(F.floor((lo - reach["a"]) / step), F.floor((hi - reach["a"]) / step)))
    by_slot = other.withColumn("slot", slots(F.col("lo"), F.col("hi"))).groupBy("slot", "w").agg(F.max("more").alias("more"))
    wide = spans.withColumn("slot", slots(F.col("first"), F.col("last"))).join(by_slot, "slot").where("w <> word").groupBy("word", "block", "slot").agg(F.sum("more").alias("more")).groupBy("word", "block").agg(F.max("more").alias("more"))
    opened = spans.join(wide, ["word", "block"], "left").where(F.col("bound") + F.coalesce("more", F.lit(0.0)) >= least)
    best = scores(opened).orderBy(F.desc("score"), "doc").limit(k).select(F.col("doc").alias(id_col), "score")
    return best, opened.select("word", "block", "size")
