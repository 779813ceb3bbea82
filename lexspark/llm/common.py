"""Shared plumbing of the training-data operators: scratch tables, row keys, components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


BROADCAST_ROWS = 1 << 17


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared ``spark.checkpoint.dir``.

    Only where that setting is absent and Spark runs in one process (tests, a laptop) a temporary folder is made and
    set; a cluster without it is refused, as its executors share no local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = held.get() if held.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster's intermediate tables need a shared folder")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/lexspark/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete the application's scratch tables, once its results were read or written elsewhere."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "x")).getParent()
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until df has no column of that name in any case."""
    held = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in held:
            n = "_" + n
        held.add(n.lower())
        out.append(n)
    return out


def materialize(df: DataFrame, name: str, compression: str = "zstd", path: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def for_join(df: DataFrame, n: int) -> DataFrame:
    """df as one side of a join of n rows (an upper bound of those that Spark might broadcast): beyond BROADCAST_ROWS both sides are shuffled.

    Spark broadcasts by the size of files or shuffle blocks, which are compressed, and takes an exploded row for one row:
    what it calls 10 MB may not fit into the driver.
    """
    return df.hint("merge") if n > BROADCAST_ROWS else df


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """run, after which a Python worker gives freed memory back to the system: idle workers stay small beside their executor."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return tidied


def row_hash(*names: str) -> Column:
    """64-bit hash that tells rows with the same id apart; null and '' differ."""
    return F.xxhash64(*[c for n in names for c in (F.col(n), F.col(n).isNull())])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def connected_components(edges: DataFrame, max_rounds: int = 60, plain: int = 1_000_000) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of the undirected edges (u, v).

    Alternating large-star and small-star steps; each round is written to the shared folder. The number
    of rounds grows with the logarithm of the longest path; an answer unfinished after max_rounds is an error. Beyond
    `plain` edges each step's least neighbours are written before they are joined, so that Spark may split the edges of
    a hub. Nothing is collected but one row of sums. Null ends are dropped; an empty table gives an empty result.
    """

    def sums(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    def star(e: DataFrame, large: bool, written: bool, n: int) -> DataFrame:
        if large:
            both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            low = materialize(low, "low") if written else low
            out = both.join(for_join(low, n), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            low = down.groupBy("u").agg(F.min("v").alias("m"))
            low = materialize(low, "low") if written else low
            out = down.join(for_join(low, n), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    e = edges.select("u", "v").where("u is not null and v is not null and u <> v").distinct()
    e = materialize(e, "edges")
    seen = sums(e)
    done = not seen[0]
    for _ in range(max_rounds):
        if done:
            break
        written = seen[0] > plain
        stars = star(e, True, written, seen[0])
        e = materialize(star(materialize(stars, "large") if written else stars, False, written, seen[0]), "star")
        now = sums(e)
        done, seen = now == seen, now
    if not done:
        raise RuntimeError(f"components unfinished after {max_rounds} rounds")
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
