"""The vector table: merges by deterministic id, guards and clean-up as joins, and commits of the buckets that changed."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.functions.ids import version_rank

LAW = ["domain", "law_id"]


def upsert(stored: DataFrame, incoming: DataFrame, key: str = "uuid") -> DataFrame:
    """stored with incoming rows in place of those of the same key. Incoming keys are unique."""
    return stored.join(incoming.select(key), key, "left_anti").unionByName(incoming, allowMissingColumns=True)


def split_existing(incoming: DataFrame, stored: DataFrame, key: str = "uuid") -> DataFrame:
    """incoming with `existing`: the key is stored already."""
    return incoming.join(stored.select(key, F.lit(True).alias("existing")).distinct(), key, "left").withColumn("existing", F.coalesce("existing", F.lit(False)))


def delete_laws(stored: DataFrame, laws: DataFrame) -> DataFrame:
    """Without all rows of (domain, law_id)."""
    return stored.join(laws.select(*LAW).distinct(), LAW, "left_anti")


def stale_versions(stored: DataFrame, keep: DataFrame) -> DataFrame:
    """Rows of laws that keep names, in versions that it doesn't name. Null versions in keep count for nothing; rows without a version are stale."""
    named = keep.where("version_uid is not null").groupBy(*LAW).agg(F.collect_set("version_uid").alias("__kept"))  # a law's versions are few
    return stored.join(named, LAW).where(~F.coalesce(F.array_contains("__kept", F.col("version_uid")), F.lit(False))).drop("__kept")


def orphan_units(stored: DataFrame, keep: DataFrame) -> DataFrame:
    """JSON rows of versions that keep names, with chunk ids that it doesn't name."""
    version = [*LAW, "version_uid"]
    return stored.where("source_type = 'JSON'").join(keep.select(*version).distinct(), version, "left_semi").join(keep.select(*version, "chunk_id").distinct(), [*version, "chunk_id"], "left_anti")


def orphan_files(stored: DataFrame, keep: DataFrame) -> DataFrame:
    """FILE rows of files that keep names, with chunk ids that it doesn't name."""
    return stored.where("source_type = 'FILE'").join(keep.select("file_id").distinct(), "file_id", "left_semi").join(keep.select("file_id", "chunk_id").distinct(), ["file_id", "chunk_id"], "left_anti")


def older_than_stored(incoming: DataFrame, stored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """incoming rows of which a strictly newer version is stored; equal ranks pass."""
    keys = keys or LAW
    best = stored.groupBy(*keys).agg(F.max(version_rank(F.col("version_uid"), F.col("mst"))).alias("best"))
    return incoming.join(best, keys).where(version_rank(F.col("version_uid"), F.col("mst")) < F.col("best")).drop("best")


def outgoing(stored: DataFrame, fresh: DataFrame, gone: DataFrame, older: bool = False) -> DataFrame:
    """`new` (1: row of fresh, 0: of stored) and uuid of the rows that don't stand once fresh is merged into stored.

    Of stored: rows of the laws of gone, rows whose id is written anew, and stale versions and orphan units. Of fresh: laws
    of which a newer version is stored, unless older, which count for nothing; and what is stale or an orphan by its own laws' rows.
    The same as older_than_stored, delete_laws, upsert, stale_versions and orphan_units one after the other, but ids and versions alone
    are shuffled, by law, and once.
    """
    new, held, law_first = F.col("new"), [*LAW, "version_uid", "source_type", "chunk_id", "uuid"], LAW[::-1]  # sorted by what tells most rows apart
    rank = lambda df: F.lit(None) if older else version_rank(df["version_uid"], df["mst"])
    rows = stored.select(F.lit(0).alias("new"), *held, rank(stored).alias("rank")).unionByName(fresh.select(F.lit(1).alias("new"), *held, rank(fresh).alias("rank")))
    rows = rows.unionByName(gone.select(F.lit(2).alias("new"), *LAW), allowMissingColumns=True).repartition(*law_first)
    among = lambda c, *by: F.bool_or(c).over(Window.partitionBy(*law_first, *by))
    # from many keys to few: one sort serves all
    rows = rows.withColumn("chunk_named", among(new == 1, "version_uid", "chunk_id")).withColumn("version_named", among(new == 1, "version_uid"))
    named, law = F.col("version_uid").isNotNull(), F.col("domain").isNotNull() & F.col("law_id").isNotNull()
    best = lambda f, n: F.when(law, f(F.when(new == n, F.col("rank"))).over(Window.partitionBy(*law_first)))
    rows = rows.withColumns({"law_named": among((new == 1) & named), "law_gone": among(new == 2), "late": F.lit(False) if older else F.coalesce(best(F.min, 1) < best(F.max, 0), F.lit(False))})
    version = named & F.col("version_named")
    orphan = F.coalesce(F.col("source_type") == "JSON", F.lit(False)) & version & ~(F.col("chunk_id").isNotNull() & F.col("chunk_named"))
    unnamed = law & ~F.col("late") & ((F.col("law_named") & ~version) | orphan)
    out = unnamed | F.when(new == 1, F.col("late")).otherwise(law & F.col("law_gone"))
    both = F.array(F.when(out, F.struct("new", "uuid")), F.when((new == 1) & ~F.col("late"), F.struct(F.lit(0).alias("new"), F.col("uuid"))))
    return rows.where(new < 2).select(F.explode(F.array_compact(both)).alias("r")).select("r.*")


def missing(expected: DataFrame, stored: DataFrame, key: str = "uuid") -> DataFrame:
    return expected.join(stored.select(key).distinct(), key, "left_anti")


def complete_documents(expected: DataFrame, stored: DataFrame, document: str, key: str = "uuid") -> DataFrame:
    """Documents with at least one expected id, all of them stored."""
    return (expected.join(stored.select(key, F.lit(1).alias("__here")).distinct(), key, "left").groupBy(document)
            .agg(F.count("*").alias("expected"), F.count("__here").alias("stored")).where("expected = stored"))


def current_versions(stored: DataFrame) -> DataFrame:
    return stored.where("version_uid is not null").select(*LAW, "version_uid").distinct()


def vector_fault(vector: Column, dim: int) -> Column:
    """Why a vector may not be written; null if it may."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (F.when(vector.isNull(), "missing").when(F.size(vector) != dim, "dimension").when(bad, "not finite")
            .when(~F.exists(vector, lambda x: x != 0), "zero"))


def reuse_vectors(rows: DataFrame, cache: DataFrame, dim: int) -> DataFrame:
    """rows with the cached vector of the same id, same text and right dimension; null where it must be made."""
    held = cache.select("uuid", F.sha2("search_text", 256).alias("__hash"), F.col("vector").alias("cached")).where(F.size("cached") == dim)
    return rows.withColumn("__hash", F.sha2("search_text", 256)).join(held, ["uuid", "__hash"], "left").drop("__hash")


def compare_exports(a: DataFrame, b: DataFrame, digits: int = 6) -> DataFrame:
    """Ids that one side lacks or whose vectors or properties differ."""
    same = lambda c: F.transform(c, lambda x: F.round(x.cast("double"), digits))
    j = a.alias("a").join(b.alias("b"), F.col("a.uuid") == F.col("b.uuid"), "full_outer")
    fault = (F.when(F.col("b.uuid").isNull(), "missing").when(F.col("a.uuid").isNull(), "extra")
             .when(~same(F.col("a.vector")).eqNullSafe(same(F.col("b.vector"))), "vector").when(~F.col("a.props").eqNullSafe(F.col("b.props")), "props"))
    return j.select(F.coalesce("a.uuid", "b.uuid").alias("uuid"), fault.alias("fault")).where("fault is not null")


def dimension_fault(stored: DataFrame, dim: int, vector: str = "vector") -> str | None:
    """Why vectors of this dimension don't fit the table; None if they do or the table has none. One row is looked at."""
    held = stored.select(F.size(vector).alias("d")).where("d >= 0").limit(1).collect()
    return f"stored vectors have {held[0]['d']} dimensions, not {dim}" if held and held[0]["d"] != dim else None


def inventory(rows: DataFrame, *keys: str, chunks: str | None = None) -> DataFrame:
    """Rows (and the sum of a column of chunk counts) for every combination of the keys from the left, totals included."""
    return rows.rollup(*keys).agg(F.count("*").alias("docs"), *([F.sum(chunks).alias("chunks")] if chunks else []))


class ConcurrentWrite(RuntimeError):
    """Another writer committed since this one read the table."""


BUCKETS = 64


def bucket(n: int = BUCKETS) -> Column:
    """The bucket of a law's rows, whatever their domain."""
    return F.pmod(F.xxhash64("law_id"), F.lit(n)).cast("int")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _generations(spark: SparkSession, root: str) -> list[int]:
    fs, path = _fs(spark, root)
    if not fs.exists(path(root)):
        return []
    return sorted(int(f.getPath().getName()[4:-5]) for f in fs.listStatus(path(root)) if f.getPath().getName().startswith("gen-"))


def _manifest(spark: SparkSession, root: str, generation: int) -> dict[int, str]:
    """The folder of each bucket that has rows."""
    return {int(k): v for k, v in json.loads(spark.read.text(f"{root}/gen-{generation:08d}.json", wholetext=True).first()[0]).items()}


def generation(spark: SparkSession, root: str) -> int:
    """The number of the last commit; 0 before the first."""
    return max(_generations(spark, root), default=0)


def commit(df: DataFrame, root: str, touched: list[int] | None = None, after: int | None = None, buckets: int = BUCKETS, rows_a_file: int = 1 << 20) -> int:
    """Write df beside the current files of root, then name the next generation: readers see all of it or none.

    df holds all rows of the touched buckets (of the whole table where none are named); other buckets keep their files.
    after: the generation that df was made from; if another writer was faster, nothing changes and ConcurrentWrite is raised.
    """
    spark = df.sparkSession
    after = generation(spark, root) if after is None else after
    name = f"v-{uuid.uuid4().hex}"
    # tasks of about equal size: small buckets share one, a large one is split
    df.withColumn("__bucket", bucket(buckets)).hint("rebalance", "__bucket").write.option("maxRecordsPerFile", rows_a_file).partitionBy("__bucket").parquet(f"{root}/{name}")
    fs, path = _fs(spark, root)
    held = {} if touched is None or not after else {k: v for k, v in _manifest(spark, root, after).items() if k not in set(touched)}
    for f in fs.listStatus(path(f"{root}/{name}")):
        if f.getPath().getName().startswith("__bucket="):
            held[int(f.getPath().getName()[9:])] = f"{name}/{f.getPath().getName()}"
    if not held:  # an empty table keeps its schema
        df.limit(0).coalesce(1).write.parquet(f"{root}/{name}/empty")
        held[-1] = f"{name}/empty"
    out = fs.create(path(f"{root}/{name}.json"))
    out.write(bytearray(json.dumps(held).encode()))
    out.close()
    jvm = spark.sparkContext._jvm
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(path(f"{root}/{name}.json"), path(f"{root}/gen-{after + 1:08d}.json"), plain)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            raise ConcurrentWrite(f"generation {after + 1} exists") from e
        raise
    return after + 1


def current(spark: SparkSession, root: str, touched: list[int] | None = None) -> DataFrame | None:
    """The table (or the touched buckets' rows of it) as of the last commit; None before the first."""
    last = generation(spark, root)
    if not last:
        return None
    held = _manifest(spark, root, last)
    folders = [f"{root}/{v}" for k, v in held.items() if touched is None or k in set(touched)]
    if not folders:
        return spark.read.parquet(f"{root}/{next(iter(held.values()))}").limit(0)
    return spark.read.parquet(*folders)


def remove_old(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the files that none of the last generations names; the names of what went."""
    numbers = _generations(spark, root)
    used = {v.split("/")[0] for n in numbers[-keep:] for v in _manifest(spark, root, n).values()}
    fs, path = _fs(spark, root)
    gone = [f.getPath().getName() for f in fs.listStatus(path(root)) if f.getPath().getName().startswith("v-") and f.getPath().getName() not in used]
    gone += [f"gen-{n:08d}.json" for n in numbers[:-keep]]
    for name in gone:
        fs.delete(path(f"{root}/{name}"), True)
    return gone
