"""Moving a vector table: exports in leaves of a digest tree, imports that go on where they stopped, checks of unequal leaves alone.

An export (and an imported table) is a folder: `rows`, Parquet by leaf (the first bits of the hash of the id) with each
row's two 64-bit digests, and `tree`, the digests of all nodes by depth, written last. A node's digest is of its rows
in any order: their number, the exclusive ors of their digests and a sum. A tree is made from the digest columns, so
vectors aren't read for it; two tables are told apart from the root down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.operators.store import compare_exports, upsert

STEP = 4  # bits from one depth to the next
WIDE = 4096  # unequal nodes that the driver follows
DIGITS = 6
TOTALS = ["n", "a", "b", "s"]
_TIMES = {"dateFormat": "yyyy-MM-dd'T00:00:00Z'", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "timeZone": "UTC", "ignoreNullFields": "false"}


def portable(rows: DataFrame, props: list[str], uuid: str = "uuid", vector: str = "vector") -> DataFrame:
    """uuid, vector (floats) and props (one JSON object, nulls kept, dates and times as RFC 3339 in UTC) of the rows that have a vector."""
    return rows.where(F.size(vector) > 0).select(F.col(uuid).cast("string").alias("uuid"), F.col(vector).cast("array<float>").alias("vector"), F.to_json(F.struct(*props), _TIMES).alias("props"))


def typed(rows: DataFrame, schema: str) -> DataFrame:
    """uuid, vector and the columns of schema read from props; `fault` is the text of props that isn't a JSON object of that schema, else null."""
    found = F.from_json("props", f"{schema}, __bad string", _TIMES | {"columnNameOfCorruptRecord": "__bad"})
    out = rows.withColumn("__p", found)
    names = [f.name for f in out.schema["__p"].dataType.fields if f.name != "__bad"]
    return out.select("uuid", "vector", *[F.col("__p")[n].alias(n) for n in names], F.col("__p")["__bad"].alias("fault"))


def bits_for(rows: int, leaf: int = 1 << 17) -> int:
    """Bits of the leaf's number: whole steps, so that a leaf has about `leaf` rows at most."""
    bits = STEP
    while rows > leaf << bits:
        bits += STEP
    return bits


def _digests(rows: DataFrame) -> DataFrame:
    """rows with d1 and d2: hashes of the id, the vector's rounded numbers and the properties."""
    held = [F.col("uuid"), F.transform("vector", lambda x: F.round(x.cast("double"), DIGITS)), F.col("vector").isNull(), F.col("props"), F.col("props").isNull()]
    return rows.withColumns({"d1": F.xxhash64(*held), "d2": F.xxhash64(F.lit(1), *held)})


def _leaf(bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64("uuid"), 64 - bits)


def _write(rows: DataFrame, path: str, most: int = 1 << 20) -> None:
    """Leaf by leaf: tasks of about equal size, however full a leaf is; other leaves of the folder stay."""
    (rows.hint("rebalance", "leaf").write.partitionBy("leaf").option("compression", "zstd").option("maxRecordsPerFile", most)
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{path}/rows"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def rows_of(spark: SparkSession, path: str) -> DataFrame:
    """uuid, vector, props, d1, d2 and leaf of an export or imported table."""
    return spark.read.schema("uuid string, vector array<float>, props string, d1 long, d2 long, leaf long").parquet(f"{path}/rows")


def _sums(rows: DataFrame, *keys: str, fresh: bool) -> DataFrame:
    n, s = (F.count("*"), F.sum(F.col("d1").bitwiseAND(F.lit((1 << 24) - 1)))) if fresh else (F.sum("n"), F.sum("s"))
    a, b = ("d1", "d2") if fresh else ("a", "b")
    return rows.groupBy(*keys).agg(n.alias("n"), F.bit_xor(a).alias("a"), F.bit_xor(b).alias("b"), s.alias("s"))


def seal(spark: SparkSession, path: str, bits: int, deep: bool = False) -> None:
    """Write the tree of the rows as they are. deep: digests are made anew from ids, vectors and properties, not taken from the files."""
    rows = rows_of(spark, path)
    leaves = _sums(_digests(rows) if deep else rows, "leaf", fresh=True)
    at = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), F.shiftright("leaf", bits - d).alias("node")) for d in range(0, bits + 1, STEP)]))
    nodes = _sums(leaves.select(*TOTALS, at.alias("at")).select("at.depth", "at.node", *TOTALS), "depth", "node", fresh=False)
    nodes.repartitionByRange("depth", "node").sortWithinPartitions("depth", "node").write.partitionBy("depth").mode("overwrite").parquet(f"{path}/tree")


def tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("node long, n long, a long, b long, s long, depth int").parquet(f"{path}/tree")


def depth_of(spark: SparkSession, path: str) -> int:
    """The bits of an export's leaves; ValueError where there is no tree, as the export didn't end. A table without rows has STEP."""
    if not _exists(spark, f"{path}/tree"):
        raise ValueError(f"no tree in {path}: the export is unfinished")
    return tree(spark, path).agg(F.max("depth")).first()[0] or STEP


def export(rows: DataFrame, path: str, bits: int | None = None) -> int:
    """Write portable rows (uuid, vector, props) to path, a new folder, and then their tree. The bits of the leaves."""
    spark = rows.sparkSession
    bits = bits or bits_for(rows.count())
    if bits % STEP or not STEP <= bits <= 32:
        raise ValueError(f"bits are a multiple of {STEP} up to 32")
    _write(_digests(rows.select("uuid", "vector", "props")).withColumn("leaf", _leaf(bits)), path)
    seal(spark, path, bits)
    return bits


def _unequal(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Numbers of the nodes that one side lacks or whose totals differ."""
    same = F.lit(True)
    for c in TOTALS:
        same = same & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    return a.alias("x").join(b.alias("y"), F.col(f"x.{on}") == F.col(f"y.{on}"), "full_outer").where(~same).select(F.coalesce(f"x.{on}", f"y.{on}").alias("leaf"))


def unequal_leaves(spark: SparkSession, a: str, b: str, wide: int = WIDE) -> DataFrame | list[int]:
    """Leaves in which two sealed tables differ: numbers, found from the root down; a DataFrame of them where more than `wide` nodes of a depth differ."""
    bits = depth_of(spark, a)
    if bits != depth_of(spark, b):
        raise ValueError("trees of different depth: export one side anew with the other's bits")
    one, two = tree(spark, a), tree(spark, b)
    found: list[int] = [0]
    for d in range(0, bits + 1, STEP):
        below = (F.col("depth") == d) & F.shiftright("node", STEP).isin(found) if d else F.col("depth") == 0
        found = [r[0] for r in _unequal(one.where(below), two.where(below), "node").limit(wide + 1).collect()]
        if len(found) > wide:
            return _unequal(one.where(F.col("depth") == bits), two.where(F.col("depth") == bits), "node")
        if not found:
            break
    return sorted(found)


def verify(spark: SparkSession, a: str, b: str, wide: int = WIDE) -> DataFrame:
    """uuid and fault (missing in b, extra in b, vector, props) of rows in which two sealed tables differ; rows of equal leaves aren't read."""
    leaves = unequal_leaves(spark, a, b, wide)
    rows = [rows_of(spark, p) for p in (a, b)]
    if isinstance(leaves, DataFrame):
        return compare_exports(*[r.join(leaves, "leaf", "left_semi") for r in rows], DIGITS)
    return compare_exports(*[r.where(F.col("leaf").isin(leaves)) for r in rows], DIGITS)


def summary(spark: SparkSession, a: str, b: str) -> DataFrame:
    """One row: numbers of rows of both sides, and of each fault."""
    size = lambda p: tree(spark, p).where("depth = 0").agg(F.sum("n")).first()[0] or 0
    faults = [F.count_if(F.col("fault") == f).alias(f) for f in ("missing", "extra", "vector", "props")]
    return verify(spark, a, b).agg(F.lit(size(a)).cast("long").alias("exported"), F.lit(size(b)).cast("long").alias("stored"), *faults)


def load(spark: SparkSession, source: str, target: str, wave: int = 64) -> int:
    """Bring target (a new folder, or one that an earlier load began or filled) up to the export in source; the number of leaves written.

    Leaves are written in waves, each a job that commits. A load that was stopped goes on with the leaves that aren't
    equal yet, told by the digest columns of what target holds. A row of target with an id of the export is replaced,
    other rows stay (their leaf differs, so a later load merges it again, to the same rows). A row whose content doesn't
    give the digests that the export noted stops the load; a source without tree is refused, as its export didn't end.
    """
    bits = depth_of(spark, source)
    wanted = tree(spark, source).where(F.col("depth") == bits).withColumnRenamed("node", "leaf").drop("depth")
    held = None
    if _exists(spark, f"{target}/rows"):
        held = rows_of(spark, target)
        have = _sums(held, "leaf", fresh=True)
        same = [F.col(f"w.{c}") == F.col(f"h.{c}") for c in ("leaf", *TOTALS)]
        wanted = wanted.alias("w").join(have.alias("h"), same, "left_anti")
    todo = sorted(r[0] for r in wanted.select("leaf").collect())  # numbers of leaves, one for some 2^17 rows
    for k in range(0, len(todo), wave):
        some = F.col("leaf").isin(todo[k : k + wave])
        read = rows_of(spark, source).where(some).withColumnsRenamed({"d1": "was1", "d2": "was2"})
        kept = (F.col("d1") == F.col("was1")) & (F.col("d2") == F.col("was2"))
        damaged = F.raise_error(F.concat(F.lit("damaged row in export: "), F.coalesce("uuid", F.lit("null")))).cast("long")
        fresh = _digests(read).withColumn("d1", F.when(kept, F.col("d1")).otherwise(damaged)).select("uuid", "vector", "props", "d1", "d2", "leaf")
        _write(fresh if held is None else upsert(held.where(some), fresh).select(*fresh.columns), target)
    if not todo and held is None:  # an empty export gives an empty table
        _write(rows_of(spark, source), target)
    seal(spark, target, bits)
    return len(todo)
