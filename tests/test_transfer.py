"""Exports, loads and checks of a vector table by its digest tree."""

import glob
import json
import shutil

import pytest
from pyspark.sql import functions as F

from lexspark.operators import transfer as tf


def table(spark, n=2000):
    return spark.range(n).select(F.col("id").cast("string").alias("uuid"), F.array(F.col("id") * 0.5, F.lit(1.0)).cast("array<float>").alias("vector"), F.format_string('{"n":%d}', "id").alias("props"))


def faults(df):
    return {r["uuid"]: r["fault"] for r in df.collect()}


def test_one_changed_vector_reads_one_leaf(spark, tmp_path):
    rows, a, b = table(spark), f"{tmp_path}/a", f"{tmp_path}/b"
    assert tf.export(rows, a, 8) == 8
    assert len(glob.glob(f"{a}/rows/leaf=*")) == 256
    tf.export(rows.withColumn("vector", F.when(F.col("uuid") == "77", F.array(F.lit(9.0), F.lit(1.0)).cast("array<float>")).otherwise(F.col("vector"))), b, 8)
    (leaf,) = tf.unequal_leaves(spark, a, b)
    assert faults(tf.verify(spark, a, b)) == {"77": "vector"}
    assert tf.unequal_leaves(spark, a, a) == [] and tf.verify(spark, a, a).count() == 0
    assert tf.summary(spark, a, b).first().asDict() == {"exported": 2000, "stored": 2000, "missing": 0, "extra": 0, "vector": 1, "props": 0}
    for f in glob.glob(f"{tmp_path}/?/rows/leaf=*"):  # rows of equal leaves aren't read
        if not f.endswith(f"leaf={leaf}"):
            shutil.rmtree(f)
    assert faults(tf.verify(spark, a, b)) == {"77": "vector"}


def test_many_unequal_leaves_are_joined(spark, tmp_path):
    rows, a, b = table(spark, 300), f"{tmp_path}/a", f"{tmp_path}/b"
    tf.export(rows, a, 8)
    tf.export(rows.where("uuid % 3 <> 0").withColumn("props", F.when(F.col("uuid") % 3 == 1, F.lit("{}")).otherwise(F.col("props"))).unionByName(rows.limit(1).withColumn("uuid", F.lit("new"))), b, 8)
    want = {str(k): "missing" if k % 3 == 0 else "props" for k in range(300) if k % 3 != 2} | {"new": "extra"}
    assert faults(tf.verify(spark, a, b)) == want
    assert faults(tf.verify(spark, a, b, wide=3)) == want


def test_a_load_goes_on_where_it_stopped(spark, tmp_path):
    rows, a, b = table(spark), f"{tmp_path}/a", f"{tmp_path}/b"
    tf.export(rows, a, 4)
    done = sorted(r[0] for r in tf.rows_of(spark, a).select("leaf").distinct().collect())
    tf._write(tf.rows_of(spark, a).where(F.col("leaf").isin(done[:10])), b)  # ten leaves, then it was stopped
    old = set(glob.glob(f"{b}/rows/leaf=*/*.parquet"))
    assert tf.load(spark, a, b, wave=4) == len(done) - 10
    assert old <= set(glob.glob(f"{b}/rows/leaf=*/*.parquet"))
    assert tf.unequal_leaves(spark, a, b) == [] and tf.rows_of(spark, b).count() == 2000
    assert tf.load(spark, a, b) == 0


def test_rows_of_the_target_are_replaced_or_stay(spark, tmp_path):
    a, b, c = (f"{tmp_path}/{x}" for x in "abc")
    tf.export(table(spark, 50), a, 4)
    tf.load(spark, a, b)
    tf.export(table(spark, 60).where("uuid >= 40").withColumn("props", F.lit("{}")), c, 4)
    tf.load(spark, c, b)
    tf.load(spark, c, b)
    got = {r["uuid"]: r["props"] for r in tf.rows_of(spark, b).collect()}
    assert got == {str(k): f'{{"n":{k}}}' if k < 40 else "{}" for k in range(60)} and tf.rows_of(spark, b).count() == 60
    assert set(faults(tf.verify(spark, c, b)).values()) == {"extra"}


def test_damage_and_unfinished_exports_are_refused(spark, tmp_path):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    tf.export(table(spark, 20), a, 4)
    rows = tf.rows_of(spark, a)
    tf._write(spark.createDataFrame(rows.collect(), rows.schema).withColumn("vector", F.when(F.col("uuid") == "7", F.array(F.lit(0.25).cast("float"))).otherwise(F.col("vector"))), a)
    tf.export(table(spark, 20), b, 4)
    assert tf.verify(spark, a, b).count() == 0  # digests of the files say nothing of it
    with pytest.raises(Exception, match="damaged row in export: 7"):
        tf.load(spark, a, f"{tmp_path}/c")
    tf.seal(spark, a, 4, deep=True)
    assert faults(tf.verify(spark, a, b)) == {"7": "vector"}
    with pytest.raises(ValueError, match="unfinished"):
        tf.load(spark, f"{tmp_path}/none", b)
    with pytest.raises(ValueError, match="different depth"):
        tf.export(table(spark, 20), f"{tmp_path}/d", 8)
        tf.verify(spark, a, f"{tmp_path}/d")


def test_empty_tables_and_odd_rows(spark, tmp_path):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    tf.export(table(spark, 0), a)
    assert tf.load(spark, a, b) == 0 and tf.verify(spark, a, b).count() == 0 and tf.rows_of(spark, b).count() == 0
    odd = spark.sql("select 1 as id, array(1.0, null) as v, date'2026-01-02' as d, timestamp'2026-01-02 03:04:05' as t, map('k', timestamp'2026-01-02 03:04:05') as m, null as z union all select 2, null, null, null, null, null union all select 3, array(), null, null, null, null")
    got = tf.portable(odd, ["d", "t", "m", "z"], "id", "v").collect()
    assert [r["uuid"] for r in got] == ["1"]
    assert json.loads(got[0]["props"]) == {"d": "2026-01-02T00:00:00Z", "t": "2026-01-02T03:04:05Z", "m": {"k": "2026-01-02T03:04:05Z"}, "z": None}
    assert tf.bits_for(1 << 21) == 4 and tf.bits_for((1 << 21) + 1) == 8
    bad = spark.createDataFrame([("1", [1.0], '{"n": "x"}'), ("2", [1.0], '{"n": 2, "more": 1}'), ("3", [1.0], "no"), ("4", [1.0], None)], "uuid string, vector array<float>, props string")
    assert [(r["n"], r["fault"]) for r in tf.typed(bad, "n int").orderBy("uuid").collect()] == [(None, '{"n": "x"}'), (2, None), (None, "no"), (None, None)]
