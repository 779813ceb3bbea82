"""Scope: which documents a configured list of names and ministries admits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions.text import compact_key


def _keys(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("__key", compact_key(F.col(column)))


def entries(spark, names: list[str]) -> DataFrame:
    """A configured list as rows; an empty list is an error, not an open gate."""
    if not names:
        raise ValueError("empty scope")
    return spark.createDataFrame([(n,) for n in names], "entry string")


def gate(rows: DataFrame, names: list[str], ministries: list[str], name_col: str = "law_name", ministry_col: str = "ministry") -> DataFrame:
    """rows admitted by name or by any of their ministries (several are split at commas and semicolons), with by_name and by_ministry."""
    spark = rows.sparkSession
    keys = lambda given: F.array(*[compact_key(F.lit(x)) for x in given])
    entries(spark, names + ministries)
    own = F.filter(F.transform(F.split(F.coalesce(F.col(ministry_col), F.lit("")), "[,;]"), compact_key), lambda x: x != "")
    by_name = F.array_contains(keys(names), compact_key(F.col(name_col))) if names else F.lit(False)
    by_ministry = F.arrays_overlap(keys(ministries), own) if ministries else F.lit(False)
    return rows.withColumns({"by_name": by_name, "by_ministry": by_ministry}).where("by_name or by_ministry")


def unmatched(rows: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Entries of the list, as they were written, that no row bears."""
    seen = _keys(rows, column).select("__key").distinct()
    return _keys(entries(rows.sparkSession, names), "entry").join(seen, "__key", "left_anti").select("entry")
