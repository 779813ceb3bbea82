"""Package files: JSON lines with a header, records and a footer."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "record_type string, package_id string, source string, law_id string, doc_id string, op string, version_uid string, record_count long, file_id string, chunk_index int, content string, old_name string, new_name string, doc_target string, sha256 string, content_b64 string, reason string, payload string"
# fixed values: types of records
ENDS = ("package_header", "package_footer")
TYPES = ("document", "normalized_chunk", "preprocessed_chunk", "file", "pending_attachment", "delete", "rename")


def parse_records(lines: DataFrame) -> DataFrame:
    """package, line_no, the known fields, body (the line itself) and error of each line that isn't blank.

    A record's law is its law_id, else its doc_id, else, for documents, that of the payload; empty ones are none. Ends
    of packages and renames need no law.
    """
    rows = lines.where(F.trim("body") != "").withColumn("r", F.from_json("body", RECORD))
    rows = rows.select("package", "line_no", "body", "r.*")
    given = lambda c: F.nullif(c, F.lit(""))
    document = F.coalesce(F.col("record_type") == "document", F.lit(False))
    rows = rows.withColumn("law_id", F.coalesce(given(F.col("law_id")), given(F.col("doc_id")), F.when(document, given(F.get_json_object("payload", "$.law_id")))))
    free = F.col("record_type").isin(*ENDS, "rename")
    error = (F.when(F.try_parse_json("body").isNull(), "json_invalid").when(F.col("record_type").isNull(), "record_type_missing")
             .when(~free & F.col("law_id").isNull(), F.when(document, "document_law_missing").otherwise("law_id_missing"))
             .when(~F.col("record_type").isin(*ENDS, *TYPES), "record_type_unknown")
             .when((F.col("record_type") == "file") & F.col("content_b64").isNotNull() & (F.sha2(F.try_to_binary("content_b64", F.lit("base64")), 256) != F.col("sha256")), "sha_mismatch"))
    return rows.withColumn("error", error)


def number_lines(lines: DataFrame) -> DataFrame:
    """package, line_no (from 1) and body of lines that were read in splits (package, block: where the split begins, row: rising within a task, body).

    Every split counts its lines; a line's number is the sum of the splits before its own and its place in that. Only
    the counts, a row a split, meet by package, so that packages of any size are numbered without moving a line. The
    splits are the same for both passes, as long as files and session settings are.
    """
    splits = lines.groupBy("package", "block").agg(F.count("*").alias("n"), F.min("row").alias("first"))

    def before(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        rows["base"] = rows["n"].cumsum() - rows["n"]
        return rows[["package", "block", "first", "base"]]

    kind = lines.schema["block"].dataType.simpleString()
    bases = splits.groupBy("package").applyInPandas(before, f"package string, block {kind}, first long, base long")
    met = lines.join(F.broadcast(bases), ["package", "block"])  # else lines would be shuffled by split, a task for each
    return met.select("package", (F.col("base") + F.col("row") - F.col("first") + 1).alias("line_no"), "body")


def place() -> Column:
    """A split's block in a package of several files, whose names are in the order of its lines."""
    return F.concat_ws("/", "_metadata.file_name", F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"))


def read_lines(spark: SparkSession, paths: str | list[str], glob: str = "*.jsonl") -> DataFrame:
    """package (name of the file), line_no and body of all lines of the files at or below the paths, blank ones too."""
    lines = spark.read.text(paths, recursiveFileLookup=True, pathGlobFilter=glob)
    lines = lines.select(F.col("_metadata.file_name").alias("package"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), F.col("value").alias("body"))
    return number_lines(lines)


def read_packages(spark: SparkSession, path: str | list[str], glob: str = "*.jsonl") -> DataFrame:
    """Records of every package below path. A package is one file, of any size: its lines are read in splits and numbered in order."""
    return parse_records(read_lines(spark, path, glob))


def headers(records: DataFrame) -> DataFrame:
    """First record of each package that isn't blank: its source and id; not a package where it is no header."""
    return records.groupBy("package").agg(F.min_by(F.struct("record_type", "package_id", "source"), "line_no").alias("h")).select("package", "h.*", (F.col("h.record_type") == "package_header").alias("is_package"))


def footers(records: DataFrame) -> DataFrame:
    return records.where("record_type = 'package_footer'").groupBy("package").agg(F.max_by("record_count", "line_no").alias("record_count"))


def law_ids(records: DataFrame) -> DataFrame:
    """Distinct laws of each package in the order in which they come."""
    first = records.where("law_id is not null").groupBy("package", "law_id").agg(F.min("line_no").alias("at"))
    return first.groupBy("package").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "law_id"))), lambda x: x["law_id"]).alias("law_ids"))


def write_packages(records: DataFrame, path: str) -> None:
    """One JSON-lines file for each package: header, records in order, footer with their count.

    records: package, source, ord, record (a JSON string). Packages are written side by side, each sorted within itself.
    """
    counts = records.groupBy("package", "source").agg(F.count("*").alias("n"))
    head = counts.select("package", F.lit(-1).cast("long").alias("ord"), F.to_json(F.struct(F.lit("package_header").alias("record_type"), F.col("package").alias("package_id"), "source")).alias("value"))
    foot = counts.select("package", F.lit((1 << 62)).cast("long").alias("ord"), F.to_json(F.struct(F.lit("package_footer").alias("record_type"), F.col("package").alias("package_id"), F.col("n").alias("record_count"))).alias("value"))
    rows = records.select("package", F.col("ord").cast("long").alias("ord"), F.col("record").alias("value")).unionByName(head).unionByName(foot)
    rows.repartition("package").sortWithinPartitions("package", "ord").select("package", "value").write.partitionBy("package").text(path)
