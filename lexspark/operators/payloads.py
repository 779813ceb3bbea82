"""What packages and change sets bring besides whole documents: inherited metadata, chunks made elsewhere, parsed files, and payloads by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions import ids, text
from lexspark.operators import units
from lexspark.sources import documents

NORMAL = "content string, chunk_index int, metadata struct<provision_id string, parent_provision_id string, unit_type string, unit_no string, unit_title string, chapter string>"
PARSED = "file_id string, content string, chunk_index int, metadata struct<provision_id string, parent_provision_id string, unit_type string, unit_no string, unit_title string, file_name string, file_url string, source_file_path string, page_no int>"
ATTACHMENT = "version_uid string, law_id string, mst string, law_name string, law_type string, doc_target string, provision_id string, parent_provision_id string, file_id string, file_name string, file_url string, unit_type string, unit_no string, unit_title string, file_kind string, git_path string, chunks array<struct<chunk_id string, content string, chunk_index int, page_no int>>"
CHANGE = "op string, source string, law_id string, doc_id string, git_path string"


def law_meta(folded: DataFrame, source: str = "law") -> DataFrame:
    """folded (law_id, document: a record with its payload) with the metadata that a law's chunks and files inherit.

    Without a payload there is the law_id alone. Rules without a version get the one that their documents are stored with.
    """
    payload = F.from_json(F.get_json_object("document", "$.payload"), documents.PAYLOAD)
    rows = folded.withColumnsRenamed({"law_id": "__law"}).withColumn("doc", payload).withColumn("path", F.coalesce(F.get_json_object("document", "$.git_path"), F.get_json_object("document", "$.payload.git_path"), F.concat(F.lit("package:"), "__law")))
    out = units.with_common(rows, source)
    made = ids.admin_rule_version(F.col("doc.adm_uid"), F.col("doc.revision_date"), F.col("doc.enforcement_date"))
    return out.withColumns({"law_id": F.coalesce("law_id", "__law"), "version_uid": F.coalesce("version_uid", made), "enforcement_date": text.iso_date(F.col("doc.enforcement_date")), "domain": F.coalesce("domain", F.lit(source))}).drop("__law", "path", "doc_base")


def normalized_chunks(laws: DataFrame) -> DataFrame:
    """Rows of chunks that came ready made: laws (as law_meta gives them, with normalized: records in order)."""
    meta = [*units.COMMON, "enforcement_date"]
    rows = laws.select(*meta, F.size("normalized").alias("chunk_count"), F.posexplode("normalized").alias("pos", "record")).withColumn("r", F.from_json("record", NORMAL))
    m = lambda c: F.col(f"r.metadata.{c}")
    content = F.coalesce("r.content", F.lit(""))
    rows = rows.select(*meta, "chunk_count", F.coalesce("r.chunk_index", "pos").alias("chunk_index"), m("provision_id").alias("provision_id"), m("parent_provision_id").alias("parent_provision_id"),
                       F.coalesce(F.nullif(m("unit_type"), F.lit("")), F.lit("ARTICLE")).alias("unit_type"), m("unit_no").alias("unit_no"), m("unit_title").alias("unit_title"), m("chapter").alias("chapter"), content.alias("content"))
    search = text.search_text(*[F.col(c) for c in ("law_name", "law_type", "chapter", "unit_no", "unit_title", "content")])
    return rows.withColumns({"source_type": F.lit("JSON"), "search_text": search, "content_hash": F.sha2("content", 256), "reference_ids": F.array().cast("array<string>"),
                             "chunk_id": ids.normal_chunk_id(F.col("version_uid"), F.nullif("provision_id", F.lit("")), F.col("unit_no"), F.col("unit_type"), F.col("chunk_index"))})


def parsed_files(laws: DataFrame) -> DataFrame:
    """Files whose chunks came as records: laws (as law_meta gives them, with preprocessed: records in order), one row a file, ready for units.file_chunks.

    A file's metadata are those of its first record.
    """
    rows = laws.select(*units.COMMON, "enforcement_date", F.posexplode("preprocessed").alias("pos", "record")).withColumn("r", F.from_json("record", PARSED)).withColumn("file_id", F.coalesce(F.nullif("r.file_id", F.lit("")), F.lit("ATTACHMENT")))
    chunk = F.struct("pos", F.struct(F.coalesce("r.content", F.lit("")).alias("content"), F.col("r.chunk_index").alias("chunk_index"), F.col("r.metadata.page_no").alias("page_no")).alias("c"))
    out = rows.groupBy(*units.COMMON, "enforcement_date", "file_id").agg(F.min_by("r.metadata", "pos").alias("m"), F.transform(F.array_sort(F.collect_list(chunk)), lambda x: x["c"]).alias("chunks"))
    kept = ("provision_id", "parent_provision_id", "unit_type", "unit_no", "file_name", "file_url", "source_file_path")
    return out.select(*units.COMMON, "enforcement_date", "file_id", "chunks", *[F.col(f"m.{c}").alias(c) for c in kept], F.coalesce("m.unit_title", "m.file_name").alias("unit_title"))


def read_attachments(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Attachments chunked elsewhere, one JSON object a file: its fields, domain and error (json_invalid or chunks_missing); good rows are ready for units.file_chunks."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob).select(F.col("_metadata.file_path").alias("path"), "value")
    return parse_attachments(files)


def parse_attachments(files: DataFrame) -> DataFrame:
    v = F.try_parse_json("value")
    rows = files.withColumn("a", F.from_json("value", ATTACHMENT)).withColumn("many", F.startswith(F.schema_of_variant(F.try_variant_get(v, "$.chunks", "variant")), F.lit("ARRAY")))
    error = F.when(v.isNull(), "json_invalid").when(~F.coalesce("many", F.lit(False)), "chunks_missing")
    chunks = F.filter("a.chunks", lambda c: c.isNotNull())
    return rows.select("path", *[F.col(f"a.{c}").alias(c) for c in spark_names(ATTACHMENT) if c not in ("chunks", "git_path", "unit_title")], F.coalesce("a.git_path", "path").alias("git_path"), F.coalesce("a.unit_title", "a.file_name").alias("unit_title"),
                       chunks.alias("chunks"), ids.domain(F.col("a.doc_target"), F.lit("law")).alias("domain"), error.alias("error"))


def spark_names(ddl: str) -> list[str]:
    """Top-level column names of a DDL string."""
    depth, out = 0, [""]
    for c in ddl:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.split()[0] for x in out]


def changes(lines: DataFrame, docs: DataFrame, source: str = "law") -> DataFrame:
    """Change-set lines (line_no, body) as changes: op, law_id, domain, payload (JSON) and error.

    A change without payload takes it from docs (git_path, value). A delete without law_id is refused, so is an upsert
    with neither payload nor path, or whose path isn't there.
    """
    rows = lines.where(F.trim("body") != "").withColumn("r", F.from_json("body", CHANGE)).withColumn("own", F.get_json_object("body", "$.payload"))
    rows = rows.select("line_no", F.try_parse_json("body").isNull().alias("bad"), F.coalesce("r.law_id", "r.doc_id").alias("law_id"), F.coalesce("r.op", F.lit("upsert")).alias("op"), "r.git_path", F.coalesce("r.source", F.lit(source)).alias("source"), "own")
    # changes that take nothing from docs have no path in common, so that they are spread by their lines
    asks = F.col("git_path").isNotNull() & F.col("own").isNull() & (F.col("op") != "delete")
    rows = rows.withColumn("__asks", asks).withColumn("__key", F.when(asks, F.col("git_path")).otherwise(F.col("line_no").cast("string")))
    read = docs.select(F.col("git_path").alias("__path"), F.col("value").alias("__value"), F.lit(True).alias("__there"))
    rows = rows.join(read, (F.col("__key") == F.col("__path")) & (F.col("__asks") == F.col("__there")), "left")
    payload = F.coalesce("own", "__value")
    target = F.get_json_object(payload, "$.doc_target")
    error = (F.when(F.col("bad"), "json_invalid").when((F.col("op") == "delete") & F.col("law_id").isNull(), "law_id_missing").when((F.col("op") != "delete") & payload.isNull(), F.when(F.col("git_path").isNull(), "payload_missing").otherwise("path_missing")))
    return rows.select("line_no", "op", "law_id", ids.route(F.when(F.col("op") != "delete", target), F.col("law_id"), F.col("source")).alias("domain"), F.when(F.col("op") != "delete", payload).alias("payload"), "git_path", error.alias("error"))
