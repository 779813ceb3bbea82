"""Document payloads: one JSON object a file, read under an explicit schema; what doesn't fit becomes an error row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions import ids, names
from lexspark.functions.text import text_or_null

RELATION = "reference_id string, target_mst string, relation_type string, source_clause string, line_text string, link_text string, target_article_title string, target_url string, resolve_method string, source_admrul_seq string, target_doc_target string, target_doc_kind string, target_git_path string, target_source_repository string, target_repo string, target_git_file_path string, target_git_path_guess string, target_candidates string, target_candidate_paths string, target_missing_unit string"
ARTICLE = f"provision_id string, article_no string, article_title string, chapter string, chapter_path string, content string, enforcement_date string, parent_provision_id string, relations array<struct<{RELATION}>>, scheduled array<struct<enforcement_date string, change string, content string>>, images array<struct<url string, seq int, filename string>>"
ADDENDUM = "promulgation_date string, promulgation_no string, content string, enforcement_date string, is_future boolean"
APPENDIX = "no string, branch string, kind string, title string, content string, is_file_only boolean, files array<struct<type string, url string, name string>>, file_url string, view_url string, filename string, local_path string, provision_id string, appendix_instance_id string, enforcement_date string"
PAYLOAD = (
    "law_id string, mst string, version_uid string, adm_uid string, doc_target string, doc_kind string, law_name string, law_abbr string, law_type string, promulgation_date string, enforcement_date string,"
    " revision_date string, revision_type string, is_current boolean, is_future boolean, promulgation_no string, amendment_text string, revision_reason string, future_enforcement_dates array<string>,"
    f" basic_info variant, source struct<source_url string, git_commit string>, body struct<format string, article_count int, articles array<struct<{ARTICLE}>>>, addenda array<struct<{ADDENDUM}>>,"
    f" appendices array<struct<{APPENDIX}>>, attachments array<struct<name string, url string, filename string, local_path string>>,"
    " ordinance_delegations array<struct<source_article_no string, link_text string, ordinance_count int, ordinances array<string>>>, addendum_provision_id string, amendment_provision_id string, repealed boolean, repeal_scheduled boolean, repealed_at string"
)


def parse_documents(raw: DataFrame, text: str = "value") -> DataFrame:
    """raw with `doc` (a payload struct) and `error`: json_invalid, json_not_object, law_id_missing, body_missing or null."""
    doc = raw.withColumn("doc", F.from_json(F.col(text), PAYLOAD, {"mode": "PERMISSIVE"})).withColumn("__v", F.try_parse_json(F.col(text)))
    error = (F.when(F.col("__v").isNull(), "json_invalid").when(~F.startswith(F.schema_of_variant("__v"), F.lit("OBJECT")), "json_not_object")
             .when(F.coalesce(F.trim("doc.law_id"), F.lit("")) == "", "law_id_missing").when(F.col("doc.body").isNull(), "body_missing"))
    return doc.withColumn("error", error).drop("__v")


def validate(files: DataFrame, text: str = "value") -> DataFrame:
    """files (path, value) of a delivery as documents: law_id, source, repealed, version_uid, hash, warning and the first error that applies.

    The top folder is the source (law or admrul). In order: json_invalid, json_not_object, law_id_missing (a repealed
    document may give it by its doc_uid), law_id_not_string, source_unknown, doc_target_unknown, source_mismatch and
    mapping_failed (a body that is no object, or no version). Repealed documents need no body.
    """
    v = F.try_parse_json(F.regexp_replace(text, "^\ufeff", ""))
    rows = files.withColumn("__v", v)
    get = lambda name: F.try_variant_get("__v", f"$.{name}", "string")
    kind = lambda name: F.schema_of_variant(F.try_variant_get("__v", f"$.{name}", "variant"))
    repealed = F.coalesce(F.try_variant_get("__v", "$.repealed", "boolean") & (kind("repealed") == "BOOLEAN"), F.lit(False))
    blank = F.trim(F.coalesce(get("law_id"), F.lit(""))) == ""
    by_uid = F.when(repealed & blank, names.law_id_of(get("doc_uid")))
    top = F.split("path", "/")[0]
    source = F.when((F.size(F.split("path", "/")) > 1) & top.isin("law", "admrul"), top)
    law_id = F.coalesce(by_uid, F.when(~blank, F.trim(get("law_id"))))
    implied = names.implied_source(get("doc_target"), law_id)
    home = F.when(implied == "law", "law").when(implied.isin("admrul", "schlpub"), "admrul")
    version = F.coalesce(text_or_null(get("version_uid")), F.when(source == "admrul", ids.admin_rule_version(get("adm_uid"), get("revision_date"), get("enforcement_date"))))
    body = F.startswith(kind("body"), F.lit("OBJECT"))
    error = (F.when(F.col("__v").isNull(), "json_invalid").when(~F.startswith(F.schema_of_variant("__v"), F.lit("OBJECT")), "json_not_object").when(blank & by_uid.isNull(), "law_id_missing")
             .when(by_uid.isNull() & (kind("law_id") != "STRING"), "law_id_not_string").when(source.isNull(), "source_unknown").when(by_uid.isNotNull() & (source != "law"), "source_mismatch")
             .when(by_uid.isNull() & (implied == "?"), "doc_target_unknown").when(by_uid.isNull() & (home != source), "source_mismatch").when(~repealed & (~F.coalesce(body, F.lit(False)) | version.isNull()), "mapping_failed"))
    return rows.select(*files.columns, law_id.alias("law_id"), source.alias("source"), repealed.alias("repealed"), version.alias("version_uid"), canonical_hash(F.col("__v")).alias("hash"),
                       F.when(by_uid.isNotNull() & error.isNull(), "law_id_from_doc_uid").alias("warning"), error.alias("error"))


def canonical_hash(v: Column) -> Column:
    """SHA-256 of a JSON value whatever its layout and its keys' order: VARIANT keeps keys sorted."""
    return F.sha2(F.to_json(v), 256)


SKIPPED = ("_manifest.json",)


def read_documents(spark: SparkSession, path: str, glob: str = "*.json", limit: int | None = None, skip: tuple[str, ...] = SKIPPED) -> DataFrame:
    """path, doc and error of every file below path but those of the names to skip; limit takes the first files by path, whose names alone are listed for that."""
    name = F.element_at(F.split("path", "/"), -1)
    if limit is not None:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path").where(~name.isin(*skip))
        chosen = [r["path"] for r in listed.orderBy("path").limit(limit).collect()]
        files = spark.read.text(chosen, wholetext=True) if chosen else None
    else:
        files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    if files is None:
        return parse_documents(spark.createDataFrame([], "path string, value string")).drop("value")
    return parse_documents(files.select(F.col("_metadata.file_path").alias("path"), "value").where(~name.isin(*skip))).drop("value")
