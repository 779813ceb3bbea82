"""States of deliveries and their files: what each is next, and where files that documents name lie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions import names
from lexspark.functions.text import IMAGE_MARK
from lexspark.operators import packages as pk
from lexspark.operators import units

# fixed values: states of a delivery
LOADING, DONE, PARTIAL, FAILED, DUPLICATE, BLOCKED = "loading", "done", "partial", "failed", "duplicate", "blocked"


def final_state(accepted: Column, rejected: Column, zip_errors: Column) -> Column:
    """struct of state and reason of a delivery that was loaded: done without refusals, partial with some, failed where all was refused."""
    good = (F.coalesce(rejected, F.lit(0)) == 0) & (F.coalesce(zip_errors, F.lit(0)) == 0)
    none = F.lit(None).cast("string")
    return F.when(good, F.struct(F.lit(DONE).alias("state"), none.alias("reason"))).when(F.coalesce(accepted, F.lit(0)) == 0, F.struct(F.lit(FAILED).alias("state"), F.lit("all_rejected").alias("reason"))).otherwise(F.struct(F.lit(PARTIAL).alias("state"), none.alias("reason")))


def next_states(zips: DataFrame, log: DataFrame, packages: DataFrame) -> DataFrame:
    """zips (zip, sha256, convert_error, accepted, rejected, zip_errors) with `state` and `reason` after this run.

    log: sha256, zip, state of earlier runs; packages: zip, status (ok, pending or failed). A file whose content was done
    before, or comes earlier by name, is a duplicate. A conversion error fails the file, so does a quarantined package; one
    that waits keeps it loading. Files go by name: behind one that is loading the others are blocked until the next run.
    """
    done = log.where(F.col("state").isin(DONE, PARTIAL)).select("sha256").distinct().withColumn("__done", F.lit(True))
    p = packages.groupBy("zip").agg(F.coalesce(F.bool_or(F.col("status") == "pending"), F.lit(False)).alias("__pending"), F.coalesce(F.bool_or(F.col("status") == "failed"), F.lit(False)).alias("__failed"))
    first = zips.groupBy("sha256").agg(F.min("zip").alias("__first"))
    rows = zips.join(done, "sha256", "left").join(first, "sha256").join(p, "zip", "left")
    s = lambda state, reason: F.struct(F.lit(state).alias("state"), (reason if isinstance(reason, Column) else F.lit(reason).cast("string")).alias("reason"))
    end = (F.when(F.col("__done").isNotNull() | (F.col("zip") != F.col("__first")), s(DUPLICATE, None)).when(F.col("convert_error").isNotNull(), s(FAILED, F.col("convert_error"))).when(F.col("__pending"), s(LOADING, None))
           .when(F.col("__failed"), s(FAILED, "load_failed")).otherwise(final_state(F.col("accepted"), F.col("rejected"), F.col("zip_errors"))))
    rows = rows.withColumn("__s", end)
    stop = rows.agg(F.min(F.when(F.col("__s.state") == LOADING, F.col("zip"))).alias("__stop"))  # one row
    late = F.coalesce(F.col("zip") > F.col("__stop"), F.lit(False))
    return rows.join(F.broadcast(stop)).select(*zips.columns, F.when(late, BLOCKED).otherwise(F.col("__s.state")).alias("state"), F.when(~late, F.col("__s.reason")).alias("reason"))


def conversion_states(zips: DataFrame, published: DataFrame, errors: DataFrame) -> DataFrame:
    """zips (zip, sha256, manifest: whether it came) with what their conversion is: pending_manifest, skipped (the same content was published), failed (any document is) or converted."""
    p = published.select("zip", F.col("sha256").alias("__sha")).distinct()
    e = errors.groupBy("zip").agg(F.count("*").alias("errors"))
    state = F.when(~F.col("manifest"), "pending_manifest").when(F.col("__sha") == F.col("sha256"), "skipped").when(F.col("errors") > 0, FAILED).otherwise("converted")
    return zips.join(p, "zip", "left").join(e, "zip", "left").withColumn("errors", F.coalesce("errors", F.lit(0).cast("long"))).withColumn("state", state).drop("__sha")


def file_outcomes(records: DataFrame, inbox: DataFrame, parsed: DataFrame, enabled: bool = True) -> DataFrame:
    """What becomes of file records (law_id, file_id, file_name, transfer_name, content_b64, sha256): `outcome` parsed or pending, its reason, and whether the package's run has an error by it.

    inbox: transfer_name, sha256 of delivered files; parsed: file_id, code, message of the parser's refusals (none: it
    worked). In order: internal_preprocess_disabled, b64_decode_failed, file_missing_in_inbox, sha256_mismatch,
    unsupported_source_file (trying again is no use, no error), preprocess_failed.
    """
    own = F.col("content_b64").isNotNull() & (F.col("content_b64") != "")
    data = F.try_to_binary("content_b64", F.lit("base64"))
    there = inbox.groupBy(F.col("transfer_name").alias("__name")).agg(F.max("sha256").alias("__sha"))
    refused = parsed.groupBy("file_id").agg(F.max("code").alias("__code"), F.max("message").alias("__message"))
    name = names.without_forbidden(F.coalesce("transfer_name", "file_name"))
    rows = records.withColumn("__own", own).join(there, F.when(~own, name) == F.col("__name"), "left").join(refused, "file_id", "left")
    found = F.when(F.col("__own"), F.sha2(data, 256)).otherwise(F.col("__sha"))
    reason = (F.when(~F.lit(enabled), "internal_preprocess_disabled").when(F.col("__own") & data.isNull(), "b64_decode_failed").when(~F.col("__own") & F.col("__name").isNull(), "file_missing_in_inbox")
              .when((F.coalesce("sha256", F.lit("")) != "") & (F.col("sha256") != found), "sha256_mismatch").when(pk.is_permanent_parser_error(F.col("__code"), F.col("__message")), "unsupported_source_file").when(F.col("__code").isNotNull(), "preprocess_failed"))
    out = rows.withColumn("reason", reason)
    failed = F.coalesce(F.col("reason").isin("b64_decode_failed", "file_missing_in_inbox", "sha256_mismatch", "preprocess_failed"), F.lit(False))
    return out.select(*records.columns, F.when(F.col("reason").isNull(), "parsed").otherwise("pending").alias("outcome"), "reason", failed.alias("is_error"))


def document_folders(docs: DataFrame, stored: DataFrame) -> DataFrame:
    """doc, folder and rank: where files of documents (doc, doc_target, doc_kind, law_name, law_id) may lie, best first.

    stored: folder, law_name, law_id, doc_target of documents as they lie; a folder below the name's own counts where
    its document is the same one.
    """
    ruled = F.coalesce(F.col("doc_target").isin("admrul", "school", "pi", "public"), F.lit(False))
    name = names.path_element(F.col("law_name"))
    plain = docs.select("doc", F.posexplode(F.when(ruled, F.array(name, F.concat(F.lit("학칙공단/"), name), F.concat(F.coalesce("doc_kind", F.lit("행정규칙")), F.lit("/"), name)))
                                            .otherwise(F.array(F.concat(names.path_element(names.family(F.col("law_name"))), F.lit("/"), names.kind_of(F.col("law_name")))))).alias("n", "folder"))
    plain = plain.select("doc", "folder", F.when(F.col("n") == 0, 0).otherwise(F.col("n") + 1).alias("rank"))
    s = stored.select("folder", F.col("law_id").alias("__id"), F.col("doc_target").alias("__target"), F.regexp_replace("folder", "/[^/]*$", "").alias("__base"))
    split = docs.where(ruled).withColumn("__base", name).join(s, "__base").where((F.trim("law_id") != "") & (F.trim("law_id") == F.trim("__id")) & ((F.coalesce(F.trim("doc_target"), F.lit("")) == "") | (F.trim("doc_target") == F.trim("__target"))) & (F.col("folder") != F.col("__base")))
    return plain.unionByName(split.select("doc", "folder", F.lit(1).alias("rank")))


def locate_files(wanted: DataFrame, folders: DataFrame, files: DataFrame) -> DataFrame:
    """wanted (doc, unit, kind, local_path, file_name, made_name) with `path`: the file's place below the best of its document's folders; null where it isn't.

    kind: the appendix's, or null for attachments. First the path that the payload gives, then the name in the kind's
    folder, then the name as it would be made.
    """
    steps = F.transform(F.split(F.coalesce("local_path", F.lit("")), "/"), names.path_element)
    given = F.when(F.trim(F.coalesce("local_path", F.lit(""))) != "", F.array_join(F.filter(steps, lambda x: x != names.UNNAMED), "/"))
    own, made = (F.when(F.trim(F.coalesce(c, F.lit(""))) != "", names.path_element(F.col(c))) for c in ("file_name", "made_name"))
    sub = names.appendix_folder(F.col("kind"))
    tries = F.when(F.col("kind").isNotNull(), F.array(given, F.concat(sub, F.lit("/"), own), F.when(own.isNull(), F.concat(sub, F.lit("/"), made)))).otherwise(F.array(given, F.concat(F.lit("첨부파일/"), own), F.concat(F.lit("원문/"), own)))
    t = wanted.select("doc", "unit", F.posexplode(tries).alias("try", "tail")).where("tail is not null").join(folders, "doc").withColumn("path", F.concat("folder", F.lit("/"), "tail"))
    # the folders of one try come before the next try
    best = t.join(files.select("path").distinct(), "path").groupBy("doc", "unit").agg(F.min_by("path", F.struct("try", "rank", "path")).alias("path"))
    return wanted.join(best, ["doc", "unit"], "left")


def match_appendix(files: DataFrame, appendices: DataFrame) -> DataFrame:
    """files (doc, path) with the provision of the first appendix (doc, pos, provision_id, names) that bears the file's name; null for plain attachments."""
    base = F.element_at(F.split("path", "/"), -1)
    hits = appendices.select("doc", "pos", "provision_id", F.explode("names").alias("__name"))
    best = files.select("doc", "path", base.alias("__name")).join(hits, ["doc", "__name"]).groupBy("doc", "path").agg(F.min_by("provision_id", "pos").alias("provision_id"))
    return files.join(best, ["doc", "path"], "left")


def preprocess_targets(docs: DataFrame, source: str) -> DataFrame:
    """path of each document (path, doc) with something to preprocess, and what: images in articles (statutes have none to read), appendices that are files, a document that is one."""
    d = F.col("doc")
    images = F.lit(source != "law") & F.coalesce(F.exists(d["body"]["articles"], lambda a: F.contains(F.coalesce(a["content"], F.lit("")), F.lit(IMAGE_MARK))), F.lit(False))
    sheets = F.coalesce(F.exists(d["appendices"], lambda a: F.coalesce(a["is_file_only"], F.lit(False))), F.lit(False))
    return docs.select("path", images.alias("images"), sheets.alias("file_only_appendices"), units.is_file_only(d).alias("file_only")).where("images or file_only_appendices or file_only")


def run_totals(outcomes: DataFrame, by: list[str], kinds: dict[str, tuple[str, ...]]) -> DataFrame:
    """Counts of a run's outcomes (a column `state`): for each name of kinds how many are in one of its states, in one pass."""
    return outcomes.groupBy(*by).agg(F.count("*").alias("total"), *[F.count_if(F.col("state").isin(*states)).alias(name) for name, states in kinds.items()])


def recent(runs: DataFrame, order: str, n: int) -> DataFrame:
    """The last n runs, newest first."""
    return runs.orderBy(F.desc(order)).limit(n)


