"""Intake of deliveries: files linked to documents by folder and declared name, formats ranked, manifests checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.functions.text import extension

# fixed values: preference of formats, for files without and with a declared one
BUNDLE_ORDER = ("hwpx", "hwp", "docx", "pdf")
DECLARED_ORDER = ("pdf", "hwpx", "hwp", "docx")


def ancestors(path: Column) -> Column:
    """All parent folders, nearest first; the top is ''."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def nearest_document(files: DataFrame, folders: DataFrame, path: str = "path", folder: str = "folder") -> DataFrame:
    """files with the columns of the closest parent folder that holds a document; null where none does."""
    key = files.select(path).distinct()
    up = key.select(path, F.posexplode(ancestors(F.col(path))).alias("up", folder))
    best = up.join(folders, folder).groupBy(path).agg(F.min_by(F.struct(*folders.columns), "up").alias("d"))
    return files.join(best.select(path, "d.*"), path, "left")


def format_rank(ext: Column, order: tuple[str, ...]) -> Column:
    return F.coalesce(F.array_position(F.array(*map(F.lit, order)), ext), F.lit(0)).cast("int")


def best_format(files: DataFrame, key: list[str], name: str, order: tuple[str, ...] = BUNDLE_ORDER, declared: str | None = None) -> DataFrame:
    """One file of each key among those in the order's formats (the declared one first); files in other formats all stay."""
    ext = extension(F.col(name))
    rank = format_rank(ext, order)
    first = [ext.eqNullSafe(F.lower(F.col(declared))).cast("int").desc()] if declared else []
    ranked = files.withColumn("__rank", rank).withColumn("__place", F.row_number().over(Window.partitionBy(*key, F.col("__rank") > 0).orderBy(*first, "__rank", name)))
    return ranked.where("__rank = 0 or __place = 1").drop("__rank", "__place")


def declared_format(files: DataFrame, key: list[str], name: str, declared: str, order: tuple[str, ...] = DECLARED_ORDER) -> DataFrame:
    """One file of each key: of the declared format (one that can be read), else of the first in the order, ties by name; keys whose files are all of other formats, such as images, have none."""
    ext = extension(F.col(name))
    rank = format_rank(ext, order)
    best = Window.partitionBy(*key).orderBy(ext.eqNullSafe(F.lower(F.col(declared))).cast("int").desc(), F.when(F.col("__rank") > 0, F.col("__rank")).otherwise(len(order) + 1), name)
    return files.withColumn("__rank", rank).withColumn("__place", F.row_number().over(best)).where("__place = 1 and __rank > 0").drop("__rank", "__place")


def match_declared(units: DataFrame, entries: DataFrame) -> DataFrame:
    """units (unit, names) with the path of the one entry (name, path) that bears any of their names; else pending or ambiguous."""
    hits = units.select("unit", F.explode(F.array_distinct("names")).alias("name")).join(entries, "name").groupBy("unit").agg(F.collect_set("path").alias("paths"))
    n = F.coalesce(F.size("paths"), F.lit(0))
    state = F.when(F.col("paths").isNull(), "pending").when(n == 1, "found").otherwise("ambiguous")
    return units.join(hits, "unit", "left").select("unit", state.alias("state"), F.when(n == 1, F.get("paths", F.lit(0))).alias("path"))


def check_manifest(documents: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Counted documents against declared ones: ok, mismatch, manifest_missing or nothing delivered."""
    found = documents.groupBy(key).agg(F.count("*").alias("found"))
    j = found.join(manifest, key, "full_outer")
    state = F.when(F.col("declared").isNull(), "manifest_missing").when(F.coalesce("found", F.lit(0)) == F.col("declared"), "ok").otherwise("manifest_mismatch")
    return j.select(key, F.coalesce("found", F.lit(0)).alias("found"), "declared", state.alias("state"))


def manifest_faults(zips: DataFrame, manifests: DataFrame) -> DataFrame:
    """zips (zip, sha256, documents, repealed: as counted) against their manifests (zip, manifest: VARIANT, error): one row for each fault, with its level.

    manifest_missing warns; manifest_invalid (unreadable, or no sha256) and manifest_mismatch (another digest, or a count that
    is no number or another one) are errors; a name of another file and a count left out warn.
    """
    get = lambda key: F.try_variant_get("manifest", f"$.{key}", "string")
    kind = lambda key: F.schema_of_variant(F.try_variant_get("manifest", f"$.{key}", "variant"))
    rows = zips.join(manifests.select("zip", "manifest", F.col("error").alias("__error"), F.lit(True).alias("__there")), "zip", "left")
    sha = F.when(kind("sha256") == "STRING", F.trim(get("sha256")))
    there, good = F.col("__there").isNotNull(), F.col("__error").isNull()
    fault = lambda when, code, level: F.when(when, F.struct(F.lit(code).alias("code"), F.lit(level).alias("level")))

    def count(key: str) -> list[Column]:
        named = F.coalesce(kind(key), F.lit("VOID"))
        same = (named == "BIGINT") & (F.try_variant_get("manifest", f"$.{key}", "long") == F.col(key))
        return [fault(there & good & (named == "VOID"), "manifest_field_missing", "warning"), fault(there & good & (named != "VOID") & ~F.coalesce(same, F.lit(False)), "manifest_mismatch", "error")]

    base = F.element_at(F.split("zip", "/"), -1)
    found = F.array_compact(F.array(fault(~there, "manifest_missing", "warning"), fault(there & (~good | (F.coalesce(sha, F.lit("")) == "")), "manifest_invalid", "error"), fault(there & good & (sha != "") & (F.lower(sha) != F.col("sha256")), "manifest_mismatch", "error"),
                                    fault(there & good & (F.coalesce(get("filename"), base) != base) & (get("filename") != ""), "manifest_filename", "warning"), *count("documents"), *count("repealed")))
    return rows.select("zip", F.explode(found).alias("f")).select("zip", "f.*").distinct()


def attachment_like(name: Column) -> Column:
    """A file that deliveries may hold as an attachment, and no system's or editor's own."""
    low = F.lower(F.coalesce(name, F.lit("")))
    return extension(low).isin(*ATTACHMENTS) & ~low.isin("thumbs.db", ".ds_store", "desktop.ini") & ~F.startswith(low, F.lit("~$")) & ~F.startswith(low, F.lit("._"))


def new_deliveries(incoming: DataFrame, accepted: DataFrame) -> DataFrame:
    """Deliveries that were not accepted before: a known file is new only with a manifest that differs from the accepted ones, all of which had one."""
    i, a = incoming.alias("i"), accepted.alias("a")
    mine, theirs = F.col("i.manifest_sha256"), F.col("a.manifest_sha256")
    same = (F.col("i.sha256") == F.col("a.sha256")) & (mine.isNull() | (mine == "") | theirs.isNull() | (mine == theirs))
    return i.join(a, same, "left_anti")


def receipt_gap(receipts: DataFrame, now: Column, most_seconds: int) -> DataFrame:
    """Last accepted receipt, its age in seconds, and whether that calls for attention (also where nothing was received)."""
    last = receipts.where("status = 'accepted'").agg(F.max("received_at").alias("last_receipt"))
    age = F.unix_timestamp(now) - F.unix_timestamp("last_receipt")
    return last.withColumn("age_seconds", age).withColumn("attention", F.coalesce(age > most_seconds, F.lit(True)))


def manifests_overdue(zips: DataFrame, manifests: DataFrame, now: Column, most_seconds: int) -> DataFrame:
    """Files (stem, arrived_at) that have waited too long for their manifest."""
    waiting = zips.join(manifests.select("stem").distinct(), "stem", "left_anti")
    return waiting.withColumn("age_seconds", F.unix_timestamp(now) - F.unix_timestamp("arrived_at")).where(F.col("age_seconds") > most_seconds)


def expired(files: DataFrame, now: Column, days: int) -> DataFrame:
    """Files (modified_at) past their retention."""
    return files.where(F.unix_timestamp(now) - F.unix_timestamp("modified_at") > days * 86_400)


def requeue(quarantined: DataFrame, live: DataFrame, kind: str | None = None, most: int | None = None) -> DataFrame:
    """Quarantined packages to try again: of one kind of refusal, none that is live again, the first `most` by name."""
    out = (quarantined if kind is None else quarantined.where(F.col("kind") == kind)).join(live.select("package").distinct(), "package", "left_anti")
    return out if most is None else out.orderBy("package").limit(most)


# fixed values: what archives may hold, and the system's own files
ATTACHMENTS = ("hwp", "hwpx", "pdf", "doc", "docx", "png", "jpg", "jpeg", "gif")
JUNK_FOLDERS = ("__MACOSX",)
JUNK_NAMES = (".DS_Store", "Thumbs.db")


def path_fault(path: Column) -> Column:
    """path_unsafe, os_metadata_ignored, manifest_ignored, unsupported_extension or null."""
    name = F.element_at(F.split(path, "/"), -1)
    return (F.when(path.isNull() | F.rlike(path, F.lit(r"(^|/)\.\.(/|$)|^[/\\]|^[A-Za-z]:|\x00")) | (F.trim(path) == ""), "path_unsafe")
            .when(F.split(path, "/")[0].isin(*JUNK_FOLDERS) | name.isin(*JUNK_NAMES), "os_metadata_ignored")
            .when(name.isin("_manifest.json", "manifest.json") | F.endswith(name, F.lit(".manifest.json")), "manifest_ignored")
            .when(~extension(path).isin("json", *ATTACHMENTS), "unsupported_extension"))
