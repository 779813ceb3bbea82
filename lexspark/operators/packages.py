"""Change packages: records folded by law, reconciled with their footers, and the verdicts that follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_wins(records: DataFrame, key: list[str], order: str, *values: str) -> DataFrame:
    """The values of each key's last record."""
    return records.groupBy(*key).agg(F.max_by(F.struct(*values), order).alias("v")).select(*key, "v.*")


def first_seen(records: DataFrame, key: list[str], order: str, *values: str) -> DataFrame:
    return records.groupBy(*key).agg(F.min_by(F.struct(*values), order).alias("v")).select(*key, "v.*")


# fixed values: the lists of a folded law and the types of records in them
LISTS = {"normalized": "normalized_chunk", "preprocessed": "preprocessed_chunk", "files": "file"}


def fold_laws(records: DataFrame, apart: bool = False) -> DataFrame:
    """One row for each law of a package: the last document's payload, whether a delete stands, chunks and files in order, and the action.

    records: package, line_no, law_id, record_type, op, payload, body, and domain where laws of several domains come
    (deletes need it; a law's document decides it before its other records). A delete is a record of that type or a document
    whose op says so; the latter brings no payload, and a document without payload or with an empty one is no content. Content beats a
    delete; a law with pending files alone keeps its stored body. `superseded`: there is content and a delete.
    apart: chunks and files are gathered by themselves, so that documents don't carry lists along: for records that are stored, as they are read twice.
    """
    kind = F.col("record_type")
    told = (kind == "document") & (F.coalesce("op", F.lit("")) != "delete")
    deleted = (kind == "delete") | (kind == "document") & (F.col("op") == "delete")
    extra = []
    if "domain" in records.columns:
        own = F.max_by("domain", F.when(told & F.col("payload").isNotNull(), F.col("line_no")))
        extra = [F.coalesce(own, F.min_by("domain", F.when(F.col("domain").isNotNull(), F.col("line_no")))).alias("domain")]

    def gathered(of: str) -> Column:
        rows = F.array_sort(F.collect_list(F.when(kind == of, F.struct("line_no", "body"))))
        return F.transform(rows, lambda r: r["body"])

    given, law = records.where("law_id is not null"), ["law_id", "package"]  # sorted by what tells most rows apart
    single = [F.max_by(F.struct("payload"), F.when(told, F.col("line_no")))["payload"].alias("document"), F.coalesce(F.bool_or(deleted), F.lit(False)).alias("deleted")]
    lists = [gathered(kinds).alias(name) for name, kinds in LISTS.items()]
    pending = F.count_if(kind == "pending_attachment").alias("pending")
    if apart:
        held = given.where(kind.isin(*LISTS.values())).groupBy(*law).agg(*lists)
        none = F.array().cast("array<string>")
        out = given.groupBy(*law).agg(*single, pending, *extra).join(held, law, "left")
        out = out.select("package", "law_id", "document", "deleted", *[F.coalesce(c, none).alias(c) for c in LISTS], "pending", *(["domain"] if extra else []))
    else:
        out = given.groupBy(*law).agg(*single, *lists, pending, *extra).select("package", "law_id", "document", "deleted", *LISTS, "pending", *(["domain"] if extra else []))
    out = out.withColumn("document", F.when(~F.rlike("document", F.lit(r"^\s*(\{\s*\}|null)?\s*$")), F.col("document")))
    content = F.col("document").isNotNull() | (F.size("normalized") > 0) | (F.size("preprocessed") > 0) | (F.size("files") > 0)
    action = F.when(content, "upsert").when(F.col("deleted"), "delete").when(F.col("pending") > 0, "keep").otherwise("none")
    return out.withColumns({"action": action, "superseded": content & F.col("deleted")})


def reconcile(records: DataFrame, key: list[str], footers: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """Each package's records against its footer's count: ok, missing footer (try again) or mismatch (quarantine).

    Packages are those of the headers, the footers and the records together: one without a record has none.
    """
    found = records.groupBy(*key).agg(F.count("*").alias("records"))
    known = [df.select(*key) for df in (footers, *([headers] if headers is not None else []))]
    everyone = found.select(*key)
    for df in known:
        everyone = everyone.unionByName(df)
    n = F.coalesce("records", F.lit(0).cast("long"))
    return everyone.distinct().join(found, key, "left").join(footers, key, "left").withColumns({"records": n, "verdict": verdict(n)})


def verdict(n: Column) -> Column:
    """Of n records against the footer's record_count."""
    return F.when(F.col("record_count").isNull(), "retry").when(F.col("record_count") == n, "ok").otherwise("quarantine")


def merge_reports(reports: DataFrame, key: str, attempt: str, status: str = "status") -> DataFrame:
    """The last report of each key; `first_attempt` gives the order in which keys were first seen."""
    return reports.groupBy(key).agg(F.max_by(status, attempt).alias("status"), F.count("*").alias("attempts"), F.min(attempt).alias("first_attempt"))


def merge_summaries(attempts: DataFrame, key: list[str], order: str, sums: list[str], lists: list[str], last: list[str]) -> DataFrame:
    """One summary of a run's attempts: numbers summed, lists joined in order of the attempts, states of the last attempt, and the number of attempts."""
    joined = [F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, F.coalesce(c, F.array()).alias("v")))), lambda x: x["v"])).alias(c) for c in lists]
    return attempts.groupBy(*key).agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in sums], *joined, *[F.max_by(c, order).alias(c) for c in last], F.count("*").alias("attempts"))


def decide(failed_zips: Column, skipped: Column, failed: Column, partial: Column, guards: Column, waiting: Column, halt_on_partial: bool = True) -> Column:
    """A run's verdict and why: struct of verdict (halt, waiting, ok) and reasons.

    It halts for deliveries that weren't converted (failed_zips: their names), a lock held by another run (skipped),
    failed and (by policy) partial loads, and quality guards (array of zip and reason). Versions passed over as older
    are no reason. Without reasons it waits while `waiting` of them are left.
    """
    some = lambda mark, n: F.when(n > 0, F.concat(F.lit(mark), n.cast("string")))
    reasons = F.concat(
        F.transform(F.coalesce(failed_zips, F.array().cast("array<string>")), lambda z: F.concat(F.lit("convert_failed:"), z)),
        F.array(F.when(skipped > 0, "lock_conflict"), some("zip_failed:", failed), some("zip_partial:", partial) if halt_on_partial else F.lit(None).cast("string")),
        F.transform(F.coalesce(guards, F.array().cast("array<struct<zip:string,reason:string>>")), lambda g: F.concat_ws(":", F.lit("quality_guard"), g["zip"], g["reason"])))
    reasons = F.array_compact(reasons)
    return F.struct(F.when(F.size(reasons) > 0, "halt").when(waiting > 0, "waiting").otherwise("ok").alias("verdict"), reasons.alias("reasons"))


def retry_or_quarantine(attempts: Column, permanent: Column, most: int = 5) -> Column:
    return F.when(permanent | (attempts >= most), "quarantine").otherwise("retry")


# fixed values: marks of errors in a package that trying again can't mend
PERMANENT_MARKS = ("파싱 실패", "source 미결정", "source 를 결정", "law_id 없는", "계약 위반", "record_count")


# fixed values: errors of records that a later attempt may mend
PASSING = ("record_type_unknown", "record_type_missing", "document_law_missing")


def is_permanent(error: Column) -> Column:
    """Package errors that trying again can't mend."""
    return F.rlike(F.coalesce(error, F.lit("")), F.lit("|".join(PERMANENT_MARKS)))


def is_permanent_parser_error(code: Column, message: Column) -> Column:
    """Limits of the source file: an application error, an empty result, or a 4xx answer but for 429."""
    refused = F.rlike(F.coalesce(message, F.lit("")), F.lit(r"^HTTP 4(?!29)\d\d"))
    return F.coalesce(code.isin("APPLICATION_ERROR", "EMPTY_RESULT") | ((code == "HTTP_ERROR") & refused), F.lit(False))


def nack(packages: DataFrame, records: DataFrame) -> DataFrame:
    """What producers are told of quarantined packages: kind and the laws concerned in order; packages without laws are left out.

    packages: package, source, permanent, errors.
    """
    first = records.where("law_id is not null").groupBy("package", "law_id").agg(F.min("line_no").alias("at"))
    laws = first.groupBy("package").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "law_id"))), lambda x: x["law_id"]).alias("law_ids"))
    return packages.join(laws, "package").select("package", "source", F.when(F.col("permanent"), "permanent").otherwise("transient_exhausted").alias("kind"), "law_ids", F.slice("errors", 1, 10).alias("errors"))


def group_faults(rows: DataFrame, group: list[str]) -> DataFrame:
    """rows with `issue`: what makes the group invalid as a whole, by precedence; first_path; and `rejected` where any row of it has an error.

    rows: path, source, repealed, version_uid, hash, error. A group with an error is rejected for that alone. An unknown
    source, version or hash is a value of its own. Of repealed rows the first by path stands whatever their versions;
    of equal rows too. Rows without a group are in none.
    """
    several = lambda c: F.min(F.struct(c)) != F.max(F.struct(c))  # noqa: E731  null counts
    repealed = F.coalesce("repealed", F.lit(False))
    flags = rows.groupBy(*group).agg(several("source").alias("__sources"), F.bool_or(repealed).alias("__repealed"), F.bool_and(repealed).alias("__all"), several("version_uid").alias("__versions"),
                                     several("hash").alias("__hashes"), F.coalesce(F.bool_or("error"), F.lit(False)).alias("__error"), F.min("path").alias("first_path"))
    issue = (F.when(F.col("__error"), F.lit(None)).when(F.col("__sources"), "law_id_multi_source").when(F.col("__repealed") & ~F.col("__all"), "repeal_conflict")
             .when(F.col("__all"), F.lit("twice")).when(F.col("__versions"), "multi_version_unsupported").when(F.col("__hashes"), "version_conflict").otherwise("twice"))
    place = F.row_number().over(Window.partitionBy(*group, "path").orderBy("hash", "version_uid"))
    out = rows.withColumn("__place", place).join(flags.withColumn("__issue", issue), group, "left")
    again = (F.col("path") != F.col("first_path")) | (F.col("__place") > 1)
    out = out.withColumns({"issue": F.when(F.col("__issue") != "twice", F.col("__issue")).when((F.col("__issue") == "twice") & again, "duplicate"),
                           "rejected": F.coalesce(F.col("__error") | (F.col("__issue") != "twice"), F.coalesce("error", F.lit(False)))})
    return out.select(*rows.columns, "issue", "first_path", "rejected")
