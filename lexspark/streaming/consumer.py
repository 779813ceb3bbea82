"""Incremental consumption: a folder of packages as a stream, each batch folded, guarded and merged into the table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.functions import ids
from lexspark.operators import packages as pk
from lexspark.operators import references, scope, units
from lexspark.operators import store as st
from lexspark.sources import documents
from lexspark.sources import packages as src
from lexspark.sources.folder import FolderSource

RecordsToRows = Callable[[DataFrame], DataFrame]
STATE = "package string, attempt int, state string, permanent boolean, errors array<string>, run string, batch string"


def with_domain(records: DataFrame, source: Column | None = None) -> DataFrame:
    """records with the domain of each: its document's or its own target first, then its package's source.

    source: that of all records, where it is known; else records hold their packages' headers, too.
    """
    if source is None:
        records = records.join(src.headers(records).select("package", F.col("source").alias("__source")), "package", "left")
    else:
        records = records.withColumn("__source", source.cast("string"))
    maybe = F.contains("payload", F.lit("doc_target")) | F.contains("payload", F.lit("\\u"))  # a key may be escaped; other payloads needn't be parsed
    own = F.when(maybe, F.nullif(F.get_json_object("payload", "$.doc_target"), F.lit("")))
    target = F.trim(F.coalesce(own, F.col("doc_target"), F.lit("")))
    return records.withColumn("__target", target).withColumn("domain", ids.routed(F.col("__target"), F.col("law_id"), F.col("__source"))).drop("__source", "__target")


LAWS = ("domain", "law_id")


def flush(stored: DataFrame | None, folded: DataFrame, renames: DataFrame, fresh: DataFrame, older: bool = False, outside: DataFrame | None = None, elsewhere: DataFrame | None = None) -> DataFrame:
    """The table after one batch of laws (folded, with their domain) and rename records.

    fresh: the store rows (domain, law_id, version_uid, mst, source_type, chunk_id, file_id, uuid, ...) of the laws with
    content; outside: laws (domain, law_id) whose content the scope keeps out. Laws to delete go, in their domain alone, and laws
    outside that were deleted and sent anew, too; laws with content are written unless a newer version is stored
    (or older ones are allowed); their stale versions and orphaned units and file chunks go after the new rows are in.
    Renames come last; elsewhere: rows of the table (provision_id) that stored leaves out, as nothing in them changes.
    """
    if outside is not None:
        fresh = fresh.join(outside, list(LAWS), "left_anti")
    if stored is None:
        merged = fresh
    else:
        gone = folded.where("action = 'delete'").select(*LAWS)
        if outside is not None:
            gone = gone.unionByName(folded.where("superseded").join(outside, list(LAWS), "left_semi").select(*LAWS))
        rows = stored.withColumn("new", F.lit(0)).unionByName(fresh.withColumn("new", F.lit(1)), allowMissingColumns=True)
        out = st.outgoing(stored, fresh, gone, older).withColumn("goes", F.lit(True))  # an anti join would be pushed below the union and made twice
        merged = rows.join(out, ["uuid", "new"], "left").where("goes is null").drop("new", "goes")
        if "file_id" in merged.columns:
            files = fresh.where("source_type = 'FILE'")
            if not older:
                heads = fresh.select(*LAWS, "version_uid", "mst").distinct()
                files = files.join(st.older_than_stored(heads, stored).select(*LAWS).distinct(), list(LAWS), "left_anti")
            merged = merged.join(st.orphan_files(merged, files).select("uuid").distinct(), "uuid", "left_anti")
    if "reference_ids" not in merged.columns:
        return merged
    return references.apply_renames(merged, references.rename_heads(renames), elsewhere=elsewhere)


def out_of_scope(names: list[str], ministries: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Of folded laws (domain, law_id, document) those whose document neither its name nor a ministry admits; laws without document are admitted by nothing."""

    def split(folded: DataFrame) -> DataFrame:
        docs = documents.parse_documents(folded, "document").select(*LAWS, F.col("doc.law_name").alias("law_name"), units.ministry(F.col("doc.basic_info")).alias("ministry"))
        inside = scope.gate(docs, names, ministries).select(*LAWS)
        return folded.select(*LAWS).join(inside, list(LAWS), "left_anti")

    return split


def judge(records: DataFrame, before: DataFrame, most_attempts: int) -> DataFrame:
    """State of each package of records: done, retry, or quarantined; before: the states so far.

    A package without footer, or with errors that may pass, is tried again until most_attempts; others quarantine it at once.
    """
    # one pass: every package with a record has a first one, its header
    footer, content = F.col("record_type") == "package_footer", F.coalesce(~F.col("record_type").isin(*src.ENDS), F.lit(True))
    counted = records.groupBy("package").agg(F.count_if(content).alias("records"), F.max_by("record_count", F.when(footer, F.col("line_no"))).alias("record_count"))
    verdicts = counted.withColumn("verdict", pk.verdict(F.col("records")))
    errors = records.where("error is not null").groupBy("package").agg(F.collect_set("error").alias("errors"))
    tried = before.where("state = 'retry'").groupBy("package").agg(F.count("*").cast("int").alias("tried"))
    out = verdicts.join(errors, "package", "left").join(tried, "package", "left")
    out = out.withColumns({"attempt": F.coalesce("tried", F.lit(0)) + 1, "errors": F.coalesce("errors", F.array().cast("array<string>")), "permanent": (F.col("verdict") == "quarantine") | F.coalesce(F.size(F.array_except("errors", F.array(*map(F.lit, pk.PASSING)))) > 0, F.lit(False))})
    good = (F.col("verdict") == "ok") & (F.size("errors") == 0)
    state = F.when(F.col("permanent"), "quarantined").when(good, "done").otherwise(F.when(F.col("attempt") >= most_attempts, "quarantined").otherwise("retry"))
    out = out.withColumn("errors", F.when(F.col("verdict") == "quarantine", F.concat("errors", F.array(F.lit("record_count")))).when(F.col("verdict") == "retry", F.concat("errors", F.array(F.lit("footer missing")))).otherwise(F.col("errors")))
    return out.select("package", "attempt", state.alias("state"), "permanent", "errors")


def _states(spark: SparkSession, root: str) -> DataFrame:
    fs, path = st._fs(spark, root)
    return spark.read.schema(STATE).parquet(f"{root}/state/*") if fs.exists(path(f"{root}/state")) else spark.createDataFrame([], STATE)


def _take(spark: SparkSession, folder: str, package: str, root: str, to_rows: RecordsToRows, most_attempts: int, run: str, batch: str, older: bool = False, outside: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Consume one package: taken twice, it gives the same table, as ids are deterministic."""
    at = f"{root}/staged/{run}-{batch}"
    lines = src.read_lines(spark, f"{folder.rstrip('/')}/{package}", "*").withColumn("package", F.lit(package))
    records = src.parse_records(lines)  # lines are parsed once: headers and domains are read from the staged records, bodies where they are gathered
    records = records.withColumn("body", F.when(F.col("record_type").isin(*pk.LISTS.values()) | F.col("error").isNotNull(), F.col("body")))
    records.write.mode("overwrite").parquet(f"{at}-records")
    records = spark.read.parquet(f"{at}-records")
    before = _states(spark, root).where(~((F.col("run") == run) & (F.col("batch") == batch)))
    judge(records, before, most_attempts).write.mode("overwrite").parquet(f"{at}-states")
    states = spark.read.parquet(f"{at}-states")
    state = states.select("state").first()  # one row, none for a package without records
    head = src.headers(records.where(F.col("line_no") == F.lit(records.agg(F.min("line_no")).first()[0]))).first()
    source = F.lit(head["source"] if head else None).cast("string")
    good = records.where("record_type is null or record_type not in ('package_header', 'package_footer')")
    if state is not None and state["state"] == "done" and not good.isEmpty():
        # made once: the guards and merges below read them several times
        pk.fold_laws(with_domain(good, source), apart=True).write.mode("overwrite").parquet(f"{at}-laws")
        folded = spark.read.parquet(f"{at}-laws")
        upserts, kept_out = folded.where("action = 'upsert'"), None
        if outside is not None:
            outside(upserts).write.mode("overwrite").parquet(f"{at}-outside")
            kept_out = spark.read.parquet(f"{at}-outside")
            upserts = upserts.join(kept_out, list(LAWS), "left_anti")
        to_rows(upserts).write.mode("overwrite").parquet(f"{at}-rows")
        fresh = spark.read.parquet(f"{at}-rows")
        last = st.generation(spark, root)
        renames = with_domain(good.where("record_type = 'rename'"), source)
        numbers = folded.select("law_id").unionByName(fresh.select("law_id").where("law_id is not null")).select(st.bucket().alias("b"))
        table, elsewhere, renamed = st.current(spark, root), None, not renames.isEmpty()
        renamed = renamed and table is not None and "reference_ids" in table.columns
        if renamed:  # and the buckets of rows that refer to an old head: ids and references of the table are read for it, no more
            held = table.select("law_id", *[c for c in ("reference_ids", "relation_refs", "meta") if c in table.columns])
            numbers = numbers.unionByName(references.referring(held, references.rename_heads(renames)).select(st.bucket().alias("b")))
        touched = sorted(r[0] for r in numbers.distinct().collect())  # BUCKETS numbers at most
        if renamed:
            elsewhere = table.where(~st.bucket().isin(touched)).select("provision_id")
        st.commit(flush(st.current(spark, root, touched), folded, renames, fresh, older, kept_out, elsewhere), root, touched, last)
    bad = states.where("state = 'quarantined'").withColumn("source", source)
    told = records if state is not None and state["state"] == "quarantined" else records.limit(0)  # no laws are gathered of packages that are fine
    pk.nack(bad, told).write.mode("overwrite").parquet(f"{root}/nack/run={run}-{batch}")
    states.select("package", "attempt", "state", "permanent", "errors", F.lit(run).alias("run"), F.lit(batch).alias("batch")).write.mode("overwrite").parquet(f"{root}/state/{run}-{batch}")


def consume(spark: SparkSession, folder: str, root: str, checkpoint: str, to_rows: RecordsToRows, most_attempts: int = 5, glob: str = "*.jsonl", older: bool = False, outside: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Consume the packages of folder one by one, in the order of their names: first those that wait for another attempt or came late, then those behind the last one taken.

    older: versions older than stored ones are taken too; outside: the laws of a package that the scope keeps out.
    root/state logs each attempt; root/nack tells producers which laws of quarantined packages to send again.
    """
    spark.dataSource.register(FolderSource)
    take = lambda package, run, batch: _take(spark, folder, package, root, to_rows, most_attempts, run, batch, older, outside)
    log = _states(spark, root)
    last = latest_state(log, "package", "attempt")
    reached = log.where("run = 'stream'").agg(F.max("package")).first()[0]
    if reached is not None:
        there = spark.read.format("lexspark_folder").option("glob", glob).option("rows", "names").load(folder)
        waiting = there.join(last.where("state <> 'retry'"), "package", "left_anti").where(F.col("package") <= reached)
        run = f"again-{uuid.uuid4().hex}"
        for n, r in enumerate(waiting.orderBy("package").select("package").collect()):  # names alone
            take(r["package"], run, str(n))
    names = spark.readStream.format("lexspark_folder").option("glob", glob).option("rows", "names").load(folder)

    def batch(df: DataFrame, n: int) -> None:
        for k, r in enumerate(df.select("package").orderBy("package").collect()):
            take(r["package"], "stream", f"{n}-{k}")

    query = names.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def latest_state(log: DataFrame, key: str, order: str) -> DataFrame:
    """Current state of each key of an append-only log."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return log.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
