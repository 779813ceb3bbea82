"""Queries over the vector table and packages: merges, guards, clean-up, folds and verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexspark.functions import ids
from lexspark.functions.scratch import folder
from lexspark.operators import packages as pk
from lexspark.operators import payloads, units
from lexspark.operators import store as st
from lexspark.operators import transfer as tf
from lexspark.sources import packages as src
from lexspark.plans.texts import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("SELECT o_orderkey AS uuid, CASE WHEN o_orderkey % 2 = 1 OR o_orderkey % 3 = 0 THEN 'new' ELSE 'old' END AS generation, CASE WHEN o_orderkey % 2 = 1 OR o_orderkey % 3 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS price FROM orders")
def q20_upsert_replace(spark, sf_dir):
    """Orders stored (all but multiples of three) and incoming (odd ones and multiples of three): every order is in one of them at least."""
    o = table(spark, sf_dir, "orders")
    stored = o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("uuid"), F.lit("old").alias("generation"), F.col("o_totalprice").alias("price"))
    incoming = o.where("o_orderkey % 2 = 1 or o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("uuid"), F.lit("new").alias("generation"), (F.col("o_totalprice") * 2).alias("price"))
    return st.upsert(stored, incoming)


@query("SELECT o_orderkey % 3 <> 0 AS existing, count(*) AS n FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey % 3 = 0 GROUP BY 1")
def q20_upsert_replace_add_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("uuid"))
    return st.split_existing(o.where("uuid % 2 = 1 or uuid % 3 = 0"), o.where("uuid % 3 <> 0")).groupBy("existing").agg(F.count("*").alias("n"))


def _chunks(spark, sf_dir):
    """Line items as chunks: an order is a law, a ship date a version."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_returnflag").alias("domain"), F.col("l_orderkey").cast("string").alias("law_id"), F.date_format("l_shipdate", "yyyyMMdd").alias("version_uid"), F.lit("1").alias("mst"),
                     F.when(F.col("l_linestatus") == "O", "JSON").otherwise("FILE").alias("source_type"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("chunk_id"), F.col("l_partkey").cast("string").alias("file_id"), "l_linenumber")


_CHUNKS = """c AS (SELECT l_returnflag AS domain, l_orderkey::VARCHAR AS law_id, strftime(l_shipdate, '%Y%m%d') AS version_uid, CASE WHEN l_linestatus = 'O' THEN 'JSON' ELSE 'FILE' END AS source_type,
 l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS chunk_id, l_partkey::VARCHAR AS file_id, l_linenumber FROM lineitem)"""


@query(f"WITH {_CHUNKS}, keep AS (SELECT domain, law_id, max(version_uid) AS v FROM c GROUP BY domain, law_id) SELECT domain, law_id, count(*) AS stale FROM c JOIN keep USING (domain, law_id) WHERE version_uid <> v GROUP BY domain, law_id")
def q21_stale_versions(spark, sf_dir):
    c = _chunks(spark, sf_dir)
    keep = c.groupBy("domain", "law_id").agg(F.max("version_uid").alias("version_uid"))
    return st.stale_versions(c, keep).groupBy("domain", "law_id").agg(F.count("*").alias("stale"))


@query(f"WITH {_CHUNKS}, keep AS (SELECT * FROM c WHERE l_linenumber % 2 = 1), v AS (SELECT DISTINCT domain, law_id, version_uid FROM keep), k AS (SELECT DISTINCT domain, law_id, version_uid, chunk_id FROM keep) SELECT domain, law_id, version_uid, chunk_id FROM (SELECT * FROM c SEMI JOIN v USING (domain, law_id, version_uid)) ANTI JOIN k USING (domain, law_id, version_uid, chunk_id) WHERE source_type = 'JSON'")
def q22_orphan_chunks(spark, sf_dir):
    c = _chunks(spark, sf_dir)
    return st.orphan_units(c, c.where("l_linenumber % 2 = 1")).select("domain", "law_id", "version_uid", "chunk_id")


@query(f"WITH {_CHUNKS}, keep AS (SELECT file_id, chunk_id FROM c WHERE l_linenumber = 1) SELECT file_id, count(*) AS orphans FROM c WHERE source_type = 'FILE' AND file_id IN (SELECT file_id FROM keep) AND (file_id, chunk_id) NOT IN (SELECT (file_id, chunk_id) FROM keep) GROUP BY file_id")
def q22_orphan_file_chunks(spark, sf_dir):
    c = _chunks(spark, sf_dir)
    return st.orphan_files(c, c.where("l_linenumber = 1")).groupBy("file_id").agg(F.count("*").alias("orphans"))


@query("""WITH r AS (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y%m%d')::BIGINT AS d FROM orders), b AS (SELECT o_custkey, max(struct_pack(d := d, k := o_orderkey)) AS best FROM r WHERE o_orderkey % 2 = 0 GROUP BY o_custkey)
SELECT r.o_custkey::VARCHAR AS law_id, r.o_orderkey::VARCHAR AS mst FROM r JOIN b USING (o_custkey) WHERE r.o_orderkey % 2 = 1 AND struct_pack(d := r.d, k := r.o_orderkey) < b.best""")
def q23_version_guard(spark, sf_dir):
    """Odd orders as incoming versions that a stored even order of the customer outranks."""
    o = table(spark, sf_dir, "orders").select(F.lit("law").alias("domain"), F.col("o_custkey").cast("string").alias("law_id"), F.concat_ws(":", "o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd")).alias("version_uid"), F.col("o_orderkey").cast("string").alias("mst"), "o_orderkey")
    return st.older_than_stored(o.where("o_orderkey % 2 = 1"), o.where("o_orderkey % 2 = 0")).select("law_id", "mst")


@query(f"WITH {_CHUNKS} SELECT law_id, count(*) AS expected FROM c GROUP BY law_id HAVING count(*) = count(*) FILTER (l_linenumber <> 4)")
def q24_skip_existing(spark, sf_dir):
    c = _chunks(spark, sf_dir)
    return st.complete_documents(c.select("law_id", "chunk_id"), c.where("l_linenumber <> 4"), "law_id", "chunk_id").select("law_id", "expected")


@query(f"WITH {_CHUNKS} SELECT domain, count(DISTINCT (law_id, version_uid)) AS versions, count(DISTINCT law_id) AS laws FROM c GROUP BY domain")
def q25_current_versions(spark, sf_dir):
    v = st.current_versions(_chunks(spark, sf_dir))
    return v.groupBy("domain").agg(F.count("*").alias("versions"), F.countDistinct("law_id").alias("laws"))


@query(f"WITH {_CHUNKS}, n AS (SELECT domain, law_id, version_uid, chunk_id, min((l_linenumber, chunk_id)) OVER (PARTITION BY domain, law_id, version_uid) = (l_linenumber, chunk_id) AS is_header FROM c) SELECT domain, law_id, version_uid, chunk_id, is_header, CASE WHEN is_header THEN law_id END AS promulgation_no FROM n")
def q26_first_row_only_meta(spark, sf_dir):
    rows = _chunks(spark, sf_dir).withColumns({"unit_ord": F.col("l_linenumber"), "chunk_index": F.col("chunk_id"), "promulgation_no": F.col("law_id")})
    return units.with_header(rows).select("domain", "law_id", "version_uid", "chunk_id", "is_header", "promulgation_no")


@query("SELECT c_mktsegment AS domain, count(*) AS n FROM customer c WHERE NOT (c_mktsegment = 'BUILDING' AND c_custkey % 5 = 0) GROUP BY 1")
def q27_domain_guarded_delete(spark, sf_dir):
    """Deleting laws of one domain leaves laws of the same id in others."""
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("domain"), (F.col("c_custkey") % 5).cast("string").alias("law_id"))
    laws = spark.createDataFrame([("BUILDING", "0")], "domain string, law_id string")
    return st.delete_laws(c, laws).groupBy("domain").agg(F.count("*").alias("n"))


@query("SELECT vec_id AS uuid, CASE WHEN vec_id % 10 = 0 THEN 'missing' WHEN vec_id % 10 = 1 THEN 'vector' ELSE 'props' END AS fault FROM embeddings WHERE vec_id % 10 <= 2")
def q28_export_verify(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("uuid"), F.col("embedding").alias("vector"), F.col("label").cast("string").alias("props"))
    k = F.col("uuid") % 10
    other = e.where(k != 0).select("uuid", F.when(k == 1, F.transform("vector", lambda x: x + 1)).otherwise(F.col("vector")).alias("vector"), F.when(k == 2, "changed").otherwise(F.col("props")).alias("props"))
    return st.compare_exports(e, other)


@query("""WITH e AS (SELECT *, vec_id % 97 AS k FROM embeddings WHERE len(embedding) > 0)
SELECT vec_id::VARCHAR AS uuid, CASE k WHEN 0 THEN 'missing' WHEN 1 THEN 'vector' WHEN 2 THEN 'props' ELSE 'extra' END AS fault FROM e WHERE k <= 3""")
def q110_verify_by_tree(spark, sf_dir):
    """Embeddings exported, loaded and verified against a table in which some are missing, changed or new: unequal leaves alone are read."""
    e, k = table(spark, sf_dir, "embeddings"), F.col("vec_id") % 97
    a, b, c = (folder(spark, name) for name in ("export", "loaded", "stored"))
    bits = tf.export(tf.portable(e.where(k != 3), ["label"], "vec_id", "embedding"), a)
    tf.load(spark, a, b)
    m = F.col("uuid").cast("long") % 97
    held = tf.rows_of(spark, b).where(m != 0).select("uuid", F.when(m == 1, F.transform("vector", lambda x: x + F.lit(1).cast("float"))).otherwise(F.col("vector")).alias("vector"), F.when(m == 2, "{}").otherwise(F.col("props")).alias("props"))
    tf.export(held.unionByName(tf.portable(e.where(k == 3), ["label"], "vec_id", "embedding")), c, bits)
    return tf.verify(spark, a, c)


@query("""SELECT o_orderkey::VARCHAR AS uuid, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS ordered, o_totalprice AS price, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority, NULL::VARCHAR AS fault
FROM orders WHERE o_orderstatus <> 'P'""")
def q111_properties_moved(spark, sf_dir):
    """Orders moved into a table of another schema: times as RFC 3339, nulls kept; those without a vector (status P) are left out."""
    o, a, b = table(spark, sf_dir, "orders"), folder(spark, "export"), folder(spark, "loaded")
    rows = o.select(F.col("o_orderkey").alias("uuid"), F.when(F.col("o_orderstatus") != "P", F.array("o_totalprice")).alias("vector"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("ordered"),
                    F.col("o_totalprice").alias("price"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("priority"))
    tf.export(tf.portable(rows, ["status", "ordered", "price", "priority"]), a)
    tf.load(spark, a, b)
    return tf.typed(tf.rows_of(spark, b), "status string, ordered string, price double, priority string").drop("vector")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def q30_last_wins_fold(spark, sf_dir):
    return pk.last_wins(table(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type", "event_id")


def _records(spark, sf_dir):
    """Events as package records: a day is a package, a user a law. Documents may be deletes by their op, or come with a null, empty or full payload."""
    e, kind, n = table(spark, sf_dir, "events"), F.col("event_type"), F.col("event_id")
    record = F.when(kind == "error", "delete").when(kind == "purchase", "document").when(kind == "click", "normalized_chunk").otherwise("pending_attachment")
    payload = F.when(n % 5 == 1, F.lit(None)).when(n % 5 == 2, "{ }").otherwise(F.concat(F.lit('{"n":'), n.cast("string"), F.lit("}")))
    return e.select(F.date_format("ts", "yyyy-MM-dd").alias("package"), n.alias("line_no"), F.col("user_id").cast("string").alias("law_id"), record.alias("record_type"), F.when(n % 3 == 0, "delete").alias("op"), payload.alias("payload"), n.cast("string").alias("body"))


@query("""WITH r AS (SELECT strftime(ts, '%Y-%m-%d') AS package, user_id::VARCHAR AS law_id, event_id AS n, event_type AS t, event_type = 'purchase' AND event_id % 3 <> 0 AS doc FROM events),
s AS (SELECT package, law_id, max(n) FILTER (doc) AS last, bool_or(t = 'error' OR t = 'purchase' AND NOT doc) AS deleted, count(*) FILTER (t = 'click')::INTEGER AS chunks, count(*) FILTER (t NOT IN ('error', 'purchase', 'click')) AS pending FROM r GROUP BY package, law_id),
d AS (SELECT *, CASE WHEN last % 5 NOT IN (1, 2) THEN '{"n":' || last::VARCHAR || '}' END AS document FROM s)
SELECT package, law_id, document, deleted, chunks, CASE WHEN document IS NOT NULL OR chunks > 0 THEN 'upsert' WHEN deleted THEN 'delete' WHEN pending > 0 THEN 'keep' ELSE 'none' END AS action,
  deleted AND (document IS NOT NULL OR chunks > 0) AS superseded FROM d""")
def q31_delete_vs_upsert_state(spark, sf_dir):
    return pk.fold_laws(_records(spark, sf_dir)).select("package", "law_id", "document", "deleted", F.size("normalized").alias("chunks"), "action", "superseded")


@query("""WITH r AS (SELECT event_id AS n, event_type AS t, user_id::VARCHAR AS u FROM events)
SELECT n AS line_no, CASE WHEN t <> 'signup' AND n % 4 = 3 AND NOT (t = 'purchase' AND n % 8 = 7) THEN NULL WHEN t = 'signup' AND n % 4 = 3 THEN NULL ELSE u END AS law_id,
  CASE WHEN n % 4 = 3 AND t = 'purchase' AND n % 8 <> 7 THEN 'document_law_missing' WHEN n % 4 = 3 AND t NOT IN ('purchase', 'signup') THEN 'law_id_missing' WHEN t = 'view' THEN 'record_type_unknown' END AS error FROM r""")
def q96_ids_of_records(spark, sf_dir):
    """Records that name their law by law_id, doc_id or (documents alone) in the payload, or not at all; unknown types; renames need no law."""
    e, n, kind = table(spark, sf_dir, "events"), F.col("event_id"), F.col("event_type")
    u = F.col("user_id").cast("string")
    record = F.when(kind == "error", "delete").when(kind == "purchase", "document").when(kind == "click", "normalized_chunk").when(kind == "signup", "rename").otherwise("memo")
    body = F.to_json(F.struct(record.alias("record_type"), F.when(n % 4 == 0, u).when(n % 4 == 1, "").alias("law_id"), F.when(n % 4 == 1, u).when(n % 4 == 2, u).alias("doc_id"),
                              F.struct(F.when(n % 8 == 7, u).otherwise("").alias("law_id"), F.lit("x").alias("law_name")).alias("payload")))
    lines = e.select(F.lit("p").alias("package"), n.alias("line_no"), body.alias("body"))
    return src.parse_records(lines).select("line_no", "law_id", "error")


@query("""WITH n AS (SELECT doc_id % 3 AS p, doc_id, row_number() OVER (PARTITION BY doc_id % 3 ORDER BY doc_id) AS k FROM documents)
SELECT 'part' || p::VARCHAR AS package, k AS line_no, doc_id FROM n""")
def q97_lines_numbered_in_splits(spark, sf_dir):
    """Documents written as three packages, of files in order, that are read in many small splits: lines numbered by their splits' counts."""
    from lexspark.functions.scratch import folder

    at = folder(spark, "numbered")
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("part"), (F.col("doc_id") % 3).cast("string")).alias("package"), F.to_json(F.struct("doc_id", "text")).alias("value"))
    # ranges of documents: no task holds a whole package, and the names of its files are in the order of its lines
    d.repartitionByRange("package", "doc_id").sortWithinPartitions("package", "doc_id").select("package", "value").write.partitionBy("package").text(at)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        lines = spark.read.text(at, recursiveFileLookup=True)
        lines = lines.select(F.regexp_extract("_metadata.file_path", "package=([^/]+)", 1).alias("package"), src.place().alias("block"), F.monotonically_increasing_id().alias("row"), F.col("value").alias("body"))
        found = src.number_lines(lines).select("package", "line_no", F.get_json_object("body", "$.doc_id").cast("long").alias("doc_id"))
        found.write.parquet(f"{at}-numbers")  # while the setting holds
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    return spark.read.parquet(f"{at}-numbers")


@query("""WITH n AS (SELECT strftime(ts, '%Y-%m-%d') AS package, count(*) AS records FROM events GROUP BY 1)
SELECT package, records, CASE day(package::DATE) % 3 WHEN 0 THEN NULL WHEN 1 THEN records ELSE records + 1 END AS record_count, CASE day(package::DATE) % 3 WHEN 0 THEN 'retry' WHEN 1 THEN 'ok' ELSE 'quarantine' END AS verdict FROM n""")
def q32_footer_reconcile(spark, sf_dir):
    r = _records(spark, sf_dir)
    k = F.day(F.to_date("package")) % 3
    feet = r.groupBy("package").agg(F.count("*").alias("n")).where(k != 0).select("package", F.when(k == 1, F.col("n")).otherwise(F.col("n") + 1).alias("record_count"))
    return pk.reconcile(r, ["package"], feet)


@query("SELECT user_id, arg_min(event_type, event_id) AS event_type, arg_min(props, event_id) AS props FROM events GROUP BY user_id")
def q33_first_seen_meta(spark, sf_dir):
    return pk.first_seen(table(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type", "props")


@query("SELECT user_id AS zip, arg_max(event_type, event_id) AS status, count(*) AS attempts, min(event_id) AS first_attempt FROM events GROUP BY user_id")
def q34_report_merge_attempts(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("zip"), F.col("event_type").alias("status"), F.col("event_id").alias("attempt"))
    return pk.merge_reports(e, "zip", "attempt")


@query("""WITH a AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS attempts, coalesce(bool_or(event_type = 'error' AND event_id % 50 = 0), FALSE) AS permanent FROM events GROUP BY user_id)
SELECT user_id, attempts, CASE WHEN permanent OR attempts >= 5 THEN 'quarantine' ELSE 'retry' END AS next FROM a WHERE attempts > 0""")
def q35_retry_quarantine(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    error = F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 50 == 0, "record_count differs").otherwise("HTTP 503 busy"))
    a = e.groupBy("user_id").agg(F.count(error).alias("attempts"), F.coalesce(F.bool_or(pk.is_permanent(error)), F.lit(False)).alias("permanent"))
    return a.where("attempts > 0").select("user_id", "attempts", pk.retry_or_quarantine(F.col("attempts"), F.col("permanent")).alias("next"))


@query("""WITH p AS (SELECT 'p/' || page_id::VARCHAR AS git_path, url FROM pages)
SELECT event_id, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op, user_id::VARCHAR AS law_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN sha256(p.url) ELSE sha256(replace(props, ' ', '')) END AS payload_hash,
 CASE WHEN event_type = 'click' AND p.url IS NULL THEN 'path_missing' END AS error FROM events LEFT JOIN p ON event_type = 'click' AND p.git_path = 'p/' || event_id::VARCHAR""")
def q36_changeset_json_props(spark, sf_dir):
    """Events as change-set lines: errors delete, clicks name a page's file by path, the others carry their payload."""
    e, kind = table(spark, sf_dir, "events"), F.col("event_type")
    body = F.concat(F.lit('{"op":"'), F.when(kind == "error", "delete").otherwise("upsert"), F.lit('","law_id":"'), F.col("user_id").cast("string"), F.lit('"'),
                    F.when(kind == "click", F.concat(F.lit(',"git_path":"p/'), F.col("event_id").cast("string"), F.lit('"'))).when(kind == "error", "").otherwise(F.concat(F.lit(',"payload":'), "props")), F.lit("}"))
    docs = table(spark, sf_dir, "pages").select(F.concat(F.lit("p/"), F.col("page_id").cast("string")).alias("git_path"), F.col("url").alias("value"))
    c = payloads.changes(e.select(F.col("event_id").alias("line_no"), body.alias("body")), docs)
    return c.select(F.col("line_no").alias("event_id"), "op", "law_id", F.sha2("payload", 256).alias("payload_hash"), "error")


@query("""WITH l AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS package, user_id, min(event_id) OVER (PARTITION BY strftime(ts, '%Y-%m-%d'), user_id) AS seen FROM events) SELECT package, list(user_id::VARCHAR ORDER BY seen) AS law_ids FROM l GROUP BY package""")
def q37_package_law_ids(spark, sf_dir):
    return src.law_ids(_records(spark, sf_dir))


@query("""WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_id % 97 AS run, list(user_id::VARCHAR ORDER BY event_id) FILTER (event_type = 'purchase' AND user_id % 10 = 0) AS broken, count(*) FILTER (event_type = 'error' AND user_id % 3 = 0) AS failed,
  count(*) FILTER (event_type = 'click' AND user_id % 5 = 0) AS partial, count(*) FILTER (event_type = 'view' AND user_id % 7 = 0) AS skipped, count(*) FILTER (event_type = 'signup') AS waiting FROM events GROUP BY ALL),
r AS (SELECT day, run, waiting, list_concat(list_concat(list_transform(coalesce(broken, []), lambda z: 'convert_failed:' || z), CASE WHEN skipped > 0 THEN ['lock_conflict'] ELSE [] END), list_concat(CASE WHEN failed > 0 THEN ['zip_failed:' || failed::VARCHAR] ELSE [] END, CASE WHEN partial > 0 THEN ['zip_partial:' || partial::VARCHAR] ELSE [] END)) AS reasons FROM d)
SELECT day, run, CASE WHEN len(reasons) > 0 THEN 'halt' WHEN waiting > 0 THEN 'waiting' ELSE 'ok' END AS verdict, array_to_string(reasons, ',') AS reasons FROM r""")
def q69_decide_verdict(spark, sf_dir):
    """Runs of a day (events by number) with the reasons for which they halt."""
    kind = lambda k, n: F.count_if((F.col("event_type") == k) & (F.col("user_id") % n == 0))
    broken = F.transform(F.array_sort(F.collect_list(F.when((F.col("event_type") == "purchase") & (F.col("user_id") % 10 == 0), F.struct("event_id", F.col("user_id").cast("string").alias("u"))))), lambda x: x["u"])
    d = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), (F.col("event_id") % 97).alias("run")).agg(broken.alias("broken"), kind("error", 3).alias("failed"), kind("click", 5).alias("partial"), kind("view", 7).alias("skipped"), kind("signup", 1).alias("waiting"))
    v = pk.decide(F.col("broken"), F.col("skipped"), F.col("failed"), F.col("partial"), F.lit(None).cast("array<struct<zip:string,reason:string>>"), F.col("waiting"))
    return d.select("day", "run", v.alias("v")).select("day", "run", "v.verdict", F.array_join("v.reasons", ",").alias("reasons"))


@query("SELECT o_orderkey, sha256(concat_ws(chr(31), 'v', o_orderkey::VARCHAR, trim(o_orderpriority))) AS stable, 'JO' || lpad((o_orderkey % 9999 + 1)::VARCHAR, 4, '0') || CASE WHEN o_custkey % 3 > 0 THEN '_' || lpad((o_custkey % 3)::VARCHAR, 2, '0') ELSE '' END AS unit FROM orders")
def q73_unit_codes(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    label = ids.article_number((F.col("o_orderkey") % 9999 + 1).cast("string"), (F.col("o_custkey") % 3).cast("string"))
    return o.select("o_orderkey", ids.stable_id(F.lit("v"), F.col("o_orderkey"), F.col("o_orderpriority")).alias("stable"), ids.article_unit(label).alias("unit"))
