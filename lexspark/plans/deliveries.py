"""Queries over deliveries and the reference graph: scope, validity, linking, manifests, resolution, renames."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexspark.functions import text
from lexspark.operators import identifiers, intake, references, scope
from lexspark.operators import packages as pk
from lexspark.plans.texts import table

_ARTICLES = "array<struct<article_no: string, relations: array<struct<" + ", ".join(f"{k}: boolean" if k == "appendix_ambiguous" else f"{k}: string" for k in identifiers.RELATION) + ">>>>"

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("SELECT c_custkey, n_name IN ('FRANCE', 'JAPAN') AS by_name, r_name IN ('ASIA') AS by_ministry FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE n_name IN ('FRANCE', 'JAPAN') OR r_name IN ('ASIA')")
def q40_scope_gate(spark, sf_dir):
    """Customers in scope by their nation's name or by their region."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = c.select("c_custkey", F.col("n_name").alias("law_name"), F.col("r_name").alias("ministry"))
    return scope.gate(rows, ["FRANCE", "J APAN"], ["AS IA"]).select("c_custkey", "by_name", "by_ministry")


@query("SELECT entry FROM (VALUES ('ASIA'), ('ATLANTIS'), ('EUR0PE'), ('AF RICA')) t(entry) WHERE replace(entry, ' ', '') NOT IN (SELECT r_name FROM region)")
def q41_scope_unmatched(spark, sf_dir):
    names = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"))
    return scope.unmatched(names, "name", ["ASIA", "ATLANTIS", "EUR0PE", "AF RICA"])


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN s_name WHEN s_suppkey % 4 = 1 THEN n_name END AS ministry FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def q42_ministry_fallback_coalesce(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey") % 4
    return s.select("s_suppkey", text.first_text(F.when(k == 0, F.col("s_name")).otherwise("  "), F.when(k == 1, F.concat(F.lit(" "), "n_name")), F.lit("")).alias("ministry"))


# lines of an order as documents of a law: sources, repeals, versions, hashes and errors so that every rule applies somewhere
_GROUPS = """g AS (SELECT l_orderkey AS law_id, l_linenumber AS path, CASE WHEN l_orderkey % 11 = 0 THEN l_returnflag WHEN l_linenumber % 2 = 0 AND l_orderkey % 13 = 0 THEN NULL ELSE 'law' END AS source, CASE WHEN l_orderkey % 7 = 0 THEN l_linestatus = 'O' WHEN l_orderkey % 3 = 0 THEN TRUE END AS repealed,
 CASE WHEN l_orderkey % 5 = 0 AND l_linenumber = 2 THEN NULL ELSE 'v' END AS version_uid, CASE WHEN l_orderkey % 4 = 0 THEN l_suppkey::VARCHAR ELSE 'h' END AS hash, l_quantity > 49 AS error FROM lineitem),
k AS (SELECT law_id, min(path) AS first_path, bool_or(error) AS err, count(DISTINCT coalesce(source, '?')) > 1 AS s, bool_or(coalesce(repealed, FALSE)) AS part_rep, bool_and(coalesce(repealed, FALSE)) AS alle, count(DISTINCT coalesce(version_uid, '?')) > 1 AS v, count(DISTINCT hash) > 1 AS h, count(*) AS n FROM g GROUP BY law_id),
j AS (SELECT *, CASE WHEN err THEN NULL WHEN s THEN 'law_id_multi_source' WHEN part_rep AND NOT alle THEN 'repeal_conflict' WHEN alle THEN 'twice' WHEN v THEN 'multi_version_unsupported' WHEN h THEN 'version_conflict' ELSE 'twice' END AS issue FROM k)"""


def _units(spark, sf_dir):
    li, order, line = table(spark, sf_dir, "lineitem"), F.col("l_orderkey"), F.col("l_linenumber")
    return li.select(order.alias("law_id"), line.alias("path"), F.when(order % 11 == 0, F.col("l_returnflag")).when((line % 2 == 0) & (order % 13 == 0), F.lit(None)).otherwise("law").alias("source"), F.when(order % 7 == 0, F.col("l_linestatus") == "O").when(order % 3 == 0, True).alias("repealed"),
                     F.when((order % 5 == 0) & (line == 2), F.lit(None)).otherwise("v").alias("version_uid"), F.when(order % 4 == 0, F.col("l_suppkey").cast("string")).otherwise("h").alias("hash"), (F.col("l_quantity") > 49).alias("error"))


@query(f"""WITH {_GROUPS} SELECT law_id, path, CASE WHEN issue <> 'twice' THEN issue WHEN issue = 'twice' AND (path <> first_path OR row_number() OVER (PARTITION BY law_id, path) > 1) THEN 'duplicate' END AS issue FROM g JOIN j USING (law_id)""")
def q50_group_validity(spark, sf_dir):
    return pk.group_faults(_units(spark, sf_dir), ["law_id"]).select("law_id", "path", "issue")


@query(f"""WITH {_GROUPS}, r AS (SELECT law_id, coalesce(err OR issue <> 'twice', FALSE) AS rejected, n FROM j) SELECT rejected, count(*) AS laws, sum(n)::BIGINT AS members FROM r GROUP BY rejected""")
def q51_group_poison(spark, sf_dir):
    g = pk.group_faults(_units(spark, sf_dir), ["law_id"]).groupBy("law_id").agg(F.bool_or("rejected").alias("rejected"), F.count("*").alias("n"))
    return g.groupBy("rejected").agg(F.count("*").alias("laws"), F.sum("n").alias("members"))


@query("""WITH p AS (SELECT page_id, string_split(split_part(split_part(split_part(url, '://', 2), '?', 1), '#', 1), '/') AS parts FROM pages), f AS (SELECT DISTINCT parts[1] AS folder FROM p WHERE page_id % 2 = 0 UNION SELECT DISTINCT parts[1] || '/' || parts[2] FROM p WHERE page_id % 3 = 0 AND len(parts) > 2)
SELECT page_id, CASE WHEN len(parts) > 2 AND parts[1] || '/' || parts[2] IN (SELECT folder FROM f) THEN parts[1] || '/' || parts[2] WHEN len(parts) > 1 AND parts[1] IN (SELECT folder FROM f) THEN parts[1] END AS folder FROM p""")
def q52_nearest_ancestor(spark, sf_dir):
    """Urls as paths: the closest folder above each that is listed."""
    raw = F.split_part(F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))
    p = table(spark, sf_dir, "pages").select("page_id", raw.alias("path"))
    parts = F.split("path", "/")
    folders = p.where("page_id % 2 = 0").select(parts[0].alias("folder")).union(p.where("page_id % 3 = 0").where(F.size(parts) > 2).select(F.concat_ws("/", parts[0], parts[1]))).distinct()
    return intake.nearest_document(p, folders).select("page_id", "folder")


@query("""WITH e AS (SELECT p_partkey, p_brand || '-' || p_size::VARCHAR AS name FROM part), k AS (SELECT name, count(*) AS n, min('f/' || p_partkey::VARCHAR) AS path FROM e GROUP BY name), u AS (SELECT DISTINCT p_brand || '-' || (p_size + 1)::VARCHAR AS name FROM part)
SELECT u.name AS unit, CASE WHEN k.n IS NULL THEN 'pending' WHEN k.n = 1 THEN 'found' ELSE 'ambiguous' END AS state, CASE WHEN k.n = 1 THEN k.path END AS path FROM u LEFT JOIN k USING (name)""")
def q53_declared_file_match(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    entries = p.select(F.concat_ws("-", "p_brand", "p_size").alias("name"), F.concat(F.lit("f/"), "p_partkey").alias("path"))
    units = p.select(F.concat_ws("-", "p_brand", F.col("p_size") + 1).alias("unit")).distinct().select("unit", F.array("unit", F.concat("unit", F.lit(".x"))).alias("names"))
    return intake.match_declared(units, entries)


_EXT = "CASE p_size % 5 WHEN 0 THEN 'pdf' WHEN 1 THEN 'hwp' WHEN 2 THEN 'hwpx' WHEN 3 THEN 'docx' ELSE 'png' END"


def _files(spark, sf_dir):
    k = F.col("p_size") % 5
    ext = F.when(k == 0, "pdf").when(k == 1, "hwp").when(k == 2, "hwpx").when(k == 3, "docx").otherwise("png")
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("doc"), F.concat(F.lpad("p_partkey", 8, "0"), F.lit("."), ext).alias("name"), F.when(F.length("p_brand") % 2 == 0, "docx").alias("declared"))


@query(f"""WITH f AS (SELECT p_brand AS doc, lpad(p_partkey::VARCHAR, 8, '0') || '.' || {_EXT} AS name, {_EXT} AS ext FROM part), r AS (SELECT doc, name, ext, CASE ext WHEN 'hwpx' THEN 1 WHEN 'hwp' THEN 2 WHEN 'docx' THEN 3 WHEN 'pdf' THEN 4 ELSE 0 END AS rank FROM f)
SELECT doc, name FROM (SELECT doc, name, rank, row_number() OVER (PARTITION BY doc, rank > 0 ORDER BY rank, name) AS n FROM r) WHERE rank = 0 OR n = 1""")
def q54_format_priority(spark, sf_dir):
    return intake.best_format(_files(spark, sf_dir), ["doc"], "name").select("doc", "name")


@query(f"""WITH f AS (SELECT p_brand AS doc, lpad(p_partkey::VARCHAR, 8, '0') || '.' || {_EXT} AS name, {_EXT} AS ext, CASE WHEN length(p_brand) % 2 = 0 THEN 'docx' END AS declared FROM part), r AS (SELECT *, CASE ext WHEN 'pdf' THEN 1 WHEN 'hwpx' THEN 2 WHEN 'hwp' THEN 3 WHEN 'docx' THEN 4 ELSE 0 END AS rank FROM f)
SELECT doc, name FROM (SELECT doc, name, rank, row_number() OVER (PARTITION BY doc, rank > 0 ORDER BY CASE WHEN ext IS NOT DISTINCT FROM declared THEN 0 ELSE 1 END, rank, name) AS n FROM r) WHERE rank = 0 OR n = 1""")
def q55_format_priority_declared_first(spark, sf_dir):
    return intake.best_format(_files(spark, sf_dir), ["doc"], "name", intake.DECLARED_ORDER, "declared").select("doc", "name")


@query(f"""WITH f AS (SELECT p_brand || CASE WHEN p_size % 5 = 4 THEN 'i' ELSE '' END AS doc, lpad(p_partkey::VARCHAR, 8, '0') || '.' || {_EXT} AS name, {_EXT} AS ext, CASE WHEN length(p_brand) % 2 = 0 THEN 'docx' ELSE 'png' END AS declared FROM part),
r AS (SELECT *, CASE ext WHEN 'pdf' THEN 1 WHEN 'hwpx' THEN 2 WHEN 'hwp' THEN 3 WHEN 'docx' THEN 4 ELSE 9 END AS rank FROM f), n AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY CASE WHEN ext = declared THEN 0 ELSE 1 END, rank, name) AS k FROM r)
SELECT doc, name FROM n WHERE k = 1 AND rank < 9""")
def q109_one_file_of_a_declared_format(spark, sf_dir):
    """Parts as files of declared formats: documents that have images alone keep none."""
    f = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_brand", F.when(F.col("p_size") % 5 == 4, "i").otherwise("")).alias("doc"), F.when(F.length("p_brand") % 2 == 0, "docx").otherwise("png").alias("declared"))
    f = f.join(_files(spark, sf_dir).select(F.substring("name", 1, 8).cast("long").alias("p_partkey"), "name"), "p_partkey")
    return intake.declared_format(f, ["doc"], "name", "declared").select("doc", "name")


@query("""WITH d AS (SELECT o_custkey, count(*) AS found FROM orders GROUP BY o_custkey), m AS (SELECT c_custkey AS o_custkey, c_custkey % 20 AS declared FROM customer WHERE c_custkey % 4 <> 0)
SELECT o_custkey, coalesce(found, 0) AS found, declared, CASE WHEN declared IS NULL THEN 'manifest_missing' WHEN coalesce(found, 0) = declared THEN 'ok' ELSE 'manifest_mismatch' END AS state FROM d FULL JOIN m USING (o_custkey)""")
def q56_manifest_reconcile(spark, sf_dir):
    m = table(spark, sf_dir, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_custkey") % 20).alias("declared"))
    return intake.check_manifest(table(spark, sf_dir, "orders"), m, "o_custkey")


@query("SELECT sha256(text) AS hash, count(*) AS copies, min(doc_id) AS first_doc FROM documents GROUP BY text HAVING count(*) > 1")
def q57_duplicate_canonical_hash(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    return d.groupBy("hash").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc")).where("copies > 1")


@query("""WITH a AS (SELECT text, CASE WHEN doc_id % 6 > 0 THEN lang END AS m FROM documents WHERE doc_id % 2 = 0), i AS (SELECT doc_id, text, CASE WHEN doc_id % 3 <> 0 THEN lang END AS m FROM documents WHERE doc_id % 2 = 1)
SELECT doc_id FROM i WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.text = i.text AND (i.m IS NULL OR a.m IS NULL OR a.m = i.m))""")
def q58_delivery_dedup(spark, sf_dir):
    """Odd documents as deliveries against the even ones that were accepted; some of either came without a manifest (lang)."""
    d, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    sha = F.sha2("text", 256).alias("sha256")
    incoming = d.where("doc_id % 2 = 1").select("doc_id", sha, F.when(k % 3 != 0, F.col("lang")).alias("manifest_sha256"))
    return intake.new_deliveries(incoming, d.where("doc_id % 2 = 0").select(sha, F.when(k % 6 > 0, F.col("lang")).alias("manifest_sha256"))).select("doc_id")


@query("SELECT count(*) AS edges, count(*) FILTER (l_partkey % 3 <> 0) AS resolved, count(DISTINCT l_partkey) FILTER (l_partkey % 3 = 0) AS dangling FROM lineitem")
def q60_reference_resolution(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("reference_id"))
    p = table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("provision_id"))
    r = references.resolve(e, p)
    return r.agg(F.count("*").alias("edges"), F.count_if("resolved").alias("resolved"), F.count_distinct(F.when(~F.col("resolved"), F.col("reference_id"))).alias("dangling"))


@query("""WITH e AS (SELECT DISTINCT 'c' || c_custkey::VARCHAR AS source, 'n' || c_nationkey::VARCHAR AS target FROM customer UNION SELECT 'n' || n_nationkey::VARCHAR, 'r' || n_regionkey::VARCHAR FROM nation)
SELECT source, target, 1 AS hops FROM e WHERE source LIKE 'c%' UNION ALL SELECT a.source, b.target, 2 FROM e a JOIN e b ON a.target = b.source WHERE a.source LIKE 'c%'""")
def q61_reference_two_hop(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    name = lambda p, k: F.concat(F.lit(p), F.col(k))
    starts = c.select(name("c", "c_custkey").alias("source"))
    edges = c.select(name("c", "c_custkey").alias("source"), name("n", "c_nationkey").alias("target")).union(n.select(name("n", "n_nationkey"), name("r", "n_regionkey")))
    return references.reach(edges, starts, 2)


@query("""WITH p AS (SELECT p_partkey, 'law:' || replace(p_brand, '#', '@') || '#JO' || lpad(p_partkey::VARCHAR, 6, '0') AS provision_id, p_brand FROM part)
SELECT p_partkey, provision_id, [CASE WHEN p_partkey % 25 = 3 THEN 'law:NEW#JO1' ELSE 'law:OTHER#JO1' END, 'law:OLD2#JO2', 'law:Brand@12#JO1'] AS reference_ids FROM p WHERE p_brand <> 'Brand#11' AND NOT (p_brand = 'Brand#12' AND p_partkey % 2 = 0)""")
def q62_rename_patch(spark, sf_dir):
    """References to a renamed law move to its new head; its own old rows go; a name that others still bear moves nothing."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    law = F.when(F.col("p_brand") == "Brand#12", F.concat(F.lit("L"), (k % 2).cast("string"))).otherwise("L")
    rows = p.select(k.cast("string").alias("uuid"), "p_partkey", F.lit("law").alias("domain"), law.alias("law_id"), F.concat(F.lit("law:"), F.replace("p_brand", F.lit("#"), F.lit("@")), F.lit("#JO"), F.lpad(k.cast("string"), 6, "0")).alias("provision_id"),
                    F.array(F.when(k % 25 == 3, "law:OLD#JO1").otherwise("law:OTHER#JO1"), F.lit("law:OLD2#JO2"), F.lit("law:Brand@12#JO1")).alias("reference_ids"))
    renames = spark.createDataFrame([("law", "x", "law:OLD", "law:NEW"), ("law", "L", "law:Brand@11", "law:GONE"), ("law", "L0", "law:Brand@12", "law:MOVED")], "domain string, law_id string, old_head string, new_head string")
    return references.apply_renames(rows, renames).select("p_partkey", "provision_id", "reference_ids")


@query("SELECT * FROM (VALUES ('law:ABSENT', 'law:NEW')) t(old_head, new_head) WHERE old_head NOT IN (SELECT 'law:' || replace(p_brand, '#', '@') FROM part)")
def q63_rename_ambiguity_guard(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("law:"), F.replace("p_brand", F.lit("#"), F.lit("@")), F.lit("#JO1")).alias("provision_id"))
    alive = rows.select(F.regexp_extract("provision_id", "^([^#]*)", 1).alias("old_head"), F.lit("law:X").alias("new_head")).distinct()
    return references.unambiguous(alive.union(spark.createDataFrame([("law:ABSENT", "law:NEW")], alive.schema)), rows)


@query("""WITH u AS (SELECT l_orderkey, l_linenumber, l_returnflag, count(*) OVER (PARTITION BY l_orderkey, l_returnflag) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem),
w AS (SELECT *, 'law:문서' || l_orderkey::VARCHAR || '#' || CASE l_returnflag WHEN 'A' THEN 'BYL0001' WHEN 'N' THEN 'BJ0001' ELSE 'FORM0001' END AS p FROM u)
SELECT l_orderkey, l_linenumber, p AS provision_id, CASE WHEN n > 1 THEN p || CASE WHEN l_linenumber % 2 = 0 THEN ':file:' || (10000 + l_linenumber)::VARCHAR ELSE ':idx:' || lpad(i::VARCHAR, 4, '0') END END AS instance_id FROM w""")
def q64_duplicate_unit_instance(spark, sf_dir):
    """Lines of an order as its appendices: units that repeat inside a document get instance ids, by their file's number or their place."""
    li, line = table(spark, sf_dir, "lineitem"), F.col("l_linenumber")
    kind = F.when(F.col("l_returnflag") == "A", "별표").when(F.col("l_returnflag") == "N", "별지").otherwise("서식")
    files = F.array(F.struct(F.lit("hwp").alias("type"), F.when(line % 2 == 0, F.concat(F.lit("u?flSeq="), (line + 10_000).cast("string"))).otherwise("u").alias("url"), F.lit("").alias("name")))
    entry = F.struct("l_linenumber", "l_partkey", "l_suppkey", kind.alias("kind"), F.lit("1").alias("no"), F.lit("00").alias("branch"), F.lit("").alias("title"), files.alias("files"))
    docs = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(entry)).alias("appendices")).select("l_orderkey", F.concat(F.lit("문서 "), F.col("l_orderkey").cast("string")).alias("law_name"), F.lit("law").alias("doc_target"), F.lit(None).cast("string").alias("id_suffix"), F.lit(None).cast(_ARTICLES).alias("articles"), "appendices")
    # outer: Spark would put a test of the array's size before the ids and make them twice
    a = identifiers.identify(docs).select("l_orderkey", F.explode_outer("appendices").alias("a")).where("a is not null")
    return a.select("l_orderkey", "a.l_linenumber", "a.provision_id", F.col("a.appendix_instance_id").alias("instance_id"))


@query("""SELECT p_partkey, 'law:N' || CASE WHEN p_size % 4 = 3 THEN 'x' ELSE '' END || (p_partkey % 10)::VARCHAR || '#JO1' AS reference, '{"n":1,"relation_refs":[{"reference_id":"law:N' || CASE WHEN p_size % 4 = 3 THEN 'x' ELSE '' END || (p_partkey % 10)::VARCHAR || '#JO1","k":"v"}]}' AS meta
FROM (SELECT p_partkey, p_size FROM part) WHERE p_size % 4 = 3
UNION ALL SELECT p_partkey, 'law:N' || (p_partkey % 10)::VARCHAR || '_9#JO1', '{"n":1,"relation_refs":[{"reference_id":"law:N' || (p_partkey % 10)::VARCHAR || '_9#JO1","k":"v"}]}' FROM part WHERE p_size % 4 <> 3""")
def q107_chains_of_renames(spark, sf_dir):
    """Parts that refer to documents renamed nine times in one package: references, and what meta holds of them, end at the last name."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    ref = F.when(F.col("p_size") % 4 == 3, F.concat(F.lit("law:Nx"), (k % 10).cast("string"), F.lit("#JO1"))).otherwise(F.concat(F.lit("law:N"), (k % 10).cast("string"), F.lit("_"), (F.col("p_size") % 9).cast("string"), F.lit("#JO1")))
    rows = p.select(k.cast("string").alias("uuid"), "p_partkey", F.lit("law").alias("domain"), F.lit("P").alias("law_id"), F.concat(F.lit("law:P#JO"), k.cast("string")).alias("provision_id"), F.array(ref).alias("reference_ids"), F.concat(F.lit('{"n":1,"relation_refs":[{"reference_id":"'), ref, F.lit('","k":"v"}]}')).alias("meta"))
    steps = p.select((k % 10).alias("d")).distinct().select("d", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("i"))
    name = lambda i: F.concat(F.lit("law:N"), F.col("d").cast("string"), F.lit("_"), i.cast("string"))
    renames = steps.select(F.lit("law").alias("domain"), F.concat(F.lit("L"), "d").alias("law_id"), name(F.col("i")).alias("old_head"), name(F.col("i") + 1).alias("new_head"), F.col("i").cast("long").alias("at"))
    return references.apply_renames(rows, renames).select("p_partkey", F.col("reference_ids")[0].alias("reference"), "meta")


@query("""SELECT p_size, p_brand, count(*) AS n, TRUE AS same FROM part GROUP BY ALL""")
def q108_hash_of_values(spark, sf_dir):
    """Parts as JSON of two layouts, keys in either order: one hash for each value, whatever it looks like."""
    from lexspark.sources import documents

    p = table(spark, sf_dir, "part")
    one = F.concat(F.lit('{"size": '), F.col("p_size").cast("string"), F.lit(', "b": ["'), "p_brand", F.lit('", null]}'))
    other = F.concat(F.lit('{"b":["'), "p_brand", F.lit('" , null],\n "size":'), F.col("p_size").cast("string"), F.lit("}"))
    h = lambda c: documents.canonical_hash(F.parse_json(c))
    both = p.select("p_size", "p_brand", h(F.when(F.col("p_partkey") % 2 == 0, one).otherwise(other)).alias("h"))
    seen = both.groupBy("h").agg(F.count("*").alias("n"), F.countDistinct("p_size", "p_brand").alias("values"), F.first("p_size").alias("p_size"), F.first("p_brand").alias("p_brand"))
    return seen.select("p_size", "p_brand", "n", (F.col("values") == 1).alias("same"))


@query("SELECT DISTINCT o_custkey, TRUE AS same FROM orders")
def q70_stream_replay_equals_batch(spark, sf_dir):
    """Orders as packages that the consumer takes one by one, twice; the table that results against a batch fold, by customer."""
    from lexspark.functions.scratch import folder
    from lexspark.operators import store as st
    from lexspark.sources import packages as src
    from lexspark.streaming import consumer

    o, at = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), folder(spark, "replay")
    version = F.concat_ws(":", "o_custkey", "o_orderkey", F.lpad(F.col("o_orderkey").cast("string"), 8, "0"))
    record = F.to_json(F.struct(F.lit("document").alias("record_type"), F.col("o_custkey").cast("string").alias("law_id"), F.struct(F.col("o_custkey").cast("string").alias("law_id"), version.alias("version_uid"), F.col("o_orderstatus").alias("content")).alias("payload")))
    rows = o.select(F.concat(F.lit("p"), (F.col("o_orderkey") % 3).cast("string")).alias("package"), F.lit("law").alias("source"), F.col("o_orderkey").alias("ord"), record.alias("record"))
    src.write_packages(rows, f"{at}/out")

    def to_rows(folded):
        d = F.from_json("document", "law_id string, version_uid string, content string")
        found = folded.select(d.alias("d")).select(F.lit("law").alias("domain"), "d.law_id", "d.version_uid", F.split_part("d.version_uid", F.lit(":"), F.lit(2)).alias("mst"), F.lit("JSON").alias("source_type"), F.col("d.content").alias("content"))
        return found.withColumn("chunk_id", F.concat_ws("-", "law_id", "version_uid")).withColumn("uuid", F.col("chunk_id"))

    for attempt in range(2):
        consumer.consume(spark, f"{at}/out", f"{at}/table", f"{at}/checkpoint-{attempt}", to_rows, glob="*.txt")
    got = st.current(spark, f"{at}/table").select(F.col("law_id").cast("long").alias("o_custkey"), "content", F.col("mst").cast("long").alias("last"))
    batch = pk.last_wins(o, ["o_custkey"], "o_orderkey", "o_orderstatus", "o_orderkey")
    same = F.col("content").eqNullSafe(F.col("o_orderstatus")) & F.col("last").eqNullSafe(F.col("o_orderkey"))
    return got.join(batch, "o_custkey", "full_outer").select("o_custkey", same.alias("same"))


@query("""WITH e AS (SELECT p_partkey % 3 AS run, 'z' || lpad(p_partkey::VARCHAR, 8, '0') AS zip, p_brand || p_size::VARCHAR AS sha, p_size % 5 = 0 AS broken, p_size % 3 AS rejected FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY run, sha ORDER BY zip) AS k, min(run) OVER (PARTITION BY sha) < run AS earlier FROM e)
SELECT run, zip, CASE WHEN k > 1 OR NOT broken AND earlier THEN 'duplicate' WHEN broken THEN 'failed' WHEN rejected = 0 THEN 'done' ELSE 'partial' END AS state, CASE WHEN broken AND k = 1 THEN 'zip_corrupt' END AS reason FROM r""")
def q102_states_in_the_stream(spark, sf_dir):
    """Parts as deliveries of three runs that come as a stream: what was done before is known from the stream's own state."""
    from lexspark.functions.scratch import folder
    from lexspark.streaming import states

    p, at, run = table(spark, sf_dir, "part"), folder(spark, "states"), F.col("p_partkey") % 3
    none = F.lit(None).cast("string")
    e = p.select(F.lit("q").alias("queue"), run.cast("long").alias("run"), F.make_timestamp(F.lit(2024), F.lit(1), (run + 1).cast("int"), F.lit(0), F.lit(0), F.lit(0)).alias("at"), F.concat(F.lit("z"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("zip"),
                 F.concat("p_brand", F.col("p_size").cast("string")).alias("sha256"), F.lit(True).alias("manifest"), F.when(F.col("p_size") % 5 == 0, "zip_corrupt").otherwise(none).alias("convert_error"), F.lit(1).cast("long").alias("accepted"), (F.col("p_size") % 3).cast("long").alias("rejected"), F.lit(0).cast("long").alias("zip_errors"), F.lit(False).alias("pending"), F.lit(False).alias("failed"))
    name = "spark.sql.streaming.stateStore.providerClass"
    held = spark.conf.get(name)
    spark.conf.set(name, states.STORE)
    try:
        for k in range(3):  # the runs come one after the other, each to a stream that is started anew
            e.where(F.col("run") == k).write.mode("append").parquet(f"{at}/in")
            stream = states.delivery_states(spark.readStream.schema(states.EVENTS).parquet(f"{at}/in"))
            stream.writeStream.foreachBatch(lambda df, n: df.write.mode("append").parquet(f"{at}/out")).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(name, held)
    return spark.read.schema(states.STATES).parquet(f"{at}/out").where("run >= 0").select("run", "zip", "state", "reason")


@query("""SELECT CASE page_id % 5 WHEN 0 THEN 'path_unsafe' WHEN 1 THEN 'os_metadata_ignored' WHEN 2 THEN 'good' WHEN 3 THEN 'manifest_ignored' ELSE 'unsupported_extension' END AS fault, count(*) AS n, sum(length(url))::BIGINT AS chars FROM pages GROUP BY 1""")
def q59_path_faults(spark, sf_dir):
    """Member paths made from page urls: climbing, system files, documents, manifests and others."""
    k, tail = F.col("page_id") % 5, F.concat(F.replace("url", F.lit("://"), F.lit("/")), F.lit("_"))
    path = (F.when(k == 0, F.concat(F.lit("../"), tail, F.lit(".json"))).when(k == 1, F.concat(F.lit("__MACOSX/"), tail, F.lit(".pdf"))).when(k == 2, F.concat(tail, F.lit(".HWPX"))).when(k == 3, F.concat(tail, F.lit(".manifest.json"))).otherwise(F.concat(tail, F.lit(".exe"))))
    return table(spark, sf_dir, "pages").select(F.coalesce(intake.path_fault(path), F.lit("good")).alias("fault"), "url").groupBy("fault").agg(F.count("*").alias("n"), F.sum(F.length("url")).alias("chars"))
