"""Queries over ids, names, relations, raw bodies, delivered files and what packages bring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexspark.functions import names
from lexspark.operators import conversion, identifiers, intake, payloads, references, rules, units
from lexspark.operators import packages as pk
from lexspark.operators import store as st
from lexspark.plans.texts import table
from lexspark.sources import documents
from lexspark.sources import packages as src
from lexspark.streaming import consumer

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


@query("""WITH s AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 'admrul' ELSE 'law' END AS domain, 'L' || (c_custkey % 50)::VARCHAR AS law_id, c_custkey FROM customer),
g AS (SELECT DISTINCT CASE WHEN c_custkey % 2 = 0 THEN 'law' ELSE 'admrul' END AS domain, 'L' || (c_custkey % 50)::VARCHAR AS law_id FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 50 < 25)
SELECT s.domain, s.law_id, count(*) AS n FROM s LEFT JOIN g USING (domain, law_id) WHERE g.law_id IS NULL GROUP BY ALL""")
def q76_flush_domain_deletes(spark, sf_dir):
    """Deletes from packages of two sources: a law goes in its package's domain alone, or in that of its own target."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    law = F.concat(F.lit("L"), text(k % 50))
    stored = c.select(F.when(k % 3 == 0, "admrul").otherwise("law").alias("domain"), law.alias("law_id"), F.lit("v").alias("version_uid"), F.lit("1").alias("mst"), F.lit("JSON").alias("source_type"), text(k).alias("chunk_id"), text(k).alias("uuid"))
    lines = c.where("c_mktsegment = 'BUILDING' and c_custkey % 50 < 25").select(F.when(k % 4 == 0, "law").when(k % 2 == 0, "mixed").otherwise("admrul").alias("package"), k.cast("int").alias("line_no"),
                                                                             F.to_json(F.struct(F.lit("delete").alias("record_type"), law.alias("law_id"), F.when(k % 4 == 2, "eflaw").alias("doc_target"))).alias("body"))
    heads = spark.createDataFrame([(p, -1, f'{{"record_type": "package_header", "source": "{s}"}}') for p, s in (("law", "law"), ("mixed", "admrul"), ("admrul", "admrul"))], lines.schema)
    records = consumer.with_domain(src.parse_records(lines.unionByName(heads))).where("record_type <> 'package_header'")
    return consumer.flush(stored, pk.fold_laws(records), records.where("record_type = 'rename'"), stored.limit(0)).groupBy("domain", "law_id").agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT o_custkey, o_orderkey, o_orderdate AS d FROM orders), b AS (SELECT o_custkey, max((d, o_orderkey)) AS best FROM r WHERE o_orderkey % 2 = 0 GROUP BY o_custkey)
SELECT r.o_custkey::VARCHAR AS law_id, r.o_orderkey::VARCHAR AS mst FROM r JOIN b USING (o_custkey) WHERE r.o_orderkey % 2 = 1 AND (r.d, r.o_orderkey) < b.best""")
def q77_version_guard_dashed(spark, sf_dir):
    """The version guard where stored versions have plain dates and incoming ones dashed."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    day = F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = o.select(F.lit("law").alias("domain"), text("o_custkey").alias("law_id"), F.concat_ws(":", "o_custkey", k, day).alias("version_uid"), text(k).alias("mst"), k)
    return st.older_than_stored(rows.where(k % 2 == 1), rows.where(k % 2 == 0)).select("law_id", "mst")


@query("""WITH p AS (SELECT c_custkey AS package, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS records FROM customer)
SELECT package, records, CASE package % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN records ELSE records + 5 END AS record_count, CASE WHEN package % 4 = 0 THEN 'retry' WHEN package % 4 = 1 AND records > 0 OR package % 4 = 3 THEN 'quarantine' ELSE 'ok' END AS verdict FROM p""")
def q78_reconcile_from_headers(spark, sf_dir):
    """Customers as packages and their orders as records: packages without a record are judged by header and footer."""
    c, k = table(spark, sf_dir, "customer"), F.col("package")
    heads = c.select(F.col("c_custkey").alias("package"))
    records = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("package"))
    n = heads.join(records.groupBy("package").agg(F.count("*").alias("n")), "package", "left")
    feet = n.where(k % 4 != 0).select("package", F.when(k % 4 == 1, 0).when(k % 4 == 2, F.coalesce("n", F.lit(0))).otherwise(F.coalesce("n", F.lit(0)) + 5).cast("long").alias("record_count"))
    return pk.reconcile(records, ["package"], feet, heads)


@query("""SELECT o_orderkey, 'JO' || lpad((o_orderkey % 999 + 1)::VARCHAR, 4, '0') || CASE WHEN o_custkey % 4 = 1 THEN '-' || lpad((o_custkey % 30 + 1)::VARCHAR, 2, '0') ELSE '' END || CASE WHEN o_custkey % 3 = 1 THEN '_' || lpad((o_custkey % 12 + 2)::VARCHAR, 2, '0') ELSE '' END AS article,
 CASE o_orderkey % 6 WHEN 0 THEN 'BYL' WHEN 1 THEN 'BJ' WHEN 2 THEN 'FORM' WHEN 3 THEN 'ATT' WHEN 4 THEN 'ANN' ELSE 'BC' END || lpad((o_orderkey % 20 + 1)::VARCHAR, 4, '0') || CASE WHEN o_custkey % 3 = 1 THEN '_' || lpad((o_custkey % 12 + 2)::VARCHAR, 2, '0') ELSE '' END AS appendix,
 CASE WHEN o_orderkey % 6 = 2 AND o_custkey % 2 = 0 THEN 'BJ' WHEN o_orderkey % 6 = 0 THEN 'BYL' WHEN o_orderkey % 6 = 1 THEN 'BJ' WHEN o_orderkey % 6 = 2 THEN 'FORM' WHEN o_orderkey % 6 = 3 THEN 'ATT' WHEN o_orderkey % 6 = 4 THEN 'ANN' ELSE 'BC' END || lpad((o_orderkey % 20 + 1)::VARCHAR, 4, '0') AS own FROM orders""")
def q80_unit_codes_of_labels(spark, sf_dir):
    """Labels of articles and appendices, written in several ways, to their codes; and appendices whose titles name a sheet."""
    o, k, c = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    branch = F.when(c % 3 == 1, F.concat(F.lit("의"), text(c % 12 + 2))).otherwise("")
    article = F.concat(F.lit("제 "), text(k % 999 + 1), F.when(c % 4 == 1, F.concat(F.lit("-"), text(c % 30 + 1))).otherwise(""), F.lit("조"), branch)
    kind = F.element_at(F.array(*map(F.lit, ("별표", "별지", "서식", "붙임", "부속서", "별첨"))), (k % 6 + 1).cast("int"))
    circled = F.substring(F.lit(identifiers.CIRCLED), (k % 20 + 1).cast("int"), F.lit(1))
    label = F.concat(kind, F.when(c % 5 == 0, circled).when(c % 2 == 0, F.concat(F.lit(" 제"), text(k % 20 + 1), F.lit("호"))).otherwise(text(k % 20 + 1)), branch)
    title = F.when(c % 2 == 0, F.concat(F.lit("[별지 제"), text(k % 20 + 1), F.lit("호 서식] 신청서"))).otherwise("기준(별표 99 관련)")
    own = identifiers.appendix_unit(kind, F.lpad(text(k % 20 + 1), 4, "0"), F.lit("00"), title)
    return o.select("o_orderkey", identifiers.unit_of(article).alias("article"), identifiers.unit_of(label).alias("appendix"), own.alias("own"))


@query("""WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem)
SELECT l_orderkey, i::INTEGER AS i, 'law:문서' || l_orderkey::VARCHAR || '#JO' || lpad(i::VARCHAR, 4, '0') AS source_id,
 CASE WHEN l_linenumber % 4 = 0 THEN 'law:문서' || l_orderkey::VARCHAR || '#JO0001' WHEN l_linenumber % 4 = 1 THEN 'admrul:고시' || l_partkey::VARCHAR || '#JO0002_03' WHEN l_linenumber % 4 = 2 THEN 'ordin:시' || l_suppkey::VARCHAR || '조례#DOC' ELSE 'law:법' || l_partkey::VARCHAR || '#BYL0007' END AS reference_id,
 CASE WHEN l_linenumber % 4 = 1 THEN '고시 ' || l_partkey::VARCHAR || '/고시 ' || l_partkey::VARCHAR || '.json' WHEN l_linenumber % 4 = 3 THEN '법 ' || l_partkey::VARCHAR || '/법률/법 ' || l_partkey::VARCHAR || '.json' WHEN l_linenumber % 4 = 0 THEN '문서 ' || l_orderkey::VARCHAR || '/법률/문서 ' || l_orderkey::VARCHAR || '.json' END AS path FROM n""")
def q81_reference_ids(spark, sf_dir):
    """Lines of an order as its articles, each with one reference: inside, to rules, to ordinances, to another law's appendix."""
    no = lambda c: F.lit(c).cast("string")

    def relation(x: Column) -> Column:
        k, part = x["l_linenumber"] % 4, text(x["l_partkey"])
        given = {"relation_type": F.when(k == 0, "internal_ref").when(k == 3, "appendix_ref").otherwise("citation"), "target_law_name": F.when(k == 0, F.concat(F.lit("문서 "), text("l_orderkey"))).when(k == 1, F.concat(F.lit("고시 "), part)).when(k == 2, F.concat(F.lit("시 "), text(x["l_suppkey"]), F.lit(" 조례"))).otherwise(F.concat(F.lit("법 "), part)),
                 "target_category": F.when(k == 1, "행정규칙"), "target_article_no": F.when(k == 0, "제1조").when(k == 1, "제2조의3"), "appendix_kind": F.when(k == 3, "별표"), "appendix_no": F.when(k == 3, "7"), "appendix_ambiguous": F.lit(False)}
        return F.struct(*[given.get(c, no(None)).alias(c) for c in identifiers.RELATION])

    # lines are gathered by their keys, not with the texts made of them
    docs = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("e"))
    articles = F.transform("e", lambda x, i: F.struct(F.concat(F.lit("제"), text(i + 1), F.lit("조")).alias("article_no"), F.array(relation(x)).alias("relations")))
    docs = docs.select("l_orderkey", F.concat(F.lit("문서 "), text("l_orderkey")).alias("law_name"), no(None).alias("doc_target"), no(None).alias("id_suffix"), articles.alias("articles"), F.array().cast("array<struct<kind: string, no: string, branch: string, title: string, files: array<struct<type: string, url: string, name: string>>>>").alias("appendices"))
    a = identifiers.identify(docs).select("l_orderkey", F.posexplode_outer("articles").alias("pos", "a")).where("pos is not null").select("l_orderkey", (F.col("pos") + 1).alias("i"), F.get("a.relations", F.lit(0)).alias("r"))
    return a.select("l_orderkey", "i", F.col("r.source_provision_id").alias("source_id"), "r.reference_id", F.col("r.target_path.path").alias("path"))


@query("""WITH p AS (SELECT p_partkey, p_name, CASE p_partkey % 3 WHEN 0 THEN ' 시행령' WHEN 1 THEN '시행규칙' ELSE '' END AS tail, CASE p_partkey % 3 WHEN 0 THEN '시행령' WHEN 1 THEN '시행규칙' ELSE '법률' END AS kind FROM part)
SELECT p_partkey, p_name AS family, kind, CASE WHEN p_partkey % 5 = 0 THEN p_name || tail || '/' || p_name || tail || '.json' ELSE p_name || '/' || kind || '/' || p_name || tail || '.json' END AS path,
 '별표' || (p_partkey % 30)::VARCHAR || CASE WHEN p_partkey % 4 > 0 THEN '의' || (p_partkey % 4)::VARCHAR ELSE '' END || '_' || p_name AS label, CASE p_partkey % 4 WHEN 0 THEN 'hwp' WHEN 1 THEN 'jpg' WHEN 2 THEN 'pdf' ELSE 'bin' END AS extension FROM p""")
def q82_names_and_paths(spark, sf_dir):
    """Parts as documents: families, ranks, repository paths, labels of appendices and extensions."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    name = F.concat("p_name", F.when(k % 3 == 0, " 시행령").when(k % 3 == 1, "시행규칙").otherwise(""))
    kind, base = F.when(k % 4 == 0, "HWP").otherwise(""), F.when(k % 4 == 0, "x").when(k % 4 == 1, "a.JPEG").when(k % 4 == 2, "b.pdf").otherwise("c")
    return p.select("p_partkey", names.family(name).alias("family"), names.kind_of(name).alias("kind"), names.git_path(F.when(k % 5 == 0, "admrul"), name).alias("path"),
                    names.appendix_label(F.lit(""), F.lpad(text(k % 30), 4, "0"), F.lpad(text(k % 4), 2, "0"), F.col("p_name")).alias("label"), names.file_extension(kind, base, F.lit("d")).alias("extension"))


@query("""WITH t AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) AS k FROM conversations), f AS (SELECT conv_id, role, turn FROM t WHERE k = 1)
SELECT conv_id, list(role ORDER BY turn, role) AS ids, list(CASE WHEN turn % 2 = 0 THEN NULL ELSE turn::VARCHAR END ORDER BY turn, role) AS link_texts, (SELECT count(*) FROM conversations c WHERE c.conv_id = f.conv_id AND c.turn % 3 = 0)::INTEGER AS scheduled, (SELECT count(*) FROM conversations c WHERE c.conv_id = f.conv_id AND c.role = 'user')::INTEGER AS groups FROM f GROUP BY conv_id""")
def q83_relation_columns(spark, sf_dir):
    """Turns as relations, announced changes and ordinance groups of an article: what its first chunk carries."""
    given = {"reference_id": F.col("role"), "link_text": F.when(F.col("turn") % 2 == 0, "").otherwise(text("turn"))}
    relation = F.struct(*[given.get(c, F.lit(None).cast("string")).alias(c) for c in ("reference_id", *units.RELATION_KEYS, *units.RELATION_MORE)])
    change = F.struct(F.lit("20250101").alias("enforcement_date"), F.lit("개정").alias("change"), F.col("text").alias("content"))
    group = F.struct(F.when(F.col("role") == "user", "제1조").otherwise("제2조").alias("source_article_no"), F.col("role").alias("link_text"), F.lit(2).alias("ordinance_count"), F.array().cast("array<string>").alias("ordinances"))
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", relation.alias("r"), change.alias("s"), group.alias("g")))).alias("t"))
    pick = lambda f: F.transform("t", f)
    refs = units.relation_refs(pick(lambda x: x["r"]))
    return c.select("conv_id", F.transform(refs, lambda r: r["reference_id"]).alias("ids"), F.transform(refs, lambda r: r["link_text"]).alias("link_texts"), F.size(F.coalesce(units.scheduled_changes(F.transform(F.filter("t", lambda x: x["turn"] % 3 == 0), lambda x: x["s"])), F.array())).alias("scheduled"),
                    F.size(F.coalesce(units.ordinance_summary(pick(lambda x: x["g"]), F.lit("제1조")), F.array())).alias("groups"))


@query("""WITH f AS (SELECT p_brand AS doc, p_partkey, 'x/' || CASE p_partkey % 5 WHEN 0 THEN '[별표 ' || p_partkey::VARCHAR || '] ' || p_name || '(법).hwp' WHEN 1 THEN '[별지 제' || p_partkey::VARCHAR || '호서식] ' || p_name || '.pdf' WHEN 2 THEN p_name || '¸ ' || p_partkey::VARCHAR || '.hwp' WHEN 3 THEN 'unknown' || p_partkey::VARCHAR || '.hwp' ELSE '[별표 ' || p_partkey::VARCHAR || '] ' || p_name || '.gif' END AS path, p_name FROM part)
SELECT doc, path, CASE p_partkey % 5 WHEN 3 THEN 'keep' WHEN 4 THEN 'drop' ELSE 'rename' END AS action, CASE p_partkey % 5 WHEN 0 THEN '별표' || p_partkey::VARCHAR || '_' || p_name || '.hwp' WHEN 1 THEN '서식' || p_partkey::VARCHAR || '_' || p_name || '.pdf' WHEN 2 THEN p_name || ', ' || p_partkey::VARCHAR || '.hwp' END AS target FROM f""")
def q84_plan_files(spark, sf_dir):
    """Parts as delivered files of their brand's document: renamed as declared, dropped, or left as they are."""
    p, k, n = table(spark, sf_dir, "part"), F.col("p_partkey") % 5, text("p_partkey")
    at = F.when(k == 0, F.concat(F.lit("[별표 "), n, F.lit("] "), "p_name", F.lit("(법).hwp"))).when(k == 1, F.concat(F.lit("[별지 제"), n, F.lit("호서식] "), "p_name", F.lit(".pdf"))).when(k == 2, F.concat("p_name", F.lit("¸ "), n, F.lit(".hwp"))).when(k == 3, F.concat(F.lit("unknown"), n, F.lit(".hwp"))).otherwise(F.concat(F.lit("[별표 "), n, F.lit("] "), "p_name", F.lit(".gif")))
    doc = F.col("p_brand").alias("doc")
    declared = p.where(k.isin(0, 1, 4)).select(doc, F.concat(F.when(k == 1, "서식").otherwise("별표"), n, F.lit("_"), "p_name", F.when(k == 4, ".pdf").otherwise(".hwp")).alias("filename"))
    attached = p.where(k == 2).select(doc, F.concat("p_name", F.lit(", "), n, F.lit(".hwp")).alias("name"))
    return conversion.plan_files(p.select(doc, F.concat(F.lit("x/"), at).alias("path")), declared, attached).select("doc", "path", "action", "target")


@query("""WITH t AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM conversations), n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)
SELECT conv_id, CASE WHEN conv_id % 7 = 0 THEN 'sequence_missing' END AS error, conv_id::VARCHAR || ':' || CASE WHEN conv_id % 7 = 0 THEN '' ELSE (conv_id * 3 + 1)::VARCHAR END || ':20240101' AS version_uid, n::INTEGER AS articles, '제' || n::VARCHAR || '조' AS last_article, 'law:문서' || conv_id::VARCHAR || '#JO' || lpad(n::VARCHAR, 4, '0') AS last_id FROM n""")
def q85_statutes_from_raw(spark, sf_dir):
    """Conversations as raw statute bodies, their turns as articles at some depth, to payloads with ids."""
    unit = lambda x, i: F.struct(F.lit("조문").alias("조문여부"), text(i + 1).alias("조문번호"), F.coalesce(x["text"], F.lit("")).alias("조문내용"))
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    info = F.struct(text("conv_id").alias("법령ID"), F.when(F.col("conv_id") % 7 > 0, text(F.col("conv_id") * 3 + 1)).alias("공포번호"), F.lit("20240101").alias("시행일자"))
    body = F.to_json(F.struct(F.struct(info.alias("기본정보"), F.struct(F.transform("t", unit).alias("조문단위")).alias("조문")).alias("법령")))
    s = conversion.statutes(c.select("conv_id", body.alias("body"), F.concat(F.lit("문서 "), text("conv_id")).alias("name"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("sequence")))
    last = F.element_at("articles", -1)
    return s.select("conv_id", "error", "version_uid", F.size("articles").alias("articles"), last["article_no"].alias("last_article"), last["provision_id"].alias("last_id"))


@query("""WITH t AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM conversations), n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)
SELECT conv_id, '제' || i::VARCHAR || '조' AS article_no, role AS title, CASE WHEN conv_id % 2 = 0 THEN '제1장 머리' ELSE '' END AS chapter, length('제' || i::VARCHAR || '조(' || role || ') 본문' || i::VARCHAR)::INTEGER + CASE WHEN conv_id % 3 = 0 THEN length(' 「다른법」 ') + length('제99조(인용)에 따른다') ELSE 0 END AS chars FROM t""")
def q86_rule_articles(spark, sf_dir):
    """Turns as a rule's flat text: two articles in an item, citations in between, a chapter in front."""
    cited = F.when(F.col("conv_id") % 3 == 0, " 「다른법」 제99조(인용)에 따른다").otherwise("")
    one = lambda x, i, cite: F.concat(F.lit("제"), text(i + 1), F.lit("조("), x["role"], F.lit(") 본문"), text(i + 1), cite)
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t")).withColumn("cite", cited)
    parts = F.transform("t", lambda x, i: one(x, i, F.col("cite")))
    head = F.when(F.col("conv_id") % 2 == 0, F.array(F.lit("제1장 머리"))).otherwise(F.array().cast("array<string>"))
    items = c.select("conv_id", F.concat(head, parts).alias("items"))
    a = rules.rule_articles(items, "conv_id").select("conv_id", F.explode("articles").alias("a"))
    return a.select("conv_id", "a.article_no", F.col("a.article_title").alias("title"), "a.chapter", F.length("a.content").alias("chars"))


@query("""WITH t AS (SELECT conv_id, conv_id % 5 AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM conversations), n AS (SELECT conv_id, k, max(i) AS n FROM t GROUP BY ALL)
SELECT conv_id, '제1-1조' AS article_no, '제1장 머리' AS path, '제1-1조 본문은' || chr(10) || string_agg('뒤' || i::VARCHAR, chr(10) ORDER BY i) AS content FROM t WHERE k = 0 GROUP BY conv_id
UNION ALL SELECT conv_id, '제1조', '', string_agg('제1조(가) u' || i::VARCHAR, chr(10) ORDER BY i) FROM t WHERE k = 1 GROUP BY conv_id
UNION ALL SELECT conv_id, '제' || i::VARCHAR || '조', '', '제' || i::VARCHAR || '조(가) 본문 건축법' || chr(10) || '제90조(나) 끝 「규칙」' || chr(10) || '제91조(다)' || chr(10) || '제92조(라)에 따른다' FROM t WHERE k = 2
UNION ALL SELECT conv_id, '전문', '', '제1조(가) 머리' || chr(10) || repeat('1-1-1. 항목이 이어진다 ', 200) || '끝' || n::VARCHAR FROM n WHERE k = 3
UNION ALL SELECT conv_id, '제' || (i + 1)::VARCHAR || '조', CASE WHEN i % 2 = 0 THEN '제2장 짝' ELSE '제1장 홀' END, '제' || (i + 1)::VARCHAR || '조(가) 본문' || chr(10) || '제1조(나) 뒤' FROM t WHERE k = 4""")
def q100_rule_marks(spark, sf_dir):
    """Rules of five kinds: an article of no title behind its chapter, a number again and again, citations by names and particles, an outline, numbers that go back under chapters in turn."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.size(F.collect_list("turn")).alias("n"))
    k, each = F.col("conv_id") % 5, F.sequence(F.lit(1), F.col("n"))
    per = lambda f: F.transform(each, f)
    items = (F.when(k == 0, F.concat(F.array(F.lit("제1장 머리제1-1조 본문은")), per(lambda i: F.concat(F.lit("뒤"), text(i))))).when(k == 1, per(lambda i: F.concat(F.lit("제1조(가) u"), text(i))))
             .when(k == 2, per(lambda i: F.concat(F.lit("제"), text(i), F.lit("조(가) 본문 건축법 제90조(나) 끝 「규칙」 제91조(다) 제92조(라)에 따른다")))).when(k == 3, F.array(F.lit("제1조(가) 머리"), F.concat(F.repeat(F.lit("1-1-1. 항목이 이어진다 "), 200), F.lit("끝"), text("n"))))
             .otherwise(F.flatten(per(lambda i: F.array(F.when(i % 2 == 0, "제2장 짝").otherwise("제1장 홀"), F.concat(F.lit("제"), text(i + 1), F.lit("조(가) 본문 제1조(나) 뒤")))))))
    a = rules.rule_articles(c.select("conv_id", items.alias("items")), "conv_id").select("conv_id", F.explode("articles").alias("a"))
    return a.select("conv_id", "a.article_no", F.col("a.chapter_path").alias("path"), "a.content")


@query("""WITH p AS (SELECT page_id, page_id % 3 AS k, url, 'f' || page_id::VARCHAR AS stem, CASE WHEN page_id % 5 = 0 THEN '시험 법' END AS law FROM pages),
t AS (SELECT *, concat_ws(chr(10), law, CASE WHEN k = 0 THEN concat_ws(chr(10), '별지', '별지 ' || page_id::VARCHAR || '의2', '제목 ' || stem) WHEN k = 1 THEN '문서 전체 원문' || chr(10) || stem END, CASE WHEN k < 2 THEN '7페이지' ELSE stem || '.hwp' END, url) AS said FROM p)
SELECT page_id, CASE WHEN k = 2 THEN stem || '.hwp' ELSE stem END AS unit_title, CASE WHEN k = 1 THEN 'document_file' ELSE 'attachment' END AS file_kind, CASE WHEN k = 0 THEN 'APPENDIX' ELSE 'FILE' END AS unit_type, 1::INTEGER AS chunk_index, 1::INTEGER AS chunk_count, CASE WHEN k = 2 THEN 7 END::INTEGER AS start_page,
  sha256(url) AS content_hash, sha256(said) AS search_hash FROM t""")
def q101_file_rows(spark, sf_dir):
    """Pages as parsed files: an appendix's, a document's whole text, and one whose chunks came as records; a filler comes first in each."""
    p, k = table(spark, sf_dir, "pages"), F.col("page_id") % 3
    none = F.lit(None).cast("string")
    chunks = F.array(F.struct(F.lit(None).cast("int").alias("chunk_index"), F.lit("| --- |").alias("content"), F.lit(1).alias("page_no")), F.struct(F.lit(None).cast("int").alias("chunk_index"), F.col("url").alias("content"), F.lit(7).alias("page_no")))
    rows = p.select("page_id", text("page_id").alias("version_uid"), F.lit("L").alias("law_id"), F.when(k == 0, "law:x#BJ0001").alias("provision_id"), none.alias("file_id"), F.concat(F.lit("f"), text("page_id"), F.lit(".hwp")).alias("file_name"), none.alias("file_url"),
                    F.when(k == 1, "DOCUMENT_FILE").alias("unit_type"), F.when(F.col("page_id") % 5 == 0, "시험 법").alias("law_name"), chunks.alias("chunks"), F.when(k == 0, F.struct(F.lit("별지").alias("kind"), text("page_id").alias("no"), F.lit("2").alias("branch"), F.concat(F.lit("제목 f"), text("page_id")).alias("title"))).alias("appendix"))
    made = units.file_chunks(rows.where(k < 2)).unionByName(units.file_chunks(rows.where(k == 2).drop("appendix")))
    return made.select("page_id", "unit_title", "file_kind", "unit_type", "chunk_index", "chunk_count", "start_page", "content_hash", F.sha2("search_text", 256).alias("search_hash"))


@query("""WITH d AS (SELECT doc_id, doc_id % 12 AS k, lang FROM documents)
SELECT doc_id, CASE k WHEN 0 THEN 'json_invalid' WHEN 1 THEN 'json_not_object' WHEN 2 THEN 'law_id_missing' WHEN 3 THEN 'law_id_not_string' WHEN 4 THEN 'source_unknown' WHEN 5 THEN 'doc_target_unknown' WHEN 6 THEN 'source_mismatch' WHEN 7 THEN 'mapping_failed' END AS error,
 CASE WHEN k >= 3 AND k <> 11 THEN doc_id::VARCHAR WHEN k = 11 THEN 'u' || doc_id::VARCHAR END AS law_id, k = 11 AS repealed, CASE WHEN k = 8 THEN 'v:' || doc_id::VARCHAR WHEN k = 9 THEN 'adm:20240101' WHEN k IN (10) THEN 'w' END AS version_uid FROM d""")
def q88_validate_documents(spark, sf_dir):
    """Documents as delivered files in which every rule of validation fails somewhere."""
    k, i = F.col("doc_id") % 12, text("doc_id")
    body = '"body":{"articles":[]}'
    j = lambda *parts: F.concat(F.lit("{"), *[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("}"))
    own = F.concat(F.lit('"law_id":"'), i, F.lit('",'))
    value = (F.when(k == 0, "{oops").when(k == 1, "[1]").when(k == 2, j(body)).when(k == 3, j('"law_id":', i, "," + body)).when(k == 4, j(own, body)).when(k == 5, j(own, '"doc_target":"odd",' + body)).when(k == 6, j(own, '"doc_target":"admrul",' + body))
             .when(k == 7, j(own, '"body":[]')).when(k == 8, j(own, '"version_uid":"v:', i, '",' + body)).when(k == 9, j(own, '"adm_uid":"adm","revision_date":"20240101",' + body)).when(k == 10, j(own, '"version_uid":"w",' + body)).otherwise(j('"repealed":true,"doc_uid":"law:eflaw:u', i, '"')))
    path = F.when(k == 4, F.concat(i, F.lit(".json"))).when(k == 9, F.concat(F.lit("admrul/"), i, F.lit(".json"))).otherwise(F.concat(F.lit("law/"), i, F.lit(".json")))
    v = documents.validate(table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), value.alias("value")))
    return v.select("doc_id", "error", "law_id", "repealed", "version_uid")


@query("""WITH e AS (SELECT user_id::VARCHAR AS law_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, props FROM events WHERE event_type IN ('click', 'view'))
SELECT law_id, CASE WHEN event_id % 2 = 0 THEN event_id ELSE pos END::INTEGER AS chunk_index, (SELECT count(*) FROM e f WHERE f.law_id = e.law_id)::INTEGER AS chunk_count, concat_ws(chr(10), '법 ' || law_id, 'c' || event_id::VARCHAR) AS search_text,
 sha256(concat_ws(chr(31), law_id || ':1', 'u' || event_id::VARCHAR, 'ARTICLE', 'NORM', (CASE WHEN event_id % 2 = 0 THEN event_id ELSE pos END)::VARCHAR)) AS chunk_id FROM e""")
def q89_normalized_chunks(spark, sf_dir):
    """Events as chunks that came ready made, under the metadata of their user's document."""
    e, k = table(spark, sf_dir, "events").where("event_type in ('click', 'view')"), F.col("event_id")
    record = F.to_json(F.struct(F.concat(F.lit("c"), text(k)).alias("content"), F.when(k % 2 == 0, k).alias("chunk_index"), F.struct(F.concat(F.lit("u"), text(k)).alias("provision_id")).alias("metadata")))
    laws = e.groupBy(text("user_id").alias("law_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct(k, record.alias("r")))), lambda x: x["r"]).alias("normalized"))
    doc = F.to_json(F.struct(F.struct(F.col("law_id"), F.concat("law_id", F.lit(":1")).alias("version_uid"), F.concat(F.lit("법 "), "law_id").alias("law_name")).alias("payload")))
    return payloads.normalized_chunks(payloads.law_meta(laws.withColumn("document", doc))).select("law_id", "chunk_index", "chunk_count", "search_text", "chunk_id")


@query("""WITH e AS (SELECT user_id::VARCHAR AS law_id, event_type AS file, event_id, value FROM events), g AS (SELECT law_id, file, arg_min(event_id, event_id) AS first, count(*) AS n FROM e GROUP BY law_id, file)
SELECT law_id, file AS file_id, 'n' || first::VARCHAR AS file_name, n::INTEGER AS chunks FROM g""")
def q90_parsed_files(spark, sf_dir):
    """Events as chunks of parsed files: a file's metadata are those of its first record, its chunks in order."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    record = F.to_json(F.struct(F.col("event_type").alias("file_id"), text("value").alias("content"), F.struct(F.concat(F.lit("n"), text(k)).alias("file_name")).alias("metadata")))
    laws = e.groupBy(text("user_id").alias("law_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct(k, record.alias("r")))), lambda x: x["r"]).alias("preprocessed")).withColumn("document", F.lit(None).cast("string"))
    return payloads.parsed_files(payloads.law_meta(laws)).select("law_id", "file_id", "file_name", F.size("chunks").alias("chunks"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l WHERE NOT (l_linenumber % 3 = 0 AND l_partkey % 8 + 1 > (SELECT max(l_linenumber) FROM lineitem m WHERE m.l_orderkey = l.l_orderkey))""")
def q91_phantom_references(spark, sf_dir):
    """Lines as relations; every third points to an article of its own order, which may not have it."""
    li = table(spark, sf_dir, "lineitem")
    code = lambda c: F.concat(F.lit("JO"), F.lpad(text(c), 4, "0"))
    most = li.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("m"))
    articles = most.select(text("l_orderkey").alias("doc"), F.explode(F.sequence(F.lit(1), F.col("m"))).alias("n")).select("doc", code(F.col("n")).alias("unit"))
    own = F.col("l_linenumber") % 3 == 0
    relations = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text("l_orderkey").alias("doc"), F.when(own, text("l_orderkey")).otherwise("other").alias("target_doc"), code(F.col("l_partkey") % 8 + 1).alias("target_unit"))
    return references.drop_phantoms(relations, articles).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""WITH r AS (SELECT user_id, event_id, event_type, value FROM events) SELECT user_id, count(*) AS attempts, sum(CASE WHEN event_type = 'purchase' THEN 2 ELSE 0 END)::BIGINT AS done, list(event_id ORDER BY event_id) FILTER (event_type = 'error') AS failed_zips, arg_max(event_type, event_id) AS waiting FROM r GROUP BY user_id""")
def q94_merge_summaries(spark, sf_dir):
    """Events as a run's attempts: numbers summed, lists joined in order, the last attempt's state."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "purchase", 2).alias("done"), F.when(F.col("event_type") == "error", F.array("event_id")).alias("failed_zips"), F.col("event_type").alias("waiting"))
    out = pk.merge_summaries(e, ["user_id"], "event_id", ["done"], ["failed_zips"], ["waiting"])
    return out.withColumn("failed_zips", F.when(F.size("failed_zips") > 0, F.col("failed_zips")))


@query("""WITH q AS (SELECT DISTINCT o_custkey AS package, CASE WHEN o_custkey % 2 = 0 THEN 'permanent' ELSE 'transient_exhausted' END AS kind FROM orders) SELECT package, kind FROM q WHERE kind = 'transient_exhausted' AND package NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q95_requeue(spark, sf_dir):
    """Quarantined packages of one kind that aren't live again."""
    k = F.col("o_custkey")
    quarantined = table(spark, sf_dir, "orders").select(k.alias("package"), F.when(k % 2 == 0, "permanent").otherwise("transient_exhausted").alias("kind")).distinct()
    live = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("package"))
    return intake.requeue(quarantined, live, "transient_exhausted")
