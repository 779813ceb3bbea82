"""Raw bodies to payloads, and delivered files to the units that payloads declare.

A body's parts stand at no fixed depth: `find` looks for the first key of a name anywhere, once for each body, as a
small helper in a task; everything else is column expressions and joins.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexspark.functions import names
from lexspark.functions.text import IMAGE_MARK, mark_images, normalize, strip, text_or_null
from lexspark.operators import identifiers, intake, raw, rules, units

# fixed values: parts that bodies are asked for
STATUTE_KEYS = ("조문단위", "부칙단위", "별표단위", "기본정보", "법령ID", "ID", "법령구분명", "법령구분", "법종구분", "공포번호", "공포일자", "시행일자", "제개정구분명", "제개정구분", "개정문내용", "제개정이유내용", "법령키")
RULE_KEYS = ("조문내용", "부칙", "별표단위", "첨부파일", "행정규칙기본정보", "개정문내용", "제개정이유내용")
RULE_KINDS = {"admrul": "행정규칙", "school": "학칙", "pi": "공단정관", "public": "공공기관"}


def _first(value, key: str):
    """The first value under a key that isn't blank, the nearest level of each branch first; None without one."""
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            if v.get(key) not in (None, ""):
                return v[key]
            stack.extend(reversed(list(v.values())))
        elif isinstance(v, list):
            stack.extend(reversed(v))
    return None


def find(body: Column, keys: tuple[str, ...]) -> Column:
    """map of each key to the JSON of its first value anywhere in a body (JSON text); keys without one are left out. Null for text that is no JSON."""

    @F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
    def found(bodies: pd.Series) -> pd.Series:
        def one(text):
            try:
                value = json.loads(text)
            except (TypeError, ValueError):
                return None
            hits = ((k, _first(value, k)) for k in keys)
            return {k: json.dumps(v, ensure_ascii=False) for k, v in hits if v is not None}

        return bodies.map(one)

    return found(body)


def _value(parts: Column, *keys: str) -> Column:
    """The text of the first of the keys that has one."""
    return F.coalesce(*[text_or_null(F.try_variant_get(F.try_parse_json(F.try_element_at(parts, F.lit(k))), "$", "string")) for k in keys], F.lit(""))


def _lines(parts: Column, key: str) -> Column:
    """All texts of a part, one to a line, images marked."""
    return F.coalesce(mark_images(raw.value(F.try_parse_json(F.try_element_at(parts, F.lit(key))), "$")), F.lit(""))


def _wrapped(parts: Column, key: str) -> Column:
    """The part as a body of its own."""
    return F.try_parse_json(F.concat(F.lit(f'{{"{key}":'), F.coalesce(F.try_element_at(parts, F.lit(key)), F.lit("null")), F.lit("}")))


def _empty_relations() -> Column:
    fields = ", ".join(f"{k}: boolean" if k == "appendix_ambiguous" else f"{k}: string" for k in identifiers.RELATION)
    return F.array().cast(f"array<struct<{fields}>>")


def _appendices(parts: Column) -> Column:
    found = raw.appendices(_wrapped(parts, "별표단위"))
    out = F.transform(found, lambda a: a.withField("kind", identifiers.appendix_kind(a["kind"], a["no"], a["title"])).withField("files", F.transform(a["files"], lambda f: f.withField("url", names.absolute(f["url"])).withField("name", normalize(f["name"])))))
    best = lambda a, kind: F.get(F.filter(a["files"], lambda f: f["type"] == kind), F.lit(0))["url"]
    return F.transform(out, lambda a: a.withField("content", F.coalesce(mark_images(a["content"]), F.lit(""))).withField("file_url", F.coalesce(best(a, "pdf"), best(a, "image"), best(a, "hwp"), F.lit(""))))


def _with_images(articles: Column) -> Column:
    kind = "array<struct<type: string, name: string, url: string, seq: string>>"
    made = lambda c: F.transform(names.images(c), lambda x: F.struct(F.lit("image").alias("type"), F.lit("").alias("name"), x["url"].alias("url"), x["seq"].alias("seq"))).cast(kind)
    return F.transform(articles, lambda a: a.withField("images", made(a["content"])).withField("content", mark_images(a["content"])).withField("relations", _empty_relations()))


def _stats(articles: Column, addenda: Column, appendices: Column, attachments: Column) -> Column:
    """Counts of a payload's parts; relations are looked for elsewhere."""
    zero = lambda *cs: [F.lit(0).alias(c) for c in cs]
    size = lambda c: F.size(F.coalesce(c, F.array()))
    return F.struct(size(articles).alias("articles_total"), size(addenda).alias("addenda_count"), size(appendices).alias("appendices_count"), size(attachments).alias("attachments_count"), *zero("relations_total", "articles_with_relations", "unmatched_relations", "ordinance_groups", "ordinance_docs_total"))


def statutes(bodies: DataFrame) -> DataFrame:
    """Payloads of raw statute bodies: bodies has body (JSON text), name, and id and sequence from the manifest (null if it lacks them). Other columns stay.

    error: json_invalid, sequence_missing (neither the manifest nor the body has one) or articles_missing.
    """
    rows = bodies.withColumn("__p", find(F.col("body"), STATUTE_KEYS)).withColumn("__k", F.sha2("body", 256))  # equal bodies have equal articles
    p = F.col("__p")
    flat = raw.articles(rows.dropDuplicates(["__k"]).select("__k", _wrapped(p, "조문단위").alias("body")), key="__k")
    entry = F.struct("pos", F.struct("article_no", "article_title", "chapter", "chapter_path", "content").alias("a"))
    listed = flat.groupBy("__k").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["a"]).alias("__articles"))
    none = F.array().cast(listed.schema["__articles"].dataType)
    rows = rows.join(listed, "__k", "left").withColumn("articles", _with_images(F.coalesce("__articles", none)))
    info = F.try_element_at(p, F.lit("기본정보"))
    of = lambda k: F.coalesce(text_or_null(F.get_json_object(info, f"$.{k}")), F.lit(""))
    law_id = F.coalesce(F.nullif(F.col("id"), F.lit("")), _value(p, "법령ID", "ID"))
    sequence = F.coalesce(F.nullif(F.col("sequence"), F.lit("")), names.sequence_fallback(_value(p, "공포번호"), _value(p, "법령키")))
    kind = F.coalesce(F.nullif(_value(p, "법령구분명", "법령구분"), F.lit("")), normalize(F.get_json_object(F.try_element_at(p, F.lit("법종구분")), "$.content")))
    date = _value(p, "시행일자")
    rows = rows.withColumns({
        "law_id": law_id, "mst": sequence, "version_uid": F.concat_ws(":", law_id, sequence, date), "law_name": F.col("name"), "law_abbr": of("법령명약칭"), "law_type": kind, "doc_target": F.lit(None).cast("string"), "id_suffix": F.lit(None).cast("string"),
        "name_aliases": names.aliases(F.col("name"), of("법령명약칭"), of("법령명_한자"), of("법령명_영어")), "promulgation_no": _value(p, "공포번호"), "promulgation_date": _value(p, "공포일자"), "enforcement_date": date, "revision_date": _value(p, "공포일자"),
        "revision_type": _value(p, "제개정구분명", "제개정구분"), "amendment_text": _lines(p, "개정문내용"), "revision_reason": _lines(p, "제개정이유내용"), "addenda": F.transform(raw.addenda(_wrapped(p, "부칙단위")), lambda a: a.dropFields("pos").withField("content", mark_images(a["content"]))),
        "appendices": _appendices(p), "attachments": F.array().cast("array<struct<name: string, url: string>>"), "basic_info": info, "source_url": names.reference_url(F.lit("법령"), F.col("name")),
        "error": F.when(p.isNull(), "json_invalid").when(sequence == "", "sequence_missing").when(F.size("articles") == 0, "articles_missing"),
    })
    return _finished(rows)


def administrative_rules(bodies: DataFrame) -> DataFrame:
    """Payloads of raw rule bodies: bodies has body (JSON text), name, target, and the id and sequence that were asked for (null if any will do).

    error: json_invalid, rule_missing (the portal has no such version), id_mismatch, sequence_mismatch or nothing_found.
    """
    rows = bodies.withColumn("__p", find(F.col("body"), RULE_KEYS))
    p = F.col("__p")
    items = F.filter(F.transform(raw.as_list(_wrapped(p, "조문내용"), "$.조문내용"), lambda v: normalize(F.coalesce(F.array_join(F.try_variant_get(v, "$", "array<string>"), " "), F.try_variant_get(v, "$", "string")))), lambda x: x != "")
    info = F.try_element_at(p, F.lit("행정규칙기본정보"))
    of = lambda k: F.coalesce(text_or_null(F.get_json_object(info, f"$.{k}")), F.lit(""))
    given = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(""))
    rule_id, sequence = of("행정규칙ID"), of("행정규칙일련번호")
    own_id, own_seq = F.when(given("id") != "", given("id")).otherwise(rule_id), F.when(given("sequence") != "", given("sequence")).otherwise(sequence)
    law_id = F.when(own_id != "", own_id).otherwise(own_seq)
    name = normalize(F.when(of("행정규칙명") != "", of("행정규칙명")).otherwise(F.col("name")))
    side = lambda part, key: F.transform(raw.as_list(F.try_parse_json(F.try_element_at(p, F.lit(part))), f"$.{key}"), lambda v: F.coalesce(mark_images(raw.value(v, "$")), F.lit("")))
    at = lambda z, k: F.coalesce(z[k], F.lit(""))
    addenda = F.arrays_zip(side("부칙", "부칙공포일자").alias("d"), side("부칙", "부칙공포번호").alias("n"), side("부칙", "부칙내용").alias("t"))
    addenda = F.transform(F.array_sort(F.transform(addenda, lambda z, i: F.struct(at(z, "d").alias("promulgation_date"), i.alias("pos"), at(z, "n").alias("promulgation_no"), at(z, "t").alias("content")))), lambda a: a.dropFields("pos"))
    files = F.transform(F.arrays_zip(side("첨부파일", "첨부파일링크").alias("u"), side("첨부파일", "첨부파일명").alias("n")), lambda z: F.struct(at(z, "n").alias("name"), at(z, "u").alias("url")))
    said = F.coalesce(F.get_json_object("body", "$.Law"), F.lit(""))
    rows = rows.withColumns({"__items": items, "__k": F.sha2("body", 256)})  # equal bodies have equal articles
    made = rules.rule_articles(rows.dropDuplicates(["__k"]).select("__k", "__items"), "__k", "__items").withColumnRenamed("articles", "__articles")
    rows = rows.join(made, "__k", "left").withColumn("__articles", F.coalesce("__articles", F.array().cast(made.schema["__articles"].dataType))).drop("__items", "__k").withColumn("articles", _with_images(F.col("__articles")))
    rows = rows.withColumns({
        "law_id": law_id, "mst": own_seq, "adm_uid": F.concat_ws(":", "target", law_id), "version_uid": F.lit(None).cast("string"), "law_name": name, "law_abbr": F.lit(""), "law_type": normalize(F.when(of("행정규칙종류") != "", of("행정규칙종류")).otherwise("행정규칙")),
        "doc_target": F.col("target"), "doc_kind": F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k in RULE_KINDS.items() for x in k]), F.col("target")), F.lit("행정규칙")), "id_suffix": F.lit(None).cast("string"),
        "promulgation_no": of("발령번호"), "promulgation_date": of("발령일자"), "enforcement_date": of("시행일자"), "revision_date": of("발령일자"), "revision_type": normalize(of("제개정구분명")), "amendment_text": _lines(p, "개정문내용"), "revision_reason": _lines(p, "제개정이유내용"),
        "addenda": addenda, "appendices": _appendices(p), "attachments": files, "basic_info": info, "source_url": names.reference_url(F.when(F.col("target").isin("school", "pi", "public"), "학칙공단").otherwise("행정규칙"), name),
    })
    lost = (F.size("articles") == 0) & (F.size("appendices") == 0) & (F.size("attachments") == 0)
    differs = lambda c, found: (given(c) != "") & (found != "") & (given(c) != found)
    error = (F.when(p.isNull(), "json_invalid").when(F.contains(said, F.lit("일치하는 행정규칙이 없습니다")), "rule_missing").when(differs("id", rule_id), "id_mismatch").when(differs("sequence", sequence), "sequence_mismatch").when(lost, "nothing_found"))
    return _finished(rows.withColumn("error", error))


def _finished(rows: DataFrame) -> DataFrame:
    """Ids and stored file names, and the counts."""
    out = identifiers.file_meta(identifiers.identify(rows))
    return out.withColumn("stats", _stats(F.col("articles"), F.col("addenda"), F.col("appendices"), F.col("attachments"))).drop("__p", "__k", "__articles", "body", "name", "id", "sequence")


# ---- files that payloads declare


def title_key(title: Column) -> Column:
    """A title as declared names hold it: the portal's cedilla is a comma, forbidden signs are replaced, blanks are single."""
    return strip(F.regexp_replace(names.path_element(F.translate(F.coalesce(title, F.lit("")), "¸", ",")), r"(?U)\s+", " "))


# fixed values: how the portal names files of appendices, how they are declared, and a looser form
ORIGINAL = r"^\[([가-힣]+?)\s*(?:제\s*)?(\d+)?\s*(?:호)?(?:\s*의\s*(\d+))?\s*(서식)?\]\s*(.+?)\s*(?:\([^()]*\))?\.([A-Za-z0-9]+)$"
DECLARED = r"^([가-힣]+)(\d+)(?:의(\d+))?_"
LOOSE = r"^(?:[\[〔【]\s*([^\]〕】]*)[\]〕】]\s*)?(.+)\.([A-Za-z0-9]+)$"


def _int(c: Column) -> Column:
    return F.nullif(c, F.lit("")).try_cast("int")


def declared_title(file: Column) -> Column:
    stem = F.regexp_replace(file, r"\.[^.]*$", "")
    return F.when(F.contains(stem, F.lit("_")), F.regexp_replace(F.regexp_replace(stem, "^[^_]*_", ""), r"_flSeq\d+$", "")).otherwise("")


def plan_files(files: DataFrame, declared: DataFrame, attachments: DataFrame) -> DataFrame:
    """What becomes of delivered files: files (doc, path) with `action` (keep, rename or drop) and `target`.

    declared: doc, filename of each appendix; attachments: doc, name. Attachments' names stay or are corrected by their
    key. An appendix's file is found by kind, number and branch, by its title where these are shared or unread; of its
    formats one stays (the declared one, then by preference), renamed as declared with its own extension; images alone go.
    Files that nothing declares, or several declarations could mean, stay as they are.
    """
    f = files.select("doc", "path", F.element_at(F.split("path", "/"), -1).alias("base")).distinct()
    a = attachments.where("coalesce(name, '') <> ''").select("doc", "name").distinct()
    exact = f.join(a.select("doc", F.col("name").alias("base")), ["doc", "base"], "left_semi").select("doc", "path", F.lit("keep").alias("action"), F.lit(None).cast("string").alias("target"))
    left = f.join(exact.select("doc", "path"), ["doc", "path"], "left_anti")
    keyed = a.groupBy("doc", title_key(F.col("name")).alias("key")).agg(F.max("name").alias("name"))
    fixed = left.withColumn("key", title_key(F.col("base"))).join(keyed, ["doc", "key"]).select("doc", "path", F.lit("rename").alias("action"), F.col("name").alias("target"))
    left = left.join(fixed.select("doc", "path"), ["doc", "path"], "left_anti")
    d = declared.where(F.rlike(F.coalesce("filename", F.lit("")), F.lit(DECLARED))).select("doc", "filename").distinct()
    g = lambda c, pattern, k: F.regexp_extract(c, pattern, k)
    d = d.select("doc", "filename", g("filename", DECLARED, 1).alias("kind"), _int(g("filename", DECLARED, 2)).alias("no"), F.coalesce(_int(g("filename", DECLARED, 3)), F.lit(-1)).alias("branch"), title_key(declared_title(F.col("filename"))).alias("title"))
    d = d.withColumn("many", F.count("*").over(Window.partitionBy("doc", "kind", "no", "branch")))
    read = left.where(F.rlike("base", F.lit(ORIGINAL))).select("doc", "path", F.coalesce(_int(g("base", ORIGINAL, 2)), F.lit(0)).alias("no"), F.coalesce(_int(g("base", ORIGINAL, 3)), F.lit(-1)).alias("branch"), title_key(g("base", ORIGINAL, 5)).alias("t"),
                                                               F.posexplode(F.array_compact(F.array(F.when(g("base", ORIGINAL, 4) != "", "서식"), g("base", ORIGINAL, 1)))).alias("try", "kind"))
    by_key = read.join(d, ["doc", "kind", "no", "branch"])
    first = by_key.groupBy("doc", "path").agg(F.min("try").alias("try"))
    by_key = by_key.join(first, ["doc", "path", "try"]).where(((F.col("no") != 0) & (F.col("many") == 1)) | (F.col("t") == F.col("title")))
    by_key = by_key.groupBy("doc", "path").agg(F.min("filename").alias("filename"), F.count_distinct("filename").alias("n")).where("n = 1")
    rest = left.join(by_key.select("doc", "path"), ["doc", "path"], "left_anti").where(F.rlike("base", F.lit(LOOSE)))
    numbers = F.regexp_extract_all(g("base", LOOSE, 1), F.lit(r"\d+"), F.lit(0))
    stem = g("base", LOOSE, 2)
    loose = rest.select("doc", "path", numbers.alias("nums"), F.explode(F.array_distinct(F.array(title_key(stem), title_key(F.regexp_replace(stem, r"\s*\([^()]*\)$", ""))))).alias("title")).join(d, ["doc", "title"])
    named = F.size("nums") > 0
    same = (F.get("nums", F.lit(0)).try_cast("int") == F.col("no")) & (F.coalesce(F.get("nums", F.lit(1)).try_cast("int"), F.lit(-1)) == F.col("branch"))
    loose = loose.where(~named | same).groupBy("doc", "path").agg(F.min("filename").alias("filename"), F.count_distinct("filename").alias("n")).where("n = 1")
    found = by_key.unionByName(loose).select("doc", "path", "filename").withColumn("ext", F.lower(F.element_at(F.split("path", r"\."), -1))).withColumn("own", F.lower(F.element_at(F.split("filename", r"\."), -1)))
    rank = F.when(F.col("ext") == F.col("own"), 0).otherwise(F.coalesce(F.nullif(intake.format_rank(F.col("ext"), intake.DECLARED_ORDER), F.lit(0)), F.lit(9)))
    best = F.row_number().over(Window.partitionBy("doc", "filename").orderBy(rank, "path"))
    readable = F.first(F.col("ext").isin(*intake.DECLARED_ORDER)).over(Window.partitionBy("doc", "filename").orderBy(rank, "path"))
    placed = found.withColumns({"n": best, "readable": readable}).select("doc", "path", F.when(F.col("readable") & (F.col("n") == 1), "rename").otherwise("drop").alias("action"),
                                                                        F.when(F.col("readable") & (F.col("n") == 1), F.concat(F.regexp_replace("filename", r"\.[^.]*$", ""), F.lit("."), "ext")).alias("target"))
    done = exact.unionByName(fixed).unionByName(placed)
    return files.join(done, ["doc", "path"], "left").withColumn("action", F.coalesce("action", F.lit("keep")))


def manifest_documents(manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (zip, folder, id, sequence, path) and renamed members (zip, path, original) of manifests (zip, manifest: VARIANT), of either form: docs or documents."""
    get = lambda v, p: F.try_variant_get(v, p, "string")
    short = manifests.select("zip", F.explode(raw.as_list(F.col("manifest"), "$.docs")).alias("d")).select("zip", F.coalesce(get("d", "$.dir"), F.lit("")).alias("folder"), get("d", "$.id").alias("id"), get("d", "$.mst").alias("sequence"), F.lit(None).cast("string").alias("path"))
    d = manifests.select("zip", F.explode(raw.as_list(F.col("manifest"), "$.documents")).alias("d")).withColumn("path", F.coalesce(get("d", "$.path"), F.lit("")))
    folder = lambda c: F.when(F.contains(c, F.lit("/")), F.regexp_replace(c, "/[^/]*$", "")).otherwise("")
    long = d.select("zip", folder(F.col("path")).alias("folder"), F.coalesce(get("d", "$.lawId"), get("d", "$.id")).alias("id"), get("d", "$.mst").alias("sequence"), "path")
    f = d.select("zip", F.explode(raw.as_list(F.col("d"), "$.files")).alias("f")).select("zip", get("f", "$.path").alias("path"), F.translate(get("f", "$.originalName"), "/\\", "__").alias("name"))
    f = f.where("path <> '' and name <> ''").where(F.element_at(F.split("path", "/"), -1) != F.col("name"))
    at = folder(F.col("path"))
    return short.unionByName(long), f.select("zip", "path", F.when(at != "", F.concat(at, F.lit("/"), "name")).otherwise(F.col("name")).alias("original"))


def with_manifest(bodies: DataFrame, documents: DataFrame) -> DataFrame:
    """bodies (zip, folder, ...) with id and sequence as the manifest gives them, and `error` manifest_document_missing where it doesn't name the folder."""
    named = documents.groupBy("zip", "folder").agg(F.min("id").alias("id"), F.min("sequence").alias("sequence"), F.lit(True).alias("__there"))
    return bodies.join(named, ["zip", "folder"], "left").withColumn("error", F.when(F.col("__there").isNull(), "manifest_document_missing")).drop("__there")


def listed_attachments(members: DataFrame, manifests: DataFrame) -> DataFrame:
    """ZIP members (zip, path, sha256) with the url that a manifest's change lists give them, and the name before a collector marked it with its digest."""
    get = lambda v, p: F.try_variant_get(v, p, "string")
    item = manifests.select("zip", F.explode(raw.as_list(F.col("manifest"), "$.changes")).alias("c")).select("zip", F.explode(raw.as_list(F.col("c"), "$.attachment_files")).alias("f"))
    item = item.select("zip", F.replace(get("f", "$.path"), F.lit("\\"), F.lit("/")).alias("path"), get("f", "$.url").alias("url"), get("f", "$.sha256").alias("listed")).where("path is not null")
    item = item.groupBy("zip", "path").agg(F.max("url").alias("url"), F.max("listed").alias("listed"))
    out = members.join(item, ["zip", "path"], "left")
    return out.withColumn("name", names.original_name(F.element_at(F.split("path", "/"), -1), F.col("listed"))).drop("listed")


def article_images(articles: DataFrame, files: DataFrame) -> DataFrame:
    """articles (doc, article_no) with the paths of their images ({article}_{number}.gif, .png, .jpg) in order of the numbers; an empty list where there are none."""
    base = F.element_at(F.split("path", "/"), -1)
    pattern = r"^(.+)_(\d+)\.(?:gif|png|jpe?g)$"
    f = files.select("doc", "path", F.regexp_extract(F.lower(base), pattern, 2).try_cast("int").alias("seq"), F.regexp_extract(base, r"(?i)" + pattern, 1).alias("article")).where("seq is not null")
    key = names.path_element(F.replace("article_no", F.lit(" "), F.lit("")))
    lists = f.groupBy("doc", "article").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "path"))), lambda x: x["path"]).alias("images"))
    return articles.withColumn("article", key).join(lists, ["doc", "article"], "left").withColumn("images", F.coalesce("images", F.array().cast("array<string>"))).drop("article")


def name_variants(*values: Column) -> Column:
    """What a declared file may be called: each value as it is and as a stored name, each once; blanks give none."""
    kept = F.filter(F.transform(F.array(*[F.coalesce(v, F.lit("")) for v in values]), strip), lambda x: x != "")
    return F.array_distinct(F.flatten(F.transform(kept, lambda x: F.array(x, names.path_element(x)))))


def appendix_names(a: Column) -> Column:
    f = names.pick_file(a["files"], names.PACKAGE_ORDER)
    made = F.concat(names.appendix_label(a["kind"], a["no"], a["branch"], a["title"]), F.lit("."), names.file_extension(f["type"], f["name"], f["url"]))
    return F.when(F.coalesce(F.trim(a["filename"]), F.lit("")) != "", name_variants(a["filename"])).otherwise(name_variants(F.when(f.isNotNull(), made)))


def image_names(article_no: Column, seq: Column, image: Column) -> Column:
    return F.when(F.coalesce(F.trim(image["filename"]), F.lit("")) != "", name_variants(image["filename"])).otherwise(name_variants(names.image_file(article_no, seq, F.lit(""), F.lit(""), image["url"])))


def declared_names(doc: Column) -> Column:
    """All file names that a document mentions: of appendices, attachments and images."""
    none = F.array().cast("array<string>")
    flat = lambda c: F.coalesce(F.flatten(c), none)
    images = F.transform(doc["body"]["articles"], lambda a: F.coalesce(F.flatten(F.transform(F.filter(a["images"], lambda im: im.isNotNull()), lambda im, i: image_names(a["article_no"], i + 1, im))), none))
    return F.array_distinct(F.concat(flat(F.transform(F.filter(doc["appendices"], lambda a: a.isNotNull()), appendix_names)), flat(F.transform(F.filter(doc["attachments"], lambda a: a.isNotNull()), lambda a: name_variants(a["name"], a["filename"]))), flat(images)))


def file_units(docs: DataFrame) -> DataFrame:
    """What files of documents (path, doc) are to be shipped, one row each: unit_type, provision_id, file_name, url, names, urls, article_no and image_seq.

    Appendices that exist as files alone; the attachments of documents without text (one format of each name); the
    images of articles whose text has their mark, numbered from one.
    """
    urls = lambda *cs: F.array_distinct(F.filter(F.transform(F.concat(*cs), lambda u: F.trim(F.coalesce(u, F.lit("")))), lambda u: u != ""))
    none, no = F.lit(None).cast("string"), F.lit(None).cast("int")
    a = units.pending_appendices(docs).withColumn("a", F.col("appendix"))
    sheets = a.select("path", F.lit("APPENDIX").alias("unit_type"), F.col("a.provision_id").alias("provision_id"), F.col("a.filename").alias("file_name"), F.col("a.file_url").alias("url"), appendix_names(F.col("a")).alias("names"),
                      urls(F.array("a.file_url"), F.coalesce(F.transform("a.files", lambda f: f["url"]), F.array().cast("array<string>"))).alias("urls"), none.alias("article_no"), no.alias("image_seq"))
    t = docs.where(units.is_file_only(F.col("doc"))).select("path", F.posexplode("doc.attachments").alias("pos", "t")).where("t is not null")
    t = t.withColumn("file", F.coalesce(F.nullif("t.filename", F.lit("")), F.nullif("t.name", F.lit("")), F.lit(""))).withColumn("stem", F.lower(F.regexp_replace("file", r"\.[^.]*$", "")))
    best = intake.best_format(t, ["path", "stem"], "file", order=intake.BUNDLE_ORDER)
    wholes = best.select("path", F.lit("DOCUMENT_FILE").alias("unit_type"), none.alias("provision_id"), F.nullif("file", F.lit("")).alias("file_name"), F.col("t.url").alias("url"), name_variants(F.col("t.name"), F.col("t.filename")).alias("names"), urls(F.array("t.url")).alias("urls"), none.alias("article_no"), no.alias("image_seq"))
    i = docs.select("path", F.explode("doc.body.articles").alias("a")).where("a is not null").where(F.contains(F.coalesce("a.content", F.lit("")), F.lit(IMAGE_MARK))).select("path", "a", F.posexplode("a.images").alias("pos", "im")).where("im is not null")
    pictures = i.select("path", F.lit("ARTICLE_IMAGE").alias("unit_type"), F.col("a.provision_id").alias("provision_id"), F.col("im.filename").alias("file_name"), F.col("im.url").alias("url"), image_names(F.col("a.article_no"), F.col("pos") + 1, F.col("im")).alias("names"), urls(F.array("im.url")).alias("urls"),
                        F.coalesce("a.article_no", F.lit("")).alias("article_no"), (F.col("pos") + 1).alias("image_seq"))
    return sheets.unionByName(wholes).unionByName(pictures)


# fixed values: formats that can be parsed
PARSED = ("pdf", "hwp", "hwpx", "docx", "ppt", "pptx", "csv", "xlsx", "jpg", "jpeg", "png", "gif", "txt")


def resolve_units(shipped: DataFrame, entries: DataFrame) -> DataFrame:
    """shipped (doc, unit, names, urls, file_name, unit_type) with the delivered file (entries: doc, name, path, url) that bears one of their names: state found, pending, unsupported or ambiguous, and its path.

    Of several files the one whose url is the unit's is meant. Formats that can't be parsed are held back.
    """
    hits = shipped.select("doc", "unit", "urls", F.explode("names").alias("name")).join(entries, ["doc", "name"]).groupBy("doc", "unit").agg(F.collect_set("path").alias("paths"), F.collect_set(F.when(F.array_contains("urls", F.col("url")), F.col("path"))).alias("exact"))
    out = shipped.join(hits, ["doc", "unit"], "left")
    paths = F.when((F.size("paths") > 1) & (F.size("exact") == 1), F.col("exact")).otherwise(F.col("paths"))
    ext = F.lower(F.regexp_extract(F.coalesce("file_name", F.element_at(F.split(F.get(paths, F.lit(0)), "/"), -1), F.lit("")), r"\.([^./]+)$", 1))
    held = (F.col("unit_type") != "ARTICLE_IMAGE") & (ext != "") & ~ext.isin(*PARSED)
    state = F.when(F.size(paths) > 1, "ambiguous").when(held, "unsupported").when(F.size(F.coalesce(paths, F.array())) == 1, "found").otherwise("pending")
    return out.withColumn("state", state).withColumn("path", F.when(F.size(paths) == 1, F.get(paths, F.lit(0)))).drop("paths", "exact")
