"""Payload to chunk rows: articles, the addenda as one unit, appendices and the amendment, each split under its prefix's budget."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lexspark.functions import ids, text
from lexspark.operators.chunking import split_units


def ministry(info: Column) -> Column:
    """The first of three keys that isn't blank; the first may be an object."""
    get = lambda path: F.try_variant_get(info, path, "string")
    plain = F.when(~F.startswith(F.coalesce(get("$.소관부처"), F.lit("")), F.lit("{")), get("$.소관부처"))
    return text.first_text(get("$.소관부처.content"), plain, get("$.소관부처명"), get("$.상위부처명"))


def with_common(docs: DataFrame, source: str = "law") -> DataFrame:
    """docs (path, doc) with the metadata that all rows of a document share."""
    d = lambda n: F.col(f"doc.{n}")
    t = lambda n: text.text_or_null(d(n))
    version = F.coalesce(t("version_uid"), ids.admin_rule_version(d("adm_uid"), d("revision_date"), d("enforcement_date")) if source == "admrul" else F.lit(None))
    return docs.withColumns({
        "law_id": t("law_id"), "version_uid": version, "mst": t("mst"), "adm_uid": t("adm_uid"), "law_name": t("law_name"), "law_abbr": t("law_abbr"), "law_type": t("law_type"),
        "promulgation_date": text.iso_date(d("promulgation_date")), "revision_date": text.iso_date(d("revision_date")), "revision_type": t("revision_type"),
        "is_current": d("is_current"), "is_future": d("is_future"), "source_url": text.text_or_null(d("source.source_url")), "git_path": F.col("path"), "git_commit": text.text_or_null(d("source.git_commit")),
        "ministry": ministry(d("basic_info")), "domain": ids.domain(t("doc_target"), F.lit(source)),
        "doc_base": ids.document_base(ids.id_prefix(d("doc_target"), F.lit(None).cast("string"), F.lit(source)), d("law_name"), t("law_id")),
    })


COMMON = ["law_id", "version_uid", "mst", "adm_uid", "law_name", "law_abbr", "law_type", "promulgation_date", "revision_date", "revision_type", "is_current", "is_future", "source_url", "git_path", "git_commit", "ministry", "domain"]


def references(relations: Column) -> Column:
    """Distinct targets in the order in which they come."""
    return F.coalesce(F.array_distinct(F.filter(F.transform(relations, lambda r: text.text_or_null(r["reference_id"])), lambda x: x.isNotNull())), F.array().cast("array<string>"))


# fixed values: what a relation keeps besides its id, and what it keeps only where it has it
RELATION_KEYS = ("target_mst", "relation_type", "source_clause", "line_text", "link_text", "target_article_title", "target_url", "resolve_method")
RELATION_MORE = ("source_admrul_seq", "target_doc_target", "target_doc_kind", "target_git_path", "target_source_repository", "target_repo", "target_git_file_path", "target_git_path_guess", "target_candidates", "target_candidate_paths", "target_missing_unit")


def relation_refs(relations: Column) -> Column:
    """What is known of each reference, the first of each id; blank values are null. Null if there is none."""
    named = F.filter(relations, lambda r: r.isNotNull() & (F.coalesce(r["reference_id"], F.lit("")) != ""))
    seen = F.transform(named, lambda r: r["reference_id"])
    first = F.filter(named, lambda r, i: F.array_position(seen, r["reference_id"]) == i + 1)
    kept = F.transform(first, lambda r: F.struct(r["reference_id"].alias("reference_id"), *[F.nullif(r[k], F.lit("")).alias(k) for k in RELATION_KEYS + RELATION_MORE]))
    return F.when(F.size(kept) > 0, kept)


def scheduled_changes(changes: Column) -> Column:
    """When and how an article will change. Null if nothing is announced."""
    t = text.text_or_null
    out = F.transform(F.filter(changes, lambda s: s.isNotNull()), lambda s: F.struct(text.iso_date(s["enforcement_date"]).alias("enforcement_date"), t(s["change"]).alias("change"), t(s["content"]).alias("content")))
    return F.when(F.size(out) > 0, out)


def ordinance_summary(delegations: Column, article_no: Column) -> Column:
    """The ordinances that an article leaves matters to: link text and number of each group. Null if there are none."""
    mine = F.filter(delegations, lambda e: e.isNotNull() & (text.text_or_null(e["source_article_no"]) == article_no))
    out = F.transform(mine, lambda e: F.struct(text.text_or_null(e["link_text"]).alias("link_text"), F.coalesce(e["ordinance_count"], F.size(F.coalesce(e["ordinances"], F.array().cast("array<string>")))).alias("count")))
    return F.when(F.size(out) > 0, out)


def addenda_text(addenda: Column) -> Column:
    """All addenda under numbered headings; skipped ones keep their number. Null if none has content."""

    def block(a, i):
        content = text.text_or_null(text.collapse_padding(a["content"]))
        labels = F.filter(F.array(F.when(a["is_future"], "시행예정"), F.concat(F.lit("시행 "), text.text_or_null(a["enforcement_date"])), F.concat(F.lit("공포 "), text.text_or_null(a["promulgation_date"])),
                                  F.concat(F.lit("제"), text.text_or_null(a["promulgation_no"]), F.lit("호"))), lambda x: x.isNotNull())
        head = F.concat(F.lit("[부칙 "), (i + 1).cast("string"), F.when(F.size(labels) > 0, F.concat(F.lit(" / "), F.array_join(labels, " "))).otherwise(""), F.lit("]"))
        return F.when(content.isNotNull(), F.concat(head, F.lit("\n"), content))

    return F.nullif(F.array_join(F.filter(F.transform(addenda, block), lambda x: x.isNotNull()), "\n\n"), F.lit(""))


def amendment_text(amendment: Column, reason: Column) -> Column:
    return F.nullif(F.concat_ws("\n\n", F.concat(F.lit("[개정문]\n"), text.text_or_null(amendment)), F.concat(F.lit("[개정이유]\n"), text.text_or_null(reason))), F.lit(""))


def has_text(doc: Column) -> Column:
    """Some article has more than a notice that its text is elsewhere."""
    return F.coalesce(F.exists(doc["body"]["articles"], lambda a: a.isNotNull() & ~text.is_placeholder(a["content"])), F.lit(False))


def is_file_only(doc: Column) -> Column:
    """No text of its own, but attachments."""
    return ~has_text(doc) & F.coalesce(F.size(doc["attachments"]) > 0, F.lit(False))


def pending_appendices(docs: DataFrame) -> DataFrame:
    """Appendices that exist as files alone, one row each."""
    return docs.select("path", F.posexplode("doc.appendices").alias("pos", "appendix")).where("appendix.is_file_only")


def units(docs: DataFrame, source: str = "law") -> DataFrame:
    """One row for each unit of the documents that carry their ids, in document order (unit_ord)."""
    base = with_common(docs, source).where("law_id is not null and version_uid is not null and doc.body is not null")
    none = F.lit(None).cast("string")
    no_refs = F.array().cast("array<string>")
    relations = F.lit(None).cast(docs.select(relation_refs(F.col("doc.body.articles")[0]["relations"]).alias("x")).schema["x"].dataType)
    changes = F.lit(None).cast("array<struct<enforcement_date: string, change: string, content: string>>")
    groups = F.lit(None).cast("array<struct<link_text: string, count: int>>")
    d = F.col("doc")
    once = [text.text_or_null(d["promulgation_no"]).alias("promulgation_no"), F.when(F.size(d["future_enforcement_dates"]) > 0, d["future_enforcement_dates"]).alias("future_enforcement_dates"), d["repealed"].alias("repealed"),
            d["repeal_scheduled"].alias("repeal_scheduled"), text.iso_date(d["repealed_at"]).alias("repealed_at")]

    def unit(df: DataFrame, rank: int, kind: str, pos: Column, **cols: Column) -> DataFrame:
        given = {"unit_no": none, "unit_title": none, "chapter": none, "chapter_path": none, "provision_id": none, "identity": none, "parent_provision_id": none, "enforcement_date": F.col("doc.enforcement_date"), "reference_ids": no_refs, "relation_refs": relations, "scheduled": changes, "image_urls": none, "ordinance_delegations": groups, "content": none} | cols
        return df.select(*COMMON, *once, F.struct(F.lit(rank).alias("kind"), pos.cast("int").alias("pos")).alias("unit_ord"), F.lit(kind).alias("unit_type"), *[c.alias(n) for n, c in given.items()])

    t = text.text_or_null
    a = base.select(*COMMON, "doc", "doc_base", F.posexplode("doc.body.articles").alias("pos", "a")).where("a is not null")
    articles = unit(a, 0, "ARTICLE", F.col("pos"), unit_no=t(F.col("a.article_no")), unit_title=t(F.col("a.article_title")), chapter=t(F.col("a.chapter")), chapter_path=t(F.col("a.chapter_path")),
                    provision_id=t(F.col("a.provision_id")), parent_provision_id=t(F.col("a.parent_provision_id")), enforcement_date=F.coalesce("a.enforcement_date", "doc.enforcement_date"), reference_ids=references(F.col("a.relations")), relation_refs=relation_refs(F.col("a.relations")), scheduled=scheduled_changes(F.col("a.scheduled")),
                    image_urls=F.when(F.size("a.images") > 0, F.to_json("a.images")), ordinance_delegations=ordinance_summary(F.col("doc.ordinance_delegations"), t(F.col("a.article_no"))), content=F.col("a.content"))
    addenda = unit(base.where(addenda_text(F.col("doc.addenda")).isNotNull()), 1, "ADDENDUM", F.lit(0), unit_title=F.lit("부칙"), content=addenda_text(F.col("doc.addenda")),
                   provision_id=F.coalesce(t(F.col("doc.addendum_provision_id")), F.concat("doc_base", F.lit("#ADDENDUM"))))
    x = base.select(*COMMON, "doc", "doc_base", F.posexplode("doc.appendices").alias("pos", "x")).where("x is not null and not coalesce(x.is_file_only, false)").where(~text.is_deleted_notice(F.col("x.content")))
    no, branch = t(F.col("x.no")), t(F.col("x.branch"))
    own = F.concat("doc_base", F.lit("#APPENDIX-"), F.substring(ids.stable_id(F.col("version_uid"), no, branch, F.col("x.kind"), F.col("x.title")), 1, 24))
    appendices = unit(x, 2, "APPENDIX", F.col("pos"), unit_no=F.when(no.isNull(), branch).when(branch.isNotNull() & (branch != "00"), F.concat(no, F.lit("-"), branch)).otherwise(no), unit_title=t(F.col("x.title")),
                      provision_id=F.coalesce(t(F.col("x.provision_id")), own), identity=t(F.col("x.appendix_instance_id")), enforcement_date=F.coalesce("x.enforcement_date", "doc.enforcement_date"), content=F.col("x.content"))
    changed = amendment_text(F.col("doc.amendment_text"), F.col("doc.revision_reason"))
    amendments = unit(base.where(changed.isNotNull()), 3, "AMENDMENT", F.lit(0), unit_title=F.lit("개정문·개정이유"), content=changed, provision_id=F.coalesce(t(F.col("doc.amendment_provision_id")), F.concat("doc_base", F.lit("#AMENDMENT"))))
    return reduce(lambda p, q: p.unionByName(q), [articles, addenda, appendices, amendments])


def chunks(units_df: DataFrame, uuid_prefix: str = "chunk:") -> DataFrame:
    """Units split into chunk rows with ids, search texts and hashes; references stay on a unit's first chunk."""
    content = text.collapse_padding(F.coalesce("content", F.lit("")))
    context = F.when(F.col("unit_type") == "ARTICLE", text.chapter_context(F.col("chapter_path"), F.col("chapter")))
    rows = units_df.withColumn("prefix", text.clamp_prefix(text.search_text(F.col("law_name"), F.col("law_type"), context, F.col("unit_no"), F.col("unit_title"))))
    rows = rows.withColumn("parts", split_units(content, text.content_budget(F.length("prefix")), is_table=F.col("unit_type") == "APPENDIX"))
    # outer, or Spark would filter by the split's size and so split each text twice
    rows = rows.select("*", F.size("parts").alias("chunk_count"), F.posexplode_outer("parts").alias("chunk_index", "part")).where("chunk_index is not null").drop("parts", "content").withColumnRenamed("part", "content")
    chunk_id = ids.json_chunk_id(F.col("version_uid"), F.coalesce("identity", "provision_id"), F.col("unit_type"), F.col("unit_no"), F.col("chunk_index"))
    rows = rows.withColumns({"chunk_id": chunk_id, "source_type": F.lit("JSON"), "search_text": text.search_text(F.col("prefix"), F.col("content")), "content_hash": F.sha2("content", 256),
                             "enforcement_date": text.iso_date(F.col("enforcement_date")), "reference_ids": F.when(F.col("chunk_index") == 0, F.col("reference_ids")).otherwise(F.array().cast("array<string>"))})
    rows = rows.withColumns({c: F.when(F.col("chunk_index") == 0, F.col(c)) for c in UNIT_ONLY if c in rows.columns})
    return rows.withColumn("uuid", ids.object_uuid(F.col("chunk_id"), uuid_prefix)).drop("identity", "chapter_path", "prefix")


# fixed values: what the first chunk of a unit, and of a document, carries alone
UNIT_ONLY = ("relation_refs", "scheduled", "image_urls", "ordinance_delegations")
DOCUMENT_ONLY = ("promulgation_no", "future_enforcement_dates", "repealed", "repeal_scheduled", "repealed_at")


def with_header(rows: DataFrame) -> DataFrame:
    """Marks the first chunk of each document, which alone keeps document-level metadata."""
    key = ["domain", "law_id", "version_uid"]
    first = rows.groupBy(*key).agg(F.min(F.struct("unit_ord", "chunk_index")).alias("__first"))  # one row a document, whatever its length
    same = F.lit(True)
    for c in key:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}"))
    out = rows.alias("r").join(first.alias("f"), same).select("r.*", (F.struct("r.unit_ord", "r.chunk_index") == F.col("__first")).alias("is_header"))
    return out.withColumns({c: F.when(F.col("is_header"), F.col(c)) for c in DOCUMENT_ONLY if c in rows.columns})


# fixed values: the properties that rows are stored with by themselves; all others go into meta
PROPERTIES = ("chunk_id", "provision_id", "law_id", "version_uid", "file_id", "unit_type", "is_current", "enforcement_date", "reference_ids", "parent_provision_id", "ministry", "domain", "law_name", "law_type", "source_type", "is_future", "revision_type", "git_path",
              "search_text", "content", "law_abbr", "unit_no", "unit_title", "chapter", "source_url", "mst", "adm_uid", "file_name", "file_url", "page_no", "chunk_index", "chunk_count", "promulgation_date", "revision_date")


def stored(rows: DataFrame, key: str = "uuid") -> DataFrame:
    """Rows as they are stored: the key, the properties, and meta (JSON of all the rest without nulls)."""
    rest = [c for c in rows.columns if c not in PROPERTIES and c not in (key, "vector", "unit_ord", "is_header")]
    return rows.select(key, *[c for c in PROPERTIES if c in rows.columns], (F.to_json(F.struct(*rest)) if rest else F.lit("{}")).alias("meta"), *(c for c in ("vector",) if c in rows.columns))


def file_chunks(parsed: DataFrame, drop_fillers: bool = True, uuid_prefix: str = "chunk:") -> DataFrame:
    """Parsed files (version_uid, law_id, provision_id, file_id, file_name, file_url, unit_type, chunks; law_name, law_type, unit_no, unit_title, file_kind and others where they are known) to FILE rows with ids, search texts and hashes.

    Fillers go (unless they are to stay), places in the file stay. A file of no given kind is an appendix where it has a provision.
    Where `parsed` has a column appendix (kind, no, branch, title), files are those that documents declare: their rows are titled by the
    file's stem and searched by the appendix's label (or as the document's whole text) and page; other columns stay.
    """
    given = set(parsed.columns)
    inner = {f.name for f in parsed.schema["chunks"].dataType.elementType}
    none = F.lit(None).cast("string")
    own = lambda name: F.col(name) if name in given else none
    of = lambda c, name: c[name] if name in inner else none
    rows = parsed.withColumn("file_id", F.coalesce(own("file_id"), ids.file_id(F.col("version_uid"), F.col("provision_id"), F.col("file_name"))))

    def chunk(c: Column, i: Column) -> Column:
        kept = [of(c, n).alias(n) for n in ("chunk_bboxes", "media_files", "guardrail_categories", "n_char", "n_word", "n_line")]
        page = lambda n: F.coalesce(of(c, n).cast("int"), c["page_no"] if "appendix" not in given else F.lit(None)).alias(n)
        return F.struct(F.coalesce(c["chunk_index"], i).alias("chunk_index"), text.collapse_padding(F.coalesce(c["content"], F.lit(""))).alias("content"), c["page_no"].alias("page_no"), of(c, "chunk_id").alias("chunk_id"), page("start_page"), page("end_page"), *kept)

    rows = rows.withColumn("kept", F.filter(F.transform("chunks", chunk), lambda c: ~text.is_filler(c["content"]) if drop_fillers else F.lit(True)))
    rows = rows.select("*", F.size("kept").alias("chunk_count"), F.explode("kept").alias("c")).drop("kept", "chunks").select("*", "c.*").drop("c")
    unit = F.when(F.col("unit_type").isin("DOCUMENT_FILE", "ATTACHMENT"), "FILE").otherwise(F.coalesce("unit_type", F.when(F.col("provision_id").isNotNull(), "APPENDIX").otherwise("FILE")))
    if "appendix" in given:
        x, stem = F.col("appendix"), F.regexp_replace("file_name", r"(?s)^(.+)\.[^.]*$", "$1")
        no, branch, kind = text.text_or_null(x["no"]), text.text_or_null(x["branch"]), F.coalesce(F.nullif(x["kind"], F.lit("")), F.lit("별표"))
        label = F.when(no.isNotNull(), F.concat(kind, F.lit(" "), no, F.when(branch.isNotNull() & (branch != "00"), F.concat(F.lit("의"), branch)).otherwise("")))
        said = [F.when(x.isNull(), F.lit("문서 전체 원문")).otherwise(x["kind"]), F.when(x.isNull(), stem).otherwise(label), x["title"], F.concat(F.col("page_no").cast("string"), F.lit("페이지"))]
        titles = {"unit_no": none, "unit_title": stem, "file_kind": F.when(x.isNull(), "document_file").otherwise("attachment")}
    else:
        title = F.coalesce(text.text_or_null(own("unit_title")), F.col("file_name"))
        said = [own("unit_no"), title]
        titles = {"unit_no": text.text_or_null(own("unit_no")), "unit_title": title, "file_kind": F.coalesce(text.text_or_null(own("file_kind")), F.lit("attachment"))}
    chunk_id = F.coalesce(text.text_or_null(F.col("chunk_id")), ids.file_chunk_id(F.col("version_uid"), F.col("provision_id"), F.col("file_id"), F.col("chunk_index")))
    rows = rows.withColumns({"search_text": text.search_text(own("law_name"), own("law_type"), *said, F.col("content")), "content_hash": F.sha2("content", 256), "chunk_id": chunk_id})
    return rows.withColumns(titles | {"unit_type": unit, "source_type": F.lit("FILE"), "is_file_only": F.lit(True), "uuid": ids.object_uuid(F.col("chunk_id"), uuid_prefix)}).drop("appendix")


def quality(rows: DataFrame, content: str = "content", kept: str | None = None, by: list[str] | None = None, most_dropped: float = 0.05) -> DataFrame:
    """Seen and dropped chunks, real characters in what was dropped, and the guard's verdict; for each of `by`.

    kept: a column that says what stays; without it, fillers go.
    """
    padded = text.collapse_padding(F.coalesce(F.col(content), F.lit("")))
    dropped = text.is_filler(padded) if kept is None else ~F.coalesce(F.col(kept), F.lit(False))
    real = F.length(F.regexp_replace(padded, "(?U)" + text.FILLER, ""))
    out = rows.groupBy(*(by or [])).agg(F.count("*").alias("seen"), F.count_if(dropped).alias("dropped"), F.coalesce(F.sum(F.when(dropped, real)), F.lit(0)).cast("long").alias("dropped_real_chars"))
    return out.withColumn("verdict", F.when(F.col("dropped_real_chars") > 0, "fail: dropped_chunks_had_content").when(F.col("dropped") > most_dropped * F.col("seen"), "fail: chunks_dropped_ratio").otherwise("pass"))


def write_observed(rows: DataFrame, path: str, content: str = "content", kept: str = "kept", most_dropped: float = 0.05) -> dict:
    """Write the rows that stay (without the column `kept`) and give quality()'s totals and verdict, counted in the same pass over the rows."""
    padded = text.collapse_padding(F.coalesce(F.col(content), F.lit("")))
    dropped = ~F.coalesce(F.col(kept), F.lit(False))
    real = F.length(F.regexp_replace(padded, "(?U)" + text.FILLER, ""))
    totals = Observation("quality")
    seen = rows.observe(totals, F.count("*").alias("seen"), F.count_if(dropped).alias("dropped"), F.coalesce(F.sum(F.when(dropped, real)), F.lit(0)).cast("long").alias("dropped_real_chars"))
    seen.where(kept).drop(kept).write.mode("overwrite").parquet(path)
    got = dict(totals.get)
    bad = "fail: dropped_chunks_had_content" if got["dropped_real_chars"] > 0 else "fail: chunks_dropped_ratio" if got["dropped"] > most_dropped * got["seen"] else "pass"
    return got | {"verdict": bad}
