"""Identifiers: deterministic digests, name-based UUIDs, versions and document routing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexspark.functions.text import compact_name, let, strip, text_or_null

# fixed value: the name space of URL-based UUIDs
URL_SPACE = "6ba7b8119dad11d180b400c04fd430c8"
SCHOOL_TARGETS = ("school", "pi", "public", "schlpub", "SchlPubRul")


def stable_id(*parts: Column) -> Column:
    """SHA-256 over the stripped parts, a unit separator between; null counts as empty."""
    return F.sha2(F.array_join(F.array(*[F.coalesce(strip(p.cast("string")), F.lit("")) for p in parts]), "\x1f"), 256)


def uuid5(name: Column, space: str = URL_SPACE) -> Column:
    """Version-5 UUID of a name."""
    h = F.sha1(F.concat(F.unhex(F.lit(space)), F.encode(name, "utf-8")))
    variant = F.element_at(F.array(*map(F.lit, "89ab")), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def object_uuid(chunk_id: Column, prefix: str = "chunk:") -> Column:
    """Id of a chunk's object. Give the prefix of an existing store to keep its ids."""
    return uuid5(F.concat(F.lit(prefix), chunk_id))


def json_chunk_id(version: Column, identity: Column, unit_type: Column, unit_no: Column, index: Column) -> Column:
    return stable_id(version, identity, unit_type, unit_no, F.lit("JSON"), F.lit(""), index)


def file_chunk_id(version: Column, provision: Column, file_id: Column, index: Column) -> Column:
    return stable_id(version, F.coalesce(provision, F.lit("ATTACHMENT")), F.lit("FILE"), file_id, index)


def normal_chunk_id(version: Column, provision: Column, unit_no: Column, unit_type: Column, index: Column) -> Column:
    return stable_id(version, F.coalesce(provision, unit_no), unit_type, F.lit("NORM"), index)


def file_id(version: Column, provision: Column, name: Column) -> Column:
    return stable_id(version, F.coalesce(provision, F.lit("ATTACHMENT")), name)


def short_file_id(version: Column, provision: Column, name: Column) -> Column:
    parts = F.array_join(F.array(*[F.coalesce(p, F.lit("")) for p in (version, provision, name)]), "\x1f")
    return F.concat(F.lit("f"), F.substring(F.sha2(parts, 256), 1, 16))


def admin_rule_version(adm_uid: Column, revision: Column, enforcement: Column) -> Column:
    """adm_uid:date, or adm_uid alone where no date is known."""
    basis = F.coalesce(text_or_null(revision), text_or_null(enforcement))
    return F.when(text_or_null(adm_uid).isNotNull(), F.concat_ws(":", text_or_null(adm_uid), basis))


def version_rank(version_uid: Column, mst: Column) -> Column:
    """(day, sequence) for comparison; dates may have dashes. Parts that can't be read are 0, the oldest."""
    day = F.regexp_extract(F.replace(F.substring_index(F.coalesce(version_uid, F.lit("")), ":", -1), F.lit("-"), F.lit("")), r"(\d{8})", 1)
    number = F.regexp_extract(F.coalesce(mst.cast("string"), F.lit("")), r"(\d+)", 1)
    whole = lambda s, kind: F.coalesce(F.nullif(s, F.lit("")).cast(kind), F.lit(0).cast(kind))
    return F.struct(whole(day, "int").alias("day"), whole(number, "decimal(38,0)").alias("number"))


def id_prefix(doc_target: Column, collection: Column, fallback: Column) -> Column:
    raw = F.coalesce(text_or_null(doc_target), text_or_null(collection), fallback)
    return (F.when(raw.isin("eflaw", "law", "법령"), "law").when(raw.isin("admrul", "행정규칙"), "admrul")
            .when(raw.isin(*SCHOOL_TARGETS, "학칙공단", "학칙", "공단정관", "공공기관"), "SchlPubRul")
            .when(raw.isin("ordin", "ordinance", "자치법규", "조례"), "ordin").otherwise(F.coalesce(raw, F.lit("law"))))


def domain(doc_target: Column, source: Column) -> Column:
    """The collection of a document: its own target first, then where it came from."""
    return (F.when(doc_target.isin(*SCHOOL_TARGETS) | source.isin(*SCHOOL_TARGETS), "schlpub")
            .when(doc_target.isin("admrul", "ordin", "ordinance") | source.isin("admrul", "ordin", "ordinance"), "admrul")
            .when((source == "eflaw") | (doc_target == "eflaw"), "law").otherwise(F.coalesce(source, F.lit("law"))))


def route(doc_target: Column, law_id: Column, default: Column) -> Column:
    """The collection that a record goes to: by its document's target, else by its law's id, else where its package came from."""
    return let(F.trim(F.coalesce(doc_target, F.lit(""))), lambda t: routed(t, law_id, default))


def routed(target: Column, law_id: Column, default: Column) -> Column:
    """route of a target that is trimmed and not null."""
    return (F.when(target.isin("school", "pi", "public"), "schlpub").when(target.isin("eflaw", "law", "법령"), "law").when(target == "admrul", "admrul")
            .when(F.rlike(F.coalesce(law_id, F.lit("")), F.lit("^(school|pi|public):")), "schlpub").otherwise(default))


def document_base(prefix: Column, name: Column, law_id: Column) -> Column:
    return F.concat(prefix, F.lit(":"), F.coalesce(compact_name(name), law_id, F.lit("unknown")))


def article_number(no: Column, branch: Column) -> Column:
    """제N조, or 제N조의M."""
    n, m = (F.regexp_extract(c, r"^\s*0*(\d+)\s*$", 1).try_cast("int") for c in (no, branch))
    return F.when(n.isNotNull(), F.concat(F.lit("제"), n.cast("string"), F.lit("조"), F.when(m > 0, F.concat(F.lit("의"), m.cast("string"))).otherwise("")))


def article_order(label: Column) -> Column:
    """Sort key of an article label: number, then branch."""
    n = F.regexp_extract(label, r"제(\d+)조", 1).try_cast("int")
    m = F.regexp_extract(label, r"조의(\d+)", 1).try_cast("int")
    return F.struct(F.coalesce(n, F.lit(0)).alias("no"), F.coalesce(m, F.lit(0)).alias("branch"))


def article_unit(label: Column) -> Column:
    """JO0005_02 for 제5조의2; null for other labels."""
    k = article_order(label)
    tail = F.when(k["branch"] > 0, F.concat(F.lit("_"), F.lpad(k["branch"].cast("string"), 2, "0"))).otherwise("")
    return F.when(k["no"] > 0, F.concat(F.lit("JO"), F.lpad(k["no"].cast("string"), 4, "0"), tail))
