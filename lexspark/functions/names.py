"""Names of files, folders and links that belong to documents, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexspark.functions.text import compact, let, normalize, strip

# fixed values: the portal's address, categories of its links, folders of appendix kinds, formats in order of preference
PORTAL = "https://www.law.go.kr"
CATEGORIES = ("법령", "행정규칙", "자치법규", "학칙공단")
APPENDIX_KINDS = ("별표", "별지", "서식", "부록", "별첨", "별도", "양식", "붙임", "기타", "부속서", "부표", "도식", "부도")
EXPORT_ORDER = ("pdf", "hwpx", "hwp", "image")
PACKAGE_ORDER = ("hwpx", "hwp", "pdf", "image")
UNNAMED = "미상"


def _empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def or_unnamed(c: Column) -> Column:
    return F.when(c == "", UNNAMED).otherwise(c)


def _element(c: Column) -> Column:
    """path_element of what is stripped already."""
    return let(F.regexp_replace(c, r'[\\/:*?"<>|\n\t]', "_"), or_unnamed)


def path_element(c: Column) -> Column:
    """A name with signs that paths can't hold replaced; never empty."""
    return _element(strip(_empty(c)))


def _kind(n: Column) -> Column:
    """kind_of a stripped name."""
    return F.when(F.endswith(n, F.lit("시행규칙")), "시행규칙").when(F.endswith(n, F.lit("시행령")), "시행령").otherwise("법률")


def kind_of(name: Column) -> Column:
    """The folder of a statute's rank: decrees and rules by the end of their names."""
    return let(strip(_empty(name)), _kind)


def _family(n: Column) -> Column:
    """family of a stripped name."""
    return F.when(F.endswith(n, F.lit("시행규칙")) | F.endswith(n, F.lit("시행령")), strip(F.regexp_replace(n, "(시행규칙|시행령)$", ""))).otherwise(n)


def family(name: Column) -> Column:
    """The statute that a decree or rule belongs to."""
    return let(strip(_empty(name)), _family)


def _path(alone: Column, n: Column) -> Column:
    """Where a document of a stripped name lies: in a folder of its own name, or by family and kind; null without a name."""
    folder = F.concat(_element(_family(n)), F.lit("/"), _kind(n))
    return F.when(n != "", let(_element(n), lambda own: F.concat(F.when(alone, own).otherwise(folder), F.lit("/"), own, F.lit(".json"))))


def git_path(doc_target: Column, name: Column, given: Column | None = None) -> Column:
    """Where a document lies in its repository: as given, else by family and kind, or in a folder of its own name for other targets."""
    alone = doc_target.isin("admrul", "school", "pi", "public", "schlpub", "SchlPubRul")
    made = let(strip(_empty(name)), lambda n: _path(alone, n))
    return made if given is None else F.coalesce(F.nullif(strip(given), F.lit("")), made)


def predicted_path(prefix: Column, name: Column) -> Column:
    """struct of repo and path where a reference's target should lie; null for targets without a repository. A guess: nothing looks whether it is there."""
    repo = F.when(prefix == "law", "LAW").when(prefix == "admrul", "ADMRUL").when(prefix == "SchlPubRul", "SCHLPUBRUL")
    made = lambda n: F.when(n != "", F.struct(repo.alias("repo"), _path(prefix != "law", n).alias("path")))
    return F.when(repo.isNotNull(), let(normalize(name), made, "struct<repo: string, path: string>"))


def file_type(kind: Column, name: Column) -> Column:
    """hwpx, hwp, pdf, image or etc: by the declared type, else by the name."""
    t, n = F.lower(_empty(kind)), F.lower(_empty(name))
    out = F.when(t.isin("img", "image", "gif", "jpg", "jpeg", "png"), "image").when(t.isin("hwpx", "hwp", "pdf"), t)
    for ext in ("hwpx", "hwp", "pdf"):
        out = out.when(F.endswith(n, F.lit(f".{ext}")), ext)
    return out.when(F.rlike(n, F.lit(r"\.(gif|jpe?g|png)$")), "image").otherwise("etc")


def file_extension(kind: Column, name: Column, url: Column, default: str = "bin") -> Column:
    """A file's extension by type, name and address."""
    t = file_type(kind, name)
    seen = F.regexp_extract(F.lower(F.concat(_empty(name), F.lit(" "), _empty(url))), r"\.(hwpx|hwp|pdf|gif|jpe?g|png)(?:$|[?&\s])", 1)
    return F.when(t.isin("hwpx", "hwp", "pdf"), t).when(seen == "jpeg", "jpg").when(seen != "", seen).when(t == "image", "gif").otherwise(default)


def pick_file(files: Column, order: tuple[str, ...] = EXPORT_ORDER) -> Column:
    """The one file of an appendix (array of type, name, url) that is kept: by format, then by place."""
    rank = lambda f: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), file_type(f["type"], f["name"])), F.lit(0)), F.lit(99))
    ranked = F.array_sort(F.transform(files, lambda f, i: F.struct(rank(f).alias("rank"), i.alias("i"), f.alias("f"))))
    return F.get(ranked, F.lit(0))["f"]


def file_sequence(url: Column) -> Column:
    """The number of a file in the portal's addresses; empty if there is none."""
    return F.regexp_extract(_empty(url), r"(?:[?&]flSeq=|/)(\d{5,})(?:$|[&#?/])", 1)


def appendix_label(kind: Column, no: Column, branch: Column, title: Column) -> Column:
    """Kind and number, with the branch, and the title behind."""
    number = F.regexp_replace(_empty(no), "^0+", "")
    tail = F.regexp_replace(_empty(branch), "^0+", "")
    head = F.concat(F.coalesce(F.nullif(strip(_empty(kind)), F.lit("")), F.lit("별표")), F.when(number == "", "0").otherwise(number), F.when(tail != "", F.concat(F.lit("의"), tail)).otherwise(""))
    named = F.regexp_replace(strip(_empty(title)), r"(?U)\s+", " ")
    return F.when(named != "", F.concat(head, F.lit("_"), named)).otherwise(head)


def appendix_folder(kind: Column) -> Column:
    k = strip(_empty(kind))
    return F.when(k.isin(*APPENDIX_KINDS), k).otherwise("별표")


def appendix_file(label: Column, file: Column, instance: Column) -> Column:
    """The stored name of an appendix's file; instances of a repeated unit (their id isn't null) carry its number."""
    number = F.coalesce(F.nullif(file_sequence(file["url"]), F.lit("")), F.element_at(F.split(instance, ":"), -1))
    mark = F.when(F.rlike(number, F.lit(r"^\d+$")), F.concat(F.lit("_flSeq"), number)).otherwise(F.concat(F.lit("_"), number))
    whole = F.concat(label, F.when(instance.isNotNull(), mark).otherwise(""))
    return path_element(F.concat(whole, F.lit("."), file_extension(file["type"], file["name"], file["url"])))


def image_file(article_no: Column, seq: Column, kind: Column, name: Column, url: Column) -> Column:
    """The stored name of an article's image."""
    base = path_element(F.replace(F.coalesce(F.nullif(article_no, F.lit("")), F.lit("본문")), F.lit(" "), F.lit("")))
    return path_element(F.concat(base, F.lit("_"), seq.cast("string"), F.lit("."), file_extension(kind, name, url, "gif")))


def absolute(url: Column) -> Column:
    """An address with the portal's host where it has none."""
    u = strip(_empty(url))
    return F.when(F.startswith(u, F.lit("//")), F.concat(F.lit("https:"), u)).when(F.startswith(u, F.lit("/")), F.concat(F.lit(PORTAL), u)).otherwise(u)


def reference_url(category: Column, title: Column, article_no: Column | None = None) -> Column:
    """The portal's page of a document, or of one of its articles."""
    page = F.concat_ws("/", F.lit(PORTAL), F.when(category.isin(*CATEGORIES), category).otherwise("법령"), normalize(title))
    return page if article_no is None else F.when(F.coalesce(article_no, F.lit("")) != "", F.concat(page, F.lit("/"), article_no)).otherwise(page)


def images(content: Column) -> Column:
    """(url, seq) of the <img> tags in order: by source, else by number; tags with neither are left out."""
    tags = F.regexp_extract_all(F.coalesce(content, F.lit("")), F.lit(r"(?i)<img\b[^>]*?>"), F.lit(0))

    def one(tag: Column) -> Column:
        src = F.regexp_extract(tag, r"""(?i)\bsrc\s*=\s*["']([^"']+)""", 1)
        number = F.regexp_extract(tag, r"""(?i)\bid\s*=\s*["']?(\d+)""", 1)
        return F.when(src != "", F.struct(absolute(src).alias("url"), F.lit("").alias("seq"))).when(number != "", F.struct(F.concat(F.lit(f"{PORTAL}/LSW/flDownload.do?flSeq="), number).alias("url"), number.alias("seq")))

    return F.filter(F.transform(tags, one), lambda x: x.isNotNull())


def law_id_of(doc_uid: Column) -> Column:
    """The law id that a collector's document id names; null for other kinds."""
    return F.nullif(F.regexp_extract(strip(_empty(doc_uid)), r"^law:eflaw:([^:\s]+)$", 1), F.lit(""))


def implied_source(doc_target: Column, law_id: Column) -> Column:
    """law, admrul or schlpub as the document's own fields say, ? for an unknown target, null if they say nothing."""
    t = F.nullif(strip(_empty(doc_target)), F.lit(""))
    schools = ("school", "pi", "public", "schlpub", "SchlPubRul")
    return (F.when(t.isin(*schools), "schlpub").when(t.isin("eflaw", "law", "법령"), "law").when(t == "admrul", "admrul").when(t.isNotNull(), "?")
            .when(F.rlike(_empty(law_id), F.lit(f"^({'|'.join(schools)}):")), "schlpub"))


def sequence_fallback(promulgation_no: Column, key: Column) -> Column:
    """A statute's sequence where it came without: its promulgation number, else what follows id and date in its key."""
    k = _empty(key)
    return F.coalesce(F.nullif(strip(_empty(promulgation_no)), F.lit("")), F.when(F.rlike(k, F.lit(r"^\d{14}.")), F.substring(k, 15, 1_000)), F.lit(""))


def original_name(name: Column, sha256: Column) -> Column:
    """The name before a collector put twelve digits of the content's digest behind its stem; as it is where they are none of it."""
    mark = F.regexp_extract(name, r"^(?s:.+)__([0-9a-f]{12})\.[^./]+$", 1)
    return F.when((mark != "") & (mark == F.lower(F.substring(_empty(sha256), 1, 12))), F.regexp_replace(name, r"__[0-9a-f]{12}(\.[^./]+)$", "$1")).otherwise(name)


def aliases(law_name: Column, *others: Column) -> Column:
    """Other names of a document, each once and none that compares equal to its own, in order."""
    named = F.filter(F.transform(F.array(*[_empty(o) for o in others]), normalize), lambda x: x != "")
    keys = F.transform(named, compact)
    return F.filter(named, lambda x, i: (compact(x) != F.coalesce(compact(law_name), F.lit(""))) & (F.array_position(keys, compact(x)) == i + 1))


def first_line_with(content: Column, part: Column) -> Column:
    """The first line of a text that holds part, stripped; null if none does."""
    lines = F.filter(F.transform(F.split(F.coalesce(content, F.lit("")), r"\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]"), strip), lambda x: x != "")
    return F.when(F.coalesce(part, F.lit("")) != "", F.get(F.filter(lines, lambda x: F.contains(x, part)), F.lit(0)))


def without_forbidden(c: Column) -> Column:
    """A path's step with the signs that paths can't hold left out."""
    return strip(F.regexp_replace(_empty(c), r'[\\/:*?"<>|\n\t]', ""))


def mirror_folder(file_name: Column, unit_type: Column) -> Column:
    """The folder of a delivered file: by the appendix kind that its name begins with, by its unit, or as an article's image."""
    kinds = "|".join(sorted(APPENDIX_KINDS, key=len, reverse=True))
    kind = F.regexp_extract(_empty(file_name), rf"^({kinds})\s*(?:제\s*)?(?:\d|[A-Za-z가-힣ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ])", 1)
    image = F.rlike(_empty(file_name), F.lit(r"(?i)^제.*_\d+\.(gif|png|jpe?g)$"))
    return F.when(kind != "", kind).when(unit_type == "APPENDIX", "별표").when(unit_type == "FILE", "첨부파일").when(image, "본문이미지").otherwise("첨부미러")
