"""Ids that documents, articles, appendices and references are known by, so that a reference's id is its target's.

An id is {prefix}:{name}[:{suffix}]#{unit}. Units of articles and appendices have codes: JO0005_02, BYL0001 and so on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions import names
from lexspark.functions.text import compact, let, normalize

# fixed values: codes of appendix kinds, kinds that stand for each other, Roman and circled numbers, and words behind a kind that are no number
CODES = {"별표": "BYL", "별지": "BJ", "서식": "FORM", "부록": "BR", "별첨": "BC", "별도": "BD", "양식": "FRM", "붙임": "ATT", "기타": "ETC", "부속서": "ANN", "부표": "BT", "도식": "DIA", "부도": "MAP"}
SAME_SPACE = {"BJ": "FORM", "FORM": "BJ"}
ROMAN = {"Ⅰ": "I", "Ⅱ": "II", "Ⅲ": "III", "Ⅳ": "IV", "Ⅴ": "V", "Ⅵ": "VI", "Ⅶ": "VII", "Ⅷ": "VIII", "Ⅸ": "IX", "Ⅹ": "X"}
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
NO_NUMBERS = ("및", "중", "또", "등", "내", "외", "그", "각", "이하", "상", "과", "와", "의", "에", "을", "를", "은", "는", "이", "로")
# fixed values: how labels are written
_KINDS = "별표|별지|서식|부록|별첨|별도|양식|붙임|기타|부속서|부표|도식|부도"
ARTICLE = r"^제?(\d+)(?:-(\d+))?조(?:의(\d+))?$"
SUBLABEL = rf"({_KINDS})\s*제\s*(\d+)(?:\s*-\s*(\d+))?\s*-\s*([가-하])\s*호"
NUMBERED = rf"(?<![가-힣])({_KINDS})\s*(?:제\s*)?(\d+)\s*(?:호)?(?:\s*의\s*(\d+))?"
LETTERED = rf"(?<![가-힣])({_KINDS})\s*(?:제\s*)?(?:[\[(（]?\s*)?([A-Za-z]{{1,3}}|[가-힣]|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+|[①-⑳])(?:\s*[\])）])?\s*(?:호)?(?:\s*(?:의|-)\s*([A-Za-z0-9가-힣ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ①-⑳]+))?(?=\s|$|[),.\]]|에|을|를|의|와|과|에서|부터|까지)"
COMPACT_APPENDIX = rf"^({_KINDS})\s*제?\s*(\d+)\s*(?:호)?(?:\s*의\s*(\d+))?"
TITLE_KIND = rf"^\s*(?:\[|\()?\s*({_KINDS})(?=\s*(?:제\s*)?(?:\d|[A-Za-z]|[가-힣]|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]))"
LABEL = "struct<kind: string, no: string, branch: string, sub: string>"


def _zfill(c: Column, n: int) -> Column:
    return F.when(F.length(c) < n, F.lpad(c, n, "0")).otherwise(c)


def _digits(c: Column) -> Column:
    return F.rlike(c, F.lit(r"^\d+$"))


def uncircled(c: Column) -> Column:
    """Circled numbers as digits."""
    found = F.regexp_extract_all(c, F.lit("[①-⑳]|[^①-⑳]+"), F.lit(0))
    place = lambda x: F.position(x, F.lit(CIRCLED))
    return F.when(F.rlike(c, F.lit("[①-⑳]")), F.array_join(F.transform(found, lambda x: F.when(place(x) > 0, place(x).cast("string")).otherwise(x)), "")).otherwise(c)


def _number(c: Column) -> Column:
    """number of what is compact already."""
    return let(uncircled(c), lambda s: F.when(_digits(s), F.regexp_replace(s, r"^0+(?=\d)", "")).otherwise(s))


def number(c: Column) -> Column:
    """A unit's number without leading zeros; letters stay."""
    return let(compact(c), _number)


def _branch(c: Column) -> Column:
    return let(_number(c), lambda n: F.when(n.isin("", "0"), "").otherwise(n))


def branch_number(c: Column) -> Column:
    """As number; none where it is zero."""
    return let(compact(c), _branch)


def token(c: Column) -> Column:
    """Letters of a compact number as an id holds them."""
    roman = F.create_map(*[F.lit(x) for r in ROMAN.items() for x in r])
    spelled = F.when(F.rlike(c, F.lit("[Ⅰ-Ⅹ]")), F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(roman, x), x)), "")).otherwise(c)
    return F.regexp_replace(F.upper(spelled), "[^0-9A-Z가-힣]+", "")


def _pre(kind: Column) -> Column:
    """The code of a compact kind."""
    codes = F.create_map(*[F.lit(x) for c in CODES.items() for x in c])
    return F.coalesce(F.try_element_at(codes, kind), F.lit("APX"))


def kind_code(kind: Column) -> Column:
    return _pre(compact(kind))


def _label(s: Column, pattern: str, sub: bool = False) -> Column:
    """The pattern's first match as a label; null without one."""
    g = lambda k: F.regexp_extract(s, pattern, k)
    return F.when(F.rlike(s, F.lit(pattern)), F.struct(g(1).alias("kind"), g(2).alias("no"), g(3).alias("branch"), (g(4) if sub else F.lit("")).alias("sub")))


def appendix_label(text: Column) -> Column:
    """kind, no, branch and sub of the first label in a text ("별표1", "별첨 A"); null if there is none."""
    some = lambda label: let(label, lambda x: F.when(~normalize(x["no"]).isin(*NO_NUMBERS), x), LABEL)
    return let(normalize(text), lambda s: F.coalesce(_label(s, SUBLABEL, True), some(_label(s, NUMBERED)), some(_label(s, LETTERED))), LABEL)


def leading_label(text: Column) -> Column:
    """The label that a title begins with. One inside a title is a reference, no label."""
    return let(F.regexp_replace(normalize(text), r"^[\[［ \t]+", ""), lambda s: F.coalesce(_label(s, "^" + SUBLABEL, True), _label(s, "^" + NUMBERED), _label(s, "^" + LETTERED)), LABEL)


def title_kind(title: Column) -> Column:
    """The kind that a title begins with; null if none."""
    return F.nullif(F.regexp_extract(normalize(title), TITLE_KIND, 1), F.lit(""))


def appendix_kind(kind: Column, no: Column, title: Column) -> Column:
    """An appendix's kind: a title may name a closer one than "별표", if it bears the same number."""
    told = let(number(appendix_label(title)["no"]), lambda n: (n != "") & (n == number(no)), "boolean")
    return F.when(title_kind(title).isNotNull() & compact(kind).isin("", "별표") & told, title_kind(title)).otherwise(normalize(kind))


def _compatible(kind: Column, found: Column) -> Column:
    """Whether a label's kind may stand for a compact kind."""
    mine = F.when(kind == "", "별표").otherwise(kind)
    return (mine == found) | ((mine == "서식") & (found == "별지"))


def _code(pre: Column, n: Column, b: Column, index: Column | None = None) -> Column:
    """A unit's code of its number and branch; numbers in letters follow a dash, without a number the index counts."""
    tail = F.when(b == "", "").when(_digits(b), F.concat(F.lit("_"), _zfill(b, 2)))
    letters = let(F.when(b == "", "").otherwise(token(b)), lambda t: F.when(t == "", "").otherwise(F.concat(F.lit("_"), t)))
    none = F.lit("0000") if index is None else F.when(index.isNull(), "0000").otherwise(F.concat(F.lit("-IDX"), _zfill(index.cast("string"), 4)))
    named = F.when(b == "", "").otherwise(F.concat(F.lit("_"), token(b)))  # a branch in letters keeps its mark
    return F.concat(pre, F.when(_digits(n), F.concat(_zfill(n, 4), F.coalesce(tail, named))).when(n != "", F.concat(F.lit("-"), token(n), letters)).otherwise(none))


def _code_of(x: Column) -> Column:
    """The code of a label."""
    return _code(_pre(x["kind"]), _number(x["no"]), _branch(x["branch"]))


def appendix_unit(kind: Column, no: Column, branch: Column, title: Column | None = None, file_name: Column | None = None, index: Column | None = None) -> Column:
    """An appendix's code. Its own number decides; a title's label counts where it leads and bears that number, and titles or file names where there is no number."""
    title, file_name = (F.lit("") if c is None else F.coalesce(c, F.lit("")) for c in (title, file_name))
    given = F.struct(number(no).alias("n"), branch_number(branch).alias("b"), compact(kind).alias("k"))

    def told(g: Column, text: Column) -> Column:
        return let(appendix_label(text), lambda x: F.when(x.isNotNull() & _compatible(g["k"], x["kind"]), _code_of(x)))

    def numbered(g: Column, lab: Column) -> Column:
        leads = lab.isNotNull() & (_number(lab["no"]) == g["n"]) & _compatible(g["k"], lab["kind"])
        deeper = F.when(leads & (lab["sub"] != "") & _branch(lab["branch"]).isin(F.lit(""), g["b"]), F.concat(F.lit("-"), lab["sub"])).otherwise("")
        return F.concat(_code(F.when(leads, _pre(lab["kind"])).otherwise(_pre(g["k"])), g["n"], g["b"]), deeper)

    def unit(g: Column) -> Column:
        own = F.when(title == "", _code(_pre(g["k"]), g["n"], g["b"])).otherwise(let(leading_label(title), lambda lab: numbered(g, lab)))
        return F.when(_digits(g["n"]), own).otherwise(F.coalesce(told(g, title), told(g, file_name), _code(_pre(g["k"]), g["n"], g["b"], index)))

    return let(given, unit)


def unit_of(label: Column) -> Column:
    """The code of an article's or an appendix's label; DOC for the document itself."""

    def behind(s: Column) -> Column:
        """An article's second number and branch; most have neither."""
        more = lambda k, sign: let(F.regexp_extract(s, ARTICLE, k), lambda n: F.when(n != "", F.concat(F.lit(sign), _zfill(n, 2))).otherwise(""))
        return F.when(F.endswith(s, F.lit("조")) & ~F.contains(s, F.lit("-")), "").otherwise(F.concat(more(2, "-"), more(3, "_")))

    def article(s: Column) -> Column:
        return F.concat(F.lit("JO"), let(F.regexp_extract(s, ARTICLE, 1), lambda n: _zfill(n, 4)), behind(s))

    def part(x: Column) -> Column:
        return F.concat(_pre(x["kind"]), _zfill(x["no"], 4), F.when(x["branch"] != "", F.concat(F.lit("_"), _zfill(x["branch"], 2))).otherwise(""))

    sub = lambda s: let(_label(s, "^" + SUBLABEL, True), lambda x: F.concat(part(x), F.lit("-"), x["sub"]))
    letters = let(appendix_label(label), lambda x: F.when(x.isNotNull() & ~_digits(_number(x["no"])), _code_of(x)))
    other = lambda s: F.coalesce(sub(s), let(_label(s, COMPACT_APPENDIX), part), letters, F.lit("DOC"))
    return let(compact(label), lambda c: F.when(c == "", "DOC").when(F.rlike(c, F.lit(ARTICLE)), article(c)).otherwise(let(uncircled(c), other)))


def article_place(label: Column) -> Column:
    """Sort key of an article's label: number, then its second number and branch; unreadable labels last."""
    pattern = r"^제(\d+)(?:-(\d+))?조(?:의(\d+))?"
    g = lambda k: F.coalesce(F.nullif(F.regexp_extract(F.coalesce(label, F.lit("")), pattern, k), F.lit("")).try_cast("long"), F.lit(0))
    return F.when(F.rlike(F.coalesce(label, F.lit("")), F.lit(pattern)), F.struct(g(1).alias("no"), (g(2) * 10_000 + g(3)).alias("branch"))).otherwise(F.struct(F.lit(10**9).cast("long").alias("no"), F.lit(0).cast("long").alias("branch")))


def _again(c: Column) -> Column:
    """compact of what is compact already: only entities that resolving has brought to light can change it."""
    return F.when(F.contains(c, F.lit("&")), compact(c)).otherwise(c)


def is_ordinance(name: Column) -> Column:
    return F.endswith(compact(name), F.lit("조례"))


def prefix_of(target: Column, fallback: str = "law") -> Column:
    """The axis of ids that a document's target lies on."""
    raw = compact(F.when(F.coalesce(target, F.lit("")) == "", fallback).otherwise(target))
    return (F.when(raw.isin("", "eflaw", "law", "법령"), "law").when(raw.isin("school", "pi", "public", "SchlPubRul"), "SchlPubRul")
            .when(raw.isin("ordin", "ordinance", "자치법규", "조례"), "ordin").when(raw.isin("admrul", "행정규칙"), "admrul").otherwise(raw))


def _category_prefix(c: Column) -> Column:
    """category_prefix of what is compact already."""
    return (F.when(c.isin("행정규칙", "admrul"), "admrul").when(c.isin("학칙공단", "학칙", "공단정관", "공공기관", "school", "pi", "public", "SchlPubRul"), "SchlPubRul")
            .when(c.isin("자치법규", "조례", "ordin", "ordinance"), "ordin").otherwise("law"))


def category_prefix(category: Column) -> Column:
    """The same of a reference's category; statutes where it says nothing."""
    return let(compact(category), _category_prefix)


def target_prefix(r: Column, name: Column, own: Column, own_name: Column) -> Column:
    """The axis of a reference's target, whose compact name is given. A category that is certain beats the target's name."""
    kind, delegated = r["relation_type"], F.coalesce(r["delegation_type"], F.lit(""))

    def axis(category: Column) -> Column:
        certain = category.isin("법령", "행정규칙", "자치법규")
        by_category, ordinance = let(_again(category), _category_prefix), F.endswith(_again(name), F.lit("조례"))
        by_name = F.when(certain, by_category).when(ordinance, "ordin").otherwise(by_category)
        handed = (F.when(certain & (category != "자치법규") & (delegated == ""), by_category).when(ordinance & ~certain, "ordin")
                  .when(delegated == "위임행정규칙", "admrul").when(delegated == "위임자치법규", "ordin").when(delegated == "위임학칙공단", "SchlPubRul").otherwise("law"))
        return F.when(kind == "delegation", handed).otherwise(by_name)

    return F.when((kind == "internal_ref") | ((kind == "appendix_ref") & (name == own_name)), own).when(kind.isin("appendix_ref", "delegation", "citation"), let(compact(r["target_category"]), axis)).otherwise("law")


def own_appendix(unit: Column, owned: Column) -> Column:
    """A unit that a document refers to among its own: itself where it is owned, else the form for the sheet (or the reverse), else the one owned unit of the same number."""
    pattern = r"^([A-Z]+)(\d{4}(?:_\w+)?)$"

    def alias(u: Column) -> Column:
        pre, tail = F.regexp_extract(u, pattern, 1), F.regexp_extract(u, pattern, 2)
        twin = F.concat(F.when(pre == "BJ", SAME_SPACE["BJ"]).when(pre == "FORM", SAME_SPACE["FORM"]), tail)
        same = F.array_distinct(F.filter(owned, lambda x: (F.regexp_extract(x, pattern, 2) == tail) & (F.regexp_extract(x, pattern, 1) != pre)))
        return (F.when((tail == "") | F.array_contains(owned, u), u).when(F.coalesce(F.array_contains(owned, twin), F.lit(False)), twin)
                .when(F.size(same) == 1, F.array_max(same)).otherwise(u))

    return let(unit, alias)


RELATION = ("relation_type", "delegation_type", "target_law_name", "target_category", "target_article_no", "target_unit", "appendix_kind", "appendix_no", "appendix_branch", "appendix_ambiguous", "link_text", "reference_id")


def identify(docs: DataFrame) -> DataFrame:
    """docs with ids of the document, its articles and appendices, and of their references' targets.

    docs: law_name, doc_target, id_suffix (null unless several documents bear the name), articles (array of article_no,
    relations and more; relations with the fields of RELATION) and appendices (array of kind, no, branch, title, files and
    more). Adds provision_id, addendum_provision_id and amendment_provision_id; articles get provision_id, relations
    source_provision_id, target_unit, reference_id and target_path (a guess); appendices get provision_id and, where a
    unit repeats, appendix_instance_id.
    """
    name = compact(F.col("law_name"))
    prefix = prefix_of(F.col("doc_target"))
    prefix = F.when((prefix == "SchlPubRul") & is_ordinance(name), "ordin").otherwise(prefix)
    suffix = compact(F.col("id_suffix"))
    head = F.concat(prefix, F.lit(":"), name, F.when((suffix != "") & prefix.isin("SchlPubRul", "admrul"), F.concat(F.lit(":"), suffix)).otherwise(""))
    file_name = lambda a: F.get(F.filter(F.transform(F.coalesce(a["files"], F.array().cast("array<struct<type: string, url: string, name: string>>")), lambda f: normalize(f["name"])), lambda x: x != ""), F.lit(0))
    apx = F.coalesce("appendices", F.array().cast(docs.schema["appendices"].dataType))
    docs = docs.withColumns({"__head": head, "__prefix": prefix, "__name": name, "__owned": F.transform(apx, lambda a: appendix_unit(a["kind"], a["no"], a["branch"], a["title"], file_name(a))), "__units": F.transform("articles", lambda a: unit_of(a["article_no"]))})

    def references(relations: Column, source: Column) -> Column:
        """The relations with their targets' ids: first the target's name, axis and unit, then the fields made of them. Relations are copied once."""
        own_name, axis_here = F.col("__name"), F.col("__prefix")

        def unit(r: Column, target: Column) -> Column:
            given = F.nullif(r["target_unit"], F.lit(""))
            kind = F.coalesce(F.nullif(r["appendix_kind"], F.lit("")), r["target_category"])
            sheet = F.coalesce(given, appendix_unit(kind, r["appendix_no"], r["appendix_branch"], r["target_article_no"], r["link_text"]))
            of = lambda u: F.when(target == own_name, own_appendix(u, F.col("__owned"))).otherwise(u)
            return F.when(r["relation_type"] == "appendix_ref", let(sheet, of)).otherwise(F.coalesce(given, unit_of(r["target_article_no"])))

        def told(r: Column) -> Column:
            facts = lambda target: F.struct(target.alias("target"), target_prefix(r, target, axis_here, own_name).alias("axis"), unit(r, target).alias("unit"))
            return let(compact(r["target_law_name"]), facts, "struct<target: string, axis: string, unit: string>")

        def filled(r: Column, x: Column) -> Column:
            target, axis = x["target"], x["axis"]
            unsure = F.coalesce(r["appendix_ambiguous"], F.lit(False))
            at = F.when((target == own_name) & (axis == axis_here), F.concat("__head", F.lit("#"), x["unit"])).otherwise(F.concat(axis, F.lit(":"), target, F.lit("#"), x["unit"]))
            return r.withField("source_provision_id", source).withField("target_unit", F.when(unsure, r["target_unit"]).otherwise(x["unit"])).withField(
                "reference_id", F.when(unsure, "").when(target == "", F.coalesce(r["reference_id"], F.lit(""))).otherwise(at)).withField(
                "target_path", F.when(~unsure & (target != ""), names.predicted_path(axis, r["target_law_name"])))

        return F.zip_with(relations, F.transform(relations, told), filled)

    def article(a: Column, i: Column) -> Column:
        at = F.concat("__head", F.lit("#"), F.get("__units", i))
        return a.withField("provision_id", at).withField("relations", references(a["relations"], at))

    def appendix(a: Column, i: Column) -> Column:
        unit = F.get("__owned", i)
        at = F.concat("__head", F.lit("#"), unit)
        seqs = F.filter(F.transform(a["files"], lambda f: names.file_sequence(f["url"])), lambda x: x != "")
        number_ = F.coalesce(F.concat(F.lit(":file:"), F.get(seqs, F.lit(0))), F.concat(F.lit(":idx:"), _zfill((i + 1).cast("string"), 4)))
        return a.withField("provision_id", at).withField("appendix_instance_id", F.when(F.size(F.filter("__owned", lambda u: u == unit)) > 1, F.concat(at, number_)))

    out = docs.withColumns({"provision_id": F.concat("__head", F.lit("#DOC")), "addendum_provision_id": F.concat("__head", F.lit("#ADDENDUM")), "amendment_provision_id": F.concat("__head", F.lit("#AMENDMENT")),
                            "articles": F.transform("articles", article), "appendices": F.transform("appendices", appendix)})
    return out.drop("__head", "__prefix", "__name", "__owned", "__units")


def file_meta(docs: DataFrame) -> DataFrame:
    """docs with filename, file_dir and local_path of the files that they name: one of each appendix, the attachments, and the articles' images.

    docs: as identify gives them, with attachments (array of name, url) and images (array of type, url, name) in articles.
    """

    def placed(x: Column, folder: Column, name: Column) -> Column:
        return x.withField("filename", name).withField("file_dir", F.when(name.isNotNull(), folder)).withField("local_path", F.concat(folder, F.lit("/"), name))

    def appendix(a: Column) -> Column:
        f = names.pick_file(a["files"])
        label = names.appendix_label(a["kind"], a["no"], a["branch"], a["title"])
        return placed(a, names.appendix_folder(a["kind"]), F.when(f.isNotNull(), names.appendix_file(label, f, a["appendix_instance_id"])))

    def attachment(x: Column) -> Column:
        name = names.path_element(F.when(F.coalesce(x["name"], F.lit("")) == "", "첨부파일.bin").otherwise(x["name"]))
        return placed(x, F.lit("첨부파일"), F.when(F.coalesce(x["url"], F.lit("")) != "", name))

    def article(a: Column) -> Column:
        image = lambda im, i: placed(im, F.lit("본문이미지"), names.image_file(a["article_no"], i + 1, im["type"], im["name"], im["url"]))
        return a.withField("images", F.transform(a["images"], image))

    return docs.withColumns({"appendices": F.transform("appendices", appendix), "attachments": F.transform("attachments", attachment), "articles": F.transform("articles", article)})
