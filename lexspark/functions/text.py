"""Text expressions with the engine's semantics: Unicode trimming, dates, names, padding, image marks."""

from __future__ import annotations

import json
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: signs dropped from compared names, and entities that occur in them
MIDDLE_DOTS = "ㆍ·․‧・"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&middot;": "·", "&amp;": "&"}
IMAGE_MARK = "[그림]"
# fixed values: what tables are filled with, notices of deleted appendices, and notices in place of a text
FILLER = r"[\s|\-+_=~·.※□■◦○●\u00a0]"
DELETED_NOTICE = r"^\s*(?:\[[^\]]{0,30}\]\s*)?[<(]?\s*삭제\s*[>)]?\s*(?:<[^>]{0,30}>)?\s*$"
PLACEHOLDER = r"^[\[［(]?\s*(첨부\s*파일\s*참조|별첨\s*참조|원문\s*은\s*첨부\s*파일\s*참조|첨부\s*파일\s*원문\s*참조|별지\s*참조|그림\s*참조|이미지\s*참조)\s*[\])］]?$"
FULL_WIDTH = "".join(map(chr, range(0xFF01, 0xFF5F)))
HALF_WIDTH = "".join(map(chr, range(0x21, 0x7F)))


def let(value: Column, f, kind: str = "string") -> Column:
    """f(value) of type kind, the value being worked out once however often f names it.

    A fold over one element: unlike taking an element of a transformed array, it doesn't derive its type again for each row.
    """
    return F.aggregate(F.array(value), F.lit(None).cast(kind), lambda _, x: f(x))


def strip(c: Column) -> Column:
    """Both ends without white space of any script."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+$", "")


def text_or_null(c: Column) -> Column:
    """Stripped text; blank becomes null."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def first_text(*cs: Column) -> Column:
    """The first value that isn't blank, stripped."""
    return F.coalesce(*map(text_or_null, cs))


def iso_date(c: Column) -> Column:
    """Eight digits (dots or dashes between) as a UTC midnight; a value with T keeps its zone or gets Z; else null. No calendar check."""
    s = F.regexp_replace(F.translate(strip(c.cast("string")), ".", "-"), r"-+$", "")
    digits = F.replace(s, F.lit("-"), F.lit(""))
    stamp = F.concat(F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 2), F.lit("-"), F.substring(digits, 7, 2), F.lit("T00:00:00Z"))
    zoned = F.endswith(s, F.lit("Z")) | F.contains(F.substring(s, 11, 1_000), F.lit("+"))
    return F.when(F.rlike(digits, F.lit(r"^\d{8}$")), stamp).when(F.contains(s, F.lit("T")), F.when(zoned, s).otherwise(F.concat(s, F.lit("Z"))))


def search_text(*cs: Column) -> Column:
    """Stripped parts that aren't blank, one to a line."""
    return F.array_join(F.filter(F.transform(F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in cs]), strip), lambda x: x != ""), "\n")


def collapse_padding(c: Column) -> Column:
    """Runs of three or more blanks, tabs or no-break spaces become one blank."""
    return F.regexp_replace(c, "[ \t ]{3,}", " ")


def is_filler(c: Column) -> Column:
    """Nothing but white space and the glyphs that tables are drawn with."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), "(?U)" + FILLER, "") == ""


def is_deleted_notice(c: Column) -> Column:
    return F.rlike(F.coalesce(c, F.lit("")), F.lit(DELETED_NOTICE))


def is_placeholder(c: Column) -> Column:
    """Blank, or nothing but a notice (bracketed or not, blanks between its words or not) that the text is elsewhere."""
    s = strip(F.coalesce(c, F.lit("")))
    return (s == "") | F.rlike(s, F.lit(PLACEHOLDER))


#: Names of the HTML standard's table that may stand without a semicolon, the longest first.
BARE_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_NAMES = json.dumps(html5)


def _control(code: int) -> str:
    """What a reference to a control character of 0x80 to 0x9f means: that of the Windows code page, where it has one."""
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


def _character(code: Column) -> Column:
    """The character of a numeric reference: controls by the Windows code page, none for non-characters, the replacement for what is no character."""
    nothing = code.between(0x1, 0x8) | code.isin(0xB, 0x7F) | code.between(0xE, 0x1F) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    windows = F.get(F.array(*[F.lit(_control(k)) for k in range(0x80, 0xA0)]), (code - 0x80).cast("int"))
    return (F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "\ufffd").when(code.between(0x80, 0x9F), windows).when(nothing, "")
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))


def unescape(c: Column) -> Column:
    """The entities that names hold resolved; short, as ids are made of many such expressions."""
    return reduce(lambda s, e: F.replace(s, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), c)


def unescape_all(c: Column) -> Column:
    """All references of HTML resolved once: names of the standard's table by the longest match, and numbers; others stay. The table is part of the plan: use it once for a column."""
    names = F.from_json(F.lit(_NAMES), "map<string,string>")

    def code(digits: Column, base: int, most: int) -> Column:
        return F.when(F.length(digits) > most, F.lit(0x110000).cast("long")).when(digits != "", F.conv(digits, base, 10).cast("long"))

    def told(p: Column, said: Column) -> Column:
        """The piece p that follows an ampersand, of which `said` may be a reference."""
        number = F.coalesce(code(F.regexp_extract(said, r"^#[xX]0*([0-9a-fA-F]+);?$", 1), 16, 7), code(F.regexp_extract(said, r"^#0*([0-9]+);?$", 1), 10, 9))
        bare = F.regexp_extract(said, f"^({BARE_NAMES})", 1)
        # the whole reference, else the longest name that it begins with; each looked up once
        found = let(F.struct(number.alias("n"), F.when(F.map_contains_key(names, said), said).otherwise(bare).alias("k")), lambda f: F.when(f["n"].isNotNull(), F.concat(_character(f["n"]), F.substr(p, F.length(said) + 1))).when(
            f["k"] != "", F.concat(F.element_at(names, f["k"]), F.substr(p, F.length(f["k"]) + 1))))
        return F.coalesce(found, F.concat(F.lit("&"), p))

    def resolved(v: Column) -> Column:
        return let(F.split(v, "&", -1), lambda parts: F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda p: let(F.regexp_extract(p, REFERENCE, 1), lambda said: told(p, said))), "")))

    return let(c, lambda v: F.when(F.contains(v, F.lit("&")), resolved(v)).otherwise(v))


def normalize(c: Column) -> Column:
    """Entities resolved, wide blanks made plain, both ends stripped; null becomes empty."""
    return strip(F.replace(unescape(F.coalesce(c.cast("string"), F.lit(""))), F.lit("\u3000"), F.lit(" ")))


def compact(c: Column) -> Column:
    """A name for matching: entities resolved, blanks, line breaks and middle dots gone, full-width signs folded; null becomes empty."""
    s = unescape(F.coalesce(c.cast("string"), F.lit("")))
    return strip(F.translate(s, FULL_WIDTH + " \u3000\n\t" + MIDDLE_DOTS, HALF_WIDTH))


def compact_name(c: Column) -> Column:
    """A name for identifiers: entities resolved, blanks and middle dots gone; null if nothing is left."""
    return F.nullif(strip(F.translate(unescape(text_or_null(c)), " 　\n\t" + MIDDLE_DOTS, "")), F.lit(""))


def compact_key(c: Column) -> Column:
    """A name for comparison: as compact_name, with full-width signs folded and all white space gone."""
    folded = F.translate(unescape(F.coalesce(c.cast("string"), F.lit(""))), FULL_WIDTH + MIDDLE_DOTS, HALF_WIDTH)
    return F.regexp_replace(folded, r"(?U)\s+", "")


def image_urls(c: Column, base: str = "") -> Column:
    """Sources of the <img> tags, in order; relative ones get the base."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?i)<img[^>]*?\ssrc\s*=\s*[\"']?([^\"'\s>]+)"), F.lit(1))
    return F.transform(found, lambda u: F.when(F.startswith(u, F.lit("/")), F.concat(F.lit(base), u)).otherwise(u))


def mark_images(c: Column) -> Column:
    """Image tags as marks; closing tags go where the text has an image."""
    return F.when(F.rlike(c, F.lit("(?i)<img")), F.regexp_replace(F.regexp_replace(c, r"(?i)<img\b[^>]*>", IMAGE_MARK), r"(?i)</\s*img\s*>", "")).otherwise(c)


def fill_image_marks(c: Column, texts: Column) -> Column:
    """The i-th mark becomes the i-th text; marks without one (or with a blank one) stay."""
    parts = F.split(c, r"\[그림\]", -1)
    tail = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda p, i: F.concat(F.coalesce(text_or_null(F.get(texts, i)), F.lit(IMAGE_MARK)), p))
    return F.concat(F.get(parts, F.lit(0)), F.array_join(tail, ""))


def image_mark_counts(c: Column, texts: Column) -> Column:
    """struct of marks in a text, and how many of them texts fill."""
    marks = F.size(F.split(F.coalesce(c, F.lit("")), r"\[그림\]", -1)) - 1
    given = F.size(F.filter(F.slice(F.coalesce(texts, F.array().cast("array<string>")), F.lit(1), F.greatest(marks, F.lit(0))), lambda x: text_or_null(x).isNotNull()))
    return F.struct(marks.alias("marks"), given.alias("filled"))


def chapter_context(path: Column, nearest: Column, most: int = 512) -> Column:
    """The chapter path; its nearest step where the path is too long; a cut path where that is too."""
    path, nearest = F.coalesce(text_or_null(path), text_or_null(nearest)), text_or_null(nearest)
    return F.when(F.length(path) <= most, path).when(F.length(nearest) <= most, nearest).otherwise(F.nullif(rstrip(F.substring(path, 1, most)), F.lit("")))


def clamp_prefix(c: Column, most: int = 8_184, least_content: int = 512) -> Column:
    """A prefix that leaves room for content."""
    limit = max(1, most - max(0, least_content))
    return F.when(F.length(c) <= limit, c).otherwise(rstrip(F.substring(c, 1, limit)))


def content_budget(prefix_length: Column, most: int = 8_184) -> Column:
    return F.greatest(F.lit(1), F.lit(most) - F.when(prefix_length > 0, prefix_length + 1).otherwise(0))


def preview(c: Column, most: int = 500, mark: str = "~") -> Column:
    """A text of at most so many characters; a longer one is cut and marked."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - len(mark)), F.lit(mark))).otherwise(c)


def extension(c: Column) -> Column:
    """Lower-case extension without the dot; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(c, F.lit("")), r"\.([A-Za-z0-9]+)$", 1))


def safe_name(c: Column, most_bytes: int = 255, keep_bytes: int = 240) -> Column:
    """A file name: forbidden signs become _; one too long in UTF-8 is cut and gets a digest's first eight digits."""
    clean = F.regexp_replace(F.coalesce(c, F.lit("")), r'[\\/:*?"<>|\x00-\x1f]', "_")
    # the longest prefix of whole characters within the bound, by lengths of its characters
    sizes = F.transform(F.split(clean, ""), lambda x: F.octet_length(x))
    n = F.aggregate(sizes, F.struct(F.lit(0).alias("b"), F.lit(0).alias("n")),
                    lambda a, s: F.struct((a["b"] + s).alias("b"), F.when(a["b"] + s <= keep_bytes, a["n"] + 1).otherwise(a["n"]).alias("n")), lambda a: a["n"])
    return F.when(F.octet_length(clean) <= most_bytes, clean).otherwise(F.concat(F.substring(clean, F.lit(1), n), F.lit("~"), F.substring(F.sha1(clean.cast("binary")), 1, 8)))
