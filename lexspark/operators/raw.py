"""Raw statute bodies (one JSON object a document, of unstable nesting) to articles, addenda and appendices.

Bodies are read as VARIANT: a part may be a list, a single object, or absent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.functions import ids, text

# fixed values: heading levels from the outermost, as their words stand in "제N편" and so on
LEVELS = ("편", "장", "절", "관")


def as_list(v: Column, path: str) -> Column:
    """The elements at a path: a list's own, or the single value; empty where there is none."""
    many = F.try_variant_get(v, path, "array<variant>")
    one = F.try_variant_get(v, path, "variant")
    return F.coalesce(many, F.when(one.isNotNull() & (F.schema_of_variant(one) != "VOID"), F.array(one)), F.array().cast("array<variant>"))


def value(v: Column, path: str) -> Column:
    """Text at a path: a string or number itself, the lines of a list (of lists) joined."""
    flat = F.array_join(F.filter(F.flatten(F.transform(as_list(v, path), lambda x: F.coalesce(F.try_variant_get(x, "$", "array<string>"), F.array(F.try_variant_get(x, "$", "string"))))), lambda x: x.isNotNull()), "\n")
    return text.text_or_null(flat)


def article_text(unit: Column) -> Column:
    """An article's own text, then each paragraph with its items and their sub-items, one to a line; sub-items that hang on the paragraph itself come after its items."""
    def lines(*parts: Column) -> Column:
        return F.filter(F.concat(*parts), lambda x: x.isNotNull())

    sub = lambda v: F.transform(as_list(v, "$.목"), lambda m: value(m, "$.목내용"))
    items = lambda v: F.flatten(F.transform(as_list(v, "$.호"), lambda h: lines(F.array(value(h, "$.호내용")), sub(h))))
    paragraphs = F.flatten(F.transform(as_list(unit, "$.항"), lambda p: lines(F.array(value(p, "$.항내용")), items(p), sub(p))))
    return F.array_join(lines(F.array(value(unit, "$.조문내용")), paragraphs, items(unit)), "\n")


NONE = ("0", "00", "000000")  # fixed values: numbers of units without one


def _bare(content: Column, number: Column, title: Column) -> Column:
    """Whether an article's text is its number and title alone."""
    def once(c: Column, part: Column) -> Column:
        at = F.instr(c, part)
        return F.when(F.coalesce(at, F.lit(0)) > 0, F.concat(F.substr(c, F.lit(1), at - 1), F.substr(c, at + F.length(part)))).otherwise(c)

    return text.text_or_null(once(text.strip(once(content, number)), F.when(title.isNotNull(), F.concat(F.lit("("), title, F.lit(")"))))).isNull()


def articles(bodies: DataFrame, body: str = "body", key: str = "law_id") -> DataFrame:
    """key, pos, article_no, article_title, content, chapter (nearest heading), chapter_path and note of each article of body's 조문단위.

    An article is a unit marked 조문, or an unmarked one that has a title or paragraphs. Other units are headings where they
    begin as one (it ends those of its level and below), else preamble. Of articles of one number the first with a text
    stays; one without number is dropped, or preamble where its number is zero. An article of number and title alone is
    given its note. A body without articles is one article, 전문, of its preambles' texts.
    """
    u = bodies.select(key, F.posexplode(as_list(F.col(body), "$.조문단위")).alias("pos", "u"))
    get = lambda name: value(F.col("u"), f"$.{name}")
    zero = F.coalesce(F.trim(get("조문번호")).isin(*NONE), F.lit(False))
    number = F.when(~zero, ids.article_number(get("조문번호"), get("조문가지번호")))
    own = F.when(get("조문여부").isNotNull(), get("조문여부") == "조문").otherwise(get("조문제목").isNotNull() | (F.size(as_list(F.col("u"), "$.항")) > 0))
    u = u.select(key, "pos", own.alias("own"), text.normalize(get("조문내용")).alias("head"), article_text(F.col("u")).alias("content"), number.alias("article_no"), zero.alias("zero"),
                 get("조문제목").alias("article_title"), text.text_or_null(text.normalize(get("조문참고자료"))).alias("note"))
    note = F.when(F.col("own") & F.col("note").isNotNull() & _bare(F.col("content"), F.col("article_no"), F.col("article_title")), F.concat_ws(" ", "content", "note"))
    u = u.withColumns({"content": text.text_or_null(F.coalesce(note, F.col("content"))), "chapter": ~F.col("own") & F.rlike(F.coalesce("head", F.lit("")), F.lit(rf"^제\d+\s*[{''.join(LEVELS)}]"))})
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heading = F.regexp_replace(F.trim(text.mark_images(F.col("head"))), r"(?U)\s+", " ")
    marked = u.withColumn("h", F.when(F.col("chapter"), heading))
    for k, level in enumerate(LEVELS):
        at = F.when(F.rlike("h", F.lit(rf"^제\d+\s*{level}(\s*의\s*\d+)?(\s|$)")), F.struct("pos", "h"))
        marked = marked.withColumn(f"h{k}", F.last(at, True).over(w))
    # a heading holds until one of its own or a higher level comes
    live = [F.when(reduce(lambda a, b: a & b, [F.coalesce(F.col(f"h{k}.pos") > F.col(f"h{j}.pos"), F.lit(True)) for j in range(k)], F.col(f"h{k}").isNotNull()), F.col(f"h{k}.h")) for k in range(len(LEVELS))]
    good = F.col("own") & F.col("article_no").isNotNull() & F.col("content").isNotNull()
    rows = marked.withColumns({"path": F.array_compact(F.array(*live)), "good": good, "preamble": F.when(~F.col("own") & ~F.col("chapter"), F.coalesce("content", text.text_or_null(F.col("head")))).when(F.col("own") & F.col("article_no").isNull() & F.col("zero"), F.col("content"))})
    whole = Window.partitionBy(key)
    rows = rows.withColumns({"any": F.bool_or("good").over(whole), "first": F.min(F.when(F.col("good"), F.col("pos"))).over(Window.partitionBy(key, "article_no"))})
    found = rows.where(F.col("good") & (F.col("pos") == F.col("first"))).select(key, "pos", "article_no", "article_title", "content", F.try_element_at("path", F.lit(-1)).alias("chapter"), F.nullif(F.array_join("path", " > "), F.lit("")).alias("chapter_path"), "note")
    none = F.lit(None).cast("string")
    alone = rows.where(~F.col("any") & F.col("preamble").isNotNull()).groupBy(key).agg(F.min("pos").alias("pos"), F.array_sort(F.collect_list(F.struct("pos", "preamble"))).alias("p"))
    alone = alone.select(key, "pos", F.lit("전문").alias("article_no"), none.alias("article_title"), F.array_join(F.transform("p", lambda x: x["preamble"]), "\n").alias("content"), none.alias("chapter"), none.alias("chapter_path"), none.alias("note"))
    return found.unionByName(alone)


def addenda(body: Column) -> Column:
    """Addenda by promulgation date, the order of the body among equals."""
    found = F.transform(as_list(body, "$.부칙단위"), lambda a, i: F.struct(F.coalesce(value(a, "$.부칙공포일자"), F.lit("")).alias("promulgation_date"), i.alias("pos"), value(a, "$.부칙공포번호").alias("promulgation_no"), value(a, "$.부칙내용").alias("content")))
    return F.array_sort(found)


# fixed values: an appendix whose text only points to its file
POINTER = r"자세한\s*내용은.*(다운로드|주소를\s*복사)"
LABEL = r"^[\[〈<]\s*(별표|별지|서식|별도|부록|별첨|양식|붙임)[^\]〉>]{0,15}[\]〉>]$"
FILES = (("hwp", "별표서식파일링크", "별표HWP파일명"), ("pdf", "별표서식PDF파일링크", "별표PDF파일명"), ("image", "별표서식이미지파일링크", "별표이미지파일명"))


def appendices(body: Column) -> Column:
    """Appendices with padded numbers (other labels stay as they are); file-only where they have a file and no text of their own.

    Each link is a file: the name in its place, else the first one.
    """

    def one(a: Column) -> Column:
        def label(n: str, width: int) -> Column:
            v = F.trim(F.coalesce(value(a, n), F.lit("0")))
            return F.when(F.rlike(v, F.lit(r"^\d+$")), F.lpad(v, F.greatest(F.length(v), F.lit(width)), "0")).otherwise(v)

        def of_kind(kind: str, link: str, name: str) -> Column:
            said = F.transform(as_list(a, f"$.{name}"), lambda x: F.try_variant_get(x, "$", "string"))
            urls = F.transform(as_list(a, f"$.{link}"), lambda x: text.text_or_null(F.try_variant_get(x, "$", "string")))
            return F.filter(F.transform(urls, lambda u, i: F.struct(F.lit(kind).alias("type"), u.alias("url"), F.coalesce(F.get(said, i), F.get(said, F.lit(0))).alias("name"))), lambda f: f["url"].isNotNull())

        files = F.concat(*[of_kind(*f) for f in FILES])
        content = value(a, "$.별표내용")
        hollow = content.isNull() | F.rlike(content, F.lit(POINTER)) | F.rlike(F.trim(content), F.lit(LABEL))
        return F.struct(label("$.별표번호", 4).alias("no"), label("$.별표가지번호", 2).alias("branch"), value(a, "$.별표구분").alias("kind"), value(a, "$.별표제목").alias("title"), content.alias("content"), (hollow & (F.size(files) > 0)).alias("is_file_only"), files.alias("files"))

    return F.transform(as_list(body, "$.별표단위"), one)
