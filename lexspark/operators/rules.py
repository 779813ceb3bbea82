"""Articles of administrative rules from flat text: items of running text become articles under their chapters.

A rule's text comes as items of unstable cut: headings, several articles in one item, or an article's later lines. All
places in it that look like an article's heading are marked at once and the text is cut there. Each piece has properties of its own
(what its mark says, whether it is cited, whether it opens its item), found by patterns over its neighbourhood; a
document's pieces, in order, then settle which marks are articles by the numbers before them. Chapters run over the pieces by windows,
and an article's text is what its pieces join to.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexspark.functions import text
from lexspark.operators.raw import LEVELS

# fixed values: how headings of articles and chapters are written, what follows or precedes a citation, and where text begins behind a heading
NUMBER = r"제\d+(?:-\d+)?조(?:의\d+)?"
HEADING = rf"({NUMBER})\s*(?:\(([^)]*)\)|<?\s*삭\s*제)"
CHAPTER = r"제\d+\s*[편장절관]"
LAW_NAME_END = r"(법|법률|령|규칙|조례|규정|준칙|협정|특례|헌장|예규|훈령|고시|지침|약관|조약|학칙|정관|내규|세칙|요령|기준)$"
CITED_ON = r"(?:에|의|를|을|은|는|이|가|와|과|로|으로|부터|까지|및|또는|에서|에게)(?=[\s가-힣,.])|\s*(?:및|또는|그리고|내지)\s*제\s*\d+\s*조|\s*[,ㆍ·]\s*제\s*\d+\s*조"
TEXT_BEGINS = r"\d+\s*[.)]|\d+\s*[-.]\s*\d+|제\s*\d+\s*(?:조|항|호|-)|[①-⑳]|[ㅇ○□▪▶◦]\s|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]\s*[.)]|이\s*(?:규정|지침|고시|기준|예규|훈령|요령|규칙|세칙|내규|표준|계획|요강|안내서)(?:은|는|이)\s"
OUTLINE = r"\d+-\d+-\d+\."
WHOLE = "전문"
# fixed values: characters of a heading alone and of its name, between a heading and an article; outlines: articles at most, length and marks at least
HEADING_CHARS, NAME_CHARS, GAP_CHARS = 400, 60, 25
OUTLINE_ARTICLES, OUTLINE_CHARS, OUTLINE_MARKS = 5, 2_000, 10

MARK = "\x01"
#: Headings in a row: each with a name that ends where the next one or text begins.
HEADINGS = rf"^(?:{CHAPTER}(?:(?!{CHAPTER}|{TEXT_BEGINS}).){{0,{NAME_CHARS}}})+"

# what a piece is, and what settles it
CLOSES, OPENS, HEADS, PLAIN = "closes", "opens", "heads", "plain"


def _matches(c: Column, pattern: str) -> Column:
    return F.coalesce(F.rlike(c, F.lit(pattern)), F.lit(False))


def _is_chapter(c: Column) -> Column:
    """A text that is chapters' headings alone, by its beginning and its length without images."""
    return _matches(c, rf"^{CHAPTER}") & ((F.length(c) <= HEADING_CHARS) | (F.length(text.strip(text.mark_images(c))) <= HEADING_CHARS))


def _bare(c: Column) -> Column:
    """struct of head, no and rest of a text that begins with chapters and goes on with an article of no title; null for others."""
    numbers = F.regexp_extract_all(c, F.lit(rf"{NUMBER}(?!\s*\()(?=\s)"), F.lit(0))
    # the text before the i-th of them
    cut = F.split(F.regexp_replace(c, rf"({NUMBER})(?!\s*\()(?=\s)", MARK + "$1"), MARK)
    places = F.transform(numbers, lambda n, i: F.struct(F.array_join(F.slice(cut, F.lit(1), i + 1), "").alias("before"), n.alias("no"), F.array_join(F.slice(cut, i + 2, F.size(cut)), "").alias("rest")))
    gap = lambda p: F.regexp_extract(F.rtrim(p["before"]), rf"(?s)^.*{CHAPTER}(.*)$", 1)
    good = F.filter(places, lambda p: _matches(p["before"], rf"^{CHAPTER}") & (F.length(gap(p)) <= GAP_CHARS) & ~_matches(gap(p), "[.。「(①]"))
    first = F.get(good, F.lit(0))
    return F.when(_matches(c, rf"^{CHAPTER}") & first.isNotNull(), F.struct(F.rtrim(first["before"]).alias("head"), first["no"].alias("no"), first["rest"].alias("rest")))


def pieces(docs: DataFrame, key: str, items: str) -> DataFrame:
    """key, item, k, sub (order of pieces), kind, no, title, cited, leads, said (the piece's text) and label (where its chapters' names stand) of each piece."""
    t = docs.select(key, F.posexplode(F.transform(F.filter(items, lambda x: x.isNotNull() & (x != "")), lambda x: F.translate(x, MARK, ""))).alias("item", "t"))
    t = t.withColumn("cut", F.split(F.regexp_replace("t", HEADING, MARK + "$0"), MARK))
    rows = t.select(key, "item", "cut", F.posexplode("cut").alias("k", "p"))
    before, after = F.get("cut", F.col("k") - 1), F.get("cut", F.col("k") + 1)
    names = F.when(_matches(F.col("p"), CHAPTER), F.when(F.contains(F.regexp_extract("p", rf"(?s)^.*{CHAPTER}(.*)$", 1), F.lit("」")), "cited").otherwise("chapter")).when(F.contains("p", F.lit("」")), "cited").when(F.col("k") == 0, "none")
    w = Window.partitionBy(key).orderBy("item", "k").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("names", names).withColumn("last", F.last("names", True).over(w))
    behind = F.concat(F.regexp_replace("p", rf"(?s)^{HEADING}", ""), F.coalesce(after, F.lit("")))
    end = F.regexp_replace(F.coalesce(before, F.lit("")), r"(?U)\s+$", "")
    # a law's name, or what closes one, stands before it, but not where that may be a chapter's name; or a particle behind
    cited = _matches(behind, rf"^(?:{CITED_ON})") | (F.col("k") > 0) & (F.coalesce(F.col("last"), F.lit("none")) != "chapter") & (F.endswith(end, F.lit("」")) | _matches(end, LAW_NAME_END))
    no, title = F.regexp_extract("p", HEADING, 1), F.regexp_extract("p", rf"(?s)^{NUMBER}\s*\(([^)]*)\)", 1)
    deleted = ~_matches(F.col("p"), rf"^{NUMBER}\s*\(")
    none, yes, nay = F.lit(None).cast("string"), F.lit(True), F.lit(False)

    def piece(sub: int, kind: str, no, title, cited, leads, said, label) -> Column:
        return F.struct(F.lit(sub).alias("sub"), F.lit(kind).alias("kind"), no.alias("no"), title.alias("title"), cited.alias("cited"), leads.alias("leads"), said.alias("said"), label.alias("label"))

    plain = text.strip(F.col("p"))
    bare = _bare(plain)
    chapters = lambda c: F.regexp_extract(c, HEADINGS, 0)
    long = ~_is_chapter(bare["head"])
    made = (F.when(F.col("k") > 0, F.array(piece(0, HEADS, no, F.when(deleted, F.lit("삭제")).otherwise(text.strip(title)), cited, (F.col("k") == 1) & (before == ""), plain, F.col("p"))))
            .when(plain == "", F.array().cast("array<struct<sub:int,kind:string,no:string,title:string,cited:boolean,leads:boolean,said:string,label:string>>"))
            .when(bare.isNotNull(), F.array(piece(0, CLOSES, none, none, nay, nay, F.when(long, bare["head"]), F.when(long, chapters(bare["head"])).otherwise(bare["head"])), piece(1, OPENS, bare["no"], F.lit(""), nay, yes, text.strip(bare["rest"]), none)))
            .when(_is_chapter(plain), F.array(piece(0, CLOSES, none, none, nay, nay, none, plain)))
            .otherwise(F.array(piece(0, PLAIN, none, none, nay, nay, plain, chapters(plain)))))
    return rows.select(key, "item", "k", F.explode(made).alias("x")).select(key, "item", "k", "x.*")


def rank(no: str) -> tuple[int, int]:
    """Order of article numbers; second numbers weigh more than branches."""
    whole, _, branch = no.removeprefix("제").partition("조")
    number, _, second = whole.partition("-")
    return int(number), int(second or 0) * 10_000 + int(branch.removeprefix("의") or 0)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _owners(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """For each piece of a document (kind, no, cited, leads), in order: the article it belongs to (from 1), 0 for the document's own text, -1 for none."""

    def settle(given) -> list[int]:
        known: dict[str, int] = {}
        now, at, out = 0, (-1, -1), []  # the article that goes on (0: none) and its place
        for p in given:
            if p["kind"] == CLOSES:
                now, at = 0, (-1, -1)
            elif p["kind"] != PLAIN and not p["cited"] and (p["leads"] or rank(p["no"]) > at):
                if p["no"] in known:  # again: more of what goes on
                    out.append(now or -1)
                    continue
                now, at = known.setdefault(p["no"], len(known) + 1), rank(p["no"])
            out.append(now)
        return out

    for documents in batches:
        yield pd.Series([settle(d) for d in documents])


def rule_articles(docs: DataFrame, key: str, items: str = "items") -> DataFrame:
    """key and articles (article_no, article_title, chapter, chapter_path, content) of rules, from their items (array of stripped texts, in order).

    An article begins at a heading that isn't cited and leads its item or has a higher number than the article before;
    one whose number came before is more of the article that goes on. Text of no article comes first, as 전문. An outline without articles is that alone.
    A rule without items has no row. A key names one rule.
    """
    named, docs = key, docs.select(F.col(key).alias("__key"), F.col(items).alias("__items"))
    key, items = "__key", "__items"
    p = pieces(docs, key, items)
    one = F.struct("item", "k", "sub", "kind", "no", "cited", "leads", "title", "said", "label")
    listed = p.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("p")).withColumn("owner", _owners("p"))
    rows = listed.select(key, F.posexplode(F.arrays_zip("p", "owner")).alias("n", "x")).select(key, "n", "x.p.*", "x.owner")
    began = Window.partitionBy(key, "owner").orderBy("n")
    rows = rows.withColumn("begins", (F.col("owner") > 0) & (F.row_number().over(began) == 1))
    lines = rows.select(key, "n", F.posexplode(F.split("label", "\n")).alias("line", "h")).select(key, "n", (F.col("line") + 1).alias("line"), text.strip(text.mark_images(F.col("h"))).alias("h"), F.lit(0).alias("owner"), F.lit(None).cast("string").alias("no"), F.lit(None).cast("string").alias("title"))
    lines = lines.where(F.rlike("h", F.lit(rf"^제\d+\s*[{''.join(LEVELS)}](\s*의\s*\d+)?(\s|$)")))
    heads = rows.where("begins").select(key, "n", F.lit(0).alias("line"), F.lit(None).cast("string").alias("h"), "owner", "no", "title")
    marked, order = heads.unionByName(lines), F.struct("n", "line")
    w = Window.partitionBy(key).orderBy("n", "line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for k, level in enumerate(LEVELS):
        marked = marked.withColumn(f"h{k}", F.last(F.when(F.rlike("h", F.lit(rf"^제\d+\s*{level}")), F.struct(order.alias("at"), "h")), True).over(w))
    live = [F.when(reduce(lambda a, b: a & b, [F.coalesce(F.col(f"h{k}.at") > F.col(f"h{j}.at"), F.lit(True)) for j in range(k)], F.col(f"h{k}").isNotNull()), F.col(f"h{k}.h")) for k in range(len(LEVELS))]
    heads = marked.where("owner > 0").withColumn("path", F.array_compact(F.array(*live))).select(key, "owner", "no", "title", F.coalesce(F.try_element_at("path", F.lit(-1)), F.lit("")).alias("chapter"), F.array_join("path", " > ").alias("chapter_path"))
    said = rows.where("owner >= 0 and said is not null").groupBy(key, "owner").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "said"))), lambda x: x["said"]), "\n").alias("content"))
    article = lambda no, title, chapter, path, content: F.struct(no.alias("article_no"), title.alias("article_title"), chapter.alias("chapter"), path.alias("chapter_path"), content.alias("content"))
    whole = lambda content: F.array(article(F.lit(WHOLE), F.lit(""), F.lit(""), F.lit(""), content))
    found = said.join(heads, [key, "owner"], "left").groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("owner") > 0, F.struct("owner", article(F.col("no"), F.col("title"), F.col("chapter"), F.col("chapter_path"), F.col("content")).alias("a"))))), lambda x: x["a"]).alias("__a"),
        F.max(F.when(F.col("owner") == 0, text.strip(F.col("content")))).alias("__loose"))
    all_text = F.array_join(F.filter(items, lambda x: x.isNotNull() & (x != "")), "\n")
    out = docs.select(key, all_text.alias("__t")).where("__t <> ''").join(found, key, "left")
    loose, some = F.coalesce("__loose", F.lit("")), F.coalesce("__a", F.array().cast(found.schema["__a"].dataType))
    outline = (F.size(some) <= OUTLINE_ARTICLES) & (F.length("__t") > OUTLINE_CHARS) & (F.size(F.regexp_extract_all("__t", F.lit(OUTLINE), F.lit(0))) >= OUTLINE_MARKS)
    return out.select(F.col(key).alias(named), F.when(outline, whole(text.strip(F.col("__t")))).when((F.size(some) == 0) & (loose == ""), whole(text.strip(F.col("__t")))).when(loose == "", some).otherwise(F.concat(whole(loose), some)).alias("articles"))
