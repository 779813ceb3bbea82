"""Text and id expressions against plain Python on odd values."""

import hashlib
import uuid

from pyspark.sql import functions as F

from lexspark.functions import ids, text


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(cols)]).first()


def each(spark, f, values, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k long, v {kind}")
    return [r["x"] for r in df.select("k", f(F.col("v")).alias("x")).orderBy("k").collect()]


def test_stable_id_strips_and_keeps_nulls(spark):
    want = hashlib.sha256("a\x1f\x1fb\x1f7".encode()).hexdigest()
    assert one(spark, ids.stable_id(F.lit("　a\t"), F.lit(None).cast("string"), F.lit("b "), F.lit(7)))[0] == want


def test_uuid5_equals_library(spark):
    names = ["chunk:x", "", "가나다", "a" * 500]
    assert each(spark, ids.uuid5, names) == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


def test_iso_date(spark):
    given = ["20240101", "2024.02.01", "2024.02.30.", " 2024-3-1", "2024-01-02T03:04:05", "2024-01-02T03:04:05+09:00", "2024-01-02T03:04:05Z", "soon", "", None, "202401011"]
    want = ["2024-01-01T00:00:00Z", "2024-02-01T00:00:00Z", "2024-02-30T00:00:00Z", None, "2024-01-02T03:04:05Z", "2024-01-02T03:04:05+09:00", "2024-01-02T03:04:05Z", None, None, None, None]
    assert each(spark, text.iso_date, given) == want


def test_strip_is_unicode_wide(spark):
    given = ["　a\t", " \n ", "b c", None, "\x85x "]
    assert each(spark, text.strip, given) == ["a", "", "b c", None, "x"]


def test_names_keep_their_two_normal_forms(spark):
    given = [" 가 나·다ㆍ&lt;라&gt; ", "ＡＢＣ　１", None, " · "]
    assert each(spark, text.compact_name, given) == ["가나다<라>", "ＡＢＣ１", None, None]
    assert each(spark, text.compact_key, given) == ["가나다<라>", "ABC1", "", ""]


def test_filler_and_padding(spark):
    assert each(spark, text.is_filler, ["| --- |\n+==+", "", None, "| 제1조 |", "…", "※ □ ●\xa0~"]) == [True, True, True, False, False, True]
    assert each(spark, text.collapse_padding, ["a   b", "a  b", "a \t \xa0b\n   c"]) == ["a b", "a  b", "a b\n c"]


def test_notices(spark):
    given = ["[별지 제1호서식] <삭제>", "삭제 <2026. 4. 15.>", "삭제한다", "[별표 2] 삭제", None, "삭제됨"]
    assert each(spark, text.is_deleted_notice, given) == [True, True, False, True, False, False]
    given = ["(원문은 첨부파일 참조)", "그림  참조", "[그림]", " ", None, "별지 참조 바람"]
    assert each(spark, text.is_placeholder, given) == [True, True, False, True, True, False]


def test_images(spark):
    html = "x<img alt='q' src='/a.gif'>y<IMG src=http://h/b.png >z<img alt='none'>"
    r = one(spark, text.mark_images(F.lit(html)), text.image_urls(F.lit(html), "http://base"), text.fill_image_marks(text.mark_images(F.lit(html)), F.array(F.lit("one"), F.lit("  "))))
    assert r[0] == "x[그림]y[그림]z[그림]" and r[1] == ["http://base/a.gif", "http://h/b.png"] and r[2] == "xoney[그림]z[그림]"


def test_prefix_budget(spark):
    assert one(spark, text.content_budget(F.lit(0)), text.content_budget(F.lit(10)), text.content_budget(F.lit(9000)))[:] == (8184, 8173, 1)
    long = "p" * 7671 + "  "
    assert each(spark, text.clamp_prefix, [long, "p"]) == ["p" * 7671, "p"]


def test_chapter_context(spark):
    df = spark.createDataFrame([("p", "n"), ("p" * 600, "n"), ("p" * 600, "n" * 600), (None, "n"), (None, None)], "p string, n string")
    assert [r[0] for r in df.select(text.chapter_context(F.col("p"), F.col("n"))).collect()] == ["p", "n", "p" * 512, "n", None]


def test_safe_name_bounds_bytes(spark):
    given = ["a/b:c?.hwp", "가" * 120 + ".pdf", "x" * 255, None]
    got = each(spark, text.safe_name, given)
    assert got[0] == "a_b_c_.hwp" and got[1] == "가" * 80 + "~" + hashlib.sha1(given[1].encode()).hexdigest()[:8] and got[2] == "x" * 255 and got[3] == ""


def test_versions_and_labels(spark):
    df = spark.createDataFrame([("L1:99:20240102", "99"), ("L1:x", "no 7"), (None, None)], "v string, m string")
    got = [tuple(map(int, r[0])) for r in df.select(ids.version_rank(F.col("v"), F.col("m"))).collect()]
    assert got == [(20240102, 99), (0, 7), (0, 0)]
    label = ids.article_number(F.lit("0005"), F.lit("02"))
    assert one(spark, label, ids.article_unit(label), ids.article_number(F.lit("x"), F.lit("1")), ids.article_unit(F.lit("부칙")))[:] == ("제5조의2", "JO0005_02", None, None)


def test_routing(spark):
    null = F.lit(None).cast("string")
    assert one(spark, ids.domain(F.lit("school"), F.lit("admrul")), ids.domain(null, F.lit("eflaw")), ids.domain(null, null), ids.id_prefix(F.lit("pi"), null, F.lit("law")), ids.id_prefix(null, null, F.lit("조례")))[:] == ("schlpub", "law", "law", "SchlPubRul", "ordin")
    assert one(spark, ids.admin_rule_version(F.lit("a:1"), F.lit(" "), F.lit("2024")), ids.admin_rule_version(F.lit("a:1"), null, null))[:] == ("a:1:2024", "a:1")


def test_all_references_of_html(spark):
    import html
    from html.entities import html5

    given = [f"x&{n}y" for n in html5] + [f"&{n}" for n in list(html5)[::7]] + [f"&#{k};" for k in [*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0xFFFF, 0x1F600, 0x1FFFF, 0x10FFFF, 0x110000, 10**12]] + [f"&#x{k:x}" for k in (0, 13, 128, 0x20AC, 0x110000)]
    given += ["&", "&&amp;&", "&amp;lt;", "&notit;", "&notin;", "&ampx", "&#", "&#x", "&#xg", "&#65", "&#0065;", "no", "", "&copy &nbsp; &unknown; &CounterClockwiseContourIntegral;"]
    df = spark.createDataFrame([(k, g) for k, g in enumerate(given)] + [(-1, None)], "k int, s string")
    got = {r["k"]: r["u"] for r in df.select("k", text.unescape_all(F.col("s")).alias("u")).collect()}
    assert got.pop(-1) is None
    assert {g: got[k] for k, g in enumerate(given)} == {g: html.unescape(g) for g in given}
