"""Codes of units, ids of documents and references, names of files."""

from pyspark.sql import functions as F

from lexspark.functions import names
from lexspark.operators import identifiers as ident


def one(spark, c, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{k} string" for k in range(len(values))))
    return df.select(c(*[F.col(f"c{k}") for k in range(len(values))]).alias("x")).first()["x"]


def many(spark, c, values):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r["x"] for r in df.orderBy("k").select(c(F.col("v")).alias("x")).collect()]


def test_units_of_labels(spark):
    want = {"제90조": "JO0090", "제5조의2": "JO0005_02", "제4-36조": "JO0004-36", "제9-4조의2": "JO0009-04_02", "별표1": "BYL0001", "별지3": "BJ0003", "서식3": "FORM0003", "별첨1": "BC0001", "별도1": "BD0001", "부속서1": "ANN0001",
            "전문": "DOC", None: "DOC", "": "DOC", "90조": "JO0090", "제 12 조": "JO0012", "별표 제2호의3": "BYL0002_03", "붙임①": "ATT0001", "별첨 A": "BC-A", "별지 제3-1-가호": "BJ0003_01-가", "붙임 가": "ATT-가", "별표 및 서류": "DOC", "제12345조": "JO12345"}
    assert dict(zip(want, many(spark, ident.unit_of, list(want)))) == want


def test_appendix_units(spark):
    cases = [(("별표", "0001", "00", "", "", None), "BYL0001"), (("별표", "3", "", "봉급표(제5조 및 별표 1 관련)", "", None), "BYL0003"), (("서식", "1", "", "[별지 제1호 서식] 신청", "", None), "BJ0001"), (("서식", "1", "", "[별지 제2호 서식] 신청", "", None), "FORM0001"),
             (("별지", "3", "1", "별지 제3-1-가호 신청", "", None), "BJ0003_01-가"), (("별표", "", "", "별표 7 기준", "", None), "BYL0007"), (("별표", "", "", "기준", "별표 8.hwp", None), "BYL0008"), (("별표", "", "", "기준", "", 4), "BYL-IDX0004"), (("별표", "", "", "기준", "", None), "BYL0000"),
             (("별첨", "Ⅲ", "", "", "", None), "BC-III"), (("모름", "2", "가", "", "", None), "APX0002_가"), (("별표", "①", "00", "", "", None), "BYL0001")]
    df = spark.createDataFrame([(k, *c) for k, (c, _) in enumerate(cases)], "k int, kind string, no string, branch string, title string, file string, i int")
    got = [r["u"] for r in df.orderBy("k").select(ident.appendix_unit(*map(F.col, ("kind", "no", "branch", "title", "file", "i"))).alias("u")).collect()]
    assert got == [w for _, w in cases]


def test_kinds_by_title(spark):
    kind = lambda *v: one(spark, ident.appendix_kind, *v)
    assert kind("별표", "1", "부속서 1 규격") == "부속서" and kind("별표", "1", "양식장 기본도") == "별표" and kind("서식", "1", "별지 1") == "서식" and kind("", "2", "별도 2") == "별도"
    assert many(spark, ident.article_place, ["제2조의3", "제1-2조의2", "제1-10조", "x"]) == [(2, 3), (1, 20_002), (1, 100_000), (10**9, 0)]


RELATION = "struct<relation_type: string, delegation_type: string, target_law_name: string, target_category: string, target_article_no: string, target_unit: string, appendix_kind: string, appendix_no: string, appendix_branch: string, appendix_ambiguous: boolean, link_text: string, reference_id: string>"
APPENDIX = "struct<kind: string, no: string, branch: string, title: string, files: array<struct<type: string, url: string, name: string>>>"


def relation(kind, law, **more):
    keys = ("relation_type", "delegation_type", "target_law_name", "target_category", "target_article_no", "target_unit", "appendix_kind", "appendix_no", "appendix_branch", "appendix_ambiguous", "link_text", "reference_id")
    return tuple(({"relation_type": kind, "target_law_name": law} | more).get(k) for k in keys)


def test_references_meet_their_targets(spark):
    own = [relation("internal_ref", "가 법", target_article_no="제2조"), relation("citation", "나법", target_category="법령", target_article_no="제3조의2"), relation("citation", "다 조례", target_article_no="제1조"), relation("citation", "라 조례", target_category="행정규칙"),
           relation("delegation", "마 고시", delegation_type="위임행정규칙"), relation("delegation", "가법 시행령"), relation("appendix_ref", "가법", appendix_kind="별지", appendix_no="1"), relation("appendix_ref", "가법", appendix_kind="부속서", appendix_no="2"),
           relation("appendix_ref", "가법", appendix_kind="별표", appendix_no="9"), relation("appendix_ref", "나법", appendix_kind="별표", appendix_no="1"), relation("appendix_ref", "가법", appendix_ambiguous=True), relation("citation", None, reference_id="kept")]
    apx = [("서식", "1", "", "", [(None, "x?flSeq=12345", "n")]), ("별표", "2", "", "", []), ("서식", "1", "", "", [(None, "u", "n")]), ("별표", "3", "", "", None)]
    schema = f"law_name string, doc_target string, id_suffix string, articles array<struct<article_no: string, images: array<struct<type: string, url: string, name: string>>, relations: array<{RELATION}>>>, appendices array<{APPENDIX}>, attachments array<struct<name: string, url: string>>"
    df = spark.createDataFrame([("가 법", None, "x", [("제1조", [("image", "/a.gif", "")], own), ("전문", None, [])], apx, [("a/b.hwp", "u"), (None, "u"), ("c", None)]), ("사 학칙", "school", "public", [("제1조", None, [relation("internal_ref", "사 학칙", target_article_no="제1조")])], [], None), ("아 조례", "school", None, None, None, None)], schema)
    got = {r["law_name"]: r for r in ident.file_meta(ident.identify(df)).collect()}
    a = got["가 법"]
    assert (a["provision_id"], a["addendum_provision_id"], a["amendment_provision_id"]) == ("law:가법#DOC", "law:가법#ADDENDUM", "law:가법#AMENDMENT")
    assert [x["provision_id"] for x in a["articles"]] == ["law:가법#JO0001", "law:가법#DOC"]
    rel = a["articles"][0]["relations"]
    assert [r["reference_id"] for r in rel] == ["law:가법#JO0002", "law:나법#JO0003_02", "ordin:다조례#JO0001", "admrul:라조례#DOC", "admrul:마고시#DOC", "law:가법시행령#DOC", "law:가법#FORM0001", "law:가법#BYL0002", "law:가법#BYL0009", "law:나법#BYL0001", "", "kept"]
    assert {r["source_provision_id"] for r in rel} == {"law:가법#JO0001"}
    assert rel[1]["target_path"] == ("LAW", "나법/법률/나법.json") and rel[4]["target_path"] == ("ADMRUL", "마 고시/마 고시.json") and rel[2]["target_path"] is None and rel[5]["target_path"] == ("LAW", "가법/시행령/가법 시행령.json")
    assert [(x["provision_id"], x["appendix_instance_id"]) for x in a["appendices"]] == [("law:가법#FORM0001", "law:가법#FORM0001:file:12345"), ("law:가법#BYL0002", None), ("law:가법#FORM0001", "law:가법#FORM0001:idx:0003"), ("law:가법#BYL0003", None)]
    assert [x["local_path"] for x in a["appendices"]] == ["서식/서식1_flSeq12345.bin", None, "서식/서식1_flSeq0003.bin", None]
    assert [x["local_path"] for x in a["attachments"]] == ["첨부파일/a_b.hwp", "첨부파일/첨부파일.bin", None] and a["articles"][0]["images"][0]["local_path"] == "본문이미지/제1조_1.gif"
    b = got["사 학칙"]
    assert b["provision_id"] == "SchlPubRul:사학칙:public#DOC" and b["articles"][0]["relations"][0]["reference_id"] == "SchlPubRul:사학칙:public#JO0001"
    assert got["아 조례"]["provision_id"] == "ordin:아조례#DOC"


def test_names(spark):
    assert many(spark, names.family, ["가법 시행령", "가법시행규칙", "가법", None]) == ["가법", "가법", "가법", ""]
    assert many(spark, names.kind_of, ["가법 시행령", "가법시행규칙", "가법", None]) == ["시행령", "시행규칙", "법률", "법률"]
    assert one(spark, names.git_path, None, "가:법 시행령") == "가_법/시행령/가_법 시행령.json" and one(spark, names.git_path, "admrul", "고시") == "고시/고시.json" and one(spark, names.git_path, "admrul", "고시", " p ") == "p" and one(spark, names.git_path, "admrul", None) is None
    assert one(spark, names.appendix_label, "", "0001", "02", " 가  나 ") == "별표1의2_가 나" and one(spark, names.appendix_label, "서식", "000", "00", None) == "서식0"
    assert one(spark, names.file_extension, "", "a.JPEG", None) == "jpg" and one(spark, names.file_extension, "img", "", "") == "gif" and one(spark, names.file_extension, "", "", "u/x.png?y") == "png" and one(spark, names.file_extension, None, None, None) == "bin"
    assert one(spark, lambda c: names.images(c), 'x<img src="/a.gif">y<IMG id=77>z<img alt="">') == [("https://www.law.go.kr/a.gif", ""), ("https://www.law.go.kr/LSW/flDownload.do?flSeq=77", "77")]
    assert many(spark, names.law_id_of, ["law:eflaw:001", "admrul:x:1", None]) == ["001", None, None]
    assert one(spark, names.implied_source, "", "school:1") == "schlpub" and one(spark, names.implied_source, "eflaw", None) == "law" and one(spark, names.implied_source, "odd", None) == "?" and one(spark, names.implied_source, None, "001") is None
    assert one(spark, names.sequence_fallback, " 123 ", None) == "123" and one(spark, names.sequence_fallback, "", "00112220240101567") == "567" and one(spark, names.sequence_fallback, None, "x") == ""
    assert one(spark, names.original_name, "a__0123456789ab.hwp", "0123456789ABff") == "a.hwp" and one(spark, names.original_name, "a__0123456789ab.hwp", "ff") == "a__0123456789ab.hwp"
    assert one(spark, lambda n, a, b, c: names.aliases(n, a, b, c), "가 법", "가법", "약칭", "약 칭") == ["약칭"]
    assert one(spark, names.first_line_with, "하나\n  둘 셋 \n둘", "둘") == "둘 셋" and one(spark, names.first_line_with, "하나", "") is None
    assert many(spark, lambda c: names.mirror_folder(c, F.lit("APPENDIX")), ["부속서 1.hwp", "무엇.hwp"]) == ["부속서", "별표"] and one(spark, names.mirror_folder, "제3조_1.gif", None) == "본문이미지" and one(spark, names.mirror_folder, "x", None) == "첨부미러"
    assert one(spark, names.without_forbidden, " a/b:c ") == "abc" and one(spark, names.reference_url, "행정규칙", "고시", "제1조") == "https://www.law.go.kr/행정규칙/고시/제1조"


def test_names_are_worked_out_once_for_a_path(spark):
    df = spark.createDataFrame([("law", "가&amp;nbsp;법 시행령"), ("admrul", "나:고시"), ("ordin", "다 조례"), ("law", " ")], "p string, n string")
    made = df.select(names.predicted_path(F.col("p"), F.col("n"))["path"].alias("x"))
    assert [r["x"] for r in made.collect()] == ["가&nbsp;법/시행령/가&nbsp;법 시행령.json", "나_고시/나_고시.json", None, None]
    assert made._jdf.queryExecution().optimizedPlan().toString().count("&middot;") == 1
