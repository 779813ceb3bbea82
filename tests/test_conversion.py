"""Raw bodies to payloads, files to what payloads declare, and what packages bring besides documents."""

import json

from pyspark.sql import functions as F

from lexspark.operators import conversion as cv
from lexspark.operators import payloads, rules, units
from lexspark.sources import documents


def dumps(x):
    return json.dumps(x, ensure_ascii=False)


LAW = {"법령": {"기본정보": {"법령ID": "001", "법령명약칭": "약칭", "법령명_한자": "가법", "공포번호": "77", "공포일자": "20240101", "시행일자": 20240201, "법종구분": {"content": " 법률 "}},
       "조문": {"조문단위": [{"조문여부": "전문", "조문내용": "제1장 총칙"}, {"조문여부": "조문", "조문번호": "1", "조문제목": "목적", "조문내용": "제1조(목적) <img src='/i.gif'>", "항": [{"항내용": "① 항", "호": [{"호내용": "1. 호"}]}]}, {"조문여부": "조문", "조문번호": "2", "조문가지번호": "3", "조문내용": "제2조의3"}]},
       "부칙": {"부칙단위": [{"부칙공포일자": "20240101", "부칙공포번호": "2", "부칙내용": [["나중"]]}, {"부칙공포일자": "20230101", "부칙공포번호": "1", "부칙내용": "먼저"}]},
       "별표": {"별표단위": {"별표번호": "0001", "별표가지번호": "00", "별표구분": "별표", "별표제목": "부속서 1 규격", "별표서식파일링크": "/f?flSeq=55555", "별표서식PDF파일링크": "/p", "별표내용": ""}},
       "개정문": {"개정문내용": [["개정", "문"]]}}}


def test_statutes(spark):
    df = spark.createDataFrame([(1, dumps(LAW), "가 법", None, "9"), (2, dumps(LAW), "가 법", "X", None), (3, "{", "나", None, None), (4, dumps({"조문단위": []}), "다", "3", "4"), (5, dumps({"a": 1}), "라", None, None), (6, None, None, None, None)], "k int, body string, name string, id string, sequence string")
    got = {r["k"]: r for r in cv.statutes(df).collect()}
    a = got[1]
    assert (a["law_id"], a["mst"], a["version_uid"], a["law_type"], a["law_abbr"], a["name_aliases"], a["error"]) == ("001", "9", "001:9:20240201", "법률", "약칭", ["약칭"], None)
    assert [(x["article_no"], x["provision_id"], x["chapter"]) for x in a["articles"]] == [("제1조", "law:가법#JO0001", "제1장 총칙"), ("제2조의3", "law:가법#JO0002_03", "제1장 총칙")]
    assert a["articles"][0]["content"] == "제1조(목적) [그림]\n① 항\n1. 호" and a["articles"][0]["images"][0]["url"] == "https://www.law.go.kr/i.gif" and a["articles"][0]["images"][0]["filename"] == "제1조_1.gif"
    assert [x["content"] for x in a["addenda"]] == ["먼저", "나중"] and a["amendment_text"] == "개정\n문"
    assert [(x["kind"], x["provision_id"], x["is_file_only"], x["file_url"], x["filename"]) for x in a["appendices"]] == [("부속서", "law:가법#ANN0001", True, "https://www.law.go.kr/p", "부속서1_부속서 1 규격.pdf")]
    assert (got[2]["law_id"], got[2]["mst"]) == ("X", "77") and a["stats"]["articles_total"] == 2 and a["stats"]["addenda_count"] == 2
    assert {k: got[k]["error"] for k in (3, 4, 5, 6)} == {3: "json_invalid", 4: "articles_missing", 5: "sequence_missing", 6: "json_invalid"}


def test_rule_articles(spark):
    outline = " ".join(f"1-{k}-1. 항목 내용이 이어진다 그리고 더 이어진다." for k in range(80))
    long = "제1장 총칙 " + "가나다라 " * 120
    cases = [
        (("제1장 총칙", "제1조(목적) 이 규정은", "① 항", "제2조(정의) 가. 나. 제3조(범위) 다."), [("제1조", "목적", "제1장 총칙", "제1조(목적) 이 규정은\n① 항"), ("제2조", "정의", "제1장 총칙", "제2조(정의) 가. 나."), ("제3조", "범위", "제1장 총칙", "제3조(범위) 다.")]),
        # citations: a law's name before, a particle behind, or a number that goes back
        (("제5조(위임) 「건설법」 제9조(관리)와 같다. 건설기술법 제10조(사업) 및 제7조(x)에 따라 제2조(정의) 참조",), [("제5조", "위임", "", "제5조(위임) 「건설법」\n제9조(관리)와 같다. 건설기술법\n제10조(사업) 및\n제7조(x)에 따라\n제2조(정의) 참조")]),
        (("제1조(a) x", "제2조 삭제 <2020>"), [("제1조", "a", "", "제1조(a) x"), ("제2조", "삭제", "", "제2조 삭제 <2020>")]),
        (("제1장 총칙제1절 통칙제1-1조 이 규정은 그렇다",), [("제1-1조", "", "제1장 총칙제1절 통칙", "제1-1조 이 규정은 그렇다")]),
        (("머리말", "제1조(a) x"), [("전문", "", "", "머리말"), ("제1조", "a", "", "제1조(a) x")]),
        (("제3관 위험관리기준제7-5조(한도) 본문",), [("제7-5조", "한도", "제3관 위험관리기준", "제7-5조(한도) 본문")]),
        (("제1조(a) x", outline), [("전문", "", "", "제1조(a) x\n" + outline)]),
        ((), None),
        (("", "텍스트"), [("전문", "", "", "텍스트")]),
        (("제1편 가", "제1장 나", "제1절 다", "제1조(a) x", "제2장 라", "제2조(b) y"), [("제1조", "a", "제1편 가 > 제1장 나 > 제1절 다", "제1조(a) x"), ("제2조", "b", "제1편 가 > 제2장 라", "제2조(b) y")]),
        (("제1조(a) x", "제1조(a) 다시"), [("제1조", "a", "", "제1조(a) x\n제1조(a) 다시")]),
        # a chapter's name that ends like a law's is no citation; the same behind a closing bracket is
        (("제1장 소방시설기준제3조(설치) 가",), [("제3조", "설치", "제1장 소방시설기준", "제3조(설치) 가")]),
        (("제1조(a) 나", "제2장 「소방」 기준 제9조(설치) 가"), [("전문", "", "", "제9조(설치) 가"), ("제1조", "a", "", "제1조(a) 나")]),
        # a chapter closes an article: the next mark may go back, a number that was there adds to nothing
        (("제5조(a) x", "제2장 나", "꼬리 제3조(b) y", "제3장 다", "앞 제5조(c) z"), [("전문", "", "", "꼬리\n앞"), ("제5조", "a", "", "제5조(a) x"), ("제3조", "b", "제2장 나", "제3조(b) y")]),
        ((long, "제1조(a) x"), [("전문", "", "", long.strip()), ("제1조", "a", long[:63].strip(), "제1조(a) x")]),
        (("제1장 총칙 1. 이 장은 " + "가나다라 " * 120, "제1조(a) x"), [("전문", "", "", ("제1장 총칙 1. 이 장은 " + "가나다라 " * 120).strip()), ("제1조", "a", "제1장 총칙", "제1조(a) x")]),
    ]
    df = spark.createDataFrame([(k, list(items)) for k, (items, _) in enumerate(cases)], "k int, items array<string>")
    got = {r["k"]: [(a["article_no"], a["article_title"], a["chapter_path"], a["content"]) for a in r["articles"]] for r in rules.rule_articles(df, "k").collect()}
    for k, (_, want) in enumerate(cases):
        assert got.get(k) == want, k


RULE = {"AdmRulService": {"행정규칙기본정보": {"행정규칙ID": "7", "행정규칙일련번호": "70", "행정규칙명": "가 고시", "행정규칙종류": "고시", "발령일자": "20240101", "발령번호": "3", "시행일자": "20240105"}, "조문내용": ["제1조(목적) 이 고시는", ["② 더", "이어"]],
                          "부칙": {"부칙공포일자": ["20240101", "20230101"], "부칙내용": [["뒤"], "앞"], "부칙공포번호": "1"}, "첨부파일": {"첨부파일링크": ["u1", "u2"], "첨부파일명": "a.hwp"}}}


def test_administrative_rules(spark):
    df = spark.createDataFrame([(1, dumps(RULE), "x", "admrul", None, None), (2, dumps(RULE), "x", "school", "8", None), (3, dumps(RULE), "x", "pi", "7", "71"), (4, dumps({"Law": "일치하는 행정규칙이 없습니다."}), "n", "admrul", "1", "2"), (5, dumps({"a": []}), "n", "admrul", "1", "2"), (6, "x", "n", "admrul", "1", "2")], "k int, body string, name string, target string, id string, sequence string")
    got = {r["k"]: r for r in cv.administrative_rules(df).collect()}
    a = got[1]
    assert (a["law_id"], a["mst"], a["adm_uid"], a["law_name"], a["law_type"], a["doc_kind"], a["error"], a["provision_id"]) == ("7", "70", "admrul:7", "가 고시", "고시", "행정규칙", None, "admrul:가고시#DOC")
    assert [(x["article_no"], x["content"]) for x in a["articles"]] == [("제1조", "제1조(목적) 이 고시는\n② 더 이어")]
    assert [(x["promulgation_date"], x["promulgation_no"], x["content"]) for x in a["addenda"]] == [("20230101", "", "앞"), ("20240101", "1", "뒤")]
    assert [(x["name"], x["url"], x["local_path"]) for x in a["attachments"]] == [("a.hwp", "u1", "첨부파일/a.hwp"), ("", "u2", "첨부파일/첨부파일.bin")]
    assert {k: got[k]["error"] for k in range(2, 7)} == {2: "id_mismatch", 3: "sequence_mismatch", 4: "rule_missing", 5: "nothing_found", 6: "json_invalid"}


def test_delivered_files_meet_declarations(spark):
    declared = spark.createDataFrame([("d", n) for n in ("별표1_과태료.pdf", "별지2의3_신청서.hwp", "별표0_삭제 가_flSeq1.hwp", "별표0_삭제 나_flSeq2.hwp", "서식100_통지.hwp", "별표5_삭제.hwp", "별표6_삭제.hwp", "무라벨.hwp")] + [("e", "별표1_과태료.hwp")], "doc string, filename string")
    attachments = spark.createDataFrame([("d", "원문, 고시.hwp"), ("d", "그대로.hwp"), ("d", None)], "doc string, name string")
    want = {"그대로.hwp": ("keep", None), "원문¸ 고시.hwp": ("rename", "원문, 고시.hwp"), "[별표 1] 과태료(가법).hwp": ("drop", None), "[별표 1] 과태료(가법).pdf": ("rename", "별표1_과태료.pdf"), "[별지 2의3] 신청서.hwpx": ("rename", "별지2의3_신청서.hwpx"),
            "[별표] 삭제 가(가법).hwp": ("rename", "별표0_삭제 가_flSeq1.hwp"), "[별표] 없는 제목.hwp": ("keep", None), "[별지 제100호서식] 통지(가법).hwp": ("rename", "서식100_통지.hwp"), "[붙임 6] 삭제(가법).pdf": ("rename", "별표6_삭제.pdf"), "[붙임] 삭제.pdf": ("keep", None), "모름.hwp": ("keep", None), "[별표 5] 삭제.gif": ("drop", None)}
    files = spark.createDataFrame([("d", f"x/{n}") for n in want] + [("e", "y/[별표 1] 과태료.pdf")], "doc string, path string")
    got = {(r["doc"], r["path"].rpartition("/")[2]): (r["action"], r["target"]) for r in cv.plan_files(files, declared, attachments).collect()}
    assert got == {("d", n): w for n, w in want.items()} | {("e", "[별표 1] 과태료.pdf"): ("rename", "별표1_과태료.pdf")}


def test_manifests(spark):
    m = [("z1", dumps({"docs": [{"id": "1", "mst": "2", "dir": "law/a"}], "changes": [{"attachment_files": [{"path": "law\\\\a\\\\f__0123456789ab.hwp".replace("\\\\", "\\"), "url": "u", "sha256": "0123456789abcd"}]}]})),
         ("z2", dumps({"documents": [{"path": "law/b/b.json", "lawId": "7", "files": [{"path": "law/b/별표/별표1.hwp", "originalName": "[별표 1] 가/나.hwp"}, {"path": "law/b/c.hwp", "originalName": "c.hwp"}]}]})), ("z3", "{}")]
    df = spark.createDataFrame(m, "zip string, text string").select("zip", F.parse_json("text").alias("manifest"))
    docs, renamed = cv.manifest_documents(df)
    assert sorted(map(tuple, docs.collect())) == [("z1", "law/a", "1", "2", None), ("z2", "law/b", "7", None, "law/b/b.json")]
    assert [tuple(r) for r in renamed.collect()] == [("z2", "law/b/별표/별표1.hwp", "law/b/별표/[별표 1] 가_나.hwp")]
    bodies = spark.createDataFrame([("z1", "law/a"), ("z1", "law/q")], "zip string, folder string")
    assert {r["folder"]: (r["id"], r["error"]) for r in cv.with_manifest(bodies, docs).collect()} == {"law/a": ("1", None), "law/q": (None, "manifest_document_missing")}
    members = spark.createDataFrame([("z1", "law/a/f__0123456789ab.hwp", "s"), ("z1", "law/a/g.hwp", "s")], "zip string, path string, sha256 string")
    assert {r["path"]: (r["name"], r["url"]) for r in cv.listed_attachments(members, df).collect()} == {"law/a/f__0123456789ab.hwp": ("f.hwp", "u"), "law/a/g.hwp": ("g.hwp", None)}
    articles = spark.createDataFrame([("d", "제1조"), ("d", "제2조")], "doc string, article_no string")
    files = spark.createDataFrame([("d", "i/제1조_10.png"), ("d", "i/제1조_2.GIF"), ("d", "i/제1조_x.gif"), ("e", "i/제1조_1.gif")], "doc string, path string")
    assert {r["article_no"]: r["images"] for r in cv.article_images(articles, files).collect()} == {"제1조": ["i/제1조_2.GIF", "i/제1조_10.png"], "제2조": []}


def test_units_of_files(spark):
    law = {"law_id": "1", "body": {"articles": [{"article_no": "제1조", "content": "[그림]", "images": [{"url": "u.png"}, {"url": "v", "filename": "own.gif"}]}, {"article_no": "제2조", "content": "글", "images": [{"url": "w"}]}]},
           "appendices": [{"kind": "별표", "no": "0001", "title": "가", "is_file_only": True, "files": [{"type": "hwp", "url": "h"}, {"type": "pdf", "url": "p"}], "file_url": "p"}, {"kind": "별표", "no": "2", "content": "x", "files": [{"type": "pdf", "url": "q"}]}], "attachments": [{"name": "a.hwp", "url": "ua"}]}
    only = {"law_id": "2", "body": {"articles": [{"content": "첨부파일 참조"}]}, "attachments": [{"name": "a.hwp", "url": "ua"}, {"filename": "A.hwpx", "url": "ub"}, {"name": "b:c.txt", "url": "uc"}]}
    docs = documents.parse_documents(spark.createDataFrame([("p1", dumps(law)), ("p2", dumps(only))], "path string, value string"))
    got = [(r["path"], r["unit_type"], r["file_name"], sorted(r["names"]), sorted(r["urls"]), r["image_seq"]) for r in cv.file_units(docs).collect()]
    assert sorted(got, key=str) == sorted([("p1", "APPENDIX", None, ["별표1_가.hwp"], ["h", "p"], None), ("p1", "ARTICLE_IMAGE", None, ["제1조_1.png"], ["u.png"], 1), ("p1", "ARTICLE_IMAGE", "own.gif", ["own.gif"], ["v"], 2),
                                           ("p2", "DOCUMENT_FILE", "A.hwpx", ["A.hwpx"], ["ub"], None), ("p2", "DOCUMENT_FILE", "b:c.txt", ["b:c.txt", "b_c.txt"], ["uc"], None)], key=str)
    assert sorted(docs.where("path = 'p1'").select(cv.declared_names(F.col("doc")).alias("n")).first()["n"]) == sorted(["별표1_가.hwp", "별표2.pdf", "a.hwp", "제1조_1.png", "own.gif", "제2조_1.gif"])
    shipped = spark.createDataFrame([("d", 1, ["n"], ["u1"], "n.hwp", "APPENDIX"), ("d", 2, ["m"], [], None, "APPENDIX"), ("d", 3, ["q"], [], "q.doc", "APPENDIX"), ("d", 4, ["r"], ["x"], None, "APPENDIX"), ("d", 5, ["s"], [], None, "ARTICLE_IMAGE")], "doc string, unit int, names array<string>, urls array<string>, file_name string, unit_type string")
    entries = spark.createDataFrame([("d", "n", "a/n", "u0"), ("d", "n", "b/n", "u1"), ("d", "q", "a/q.doc", None), ("d", "r", "a/r", "u"), ("d", "r", "b/r", "v"), ("d", "s", "a/s.bmp", None), ("e", "m", "a/m", None)], "doc string, name string, path string, url string")
    assert {r["unit"]: (r["state"], r["path"]) for r in cv.resolve_units(shipped, entries).collect()} == {1: ("found", "b/n"), 2: ("pending", None), 3: ("unsupported", "a/q.doc"), 4: ("ambiguous", None), 5: ("found", "a/s.bmp")}


def test_relations_on_first_chunks(spark):
    rel = [{"reference_id": "law:나#JO1", "link_text": "나", "relation_type": ""}, {"reference_id": "law:나#JO1", "link_text": "다시"}, {"reference_id": ""}, {"reference_id": "law:다#DOC", "target_candidates": 2, "target_candidate_paths": [{"p": 1}]}]
    law = {"law_id": "1", "version_uid": "1:2:20240101", "law_name": "가", "promulgation_no": "5", "repealed": False, "repealed_at": "2024.01.02", "future_enforcement_dates": ["20250101"], "ordinance_delegations": [{"source_article_no": "제1조", "link_text": "조례", "ordinance_count": 3}, {"source_article_no": "제1조", "ordinances": ["a", "b"]}, {"source_article_no": " "}],
           "body": {"articles": [{"article_no": "제1조", "provision_id": "p", "content": ("가" * 100 + "\n") * 60, "relations": rel, "scheduled": [{"enforcement_date": "20250101", "change": "개정", "content": " "}], "images": [{"url": "u"}]}, {"article_no": "제2조", "provision_id": "q", "content": "x"}]}}
    docs = documents.parse_documents(spark.createDataFrame([("p", dumps(law))], "path string, value string"))
    rows = units.with_header(units.chunks(units.units(docs))).orderBy("unit_ord", "chunk_index").collect()
    assert len(rows) > 3 and [bool(r["is_header"]) for r in rows] == [True] + [False] * (len(rows) - 1)
    a = rows[0]
    assert [(x["reference_id"], x["link_text"], x["relation_type"], x["target_candidates"]) for x in a["relation_refs"]] == [("law:나#JO1", "나", None, None), ("law:다#DOC", None, None, "2")]
    assert [tuple(x) for x in a["scheduled"]] == [("2025-01-01T00:00:00Z", "개정", None)] and [tuple(x) for x in a["ordinance_delegations"]] == [("조례", 3), (None, 2)] and json.loads(a["image_urls"])[0]["url"] == "u"
    assert (a["promulgation_no"], a["repealed"], a["repealed_at"], a["future_enforcement_dates"]) == ("5", False, "2024-01-02T00:00:00Z", ["20250101"])
    assert all(r["relation_refs"] is None and r["scheduled"] is None and r["promulgation_no"] is None for r in rows[1:])
    s = units.stored(units.with_header(units.chunks(units.units(docs)))).where("chunk_index = 0 and unit_no = '제1조'").first()
    meta = json.loads(s["meta"])
    assert meta["promulgation_no"] == "5" and len(meta["relation_refs"]) == 2 and "vector" not in meta and "content" not in meta and s["content"].startswith("가")


def test_what_packages_bring(spark):
    doc = {"record_type": "document", "law_id": "A", "git_path": "g", "payload": {"law_id": "A", "adm_uid": "admrul:A", "revision_date": "20240101", "law_name": "가", "enforcement_date": "20240101", "source": {"source_url": "u"}}}
    normal = [{"content": "하나", "metadata": {"provision_id": "p", "unit_no": "1"}}, {"content": None, "chunk_index": 7, "metadata": {"unit_no": "2", "unit_type": "FILE"}}]
    parsed = [{"file_id": "f", "content": "첫", "chunk_index": 0, "metadata": {"file_name": "n", "provision_id": "p"}}, {"content": "딴", "metadata": {}}, {"file_id": "f", "content": "둘", "chunk_index": 3, "metadata": {"file_name": "other"}}]
    folded = spark.createDataFrame([("A", dumps(doc), [dumps(x) for x in normal], [dumps(x) for x in parsed]), ("B", None, [], [])], "law_id string, document string, normalized array<string>, preprocessed array<string>")
    laws = payloads.law_meta(folded, "admrul")
    got = {r["law_id"]: (r["version_uid"], r["law_name"], r["domain"], r["git_path"], r["source_url"]) for r in laws.collect()}
    assert got == {"A": ("admrul:A:20240101", "가", "admrul", "g", "u"), "B": (None, None, "admrul", "package:B", None)}
    rows = {r["chunk_index"]: r for r in payloads.normalized_chunks(laws).collect()}
    assert set(rows) == {0, 7} and rows[0]["search_text"] == "가\n1\n하나" and rows[7]["unit_type"] == "FILE" and rows[0]["chunk_count"] == 2 and rows[0]["law_id"] == "A" and rows[0]["enforcement_date"] == "2024-01-01T00:00:00Z"
    files = payloads.parsed_files(laws)
    assert {r["file_id"]: (r["file_name"], r["unit_title"], [c["content"] for c in r["chunks"]]) for r in files.collect()} == {"f": ("n", "n", ["첫", "둘"]), "ATTACHMENT": (None, None, ["딴"])}
    assert {(r["file_id"], r["chunk_index"], r["unit_type"]) for r in units.file_chunks(files, drop_fillers=False).collect()} == {("f", 0, "APPENDIX"), ("f", 3, "APPENDIX"), ("ATTACHMENT", 0, "FILE")}


def test_ready_made_attachments(spark, tmp_path):
    (tmp_path / "a.json").write_text(dumps({"law_id": "1", "version_uid": "v", "file_name": "f", "chunks": [{"content": "가", "page_no": 2}, None, {"content": "| |", "chunk_index": 9}]}))
    (tmp_path / "b.json").write_text("{")
    (tmp_path / "c.json").write_text("{}")
    got = payloads.read_attachments(spark, str(tmp_path))
    assert {r["path"].rpartition("/")[2]: r["error"] for r in got.collect()} == {"a.json": None, "b.json": "json_invalid", "c.json": "chunks_missing"}
    rows = units.file_chunks(got.where("error is null"), drop_fillers=False).collect()
    assert [(r["chunk_index"], r["content"], r["page_no"], r["unit_title"]) for r in sorted(rows, key=lambda r: r["chunk_index"])] == [(0, "가", 2, "f"), (9, "| |", None, "f")]


def test_change_sets(spark):
    lines = [{"op": "upsert", "law_id": "1", "payload": {"doc_target": "school"}}, {"op": "upsert", "doc_id": "2", "git_path": "a/b.json"}, {"op": "upsert", "law_id": "3", "git_path": "none"}, {"op": "upsert", "law_id": "4"}, {"op": "delete"}, {"op": "delete", "law_id": "6", "source": "admrul", "git_path": "a/b.json"}]
    df = spark.createDataFrame([(k, dumps(x)) for k, x in enumerate(lines)] + [(6, "{"), (7, "  ")], "line_no int, body string")
    docs = spark.createDataFrame([("a/b.json", '{"doc_target": "eflaw"}')], "git_path string, value string")
    got = {r["line_no"]: (r["op"], r["law_id"], r["domain"], r["payload"], r["error"]) for r in payloads.changes(df, docs).collect()}
    assert got == {0: ("upsert", "1", "schlpub", '{"doc_target":"school"}', None), 1: ("upsert", "2", "law", '{"doc_target": "eflaw"}', None), 2: ("upsert", "3", "law", None, "path_missing"), 3: ("upsert", "4", "law", None, "payload_missing"), 4: ("delete", None, "law", None, "law_id_missing"), 5: ("delete", "6", "admrul", None, None), 6: ("upsert", None, "law", None, "json_invalid")}


def test_delivered_documents(spark):
    body = {"body": {"articles": []}}
    given = [("law/a.json", "{"), ("law/a.json", "[]"), ("law/a.json", dumps({"a": 1})), ("law/a.json", dumps({"law_id": 12} | body)), ("a.json", dumps({"law_id": "1"} | body)), ("law/a.json", dumps({"law_id": "1", "doc_target": "odd", "version_uid": "v"} | body)), ("law/a.json", dumps({"law_id": "1", "doc_target": "admrul", "version_uid": "v"} | body)),
             ("law/a.json", dumps({"law_id": "1", "version_uid": "v", "body": []})), ("law/a.json", dumps({"law_id": "1"} | body)), ("admrul/a.json", dumps({"law_id": "school:1", "adm_uid": "u", "revision_date": "20240101"} | body)), ("law/a.json", dumps({"repealed": True, "doc_uid": "law:eflaw:009"})), ("admrul/a.json", dumps({"repealed": True, "doc_uid": "law:eflaw:009"})), ("law/a.json", "\ufeff" + dumps({"version_uid": "v", "law_id": " 001 "} | body)), ("law/b.json", json.dumps({"law_id": " 001 ", "version_uid": "v"} | body, indent=3))]
    df = spark.createDataFrame([(k, *g) for k, g in enumerate(given)], "k int, path string, value string")
    got = {r["k"]: r for r in documents.validate(df).collect()}
    assert [got[k]["error"] for k in range(len(given))] == ["json_invalid", "json_not_object", "law_id_missing", "law_id_not_string", "source_unknown", "doc_target_unknown", "source_mismatch", "mapping_failed", "mapping_failed", None, None, "source_mismatch", None, None]
    assert (got[9]["version_uid"], got[10]["law_id"], got[10]["warning"], got[12]["law_id"]) == ("u:20240101", "009", "law_id_from_doc_uid", "001") and got[12]["hash"] == got[13]["hash"]
