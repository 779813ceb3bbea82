"""Units, packages, store, intake, references, sources and the stream over hand-made payloads."""

import collections
import hashlib
import io
import json
import warnings
import zipfile

import pytest
from pyspark.sql import functions as F

from lexspark.operators import intake, references, scope, units
from lexspark.operators import packages as pk
from lexspark.operators import store as st
from lexspark.sources import documents, packages, zips
from lexspark.streaming import consumer


def law(law_id="L1", version="L1:10:20240101", **more):
    return {"law_id": law_id, "mst": "10", "version_uid": version, "law_name": "시험 법", "law_type": "법률", "promulgation_date": "2024.01.01", "enforcement_date": "20240201", "is_current": True,
            "basic_info": {"소관부처": {"content": " 법무부 ", "소관부처코드": "1"}}, "source": {"source_url": "http://x"},
            "body": {"articles": [{"provision_id": "law:시험법#JO0001", "article_no": "제1조", "article_title": "목적", "chapter": "제1장", "chapter_path": "제1편 제1장", "content": "첫째   본문",
                                   "relations": [{"reference_id": "a"}, {"reference_id": "b"}, {"reference_id": "a"}, {"reference_id": None}]}, None, {"provision_id": "law:시험법#JO0002", "article_no": "제2조", "content": "가" * 6000}]},
            "addenda": [{"content": " "}, {"content": "부칙 본문", "promulgation_no": "7", "is_future": True}],
            "appendices": [{"no": "0001", "branch": "00", "title": "표", "content": "h1\nh2\n" + "row\n" * 900}, {"no": "0002", "is_file_only": True, "content": ""}, {"no": "0003", "content": "[별표 3] 삭제 <2020>"}, {"no": "0004", "branch": "02", "kind": "별지", "content": "x"}],
            "amendment_text": "바꿈", "revision_reason": None} | more


@pytest.fixture
def docs(spark):
    raw = [json.dumps(law(), ensure_ascii=False), json.dumps(law("A1", None, adm_uid="admrul:5", revision_date="20230101", doc_target="school", basic_info={"소관부처": "", "소관부처명": " ", "상위부처명": "대법원"})), "{bad", "[1]", json.dumps({"law_id": " "}), json.dumps({"law_id": "x", "body": 3})]
    return documents.parse_documents(spark.createDataFrame([(f"p{k}", r) for k, r in enumerate(raw)], "path string, value string"))


def test_document_errors(docs):
    assert {r["path"]: r["error"] for r in docs.collect()} == {"p0": None, "p1": None, "p2": "json_invalid", "p3": "json_not_object", "p4": "law_id_missing", "p5": "body_missing"}


def test_units_and_chunks(docs):
    rows = units.with_header(units.chunks(units.units(docs.where("path = 'p0'")))).orderBy("unit_ord", "chunk_index").collect()
    kinds = [r["unit_type"] for r in rows]
    assert kinds == ["ARTICLE"] * 2 + ["ADDENDUM"] + ["APPENDIX"] * (len(rows) - 4) + ["AMENDMENT"] and kinds.count("APPENDIX") == 3
    first = rows[0]
    assert first["content"] == "첫째 본문" and first["reference_ids"] == ["a", "b"] and first["ministry"] == "법무부" and first["is_header"] and not rows[1]["is_header"]
    assert first["search_text"].split("\n") == ["시험 법", "법률", "제1편 제1장", "제1조", "목적", "첫째 본문"]
    assert first["enforcement_date"] == "2024-02-01T00:00:00Z" and first["domain"] == "law"
    assert rows[2]["content"] == "[부칙 2 / 시행예정 제7호]\n부칙 본문" and rows[2]["provision_id"] == "law:시험법#ADDENDUM"
    table = [r for r in rows if r["unit_type"] == "APPENDIX" and r["unit_no"] == "0001"]
    assert len(table) == 2 and all(r["content"].startswith("h1\nh2\n") for r in table) and {r["chunk_count"] for r in table} == {2}
    assert [r["unit_no"] for r in rows if r["unit_type"] == "APPENDIX"][-1] == "0004-02"
    assert rows[-1]["content"] == "[개정문]\n바꿈" and len({r["chunk_id"] for r in rows}) == len(rows) and len({r["uuid"] for r in rows}) == len(rows)


def test_admin_rules_get_a_version_and_a_fallback_ministry(docs):
    r = units.units(docs.where("path = 'p1'"), "admrul").first()
    assert r["version_uid"] == "admrul:5:20230101" and r["ministry"] == "대법원" and r["domain"] == "schlpub"
    assert units.units(docs.where("path = 'p1'"), "law").count() == 0


def test_file_chunks_drop_fillers_but_keep_places(spark):
    df = spark.createDataFrame([("v", "L", None, None, "f.hwp", None, "ATTACHMENT", [(None, "| --- |", 1), (None, "글", 2)])], "version_uid string, law_id string, provision_id string, file_id string, file_name string, file_url string, unit_type string, chunks array<struct<chunk_index: int, content: string, page_no: int>>")
    (r,) = units.file_chunks(df).collect()
    assert (r["chunk_index"], r["chunk_count"], r["content"], r["page_no"], r["unit_type"]) == (1, 1, "글", 2, "FILE")
    assert (r["search_text"], r["file_kind"], r["start_page"], r["unit_title"]) == ("f.hwp\n글", "attachment", 2, "f.hwp") and len(r["content_hash"]) == 64 and len(r["uuid"]) == 36


def test_file_chunks_of_a_package_are_stored_and_found(spark, tmp_path):
    from lexspark.operators import search

    def to_file_rows(folded):
        d = F.from_json("document", "law_id string, version_uid string, law_name string, law_type string")
        laws = folded.select("law_id", F.col("preprocessed"), d.alias("d")).select(F.lit("law").alias("domain"), "law_id", "d.version_uid", "d.law_name", "d.law_type", F.explode("preprocessed").alias("r"))
        r = F.from_json("r", "file_id string, chunk_index int, content string, metadata struct<provision_id string, unit_type string, file_name string, page_no int>")
        flat = laws.select("domain", "law_id", "version_uid", "law_name", "law_type", r.alias("r")).select("*", "r.file_id", "r.metadata.provision_id", "r.metadata.unit_type", "r.metadata.file_name")
        files = flat.groupBy("domain", "law_id", "version_uid", "law_name", "law_type", "file_id", "provision_id", "unit_type", "file_name").agg(F.array_sort(F.collect_list(F.struct("r.chunk_index", "r.content", F.col("r.metadata.page_no").alias("page_no")))).alias("chunks"))
        return units.file_chunks(files.withColumn("file_url", F.lit(None).cast("string"))).withColumn("mst", F.lit("1"))

    inbox, root = tmp_path / "in", f"{tmp_path}/t"
    inbox.mkdir()
    chunk = lambda k, content: {"record_type": "preprocessed_chunk", "law_id": "A", "file_id": "f1", "chunk_index": k, "content": content, "metadata": {"provision_id": "law:가#BYL0001", "file_name": "별표1.hwp", "page_no": k + 1}}
    body = {"record_type": "document", "payload": {"law_id": "A", "version_uid": "A:20240101", "law_name": "가 법", "law_type": "법률"}}
    write_package(inbox / "1.jsonl", body, chunk(0, "| --- |"), chunk(1, "과태료 기준"), chunk(2, "둘째 쪽"))
    consumer.consume(spark, str(inbox), root, f"{tmp_path}/ck", to_file_rows)
    rows = {r["chunk_index"]: r for r in st.current(spark, root).collect()}
    assert {k: (r["search_text"], r["unit_type"], r["start_page"], r["chunk_count"]) for k, r in rows.items()} == {1: ("가 법\n법률\n별표1.hwp\n과태료 기준", "APPENDIX", 2, 2), 2: ("가 법\n법률\n별표1.hwp\n둘째 쪽", "APPENDIX", 3, 2)}
    found = search.keyword_scores(st.current(spark, root).select(F.col("uuid").alias("doc_id"), F.translate("search_text", "\n", " ").alias("text")), ["과태료"]).collect()
    assert [r["doc_id"] for r in found] == [rows[1]["uuid"]]
    write_package(inbox / "2.jsonl", body, chunk(1, "바뀐 기준"))  # the file has a chunk fewer: the orphan goes
    consumer.consume(spark, str(inbox), root, f"{tmp_path}/ck", to_file_rows)
    assert [(r["chunk_index"], r["content"]) for r in st.current(spark, root).collect()] == [(1, "바뀐 기준")]


def records(*rows):
    return [json.dumps(r, ensure_ascii=False) for r in rows]


def write_package(path, *rows, count=None, footer=True):
    lines = records({"record_type": "package_header", "package_id": path.stem, "source": "law"}, *rows)
    if footer:
        lines += records({"record_type": "package_footer", "package_id": path.stem, "record_count": len(rows) if count is None else count})
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def doc(law_id, version, text="본문"):
    return {"record_type": "document", "op": "upsert", "law_id": law_id, "payload": {"law_id": law_id, "version_uid": version, "content": text}}


def test_packages(spark, tmp_path):
    write_package(tmp_path / "a.jsonl", doc("L1", "1"), {"record_type": "delete", "law_id": "L1"}, doc("L1", "2"), {"record_type": "delete", "law_id": "L2"}, {"record_type": "pending_attachment", "law_id": "L3", "reason": "later"})
    write_package(tmp_path / "b.jsonl", doc("L9", "1"), footer=False)
    write_package(tmp_path / "c.jsonl", doc("L9", "1"), count=5)
    (tmp_path / "d.jsonl").write_text('{"record_type": "file", "law_id": "x", "content_b64": "YQ==", "sha256": "00"}\n\n{broken\n{"law_id": 1}\n')
    r = packages.read_packages(spark, str(tmp_path))
    assert {x["package"]: x["is_package"] for x in packages.headers(r).collect()} == {"a.jsonl": True, "b.jsonl": True, "c.jsonl": True, "d.jsonl": False}
    content = r.where("record_type is null or record_type not like 'package%'")
    assert {x["package"]: x["verdict"] for x in pk.reconcile(content, ["package"], packages.footers(r)).collect()} == {"a.jsonl": "ok", "b.jsonl": "retry", "c.jsonl": "quarantine", "d.jsonl": "retry"}
    assert [x["error"] for x in r.where("package = 'd.jsonl'").orderBy("line_no").collect()] == ["sha_mismatch", "json_invalid", "record_type_missing"]
    folded = {x["law_id"]: x for x in pk.fold_laws(content.where("package = 'a.jsonl'")).collect()}
    assert {k: v["action"] for k, v in folded.items()} == {"L1": "upsert", "L2": "delete", "L3": "keep"} and json.loads(folded["L1"]["document"])["version_uid"] == "2"
    assert {x["package"]: x["law_ids"] for x in packages.law_ids(r).collect()}["a.jsonl"] == ["L1", "L2", "L3"]


def test_packages_written_read_back(spark, tmp_path):
    given = spark.createDataFrame([("p1", "law", k, json.dumps(doc(f"L{k}", "1"))) for k in range(5)] + [("p2", "law", 0, json.dumps(doc("M", "1")))], "package string, source string, ord int, record string")
    packages.write_packages(given, f"{tmp_path}/out")
    lines = spark.read.text(f"{tmp_path}/out/package=p1").collect()
    kinds = [json.loads(x["value"])["record_type"] for x in lines]
    assert kinds == ["package_header", *["document"] * 5, "package_footer"] and json.loads(lines[-1]["value"])["record_count"] == 5


def to_rows(folded):
    body = F.from_json("document", "law_id string, version_uid string, content string")
    rows = folded.select(body.alias("d")).select(F.lit("law").alias("domain"), "d.law_id", "d.version_uid", F.lit("1").alias("mst"), F.lit("JSON").alias("source_type"), F.posexplode(F.split("d.content", "/")).alias("n", "content"))
    return rows.withColumn("chunk_id", F.concat_ws("-", "law_id", "version_uid", "n")).withColumn("uuid", F.col("chunk_id"))


def test_stream_guards_cleans_and_replays(spark, tmp_path):
    inbox, root = tmp_path / "in", f"{tmp_path}/store"
    inbox.mkdir()

    def state():
        return {r["uuid"]: r["content"] for r in st.current(spark, root).collect()}

    def run(name, *rows, **more):
        write_package(inbox / f"{name}.jsonl", *rows, **more)
        consumer.consume(spark, str(inbox), root, f"{tmp_path}/ck", to_rows)

    run("1", doc("A", "A:20240101", "a/b/c"), doc("B", "B:20240101", "x"))
    assert state() == {"A-A:20240101-0": "a", "A-A:20240101-1": "b", "A-A:20240101-2": "c", "B-B:20240101-0": "x"}
    run("2", doc("A", "A:20240101", "a/z"))
    assert state() == {"A-A:20240101-0": "a", "A-A:20240101-1": "z", "B-B:20240101-0": "x"}  # orphan gone
    run("3", doc("A", "A:20230101", "old"))
    assert "A-A:20230101-0" not in state()  # an older version is refused
    run("4", doc("A", "A:20250101", "new"), {"record_type": "delete", "law_id": "B"})
    assert state() == {"A-A:20250101-0": "new"}  # stale version and deleted law gone
    before = state()
    run("5", doc("C", "C:20250101", "q"), count=9)
    log = lambda: {(r["package"], r["attempt"]): (r["state"], r["permanent"]) for r in spark.read.parquet(f"{root}/state/*").collect()}
    assert state() == before and log()["5.jsonl", 1] == ("quarantined", True)
    nacks = lambda: {r["package"]: (r["kind"], r["law_ids"], r["source"]) for r in spark.read.parquet(f"{root}/nack").collect()}
    assert nacks() == {"5.jsonl": ("permanent", ["C"], "law")}
    run("6", doc("D", "D:20250101", "q"), footer=False)  # no footer yet: tried again
    assert log()["6.jsonl", 1] == ("retry", False) and state() == before
    run("7", {"record_type": "delete", "law_id": "zz"})
    assert log()["6.jsonl", 2] == ("retry", False)
    write_package(inbox / "6.jsonl", doc("D", "D:20250101", "q"))
    consumer.consume(spark, str(inbox), root, f"{tmp_path}/ck", to_rows)
    assert log()["6.jsonl", 3] == ("done", False) and state() == before | {"D-D:20250101-0": "q"}
    run("8", doc("E", "E:1", "q"), footer=False)
    for _ in range(4):
        consumer.consume(spark, str(inbox), root, f"{tmp_path}/ck", to_rows)
    assert log()["8.jsonl", 5] == ("quarantined", False) and nacks()["8.jsonl"] == ("transient_exhausted", ["E"], "law")
    assert ("8.jsonl", 6) not in log()
    run("9", {"record_type": "document", "op": "delete", "law_id": "", "doc_id": "D"}, {"record_type": "document", "payload": {"law_id": "F", "version_uid": "F:20250101", "content": "f"}})
    assert state() == before | {"F-F:20250101-0": "f"}  # a repeal sent as a document; a law named by its payload alone
    run("10", doc("D", "D:20250101", "q"), {"record_type": "delete", "law_id": "F"})  # late: before 9 by name
    assert log()["10.jsonl", 1] == ("done", False) and state() == before | {"D-D:20250101-0": "q"}
    run("91", {"record_type": "memo", "law_id": "G"})
    assert log()["91.jsonl", 1] == ("retry", False)
    assert len(st.remove_old(spark, root)) > 2 and state() == before | {"D-D:20250101-0": "q"}
    assert st.current(spark, f"{tmp_path}/nothing") is None


def test_a_rename_rewrites_the_buckets_that_it_names(spark, tmp_path):
    from lexspark.operators import references

    (tmp_path / "in").mkdir()
    root = f"{tmp_path}/t"
    schema = "domain string, law_id string, version_uid string, mst string, source_type string, chunk_id string, uuid string, content string, provision_id string, reference_ids array<string>, meta string"

    def row(n, head, refs=(), meta=None):
        return ("law", f"L{n}", "1", "1", "JSON", f"c{n}", f"u{n}", "x", f"law:{head}#1", list(refs), meta)

    rows = [row(n, f"법{n}") for n in range(40)] + [row(50, "가법"), row(51, "나법"), row(52, "나법"), row(60, "다법", ["law:가법#3"]), row(61, "라법", [], '{"r":[{"reference_id":"law:가법#4"}]}'), row(62, "마법", ["law:나법#1", "law:가법B#1"])]
    table = spark.createDataFrame(rows, schema)
    st.commit(table, root)
    before = st._manifest(spark, root, 1)
    renames = [{"record_type": "rename", "law_id": "L50", "old_name": "가법", "new_name": "새법"}, {"record_type": "rename", "law_id": "L51", "old_name": "나법", "new_name": "하법"}]
    write_package(tmp_path / "in" / "1.jsonl", *renames)
    consumer.consume(spark, f"{tmp_path}/in", root, f"{tmp_path}/ck", lambda folded: table.limit(0))
    after = st._manifest(spark, root, st.generation(spark, root))
    number = {r["law_id"]: r["b"] for r in table.select("law_id", st.bucket().alias("b")).collect()}
    named = {number[f"L{n}"] for n in (50, 51, 60, 61, 62)}
    assert {b for b in before if before[b] != after.get(b)} == named and len(before) > len(named) + 5
    # a bucket that isn't read (L52's) has a row that still bears the old name: references to it stay
    assert number["L52"] not in named
    given = spark.createDataFrame([("law", f"L{n}", None, a, b) for n, a, b in ((50, "가법", "새법"), (51, "나법", "하법"))], "domain string, law_id string, doc_target string, old_name string, new_name string")
    show = lambda df: {r["uuid"]: (r["reference_ids"], r["meta"]) for r in df.collect()}
    got = show(st.current(spark, root))
    assert got == show(references.apply_renames(table, references.rename_heads(given)))
    assert got["u60"] == (["law:새법#3"], None) and got["u61"] == ([], '{"r":[{"reference_id":"law:새법#4"}]}') and got["u62"] == (["law:나법#1", "law:가법B#1"], None) and "u50" not in got


def test_nearest_of_vectors_of_several_lengths(spark):
    from lexspark.operators import search

    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [1.0, 0.0, 0.0]), (4, [0.9, 0.1, 0.0]), (5, None), (6, []), (7, [0.0, 0.0])], "vec_id long, embedding array<double>")
    got = {(r["q"], r["id"]) for r in search.nearest_to_each(rows, rows, 5).collect()}
    assert got == {(a, b) for g in ((1, 2), (3, 4)) for a in g for b in g}


def test_scope_keeps_content_out_but_not_deletes(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def run(name, *rows):
        write_package(tmp_path / "in" / f"{name}.jsonl", *rows)
        consumer.consume(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/ck", to_rows, outside=consumer.out_of_scope(["시험 법"], ["법무부"]))
        return sorted(r["uuid"] for r in st.current(spark, f"{tmp_path}/t").collect())

    given = lambda law, version, name, ministry=None: {"record_type": "document", "law_id": law, "payload": {"law_id": law, "version_uid": f"{law}:{version}", "law_name": name, "content": "x", "basic_info": {"소관부처": {"content": ministry}} if ministry else {}, "body": {"articles": []}}}
    assert run("1", given("A", 20240101, "시험법"), given("B", 20240101, "다른 법", "법무부"), given("C", 20240101, "다른 법")) == ["A-A:20240101-0", "B-B:20240101-0"]
    # A's new version is out of scope: the old one stays; B's is, too, but its delete counts
    assert run("2", given("A", 20250101, "새 이름"), given("B", 20250101, "다른 법"), {"record_type": "delete", "law_id": "B"}) == ["A-A:20240101-0"]


def test_lines_of_small_splits(spark, tmp_path):
    for name, n in (("a", 5_000), ("b", 1), ("c", 777)):
        (tmp_path / f"{name}.jsonl").write_text("".join("\n" if k % 10 == 3 else json.dumps({"record_type": "memo", "law_id": f"{name}{k}"}) + "\r\n" for k in range(n)))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        r = packages.read_packages(spark, str(tmp_path))
        assert "Window" not in r._jdf.queryExecution().executedPlan().toString() and spark.read.text(f"{tmp_path}/a.jsonl").rdd.getNumPartitions() > 8
        got = {(x["package"], x["line_no"]): x["law_id"] for x in r.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert got == {(f"{name}.jsonl", k + 1): f"{name}{k}" for name, n in (("a", 5_000), ("b", 1), ("c", 777)) for k in range(n) if k % 10 != 3}


def test_folder_source_by_name(spark, tmp_path):
    import zipfile

    from lexspark.sources.folder import FolderSource

    spark.dataSource.register(FolderSource)
    inbox = tmp_path / "in"
    inbox.mkdir()
    for name in ("b", "a", "d"):
        (inbox / f"{name}.jsonl").write_text(f"{name}1\n\n{name}3")
    (inbox / ".hidden.jsonl").write_text("x")
    seen = []

    def run():
        q = spark.readStream.format("lexspark_folder").load(str(inbox)).writeStream.foreachBatch(lambda df, n: seen.append((n, sorted(map(tuple, df.collect()))))).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination()

    rows = lambda *names: sorted((f"{n}.jsonl", k, body) for n in names for k, body in ((1, f"{n}1"), (2, ""), (3, f"{n}3")))
    run()
    assert seen == [(0, rows("a", "b", "d"))]
    (inbox / "e.jsonl").write_text("e1\n\ne3")
    (inbox / "c.jsonl").write_text("late")
    run()
    assert seen[1:] == [(1, rows("e"))]
    assert sorted(map(tuple, spark.read.format("lexspark_folder").option("later_than", "d.jsonl").load(str(inbox)).collect())) == rows("e")
    with zipfile.ZipFile(inbox / "z.zip", "w") as z:
        z.writestr("law/x.json", "{}")
        z.writestr("law/y.hwp", "body")
    (inbox / "y.zip").write_bytes(b"PK broken")
    got = {(r["zip"], r["path"]): (r["bytes"], r["error"]) for r in spark.read.format("lexspark_folder").option("rows", "members").load(str(inbox)).collect()}
    assert got == {("y.zip", None): (9, "zip_corrupt"), ("z.zip", "law/x.json"): (2, None), ("z.zip", "law/y.hwp"): (4, None)}


def split(records):
    return pk.fold_laws(records), records.where("record_type = 'rename'")


def test_deletes_stay_in_their_domain(spark):
    """The same id in two collections: a law's delete leaves the rule."""
    row = lambda domain, law, version="L:20240101", kind="JSON", file=None, n=0: (domain, law, version, "1", kind, f"{domain}{law}{version}{kind}{file}{n}", file, f"{domain}{law}{version}{kind}{file}{n}")
    schema = "domain string, law_id string, version_uid string, mst string, source_type string, chunk_id string, file_id string, uuid string"
    stored = spark.createDataFrame([row("law", "A"), row("admrul", "A"), row("law", "B", "L:20240101", "FILE", "f1", 0), row("law", "B", "L:20240101", "FILE", "f1", 1), row("law", "B", "L:20240101", "FILE", "f2", 0)], schema)
    lines = lambda *rs: spark.createDataFrame([("p", k, json.dumps(r)) for k, r in enumerate(rs)], "package string, line_no int, body string")
    given = consumer.with_domain(packages.parse_records(lines({"record_type": "package_header", "source": "law"}, {"record_type": "delete", "law_id": "A"}))).where("record_type <> 'package_header'")
    out = consumer.flush(stored, *split(given), stored.limit(0))
    assert sorted((r["domain"], r["law_id"]) for r in out.collect()) == [("admrul", "A"), ("law", "B"), ("law", "B"), ("law", "B")]
    own = consumer.with_domain(packages.parse_records(lines({"record_type": "package_header", "source": "law"}, {"record_type": "delete", "law_id": "A", "doc_target": "admrul"}))).where("record_type <> 'package_header'")
    assert sorted((r["domain"], r["law_id"]) for r in consumer.flush(stored, *split(own), stored.limit(0)).collect())[0] == ("law", "A")
    # a file with one chunk fewer: the orphan goes, other files stay
    fresh = spark.createDataFrame([row("law", "B", "L:20240101", "FILE", "f1", 0)], schema)
    out = consumer.flush(stored, *split(given.limit(0)), fresh)
    assert sorted(r["uuid"] for r in out.where("law_id = 'B'").collect()) == ["lawBL:20240101FILEf10", "lawBL:20240101FILEf20"]
    # dashed dates rank as dates
    late = spark.createDataFrame([row("law", "A", "L:2023-12-31")], schema)
    assert consumer.flush(stored, *split(given.limit(0)), late).where("version_uid like '%2023%'").count() == 0
    assert consumer.flush(stored, *split(given.limit(0)), late, older=True).where("version_uid like '%2023%'").count() == 1
    newer = spark.createDataFrame([row("law", "A", "L:2025-01-01")], schema)
    assert [r["version_uid"] for r in consumer.flush(stored, *split(given.limit(0)), newer).where("law_id = 'A' and domain = 'law'").collect()] == ["L:2025-01-01"]


def test_commits_touch_buckets_and_see_other_writers(spark, tmp_path):
    root = f"{tmp_path}/t"
    df = spark.createDataFrame([("law", f"L{k}", k) for k in range(40)], "domain string, law_id string, n int")
    assert st.commit(df, root, buckets=8) == 1
    one = df.where("law_id = 'L7'").withColumn("b", st.bucket(8)).first()["b"]
    part = df.where(st.bucket(8) == one)
    assert st.commit(part.withColumn("n", F.col("n") + 100), root, [one], 1, 8) == 2
    got = {r["law_id"]: r["n"] for r in st.current(spark, root).collect()}
    gone = {r["law_id"] for r in part.collect()}
    assert got == {f"L{k}": k + 100 * (f"L{k}" in gone) for k in range(40)}
    assert {r["law_id"] for r in st.current(spark, root, [one]).collect()} == gone
    with pytest.raises(st.ConcurrentWrite):
        st.commit(part, root, [one], 1, 8)
    assert st.commit(part.limit(0), root, [one], 2, 8) == 3 and st.current(spark, root).count() == 40 - len(gone)
    assert st.commit(df.limit(0), root) == 4 and st.current(spark, root).count() == 0 and st.current(spark, root).columns == df.columns


def test_stale_versions_and_nulls(spark):
    stored = spark.createDataFrame([("law", "A", "1"), ("law", "A", None), ("law", "A", "2"), ("adm", "A", "1"), ("law", "B", "1")], "domain string, law_id string, version_uid string")
    keep = spark.createDataFrame([("law", "A", "2"), ("law", "A", None), ("law", "B", None)], stored.schema)
    assert sorted(map(tuple, st.stale_versions(stored, keep).select("domain", "law_id", "version_uid").collect()), key=str) == sorted([("law", "A", "1"), ("law", "A", None)], key=str)


def test_vector_faults(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [1.0]), (5, None), (6, [float("inf"), 1.0]), (7, [None, 1.0])], "k int, v array<float>")
    assert [r[0] for r in df.orderBy("k").select(st.vector_fault(F.col("v"), 2)).collect()] == [None, "zero", "not finite", "dimension", "missing", "not finite", "not finite"]


def zipped(*members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return out.getvalue()


def test_zip_members(spark, tmp_path):
    deepest = zipped(("x.pdf", b"4"), ("four.zip", zipped(("lost.pdf", b"5"))))
    third = zipped(("deep.hwp", b"3"), ("last.zip", deepest))
    inner = zipped(("sub/first.hwp", b"1"), ("skip.json", b"{}"), ("__MACOSX/j", b""), ("../up.pdf", b""), ("two.zip", third), ("sub2/first.hwp", b"1b"))
    link = zipfile.ZipInfo("link.pdf")
    link.external_attr = 0o120777 << 16
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        one = zipped(("law/가/doc.json", b"{}"), ("law/가/set.zip", inner), ("law/가/broken.zip", b"PK no"), ("__MACOSX/x", b""), ("../up.pdf", b""), ("a\\b.pdf", b"w"), ("a.exe", b""), (link, b"t"), ("twice.pdf", b"1"), ("twice.pdf", b"2"), ("x.manifest.json", b"{}"), ("manifest.json", b"{}"))
    (tmp_path / "one.zip").write_bytes(one)
    damaged = bytearray(zipped(("good.pdf", b"good"), ("bad.pdf", b"payload")))
    damaged[damaged.index(b"payload")] ^= 1
    (tmp_path / "crc.zip").write_bytes(bytes(damaged))
    (tmp_path / "bad.zip").write_bytes(b"not a zip")
    got = sorted((r["zip"].rpartition("/")[2], r["path"], r["error"]) for r in zips.read_zips(spark, str(tmp_path)).collect())
    assert [g for g in got if g[0] != "one.zip"] == [("bad.zip", None, "zip_corrupt"), ("crc.zip", None, "zip_corrupt")]
    assert sorted((p, e) for z, p, e in got if z == "one.zip") == sorted([
        ("law/가/doc.json", None), ("law/가/set__first.hwp", None), ("law/가/set__first_1.hwp", None), ("law/가/set__two__deep.hwp", None), ("law/가/set__two__last__x.pdf", None), ("law/가/broken.zip", "unsupported_extension"),
        ("__MACOSX/x", "os_metadata_ignored"), ("../up.pdf", "path_unsafe"), ("a/b.pdf", None), ("a.exe", "unsupported_extension"), ("link.pdf", "path_unsafe"), ("twice.pdf", "path_duplicate"), ("twice.pdf", "path_duplicate"), ("x.manifest.json", "manifest_ignored"), ("manifest.json", "manifest_ignored")])
    held = {r["path"]: r for r in zips.read_zips(spark, str(tmp_path), content=True).where("zip like '%one.zip'").collect()}
    assert bytes(held["law/가/set__two__last__x.pdf"]["content"]) == b"4" and held["a/b.pdf"]["sha256"] == hashlib.sha256(b"w").hexdigest()


def test_zip_member_names():
    info = zipfile.ZipInfo("가.pdf")
    assert zips.member_name(info)[1] is None
    for raw, want in (("가나".encode("cp949"), ("가나.pdf", None)), ("가나".encode(), ("가나.pdf", None)), (b"\x81\xff\xff", (None, "filename_encoding"))):
        info = zipfile.ZipInfo(raw.decode("cp437") + ".pdf")
        info.flag_bits = 0
        name, fault = zips.member_name(info)
        assert fault == want[1] and (want[0] is None or name == want[0])
    assert len(zips.fit_name("가" * 100 + ".hwp").encode()) <= zips.NAME_BYTES and zips.fit_name("가" * 100 + ".hwp").endswith(".hwp") and zips.fit_name("a.b") == "a.b"


def test_manifests_beside_their_zips(spark, tmp_path):
    (tmp_path / "a.manifest.json").write_text('{"n": 1}')
    (tmp_path / "a.zip.manifest.json").write_text('{"n": 2}')
    (tmp_path / "b.zip.manifest.json").write_text("[1]")
    (tmp_path / "c.manifest.json").write_text("{")
    got = {r["zip"].rpartition("/")[2]: (r["n"], r["error"]) for r in zips.manifests(spark, str(tmp_path)).select("zip", F.try_variant_get("manifest", "$.n", "int").alias("n"), "error").collect()}
    assert got == {"a.zip": (1, None), "b.zip": (None, "manifest_invalid"), "c.zip": (None, "manifest_invalid")}


def test_group_rules(spark):
    rows = [("src", "1", "law", False, "v", "h", False), ("src", "2", None, False, "v", "h", False), ("mix", "1", "law", True, "v", "h", False), ("mix", "2", "law", None, "v", "h", False),
            ("gone", "1", "law", True, "v1", "h", False), ("gone", "2", "law", True, "v2", "h2", False), ("ver", "1", "law", False, "v", "h", False), ("ver", "2", "law", False, None, "h", False),
            ("con", "1", "law", False, "v", "h", False), ("con", "2", "law", False, "v", None, False), ("dup", "1", "law", False, "v", "h", False), ("dup", "2", "law", False, "v", "h", False), ("dup", "2", "law", False, "v", "h", False),
            ("err", "1", "law", False, "v", "h", True), ("err", "2", "adm", True, "w", "i", False), ("one", "1", "law", False, None, None, None), (None, "1", "a", False, "v", "h", False), (None, "2", "b", False, "v", "h", True)]
    df = spark.createDataFrame(rows, "law_id string, path string, source string, repealed boolean, version_uid string, hash string, error boolean")
    got = collections.defaultdict(list)
    for r in pk.group_faults(df, ["law_id"]).orderBy("path", "issue").collect():
        got[r["law_id"]].append((r["issue"], r["rejected"]))
    assert dict(got) == {"src": [("law_id_multi_source", True)] * 2, "mix": [("repeal_conflict", True)] * 2, "gone": [(None, False), ("duplicate", False)], "ver": [("multi_version_unsupported", True)] * 2, "con": [("version_conflict", True)] * 2,
                         "dup": [(None, False), ("duplicate", False), ("duplicate", False)], "err": [(None, True), (None, True)], "one": [(None, False)], None: [(None, False), (None, True)]}


def test_verdicts_and_summaries(spark):
    df = spark.createDataFrame([(["z1"], 0, 0, 0, [("z", "r")], 1), (None, 1, 2, 3, None, 0), ([], 0, 0, 3, [], 0), (None, 0, 0, 0, None, 1), (None, 0, 0, 0, None, 0)], "f array<string>, s int, a int, p int, g array<struct<zip:string,reason:string>>, w int")
    at = lambda halt: [tuple(r[0]) for r in df.select(pk.decide(*map(F.col, "fsapgw"), halt_on_partial=halt)).collect()]
    assert at(True) == [("halt", ["convert_failed:z1", "quality_guard:z:r"]), ("halt", ["lock_conflict", "zip_failed:2", "zip_partial:3"]), ("halt", ["zip_partial:3"]), ("waiting", []), ("ok", [])]
    assert at(False)[2] == ("ok", [])
    runs = spark.createDataFrame([("r", 1, 3, 0, ["a"], 5), ("r", 2, 4, None, None, 0), ("r", 3, 1, 1, ["b", "c"], 2)], "run string, n int, total int, failed int, zips array<string>, waiting int")
    r = pk.merge_summaries(runs, ["run"], "n", ["total", "failed"], ["zips"], ["waiting"]).first()
    assert (r["total"], r["failed"], r["zips"], r["waiting"], r["attempts"]) == (8, 1, ["a", "b", "c"], 2, 3)


def test_packages_without_records(spark):
    keys = lambda *names: spark.createDataFrame([(n,) for n in names], "package string")
    feet = spark.createDataFrame([("empty", 5), ("none", 0), ("ok", 1)], "package string, record_count long")
    got = {r["package"]: (r["records"], r["verdict"]) for r in pk.reconcile(keys("ok", "bare"), ["package"], feet, keys("head", "ok")).collect()}
    assert got == {"empty": (0, "quarantine"), "none": (0, "ok"), "ok": (1, "ok"), "bare": (1, "retry"), "head": (0, "retry")}


def test_receipts_and_retention(spark):
    now = F.lit("2024-01-10 00:00:00").cast("timestamp")
    t = lambda d: F.lit(f"2024-01-{d:02d} 00:00:00").cast("timestamp")
    receipts = spark.range(1).select(t(9).alias("received_at"), F.lit("accepted").alias("status")).union(spark.range(1).select(t(10), F.lit("rejected")))
    assert tuple(intake.receipt_gap(receipts, now, 3600).select("age_seconds", "attention").first()) == (86_400, True)
    assert intake.receipt_gap(receipts, now, 90_000).first()["attention"] is False and intake.receipt_gap(receipts.limit(0), now, 1).first()["attention"] is True
    z = spark.range(1).select(F.lit("a").alias("stem"), t(1).alias("arrived_at")).union(spark.range(1).select(F.lit("b"), t(1))).union(spark.range(1).select(F.lit("c"), t(10)))
    assert [r["stem"] for r in intake.manifests_overdue(z, spark.createDataFrame([("b",)], "stem string"), now, 3600).collect()] == ["a"]
    assert intake.expired(z.withColumnRenamed("arrived_at", "modified_at"), now, 5).count() == 2
    q = spark.createDataFrame([("p1", "permanent"), ("p2", "transient_exhausted"), ("p3", "transient_exhausted"), ("p4", "transient_exhausted")], "package string, kind string")
    assert [r["package"] for r in intake.requeue(q, spark.createDataFrame([("p2",)], "package string"), "transient_exhausted", 1).collect()] == ["p3"]


def test_quality_guard(spark):
    df = spark.createDataFrame([("a", "| -- |", True), ("a", "글", False), ("b", "| |", False), *[("b", "text", True)] * 30, ("c", "||", False), ("c", "x", True)], "k string, content string, kept boolean")
    got = {r["k"]: tuple(r)[1:] for r in units.quality(df, kept="kept", by=["k"]).collect()}
    assert got == {"a": (2, 1, 1, "fail: dropped_chunks_had_content"), "b": (31, 1, 0, "pass"), "c": (2, 1, 0, "fail: chunks_dropped_ratio")}
    assert tuple(units.quality(df).first()) == (35, 3, 0, "fail: chunks_dropped_ratio")


def test_nearest_document_and_matches(spark):
    files = spark.createDataFrame([("a/b/c/f.pdf",), ("a/x.pdf",), ("top.pdf",)], "path string")
    folders = spark.createDataFrame([("a", 1), ("a/b", 2)], "folder string, doc int")
    assert {r["path"]: r["doc"] for r in intake.nearest_document(files, folders).collect()} == {"a/b/c/f.pdf": 2, "a/x.pdf": 1, "top.pdf": None}
    u = spark.createDataFrame([("u1", ["n1", "m1", "n1"]), ("u2", ["n2"]), ("u3", ["n3"])], "unit string, names array<string>")
    e = spark.createDataFrame([("n1", "p1"), ("m1", "p1"), ("n2", "p2"), ("n2", "p3")], "name string, path string")
    assert {r["unit"]: (r["state"], r["path"]) for r in intake.match_declared(u, e).collect()} == {"u1": ("found", "p1"), "u2": ("ambiguous", None), "u3": ("pending", None)}


def test_deliveries_with_and_without_manifest(spark):
    accepted = spark.createDataFrame([("s", "m"), ("t", None)], "sha256 string, manifest_sha256 string")
    new = spark.createDataFrame([(1, "s", "m"), (2, "s", "other"), (3, "s", None), (4, "t", None), (5, "u", "m"), (6, "t", "m")], "k int, sha256 string, manifest_sha256 string")
    assert sorted(r["k"] for r in intake.new_deliveries(new, accepted).collect()) == [2, 5]


def test_renames_stop_at_head_boundaries_and_living_names(spark):
    schema = "uuid string, domain string, law_id string, provision_id string, reference_ids array<string>, relation_refs array<struct<reference_id: string, link_text: string>>"
    rows = spark.createDataFrame([("1", "law", "L1", "law:가법#1", ["law:B#1"], None), ("2", "law", "L2", "law:가법B#1", ["law:가법#2", "law:가법B#3", "law:나법#1"], [("law:가법#2", "t"), ("x", "u")]), ("3", "law", "L2", "law:가법B#1", None, None),
                                  ("4", "law", "L3", "law:나법#1", [], None), ("5", "law", "L4", "law:나법#1", ["law:나법#1"], None), ("6", "admrul", "L1", "law:다#1", ["law:가법"], None)], schema)
    records = spark.createDataFrame([("law", "L1", "eflaw", "가 법", "새 법"), ("law", "L3", None, "나법", "하법"), ("law", "L5", None, "가 나", "가나")], "domain string, law_id string, doc_target string, old_name string, new_name string")
    renames = references.rename_heads(records)
    assert {(r["old_head"], r["new_head"]) for r in renames.collect()} == {("law:가법", "law:새법"), ("law:나법", "law:하법")}
    out = references.apply_renames(rows, renames)
    want = {"2": (["law:새법#2", "law:가법B#3", "law:나법#1"], [("law:새법#2", "t"), ("x", "u")]), "3": (None, None), "5": (["law:나법#1"], None), "6": (["law:새법"], None)}
    show = lambda df: {r["uuid"]: (r["reference_ids"], r["relation_refs"] and [tuple(x) for x in r["relation_refs"]]) for r in df.collect()}
    assert show(out) == want and show(references.apply_renames(out, renames)) == want


def test_phantom_references(spark):
    articles = spark.createDataFrame([("d1", "JO0001"), ("d1", "JO0002_02"), ("d2", "DOC")], "doc string, unit string")
    relations = spark.createDataFrame([(1, "d1", "d1", "JO0001"), (2, "d1", "d1", "JO0009"), (3, "d1", "d2", "JO0009"), (4, "d2", "d2", "JO0001"), (5, "d1", "d1", "BYL0001")], "k int, doc string, target_doc string, target_unit string")
    assert sorted(r["k"] for r in references.drop_phantoms(relations, articles).collect()) == [1, 3, 4, 5]


def test_scope_needs_entries(spark):
    rows = spark.createDataFrame([("가 나법", "A,B"), ("다", "C; D"), (None, None)], "law_name string, ministry string")
    assert [r["law_name"] for r in scope.gate(rows, ["가나법"], ["d"]).collect()] == ["가 나법"]
    assert [r["law_name"] for r in scope.gate(rows, ["x"], ["D"]).collect()] == ["다"]
    with pytest.raises(ValueError):
        scope.gate(rows, [], [])


def test_permanent_errors(spark):
    df = spark.createDataFrame([("HTTP_ERROR", "HTTP 404 x"), ("HTTP_ERROR", "HTTP 429"), ("HTTP_ERROR", "HTTP 503"), ("TIMEOUT", "record_count differs"), ("EMPTY_RESULT", None), (None, None)], "c string, e string")
    assert [tuple(r) for r in df.select(pk.is_permanent(F.col("e")), pk.is_permanent_parser_error(F.col("c"), F.col("e"))).collect()] == [(False, True), (False, False), (False, False), (True, False), (False, True), (False, False)]


def test_file_only_documents(spark):
    given = [law(body={"articles": [{"content": "[첨부파일 참조]"}, None]}, attachments=[{"name": "a"}]), law(body={"articles": []}), law(attachments=[{"name": "a"}]), law(body={"articles": [{"content": "[그림]"}]}, attachments=[{"name": "a"}])]
    docs = documents.parse_documents(spark.createDataFrame([(str(k), json.dumps(g, ensure_ascii=False)) for k, g in enumerate(given)], "path string, value string"))
    assert [tuple(r) for r in docs.orderBy("path").select(units.has_text(F.col("doc")), units.is_file_only(F.col("doc"))).collect()] == [(False, True), (False, False), (True, False), (True, False)]
    assert units.pending_appendices(docs.where("path = '2'")).count() == 1


def test_large_packages_are_read_in_splits(spark, tmp_path):
    n = 5_000
    write_package(tmp_path / "big.jsonl", *[doc(f"L{k}", "1", "x" * 200) for k in range(n)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        r = packages.read_packages(spark, str(tmp_path))
        got = r.where("record_type = 'document'").orderBy("line_no").select("line_no", "law_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(x) for x in got] == [(k + 2, f"L{k}") for k in range(n)] and packages.footers(r).first()["record_count"] == n


def test_cells_and_codes(spark, tmp_path):
    import numpy as np

    from lexspark.operators import ann, search

    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(30, 12)), 20, 0) + rng.normal(scale=0.2, size=(600, 12))
    data = [(k, v.tolist()) for k, v in enumerate(x)] + [(900, None), (901, [0.0] * 12), (902, [float("nan")] * 12), (903, [None] + [1.0] * 11), (904, [float("inf")] * 12)]
    data += [(1000 + k, x[0].tolist()) for k in range(300)]  # a third of the rows in one cell
    e = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    index = ann.build(e, f"{tmp_path}/lists", cells=12, subspaces=5)
    assert index.lists.count() == 900 and index.books.shape == (4, 256, 3)
    asked = e.where("vec_id % 50 = 1 or vec_id > 899 and vec_id < 910")
    exact = search.nearest_to_each(e.where(ann.usable(F.col("embedding"))), asked.where(ann.usable(F.col("embedding"))), 10)
    found = ann.search(index, e, asked, 10, probes=12, shortlist=900, part=64)
    key = lambda df: sorted((r["q"], r["place"], r["id"]) for r in df.collect())
    assert key(found) == key(exact)  # all cells, whole lists: exact, cells in parts
    probes, shortlist, got = ann.audit(index, e, target=0.9, probes=1, shortlist=10)
    assert got >= 0.9 and probes <= 12
    few = ann.search(index, e, asked, 10, probes, shortlist)
    assert ann.recall(few, exact).agg(F.avg("recall")).first()[0] >= 0.8
    none = ann.build(e.limit(0), f"{tmp_path}/none")
    assert ann.search(none, e.limit(0), asked, 10).count() == 0
    with pytest.raises(ValueError):
        ann.build(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>"), f"{tmp_path}/bad")


def test_posting_blocks_equal_keyword_scores(spark, tmp_path):
    import random

    from lexspark.operators import postings, search

    rnd = random.Random(9)
    texts = [" ".join(rnd.choices(["the", "a", "Rare", "x", "y", "z"], weights=[40, 20, 1, 10, 10, 10], k=rnd.randint(0, 40))) for _ in range(3_000)]
    texts += ["rare rare rare", "rare the", None, "rare rare rare"]
    docs = spark.createDataFrame([(7 * k - 500, t) for k, t in enumerate(texts)], "doc_id long, text string")
    postings.build(docs, f"{tmp_path}/p", block=16)
    for words in (["rare", "the"], ["rare"], ["the", "a", "nowhere"], ["nowhere"], ["rare", "x", "rare"]):
        want = [(r["doc_id"], round(r["score"], 9)) for r in search.keyword_scores(docs.where("text is not null"), list(dict.fromkeys(words))).orderBy(F.desc(F.round("score", 9)), "doc_id").limit(10).collect()]
        got, opened = postings.top(spark, f"{tmp_path}/p", words)
        assert sorted((r["doc_id"], round(r["score"], 9)) for r in got.collect()) == sorted(want) or [s for _, s in want] == [round(r["score"], 9) for r in got.orderBy(F.desc("score")).collect()], words
        if words[0] == "rare":
            heads = spark.read.parquet(f"{tmp_path}/p/heads").where(F.col("word").isin(words))
            assert opened.count() < heads.count()  # blocks stay closed


def test_one_pass_over_ids_stands_for_the_guards_and_clean_ups(spark):
    import random

    rnd = random.Random(7)
    schema = "domain string, law_id string, version_uid string, mst string, source_type string, chunk_id string, uuid string"

    def rows(n, mark):
        some = [(rnd.choice(["law", "admrul", None]) if rnd.random() < 0.2 else "law", rnd.choice([f"L{k}" for k in range(12)] + [None]), rnd.choice([f"v:2024010{k}" for k in range(3)] + [None]),
                 str(rnd.randrange(3)), rnd.choice(["JSON", "JSON", "FILE", None]), rnd.choice(["a", "b", "c", None])) for _ in range(n)]
        return [(*r, rnd.choice([f"u{k}", f"{mark}{k}"])) for k, r in enumerate(some)]

    stored, fresh = spark.createDataFrame(rows(150, "s"), schema), spark.createDataFrame(rows(60, "f"), schema)
    fresh = fresh.where("law_id is null or law_id not in ('L1', 'L2')")
    gone = spark.createDataFrame([("law", "L1"), ("law", "L3"), ("law", "L1"), ("admrul", "L2"), (None, "L2")], "domain string, law_id string")
    changed = 0
    for older in (False, True):
        late = st.older_than_stored(fresh.select("domain", "law_id", "version_uid", "mst").distinct(), stored).select("domain", "law_id").distinct()
        kept = fresh if older else fresh.join(late, ["domain", "law_id"], "left_anti")
        merged = st.upsert(st.delete_laws(stored, gone), kept)
        drop = st.stale_versions(merged, kept).select("uuid").unionByName(st.orphan_units(merged, kept).select("uuid"))
        want = sorted((r["uuid"] for r in merged.join(drop, "uuid", "left_anti").collect()))
        both = stored.withColumn("new", F.lit(0)).unionByName(fresh.withColumn("new", F.lit(1)))
        got = both.join(st.outgoing(stored, fresh, gone, older), ["new", "uuid"], "left_anti")
        assert sorted(r["uuid"] for r in got.collect()) == want
        changed += len(want)
    assert 100 < changed < 400


def test_chunks_gathered_apart_are_the_same(spark):
    lines = [("p", n, f"L{n % 4}", kind, None, f'{{"n": {n}}}' if kind == "document" and n % 3 else None, f"b{n}", "law" if n % 5 else None) for n, kind in enumerate(["document", "normalized_chunk", "preprocessed_chunk", "file", "delete", "pending_attachment", "rename"] * 4)]
    records = spark.createDataFrame(lines, "package string, line_no long, law_id string, record_type string, op string, payload string, body string, domain string")
    rows = lambda apart: {r["law_id"]: r for r in pk.fold_laws(records, apart=apart).collect()}
    assert rows(True) == rows(False) and len(rows(True)) == 4
    plain = records.where("record_type in ('document', 'delete')").drop("domain")
    assert sorted(pk.fold_laws(plain, apart=True).collect()) == sorted(pk.fold_laws(plain).collect()) and pk.fold_laws(plain, apart=True).columns == pk.fold_laws(plain).columns
