"""States of deliveries and files."""

import base64
import hashlib
import json

from lexspark.operators import deliveries as dl
from lexspark.sources import documents


def test_states_of_deliveries(spark):
    zips = [("a.zip", "s1", None, 3, 0, 0), ("b.zip", "s2", "zip_corrupt", None, None, None), ("c.zip", "s3", None, 0, 2, 0), ("d.zip", "s4", None, 2, 1, 0), ("e.zip", "s5", None, 1, 0, 0), ("f.zip", "s1", None, 3, 0, 0), ("g.zip", "old", None, 1, 0, 0), ("h.zip", "s6", None, 1, 0, 1), ("i.zip", "s7", None, 1, 0, 0), ("j.zip", "s8", None, 1, 0, 0)]
    df = spark.createDataFrame(zips, "zip string, sha256 string, convert_error string, accepted int, rejected int, zip_errors int")
    log = spark.createDataFrame([("old", "x.zip", "done"), ("s4", "d.zip", "failed")], "sha256 string, zip string, state string")
    packages = spark.createDataFrame([("a.zip", "ok"), ("e.zip", "failed"), ("e.zip", "ok"), ("i.zip", "pending")], "zip string, status string")
    got = {r["zip"]: (r["state"], r["reason"]) for r in dl.next_states(df, log, packages).collect()}
    assert got == {"a.zip": ("done", None), "b.zip": ("failed", "zip_corrupt"), "c.zip": ("failed", "all_rejected"), "d.zip": ("partial", None), "e.zip": ("failed", "load_failed"), "f.zip": ("duplicate", None), "g.zip": ("duplicate", None), "h.zip": ("partial", None), "i.zip": ("loading", None), "j.zip": ("blocked", None)}
    assert dl.next_states(df.limit(0), log, packages).count() == 0
    z = spark.createDataFrame([("a", "s", True), ("b", "s", True), ("c", "s", False), ("d", "s", True)], "zip string, sha256 string, manifest boolean")
    got = dl.conversion_states(z, spark.createDataFrame([("a", "s"), ("d", "other")], "zip string, sha256 string"), spark.createDataFrame([("b",), ("b",)], "zip string"))
    assert {r["zip"]: (r["state"], r["errors"]) for r in got.collect()} == {"a": ("skipped", 0), "b": ("failed", 2), "c": ("pending_manifest", 0), "d": ("converted", 0)}
    t = dl.run_totals(dl.next_states(df, log, packages), [], {"good": ("done", "partial"), "bad": ("failed",)}).first()
    assert (t["total"], t["good"], t["bad"]) == (10, 3, 3)
    assert [r["n"] for r in dl.recent(spark.createDataFrame([(k,) for k in range(5)], "n int"), "n", 2).collect()] == [4, 3]


def test_outcomes_of_file_records(spark):
    b64 = base64.b64encode(b"data").decode()
    good = hashlib.sha256(b"data").hexdigest()
    rows = [("1", "f1", "n", None, b64, good), ("1", "f2", "n", None, "%%%", None), ("1", "f3", "gone.hwp", None, None, None), ("1", "f4", "n", "a:b.hwp", None, "x"), ("1", "f5", "n", None, b64, "bad"), ("1", "f6", "n", None, b64, None), ("1", "f7", "n", "ab.hwp", None, None), ("1", "f8", "n", None, b64, "")]
    df = spark.createDataFrame(rows, "law_id string, file_id string, file_name string, transfer_name string, content_b64 string, sha256 string")
    inbox = spark.createDataFrame([("ab.hwp", "x")], "transfer_name string, sha256 string")
    parsed = spark.createDataFrame([("f6", "EMPTY_RESULT", "m"), ("f7", "HTTP_ERROR", "HTTP 503")], "file_id string, code string, message string")
    got = {r["file_id"]: (r["outcome"], r["reason"], r["is_error"]) for r in dl.file_outcomes(df, inbox, parsed).collect()}
    assert got == {"f1": ("parsed", None, False), "f2": ("pending", "b64_decode_failed", True), "f3": ("pending", "file_missing_in_inbox", True), "f4": ("parsed", None, False), "f5": ("pending", "sha256_mismatch", True), "f6": ("pending", "unsupported_source_file", False), "f7": ("pending", "preprocess_failed", True), "f8": ("parsed", None, False)}
    assert {r["reason"] for r in dl.file_outcomes(df, inbox, parsed, enabled=False).collect()} == {"internal_preprocess_disabled"}


def test_places_of_files(spark):
    docs = spark.createDataFrame([("d1", None, None, "가법 시행령", "1"), ("d2", "admrul", None, "나 고시", "2"), ("d3", "school", "학칙", "다 학칙", "3")], "doc string, doc_target string, doc_kind string, law_name string, law_id string")
    stored = spark.createDataFrame([("나 고시/admrul_2", "나 고시", "2", "admrul"), ("나 고시/public", "나 고시", "9", "public"), ("다 학칙/x", "다 학칙", "3", "public")], "folder string, law_name string, law_id string, doc_target string")
    folders = dl.document_folders(docs, stored)
    assert sorted((r["doc"], r["rank"], r["folder"]) for r in folders.collect()) == [("d1", 0, "가법/시행령"), ("d2", 0, "나 고시"), ("d2", 1, "나 고시/admrul_2"), ("d2", 2, "학칙공단/나 고시"), ("d2", 3, "행정규칙/나 고시"), ("d3", 0, "다 학칙"), ("d3", 2, "학칙공단/다 학칙"), ("d3", 3, "학칙/다 학칙")]
    wanted = spark.createDataFrame([("d1", 1, "별지", "별지/a.hwp", "b.hwp", None), ("d1", 2, "별지", None, "b.hwp", None), ("d1", 3, "모름", None, None, "made.pdf"), ("d2", 4, None, "첨부파일/c.hwp", "c.hwp", None), ("d2", 5, None, None, "e:f.hwp", None), ("d1", 6, "별표", None, "none.hwp", "made.pdf")], "doc string, unit int, kind string, local_path string, file_name string, made_name string")
    files = spark.createDataFrame([("가법/시행령/별지/a.hwp",), ("가법/시행령/별지/b.hwp",), ("가법/시행령/별표/made.pdf",), ("나 고시/admrul_2/첨부파일/c.hwp",), ("행정규칙/나 고시/첨부파일/c.hwp",), ("나 고시/원문/e_f.hwp",)], "path string")
    assert {r["unit"]: r["path"] for r in dl.locate_files(wanted, folders, files).collect()} == {1: "가법/시행령/별지/a.hwp", 2: "가법/시행령/별지/b.hwp", 3: "가법/시행령/별표/made.pdf", 4: "나 고시/admrul_2/첨부파일/c.hwp", 5: "나 고시/원문/e_f.hwp", 6: None}
    f = spark.createDataFrame([("d", "x/a.hwp"), ("d", "x/b.hwp"), ("e", "x/a.hwp")], "doc string, path string")
    a = spark.createDataFrame([("d", 2, "p2", ["a.hwp"]), ("d", 1, "p1", ["z", "a.hwp"])], "doc string, pos int, provision_id string, names array<string>")
    assert {(r["doc"], r["path"]): r["provision_id"] for r in dl.match_appendix(f, a).collect()} == {("d", "x/a.hwp"): "p1", ("d", "x/b.hwp"): None, ("e", "x/a.hwp"): None}


def test_what_is_left_to_preprocess(spark):
    given = {"a": {"law_id": "1", "body": {"articles": [{"content": "x [그림]"}]}}, "b": {"law_id": "1", "body": {"articles": [{"content": "x"}]}, "appendices": [{"is_file_only": True}]}, "c": {"law_id": "1", "body": {"articles": []}, "attachments": [{"name": "n"}]}, "d": {"law_id": "1", "body": {"articles": [{"content": "x"}]}}}
    docs = documents.parse_documents(spark.createDataFrame([(k, json.dumps(v, ensure_ascii=False)) for k, v in given.items()], "path string, value string"))
    show = lambda source: {r["path"]: (r["images"], r["file_only_appendices"], r["file_only"]) for r in dl.preprocess_targets(docs, source).collect()}
    assert show("admrul") == {"a": (True, False, False), "b": (False, True, False), "c": (False, False, True)} and set(show("law")) == {"b", "c"}


def test_manifest_faults(spark):
    from pyspark.sql import functions as F

    from lexspark.functions import text
    from lexspark.operators import intake

    zips = spark.createDataFrame([(f"d/{k}.zip", "ab", 2, 1) for k in "abcdefg"], "zip string, sha256 string, documents long, repealed long")
    given = {"a": '{"sha256": " AB ", "documents": 2, "repealed": 1, "filename": "a.zip"}', "b": '{"sha256": "xx", "documents": 3, "filename": "z.zip"}', "c": '{"documents": true, "repealed": "1"}', "d": None, "f": '{"sha256": 5, "documents": 2.0, "repealed": 1}', "g": '{"sha256": "ab", "documents": 2, "repealed": null}'}
    m = spark.createDataFrame([(f"d/{k}.zip", v) for k, v in given.items()], "zip string, text string").select("zip", F.try_parse_json("text").alias("manifest"), F.when(F.col("text").isNull(), "manifest_invalid").alias("error"))
    got = {}
    for r in intake.manifest_faults(zips, m).collect():
        got.setdefault(r["zip"][2], set()).add((r["code"], r["level"]))
    assert got == {"b": {("manifest_mismatch", "error"), ("manifest_filename", "warning"), ("manifest_field_missing", "warning")}, "c": {("manifest_invalid", "error"), ("manifest_mismatch", "error")}, "d": {("manifest_invalid", "error")}, "e": {("manifest_missing", "warning")},
                   "f": {("manifest_invalid", "error"), ("manifest_mismatch", "error")}, "g": {("manifest_field_missing", "warning")}}
    df = spark.createDataFrame([("a.HWP",), ("~$a.hwp",), ("._a.pdf",), ("Thumbs.db",), ("x.txt",), (None,)], "n string")
    assert [r[0] for r in df.select(intake.attachment_like(F.col("n"))).collect()] == [True, False, False, False, False, False]
    c = spark.createDataFrame([("[그림] a [그림] b", ["x", " ", "z"]), ("none", None)], "c string, t array<string>").select(text.image_mark_counts(F.col("c"), F.col("t")).alias("x")).collect()
    assert [tuple(r["x"]) for r in c] == [(2, 1), (0, 0)]


def test_discovery(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for n in ("b.json", "a.json", "_manifest.json", "sub/c.json", "d.txt"):
        (tmp_path / n).write_text('{"law_id": "1", "body": {}}')
    base = lambda df: sorted(r["path"].rpartition("/")[2] for r in df.collect())
    assert base(documents.read_documents(spark, str(tmp_path))) == ["a.json", "b.json", "c.json"]
    assert base(documents.read_documents(spark, str(tmp_path), limit=2)) == ["a.json", "b.json"] and base(documents.read_documents(spark, str(tmp_path), limit=0)) == []


def test_states_in_the_stream_equal_the_batch_rules(spark, tmp_path):
    """Runs as a stream, with a restart in between: states as next_states gives them from the log; attempts and manifests by state and timer."""
    import datetime

    from lexspark.operators.deliveries import next_states
    from lexspark.streaming import states

    day = lambda n: datetime.datetime(2024, 1, n)
    row = lambda run, zip, sha, at=None, manifest=True, error=None, good=1, bad=0, faults=0, pending=False, failed=False, queue="q": (queue, run, at or day(run), zip, sha, manifest, error, good, bad, faults, pending, failed)
    runs = [
        [row(1, "a", "1"), row(1, "b", "1"), row(1, "c", "2", bad=2, good=0), row(1, "d", "3", pending=True), row(1, "e", "4"), row(1, "a", "9", queue="p")],
        [row(2, "d", "3", pending=True), row(2, "e", "4"), row(2, "f", "1")],
        [row(3, "d", "3", bad=1), row(3, "e", "4", error="zip_corrupt"), row(3, "g", "3"), row(3, "h", "5", failed=True)],
    ]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", states.STORE)
    got = []

    def run(n, rows):
        spark.createDataFrame(rows, states.EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(states.EVENTS).parquet(f"{tmp_path}/in")
        q = states.delivery_states(stream, "0 seconds", wait_ms=86_400_000, most_attempts=3).writeStream.foreachBatch(lambda df, k: got.extend(map(tuple, df.collect()))).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination()

    try:
        log = []
        for n, rows in enumerate(runs, 1):
            before = len(got)
            run(n, rows)
            zips = spark.createDataFrame([r[3:5] + r[6:10] for r in rows if r[0] == "q"], "zip string, sha256 string, convert_error string, accepted long, rejected long, zip_errors long")
            packages = spark.createDataFrame([(r[3], "pending" if r[10] else "failed" if r[11] else "ok") for r in rows if r[0] == "q"], "zip string, status string")
            want = {(r["zip"], r["state"], r["reason"]) for r in next_states(zips, spark.createDataFrame(log, "sha256 string, zip string, state string"), packages).collect()}
            assert {(z, s, reason) for q, k, z, s, reason, _ in got[before:] if q == "q"} == want
            sha = {r[3]: r[4] for r in rows}
            log += [(sha[z], z, s) for z, s, _ in want]
        assert {g[5] for g in got if g[2] == "d"} == {1, 2}
        # a third loading is the last; a manifest that doesn't come is told once, one that comes isn't
        run(4, [row(4, "k", "7", pending=True), row(4, "m", "8", manifest=False), row(4, "n", "9", manifest=False)])
        run(5, [row(5, "k", "7", pending=True), row(5, "n", "9")])
        before = len(got)
        run(6, [row(6, "k", "7", pending=True, at=day(8))])
        run(7, [row(7, "z", "0", at=day(9))])
        assert ("q", 6, "k", "failed", "attempts_exhausted", 3) in got[before:]
        assert [g for g in got if g[3] == states.OVERDUE] == [("q", -1, "m", states.OVERDUE, None, 0)]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
