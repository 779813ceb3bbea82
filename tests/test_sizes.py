"""What a task holds or moves, at sizes that tests can make."""

import numpy as np
from pyspark.sql import functions as F

from lexspark.operators import ann, payloads, search


def test_audit_raises_what_is_short_alone(spark, tmp_path):
    x = np.random.default_rng(5).normal(size=(1_500, 12))
    e = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    index = ann.build(e, f"{tmp_path}/lists", cells=30, subspaces=12)
    probes, shortlist, got = ann.audit(index, e, target=0.9, queries=16, probes=1, shortlist=300)
    assert got >= 0.9 and 1 < probes < 30 and shortlist == 300


def test_distances_held_at_a_time_are_bounded():
    assert all(search.at_a_time(n) * n * 8 <= 1 << 25 for n in (1, 1_000, 65_536, 131_072, 1 << 22))


def test_changes_without_path_do_not_meet_in_one_task(spark):
    lines = spark.range(2_000).select(F.col("id").alias("line_no"), F.concat(F.lit('{"op":"upsert","law_id":"'), "id", F.lit('",'), F.when(F.col("id") % 10 == 0, F.concat(F.lit('"git_path":"p/'), F.col("id"), F.lit('"'))).otherwise('"payload":{"a":1}'), F.lit("}")).alias("body"))
    docs = spark.range(0, 2_000, 20).select(F.concat(F.lit("p/"), F.col("id")).alias("git_path"), F.lit('{"b":2}').alias("value"))
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(held, ("-1", "false", "8")):
            spark.conf.set(k, v)
        c = payloads.changes(lines, docs)
        sizes = [r["n"] for r in c.groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n")).collect()]
        got = {r["line_no"]: (r["payload"], r["error"]) for r in c.collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and max(sizes) < 600
    assert got == {k: ('{"a":1}', None) if k % 10 else ('{"b":2}', None) if k % 20 == 0 else (None, "path_missing") for k in range(2_000)}


def test_no_task_holds_a_whole_package(spark, tmp_path, monkeypatch):
    from lexspark.plans import tables

    n = 4_000
    spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 300).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr("lexspark.functions.scratch.folder", lambda spark, name: f"{tmp_path}/{name}")
    held = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = tables.q97_lines_numbered_in_splits(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", held)
    assert sorted((r["package"], r["line_no"], r["doc_id"]) for r in got) == sorted((f"part{k % 3}", k // 3 + 1, k) for k in range(n))
    assert len(list((tmp_path / "numbered").glob("package=part1/*.txt"))) > 1


def test_consumer_parses_each_line_once(spark, tmp_path, monkeypatch):
    from lexspark.sources import packages as src
    from lexspark.streaming import consumer

    n, seen, parse = 40, spark.sparkContext.accumulator(0), src.parse_records

    def counted(lines):
        def pass_on(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        return parse(lines.mapInArrow(pass_on, lines.schema))

    lines = ['{"record_type": "package_header", "package_id": "p", "source": "admrul"}']
    lines += [f'{{"record_type": "document", "law_id": "L{k}", "payload": {{"law_id": "L{k}", "v": "{k}:20240101"{", " + chr(34) + "doc_target" + chr(34) + ": " + chr(34) + "eflaw" + chr(34) if k % 2 else ""}}}}}' for k in range(n)]
    lines += [f'{{"record_type": "package_footer", "package_id": "p", "record_count": {n}}}']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.jsonl").write_text("\n".join(lines) + "\n")
    monkeypatch.setattr(src, "parse_records", counted)

    def to_rows(folded):
        found = folded.select("domain", "law_id", F.get_json_object("document", "$.v").alias("version_uid"))
        return found.select("*", F.lit("1").alias("mst"), F.lit("JSON").alias("source_type"), F.lit("c").alias("content"), F.col("law_id").alias("chunk_id"), F.col("law_id").alias("uuid"))

    consumer.consume(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/ck", to_rows)
    from lexspark.operators import store

    got = {r["law_id"]: r["domain"] for r in store.current(spark, f"{tmp_path}/t").collect()}
    assert got == {f"L{k}": "law" if k % 2 else "admrul" for k in range(n)}
    assert seen.value == n + 2


def test_calls_to_the_state_store_do_not_grow_with_repeats():
    import pandas as pd

    from lexspark.streaming import states

    class Held(dict):
        calls = 0

        def _count(f):
            def counted(self, *args):
                Held.calls += 1
                return f(self, *args)

            return counted

        containsKey, getValue = _count(lambda self, k: k in self), _count(lambda self, k: self[k])
        updateValue, removeKey = _count(dict.__setitem__), _count(dict.pop)
        keys, iterator = _count(dict.keys), _count(dict.items)

    class Handle:
        def getMapState(self, *args):
            return Held()

    rows = pd.DataFrame([("q", run, pd.Timestamp(2024, 1, run), f"z{k:05d}", str(k % 7), True, "bad" if k % 7 == 3 else None, 1, k % 7 % 2, 0, False, False) for run in (1, 2) for k in range(run, 4_000, 2)],
                        columns=[c.split()[0] for c in states.EVENTS.split(", ")])
    d = states.Deliveries(1_000, 3)
    d.init(Handle())
    got = pd.concat(d.handleInputRows(("q",), iter([rows[3_000:], rows[:3_000]]), None))
    firsts = {(1, f"z{k:05d}") for k in range(1, 15, 2)}
    want = {(r.run, r.zip): "failed" if r.sha256 == "3" and ((r.run, r.zip) in firsts or (r.run, r.zip) == (2, "z00010")) else "duplicate" if (r.run, r.zip) not in firsts else "partial" if r.rejected else "done" for r in rows.itertuples()}
    assert {(r.run, r.zip): r.state for r in got.itertuples()} == want
    assert list(got["zip"]) == sorted(got["zip"][:2_000]) + sorted(got["zip"][2_000:])
    assert Held.calls < 40


def test_posting_blocks_are_made_once(spark, tmp_path):
    from lexspark.operators import postings

    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("often w"), F.col("id")).alias("text"))
    postings.build(docs, f"{tmp_path}/p", block=2)
    rows = lambda name: sorted(map(tuple, spark.read.parquet(f"{tmp_path}/p/{name}").select("word", "block", "first", "last", "size").collect()))
    assert rows("made") == rows("blocks") == rows("heads")
    often = [r for r in rows("blocks") if r[0] == "often"]
    assert sum(r[4] for r in often) == 300 and len({r[1].split("-")[0] for r in often}) > 1
    assert all(r[1] == "0-0" and r[4] == 1 for r in rows("blocks") if r[0] != "often") and len(rows("blocks")) == 300 + len(often)


def test_tables_are_split_once_and_handed_over_in_pieces(spark, tmp_path):
    from lexspark.operators import chunking
    from lexspark.plans import texts

    text = "\n".join(["t" * 90, "h" * 90, *["row " * 40] * 60])
    spark.range(50).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    q = texts.q07_table_header_repeat(spark, str(tmp_path))
    parts = chunking.table(text, 400)
    want = {(k, len(parts), 60, max(map(len, parts))) for k in range(50)}
    assert set(map(tuple, q.select("doc_id", "parts", "rows", "longest").collect())) == want
    assert q._jdf.queryExecution().optimizedPlan().toString().count("_split_long(") == 1
    held = list(chunking.pieces((p for p in [["x" * 60] * 5] * 9), 1_000))
    assert list(map(len, held)) == [4, 4, 1] and [p for h in held for p in h] == [["x" * 60] * 5] * 9


def test_numbered_lines_stay_in_their_splits(spark, tmp_path):
    from lexspark.sources import packages as src

    (tmp_path / "a.jsonl").write_text("x\ny\n")
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(held, ("-1", "false")):
            spark.conf.set(k, v)
        df = src.read_lines(spark, str(tmp_path))
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, df.collect()))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == [("a.jsonl", 1, "x"), ("a.jsonl", 2, "y")]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_batch_is_merged_by_reading_the_table_twice(spark, tmp_path):
    from lexspark.streaming import consumer

    schema = "domain string, law_id string, version_uid string, mst string, source_type string, chunk_id string, uuid string"
    row = lambda law, version, chunk: ("law", law, f"v:{version}", "1", "JSON", chunk, f"{law}-{version}-{chunk}")
    spark.createDataFrame([row("A", 20240101, "a"), row("B", 20240101, "b"), row("C", 20240301, "c"), row("D", 20240101, "d"), row("D", 20240101, "e"), row("E", 20240101, "f")], schema).write.parquet(f"{tmp_path}/stored")
    spark.createDataFrame([row("B", 20240201, "b"), row("C", 20240201, "c"), row("D", 20240101, "d")], schema).write.parquet(f"{tmp_path}/fresh")
    folded = spark.createDataFrame([("law", "E", "delete", False), ("law", "B", "upsert", False)], "domain string, law_id string, action string, superseded boolean")
    out = consumer.flush(spark.read.parquet(f"{tmp_path}/stored"), folded, None, spark.read.parquet(f"{tmp_path}/fresh"))
    assert sorted(r["uuid"] for r in out.collect()) == ["A-20240101-a", "B-20240201-b", "C-20240301-c", "D-20240101-d"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 4  # ids, then rows, of stored and of fresh


def test_domains_of_payloads_whose_key_is_escaped(spark):
    from lexspark.streaming import consumer

    payloads = ['{"doc_target": "admrul"}', '{"doc\\u005ftarget": "admrul"}', '{"a": "doc_target"}', '{"doc_target": ""}', "{}", None]
    rows = [("p", n, "package_header" if n == 0 else "document", "p", "law" if n == 0 else None, None if n == 0 else f"L{n}", "eflaw" if n == 3 else None, ([None] + payloads)[n]) for n in range(7)]
    records = spark.createDataFrame(rows, "package string, line_no long, record_type string, package_id string, source string, law_id string, doc_target string, payload string")
    got = {r["line_no"]: r["domain"] for r in consumer.with_domain(records).collect()}
    assert [got[n] for n in range(1, 7)] == ["admrul", "admrul", "law", "law", "law", "law"]
    known = {r["line_no"]: r["domain"] for r in consumer.with_domain(records.where("line_no > 0"), F.lit("admrul")).collect()}
    assert [known[n] for n in range(1, 7)] == ["admrul", "admrul", "law", "admrul", "admrul", "admrul"]
