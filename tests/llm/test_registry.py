"""Every operator has its query, and those with SQL agree with it over the smallest tables."""

import glob
import os
import sys
import zlib

import duckdb
import numpy as np
import pytest

from lexspark.llm import registry

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.sql(registry.ORACLE_SQL[name])
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert sorted(str(tuple(r[c] for c in cols)) for r in df.collect()) == sorted(str(tuple(r[k] for k in at)) for r in want.fetchall())


def documents():
    import pyarrow.parquet as pq

    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


def ids_of(name, text):
    from lexspark.llm import bpe

    return bpe.encoder(bpe.vocabulary(name), "word" if name.startswith("word") else "byte").tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_op1(spark):
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in registry.QUERIES["op1_token_counts"](spark, SF).collect()}
    want = {d["doc_id"]: (len((d["text"] or "").encode()), len(ids_of("word_bpe_49k.json", d["text"]))) for d in documents()}
    assert got == {k: (b, n, n > 2048) for k, (b, n) in want.items()} and len({x[2] for x in got.values()}) == 2


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_op2(spark):
    got, at = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in registry.QUERIES["op2_token_ids"](spark, SF).collect()}, 0
    for d in sorted(documents(), key=lambda d: d["doc_id"]):
        ids = ids_of("byte_bpe_50k.json", d["text"]) + [2]
        assert got.pop(d["doc_id"]) == (at, len(ids), crc(ids))
        at += len(ids)
    assert not got


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_op3(spark):
    from test_text_operators import slow_components, slow_fingerprint

    docs = documents()
    fp = [slow_fingerprint(d["text"]) for d in docs]
    low = slow_components([d["doc_id"] for d in docs], lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 4)
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in registry.QUERIES["op3_simhash"](spark, SF).collect())
    assert got == sorted((d["doc_id"], f"{f:016x}", c) for d, f, c in zip(docs, fp, low))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_op8(spark):
    docs = {d["doc_id"]: d for d in documents()}
    got = registry.QUERIES["op8_language_id"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    right = []
    for r in got:
        d = docs[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        lettered = any(map(str.isalpha, d["text"] or ""))
        assert (r["lang_pred"] == "und") == (not lettered)
        if r["held_out"] and lettered and d["lang"]:
            right.append(r["lang_pred"] == d["lang"])
    assert sum(right) >= 0.95 * len(right)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_op10(spark):
    pieces, sequences = {}, {}
    for r in registry.QUERIES["op10_packing"](spark, SF).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d in documents():
        ids, at = ids_of("byte_bpe_50k.json", d["text"]) + [1], 0
        for r in sorted(pieces.pop(d["doc_id"]), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids[at : at + r["length"]]))
            at += r["length"]
        assert at == len(ids)
    assert not pieces
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    used = sum(n for s in sequences.values() for _, n in s)
    assert used >= 0.9 * 2048 * len(sequences)
