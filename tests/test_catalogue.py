"""Every query of the catalogue against its SQL in DuckDB, over the smallest tables."""

import glob
import hashlib
import math
import os

import duckdb
import pytest

from lexspark.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(list(map(plain, v))) if isinstance(v, list | tuple) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in catalogue.ORACLE_SQL:
        assert got
        return
    want = duck.sql(catalogue.ORACLE_SQL[name])
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert got == sorted(tuple(plain(r[k]) for k in at) for r in want.fetchall())


def test_embedding_digests(spark, tmp_path):
    from lexspark.operators.embedding import HashModel

    texts = {1: "a b c " * 3000 + "end", 2: "a b c " * 3000 + "END", 3: "", 4: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in catalogue.QUERIES["q75_embedding_connector"](spark, str(tmp_path)).collect()}
    for k, t in texts.items():
        v = HashModel(64)([t or ""])[0]
        want = ",".join(str(math.floor(abs(float(x)) * 10_000 + 0.5) * (1 if x >= 0 else -1)) for x in v)
        assert got[k]["digest"] == hashlib.sha256(want.replace("-0,", "0,").encode()).hexdigest()
    assert got[1]["digest"] != got[2]["digest"]


def test_whole_texts_are_composed_and_collapsed(spark, tmp_path):
    texts = {1: "a" * 400 + "   b" + "c" * 9000, 2: "|" * 30 + "x", 3: "|" * 400, 7: "x", 14: "x"}
    spark.createDataFrame([(k, t, "de", "s") for k, t in texts.items()], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r["doc_id"]: r["search_hash"] for r in catalogue.QUERIES["q04_search_text_whole"](spark, str(tmp_path)).collect()}
    assert got == {k: sha("s\nde\n" + ("good\n" if k == 1 else "") + t) for k, t in texts.items()}
    got = {r["doc_id"]: (r["collapsed_hash"], r["filler"]) for r in catalogue.QUERIES["q05_padding_collapse_filler_whole"](spark, str(tmp_path)).collect()}
    assert got == {k: (sha(t.replace("   ", " ")), k in (3, 7)) for k, t in texts.items()}


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
