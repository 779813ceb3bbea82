"""Raw bodies of unstable nesting, and the embedding connector."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.operators import embedding, raw


def bodies(spark, *given):
    df = spark.createDataFrame([(f"L{k}", json.dumps(b, ensure_ascii=False)) for k, b in enumerate(given)], "law_id string, json string")
    return df.select("law_id", F.parse_json("json").alias("body"))


def head(text):
    return {"조문여부": "전문", "조문내용": text}


def art(no, text, **more):
    return {"조문여부": "조문", "조문번호": no, "조문내용": text} | more


def test_articles_and_running_headings(spark):
    body = {"조문단위": [head("제1편 총론"), head("제1장  총칙"), art("1", "제1조(목적)", 항=[{"항내용": ["① 가", "나"], "호": {"호내용": "1. 호", "목": [{"목내용": "가. 목"}, {"목내용": [["나. 목"]]}]}, "목": [{"목내용": "다. 뒤"}]}]),
                     head("제2절 절"), art("2", "제2조", 조문가지번호="3"), head("제2편 각론"), art("4", "제4조", 호=[{"호내용": "1. 바로"}]), art("4", "제4조", 호=[{"호내용": "1. 바로"}])]}
    got = [tuple(r)[1:] for r in raw.articles(bodies(spark, body)).orderBy("pos").collect()]
    assert got == [
        (2, "제1조", None, "제1조(목적)\n① 가\n나\n1. 호\n가. 목\n나. 목\n다. 뒤", "제1장 총칙", "제1편 총론 > 제1장 총칙", None),
        (4, "제2조의3", None, "제2조", "제2절 절", "제1편 총론 > 제1장 총칙 > 제2절 절", None),
        (6, "제4조", None, "제4조\n1. 바로", "제2편 각론", "제2편 각론", None),
    ]


def test_single_elements_and_absent_parts(spark):
    df = bodies(spark, {"조문단위": art(7, "하나"), "부칙단위": {"부칙내용": "끝"}}, {}, {"조문단위": None, "별표단위": {"별표번호": "3", "별표서식PDF파일링크": "/f.pdf", "별표내용": [" "]}})
    assert [(r["law_id"], r["article_no"], r["content"]) for r in raw.articles(df).collect()] == [("L0", "제7조", "하나")]
    rows = df.select(raw.addenda(F.col("body")).alias("a"), raw.appendices(F.col("body")).alias("x")).collect()
    assert rows[0]["a"][0]["content"] == "끝" and rows[1]["a"] == [] and rows[1]["x"] == []
    x = rows[2]["x"][0]
    assert (x["no"], x["branch"], x["is_file_only"], x["files"][0]["type"]) == ("0003", "00", True, "pdf")


def test_addenda_by_date(spark):
    df = bodies(spark, {"부칙단위": [{"부칙공포일자": "20200101", "부칙내용": "b"}, {"부칙공포일자": "20190101", "부칙내용": "a"}, {"부칙공포일자": "20200101", "부칙내용": "c"}]})
    assert [a["content"] for a in df.select(raw.addenda(F.col("body")).alias("a")).first()["a"]] == ["a", "b", "c"]


def test_embedding_connector(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "a b")], "k int, search_text string")
    got = {r["k"]: r["vector"] for r in embedding.embed(df, lambda: embedding.HashModel(8), 8, batch=2).collect()}
    assert got[1] == got[3] and all(np.isclose(np.linalg.norm(v), 1) for v in got.values())
    with pytest.raises(Exception, match="8"):
        embedding.embed(df, lambda: embedding.HashModel(4), 8).collect()
    held = df.withColumn("cached", F.when(F.col("k") == 1, F.array(F.lit(9.0).cast("float"))))
    out = {r["k"]: r["vector"] for r in embedding.embed_missing(held, lambda: embedding.HashModel(8), 8).collect()}
    assert out[1] == [9.0] and len(out[2]) == 8
