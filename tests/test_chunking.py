"""Chunking: obligations as properties, and lines alone against a plain packer."""

import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexspark.operators import chunking as ch

TEXT = st.text(alphabet="가나 .①②1\n\t|x。", max_size=400)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 60))
def test_hard_cut_is_lossless_and_bounded(text, limit):
    parts = list(ch.hard_parts(text, limit))
    assert "".join(parts) == text and all(len(p) <= limit for p in parts)
    assert ch.limited(parts, limit) == parts


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(5, 60))
def test_prose_keeps_every_character_that_shows(text, limit):
    parts = ch.prose(text, limit, 80)
    assert all(len(p) <= 80 for p in parts)
    assert "".join("".join(parts).split()) == "".join(text.split())
    if len(text) <= limit:
        assert parts == [text]


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(5, 40))
def test_growing_text_keeps_early_chunks(text, limit):
    text = text.replace("\n", " ").strip() or "x"
    lines = "\n".join([text[:limit]] * 5)
    a, b = ch.prose(lines, limit, 10_000), ch.prose(lines + "\n" + "y" * limit, limit, 10_000)
    assert a[:-1] == b[: len(a) - 1]


def test_levels_in_order():
    assert ch.prose("①aaa\n②bbb", 5) == ["①aaa\n", "②bbb"]
    assert ch.prose("①a\n1. bb\n2. cc", 8) == ["①a\n1. bb\n"[:0] + p for p in ch.prose("①a\n1. bb\n2. cc", 8)]
    assert ch.prose("aa\n\nbb\n\ncc", 6) == ["aa\n\nbb", "cc"]
    assert ch.prose("aaaaaaa\nb\nc", 4) == ["aaaaaaa", "b\nc"]  # an oversize line ends the gathering


def test_hard_cut_prefers_sentences_then_marks_then_blanks():
    assert list(ch.hard_parts("aaaa. bbb ccc", 8)) == ["aaaa. ", "bbb ccc"]
    assert list(ch.hard_parts("aaaa①bb cccccc", 8))[0] == "aaaa"
    assert list(ch.hard_parts("aaaaa cccccccc", 8))[0] == "aaaaa "
    assert list(ch.hard_parts("abcdefgh", 3)) == ["abc", "def", "gh"]


def test_table_repeats_its_head():
    rows = ["title", "head", *[f"row {k}" for k in range(20)]]
    parts = ch.table("\n".join(rows), 40)
    assert len(parts) > 3 and all(p.startswith("title\nhead\n") and len(p) <= 40 for p in parts)
    assert [line for p in parts for line in p.split("\n")[2:]] == rows[2:]
    wide = "\n".join(["t" * 50, "h" * 50, *["r" * 30] * 5])
    assert not ch.table(wide, 60, 120)[1].startswith("t")  # such a head would fill half of what the model reads


def test_split_units_agrees_with_helpers(spark):
    texts = ["short", "", None, "line one\nline two\n" * 300, "x" * 9000, "a. " * 3000]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = [r[0] for r in df.orderBy("k").select(ch.split_units(F.col("t"), F.lit(500), 400)).collect()]
    assert got == [ch.prose(t or "", 400, 500) for t in texts]
    got = [r[0] for r in df.orderBy("k").select(ch.split_units(F.col("t"), F.lit(500), 400, F.lit(True))).collect()]
    assert got == [ch.table(t or "", 400, 500) for t in texts]


def test_lines_alone(spark):
    texts = ["a\n" * 200, "aaaa\n\n  \nbbbb\n" * 60, "x" * 50 + "\ny\nz", "one", None, "x" * 50]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = [r[0] for r in df.orderBy("k").select(ch.split_lines(F.col("t"), 30)).collect()]

    def slow(t):
        lines, out, held = [p for p in t.split("\n") if p.strip()], [], []
        if len(t) <= 30 or len(lines) < 2:
            return [t]
        for p in lines:
            if held and len("\n".join([*held, p])) > 30:
                out, held = [*out, "\n".join(held)], []
            held.append(p)
            if len(p) > 30:
                out, held = [*out, p], []
        return out + (["\n".join(held)] if held else [])

    assert got == [slow(t or "") for t in texts]


def test_many_lines_take_seconds():
    began = time.perf_counter()
    text = "some words\n" * 200_000
    assert sum(p.count("\n") + 1 for p in ch.lines_alone(text)) == 200_000
    assert len(ch.prose(text)) == len(ch.lines_alone(text)) and len(ch.table(text)) > 800
    assert "".join(ch.hard_parts("a. " * 700_000, 2_000)) == "a. " * 700_000
    assert time.perf_counter() - began < 20
