"""Splitting of units into chunks: at structure first, then lines, and at last anywhere, without losing a character.

Every split works on lengths and offsets: the places where a text may break are collected once, and a running sum of
lengths tells by bisection how far each chunk reaches. So a text of any number of lines takes time in proportion.
Texts within the limit stay whole in a native expression; only the longer ones visit an Arrow function.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate, groupby

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_CHARS, MODEL_CHARS, HEADER_LINES = 2_500, 8_184, 2
HELD_CHARS = 1 << 21  # of chunks that a Python worker makes before it hands them over
# fixed values: where units break (circled paragraph, numbered item, blank line, line) and what joins the pieces again
LEVELS = (
    (re.compile(r"(?m)(?=^[ \t]*[①-⑳㉑-㉚])"), ""),
    (re.compile(r"(?m)(?=^[ \t]*\d{1,3}\.[ \t])"), ""),
    (re.compile(r"\n[ \t]*\n"), "\n\n"),
    (re.compile(r"\n"), "\n"),
)
# fixed values: preferred places of a hard cut, best first: behind a sentence, before an enumeration, behind white space
SENTENCE = re.compile("[.。!?！？;][\\s\"'”’)\\]】]*")
ENUMERATION = re.compile(r"[①-⑳㉑-㉚]|(?<!\d)\d{1,3}\.|[가-힣]\.")
BLANKS = re.compile(r"\s+")


class _Breaks:
    """Where a text may be cut: the matches of each pattern, in order."""

    def __init__(self, text: str):
        self.found = [([m.start() for m in found], [m.end() for m in found]) for found in (list(p.finditer(text)) for p in (SENTENCE, ENUMERATION, BLANKS))]

    def last(self, begin: int, low: int, high: int) -> int:
        """The best cut of a stretch from begin that lies within low and high; high where there is none."""
        (s_start, s_end), (e_start, e_end), (b_start, b_end) = self.found
        k = bisect_left(s_start, high) - 1
        if k >= 0 and s_start[k] >= begin and (at := min(s_end[k], high)) >= low:
            return at
        k = bisect_right(e_end, high) - 1
        if k >= 0 and e_start[k] >= low:
            return e_start[k]
        k = bisect_left(b_start, high) - 1
        if k >= 0 and (at := min(b_end[k], high)) >= low:
            return at
        return high


def hard_parts(text: str, limit: int) -> list[str]:
    """Consecutive slices of at most limit characters, each cut at the best place in its second half."""
    limit = max(1, limit)
    if len(text) <= limit:
        return [text]
    breaks, cuts = _Breaks(text), [0]
    while len(text) - cuts[-1] > limit:
        begin = cuts[-1]
        cuts.append(breaks.last(begin, begin + max(1, limit // 2), begin + limit))
    return [text[i:j] for i, j in zip(cuts, [*cuts[1:], len(text)])]


def limited(parts: list[str], limit: int) -> list[str]:
    """The parts, those beyond the limit cut."""
    return [x for p in parts for x in hard_parts(p, limit)]


def groups(sizes: list[int], glue: int, room: int) -> list[tuple[int, int]]:
    """Consecutive pieces that fit into room together, glue between; a piece too large stands alone."""
    reach = [0, *accumulate(n + glue for n in sizes)]
    out, i = [], 0
    while i < len(sizes):
        j = max(i + 1, bisect_right(reach, reach[i] + room + glue) - 1)
        out.append((i, j))
        i = j
    return out


def _joined(pieces: list[str], glue: str, limit: int) -> list[str]:
    return [glue.join(pieces[i:j]) for i, j in groups(list(map(len, pieces)), len(glue), limit)]


def _level(text: str, limit: int, level: int) -> list[tuple[str, int]] | None:
    """One level's chunks, each with the level at which it may be split further (the last for those that fit); None if nothing breaks at it."""
    pattern, glue = LEVELS[level]
    pieces = [p for p in pattern.split(text) if p.strip()]
    if len(pieces) < 2:
        return None
    out: list[tuple[str, int]] = []
    for large, run in groupby(pieces, lambda p: len(p) > limit):
        out += [(p, level + 1) for p in run] if large else [(p, len(LEVELS)) for p in _joined(list(run), glue, limit)]
    return out


def prose(text: str, limit: int = CHUNK_CHARS, hard: int = MODEL_CHARS) -> list[str]:
    """Chunks at the highest level of structure that breaks a text; chunks too large go down level by level."""
    done, todo = [], [(text, 0)]
    while todo:
        part, level = todo.pop()
        if level == len(LEVELS) or len(part) <= limit:
            done.append(part)
        else:
            todo += reversed(_level(part, limit, level) or [(part, level + 1)])
    return limited(done, hard)


def table(text: str, limit: int = CHUNK_CHARS, hard: int = MODEL_CHARS) -> list[str]:
    """Rows gathered under the repeated first two lines; without them where they would fill half of what the model reads."""
    lines = text.splitlines()
    head, rows = "\n".join(lines[:HEADER_LINES]), lines[HEADER_LINES:]
    if len(text) <= limit:
        parts = [text]
    elif rows and len(head) + 1 < max(2, hard) // 2:
        parts = ["\n".join([head, *rows[i:j]]) for i, j in groups(list(map(len, rows)), 1, limit - len(head) - 1)]
    else:
        parts, i = [], 0
        sizes = list(map(len, lines))
        while (i := next((k for k in range(i, len(lines)) if sizes[k]), len(lines))) < len(lines):  # a chunk begins with text
            reach = next(iter(groups(sizes[i : i + limit + 2], 1, limit)))[1]
            parts.append("\n".join(lines[i : i + reach]))
            i += reach
    return limited(parts, hard)


def lines_alone(text: str, limit: int = CHUNK_CHARS) -> list[str]:
    """The last level alone: lines gathered, blank ones dropped, one too long by itself."""
    found = _level(text, limit, len(LEVELS) - 1) if len(text) > limit else None
    return [p for p, _ in found] if found else [text]


def pieces(parts: Iterable[list[str]], most: int = HELD_CHARS) -> Iterator[list[list[str]]]:
    """The same lists in runs of about `most` characters, so that what is held at a time does not grow with a batch."""
    held, size = [], 0
    for p in parts:
        held.append(p)
        size += sum(map(len, p))
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


@F.pandas_udf(T.ArrayType(T.StringType()))
def _split_long(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for text, hard, limit, rows in batches:
        for held in pieces((table if r else prose)(t, int(n), int(h)) for t, h, n, r in zip(text, hard, limit, rows)):
            yield pd.Series(held)


def split_units(content: Column, hard: Column | None = None, limit: int = CHUNK_CHARS, is_table: Column | None = None) -> Column:
    """Chunks of a unit's content: array<string>. Null or empty content is one chunk."""
    content = F.coalesce(content, F.lit(""))
    hard = F.lit(MODEL_CHARS) if hard is None else hard
    is_table = F.lit(False) if is_table is None else is_table
    fits = (F.length(content) <= limit) & (F.length(content) <= hard)
    long = _split_long(F.when(fits, F.lit("")).otherwise(content), hard, F.lit(limit), is_table)
    return F.when(fits, F.array(content)).otherwise(long)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _lines_of_long(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for text, limit in batches:
        for held in pieces(lines_alone(t, int(n)) for t, n in zip(text, limit)):
            yield pd.Series(held)


def split_lines(content: Column, limit: int = CHUNK_CHARS) -> Column:
    """Chunks of whole lines: array<string>. Null content is one empty chunk."""
    content = F.coalesce(content, F.lit(""))
    fits = F.length(content) <= limit
    return F.when(fits, F.array(content)).otherwise(_lines_of_long(F.when(fits, F.lit("")).otherwise(content), F.lit(limit)))
