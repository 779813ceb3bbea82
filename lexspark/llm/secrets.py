"""Operator 7, secret scans: a trigram inverted index in front of regular expressions, in DataFrame functions only.

Each rule's expression gives a Boolean query over trigrams of lower-cased text (alternatives of sets that must all
occur). The index has postings for the trigrams that some query names; a document is a candidate of a rule if one
alternative's postings all hold it. Candidates are verified by the expression itself; a rule without mandatory
trigrams is verified on every document. A match's place follows from the lengths of matches and of gaps between them,
in code points, summed in blocks: a text of n matches takes n**1.5 steps at most. Candidates are written before they
are joined: few are broadcast by their size as Spark finds it, so texts move only where they are many.

Null text counts as empty. Null or repeated ids: rows are told apart by the text's hash, equal rows give equal
results. Spans of one kind never overlap; those of different kinds may. An empty table gives an empty result. Extra
columns are kept by `redact` and ignored elsewhere.
Document ids are 64-bit integers, or strings of such; another id ends in CAST_INVALID_INPUT.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.common import materialize, unused

_ANY = frozenset([frozenset()])


@dataclass(frozen=True)
class Rule:
    """pattern: in the syntax that Java and Python share. A match is kept if its group has `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    quick: str | None = None  # an expression that every kept match holds, cheaper to look for
    query: frozenset = field(default=_ANY)


def _absorb(q: set[frozenset]) -> frozenset:
    return frozenset(a for a in q if not any(b < a for b in q))


def _both(a: frozenset, b: frozenset) -> frozenset:
    return _absorb({x | y for x in a for y in b})


def _needs(words: set[str]) -> frozenset:
    return _absorb({frozenset(w[k : k + 3] for k in range(len(w) - 2)) for w in words})


def trigram_query(pattern: str, most: int = 64) -> frozenset:
    """Alternatives (sets of trigrams) of which any match holds one whole, in lower case. {{}}: nothing is mandatory."""
    parser = re._parser

    def walk(items) -> tuple[set[str] | None, frozenset]:
        """All strings that the items match, if they are few; and a query."""
        exact, query, whole = {""}, _ANY, True

        def flush():
            nonlocal exact, query, whole
            query, exact, whole = _both(query, _needs(exact)), {""}, False

        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                part = {chr(arg).lower()}
            elif name == "IN":
                chars = [chr(a).lower() for o, a in arg if str(o) == "LITERAL"]
                part = set(chars) if len(chars) == len(arg) and len(chars) <= 8 else None
            elif name == "SUBPATTERN":
                part, inner = walk(arg[3])
                query = _both(query, inner)
            elif name == "BRANCH":
                sides = [walk(x) for x in arg[1]]
                part = set().union(*(s[0] for s in sides)) if all(s[0] is not None for s in sides) else None
                if part is None:
                    query = _both(query, _absorb({y for s in sides for y in (_both(s[1], _needs(s[0])) if s[0] else s[1])}))
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                low, high, inner = arg
                once, needs = walk(inner)
                if once is not None and (low, high) == (0, 1):
                    part = once | {""}
                elif once is not None and low == high and len(once) ** low <= most:
                    part = {""}
                    for _ in range(low):
                        part = {a + b for a in part for b in once}
                else:
                    part = None
                    if low and once is not None:
                        exact = {a + b for a in exact for b in once}
                    elif low:
                        query = _both(query, needs)
            elif name == "AT":
                continue
            else:
                part = None
            if part is None or len(exact) * len(part) > most:
                flush()
            if part is not None:
                exact = {a + b for a in exact for b in part} if len(exact) * len(part) <= most else {""}
        return (exact, query) if whole else (None, _both(query, _needs(exact)))

    exact, query = walk(parser.parse(pattern))
    return query if exact is None else _both(query, _needs(exact))


def rule(kind: str, pattern: str, group: int = 0, least: int = 0, quick: str | None = None) -> Rule:
    return Rule(kind, pattern, group, least, quick, trigram_query(pattern))


# fixed values: the base kinds, in order
BASE = (
    rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    rule("hex", r"[0-9a-f]{16,}", 0, 16, r"[0-9a-f]{16}"),
)
# kinds added to the base ones
ADDED = (
    rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    rule("slack", r"xox[abpr]-[A-Za-z0-9-]{10,}"),
    rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
)
RULES = BASE + ADDED
_SPAN = "array<struct<start: int, rank: int, kind: string, end: int>>"


def _row(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _let(value: Column, f) -> Column:
    """f(value), the value being worked out once however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _sqrt_blocks(a: Column) -> Column:
    """The array in consecutive blocks of about the square root of its length."""
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(a))).cast("int"))
    last = F.floor((F.size(a) - 1) / size).cast("int")
    return F.when(F.size(a) > 0, F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(a, b * size + 1, size)))


def _with_prefix(a: Column, value, combine, then) -> Column:
    """Blocks of (base, items): items are then(element, prefix), the prefix being combine over value of all before it; base is the prefix of the block's first. Null for an empty array.

    Appending to an array copies it, so one running total over n elements would take n**2 steps; blocks take n**1.5.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    bases = lambda blocks: F.aggregate(blocks, start, lambda s, x: F.struct(combine(s["at"], x["t"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    def inside(b: Column) -> Column:
        first = F.get(b["b"], F.lit(0))
        start = F.struct(combine(b["base"], value(first)).alias("at"), F.array(then(first, b["base"])).alias("out"))
        return F.aggregate(F.slice(b["b"], 2, F.size(b["b"])), start, lambda s, x: F.struct(combine(s["at"], value(x)).alias("at"), F.concat(s["out"], F.array(then(x, s["at"]))).alias("out")),
                           lambda s: F.struct(b["base"].alias("base"), s["at"].alias("end"), s["out"].alias("items")))

    blocks = F.transform(_let(a, _sqrt_blocks), lambda b: F.struct(b.alias("b"), F.aggregate(b, F.lit(0), lambda t, x: combine(t, value(x))).alias("t")))
    return _let(blocks, lambda blocks: F.transform(F.arrays_zip(F.transform(blocks, lambda x: x["b"]).alias("b"), bases(blocks).alias("base")), inside))


def trigram_index(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (t, doc_id, row): t is a place in trigrams, which the text holds whatever its letters' case."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _row(text_col).alias("row"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(k)) for k, t in enumerate(trigrams)]))
    # outer: Spark would put a test of the array's size first, and look for every trigram twice
    return rows.select(F.explode_outer(held).alias("t"), "doc_id", "row").where("t is not null")


def candidates(index: DataFrame, trigrams: list[str], rules: tuple[Rule, ...]) -> DataFrame:
    """doc_id, row, and for each rule with mandatory trigrams a column c<k>: some alternative's postings all hold the document."""
    at = {t: k for k, t in enumerate(trigrams)}
    words = -(-len(trigrams) // 60)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("t") % 60)
    masks = [F.bit_or(F.when(F.floor(F.col("t") / 60) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"m{w}") for w in range(words)]
    seen = index.groupBy("doc_id", "row").agg(*masks)

    def holds(alternative: frozenset) -> Column:
        need = [sum(1 << (at[t] % 60) for t in alternative if at[t] // 60 == w) for w in range(words)]
        return reduce(lambda a, b: a & b, [F.col(f"m{w}").bitwiseAND(F.lit(n)) == n for w, n in enumerate(need) if n])

    flags = {f"c{k}": reduce(lambda a, b: a | b, map(holds, r.query)) for k, r in enumerate(rules) if r.query != _ANY}
    out = seen.select("doc_id", "row", *[c.alias(n) for n, c in flags.items()])
    return out.where(reduce(lambda a, b: a | b, map(F.col, flags)))


def _spans(text: Column, r: Rule, rank: int) -> Column:
    """Kept matches of one rule in text, in order."""
    found = F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0))
    gaps = F.transform(F.split(text, r.pattern, -1), lambda g: F.length(g))
    parts = _let(found, lambda m: F.arrays_zip(m.alias("m"), F.regexp_extract_all(text, F.lit(r.pattern), F.lit(r.group)).alias("g"), F.slice(gaps, F.lit(1), F.size(m)).alias("gap")))
    parts = F.transform(parts, lambda p: F.struct(F.length(p["m"]).alias("m"), F.length(p["g"]).alias("g"), p["gap"].alias("gap")))

    def span(p: Column, at: Column) -> Column:
        begin = at + p["gap"]
        return F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(r.kind).alias("kind"), (begin + p["m"]).alias("end"), (p["g"] >= r.least).alias("kept"))

    placed = _with_prefix(parts, lambda p: p["gap"] + p["m"], lambda t, x: t + x, span)
    spans = F.filter(F.flatten(F.transform(placed, lambda b: b["items"])), lambda x: x["kept"])
    spans = F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["kind"].alias("kind"), x["end"].alias("end")))
    return F.coalesce(spans, F.array().cast(_SPAN))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", out: str = "secret_spans") -> DataFrame:
    """docs with a column `out`: array of (start, rank, kind, end) by start, then rule. A column of that name is replaced."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()])
    trigrams = sorted({t for r in rules for a in r.query for t in a})
    text = F.coalesce(F.col(text_col), F.lit(""))
    flags = {k: n for k, n in enumerate(unused(docs, *[f"c{k}" for k in range(len(rules))]))}
    rows = docs
    if trigrams:
        hits = candidates(materialize(trigram_index(docs, trigrams, id_col, text_col), "postings"), trigrams, rules)
        doc, hit = unused(docs, "hit_doc", "hit_row")
        hits = materialize(hits.withColumnsRenamed({"doc_id": doc, "row": hit} | {f"c{k}": n for k, n in flags.items()}), "candidates", "uncompressed")  # its size on disk tells its size in memory
        rows = rows.join(hits, F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (_row(text_col) == F.col(hit)), "left")
    none = F.array().cast(_SPAN)
    found = []
    for k, r in enumerate(rules):
        maybe = F.col(flags[k]) if r.query != _ANY else F.lit(True)
        if r.quick:
            maybe = maybe & F.rlike(text, F.lit(r.quick))
        found.append(F.when(maybe, _spans(text, r, k)).otherwise(none))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.sort_array(F.concat(*found)).alias(out))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every secret in the text replaced by [SECRET]; overlapping secrets by one."""
    text, (spans,) = F.col(text_col), unused(docs, "secret_spans")
    # each span with the end of those before it; the text is cut into the blocks' stretches first, as a substring's cost grows with its place
    blocks = _with_prefix(F.col(spans), lambda x: x["end"], F.greatest, lambda x, at: F.struct(x["start"].alias("start"), at.alias("before")))

    def block(b: Column) -> Column:
        stretch = F.substring(text, b["base"] + 1, b["end"] - b["base"])
        piece = lambda x, s: F.when(x["start"] >= x["before"], F.concat(F.substring(s, x["before"] - b["base"] + 1, x["start"] - x["before"]), F.lit("[SECRET]"))).otherwise("")
        return F.array_join(_let(stretch, lambda s: F.transform(b["items"], lambda x: piece(x, s))), "")

    last = F.aggregate(spans, F.lit(0), lambda t, x: F.greatest(t, x["end"]))
    done = F.concat(F.array_join(F.transform(blocks, block), ""), F.substring(text, last + 1, F.length(text)))
    found = scan(docs, rules, id_col, text_col, spans)
    return found.select(*[(F.when(F.size(spans) > 0, done).otherwise(text).alias(c) if c.lower() == text_col.lower() else F.col(f"`{c}`")) for c in docs.columns])


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    spans, base = F.col("secret_spans"), F.filter("secret_spans", lambda s: s["rank"] < len(BASE))

    def joined(a: Column) -> Column:
        return F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def n(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(docs).select("doc_id", *[n(r.kind) for r in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))
