"""Operator 4, chat formatting: a template compiler.

A template has text, {{ expression }}, {% for x in xs %}, {% if %}/{% elif %}/{% else %} and {% generation %} blocks.
Expressions are literals, names, fields (x.role), ==, !=, <, in, and, or, not, +, a if c else b, and filters
(x|escape); anything else is refused, so a template can reach nothing but what it is given. The syntax tree has its
constants folded (constant conditions choose their branch, neighbouring texts join) and becomes Python closures that
render lazily: a conversation's turns stream through, and each piece of text knows whether the model should learn it.

The escape filter puts a backslash after the first character of every control string inside a text, and doubles
backslashes; unescaping takes one backslash off. Formatted conversations are written in parts of whole turns.

`and` and `or` give the operand that decides, as Python's do. A fault of a template (a tag without an expression, a
second else, operands that don't add up, a missing name or field) is a TemplateError.

Null text or role: empty. Rows of a conversation go by turn (nulls first), then role and text; equal rows are turns
of their own. Rows with a null conv_id make one conversation. A conversation's turns stream through one task, as its
digests run over them in order; memory doesn't grow with it. An empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import ast
import hashlib
import itertools
import operator
import re
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.common import materialize

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_COMPARE = {ast.Eq: operator.eq, ast.NotEq: operator.ne, ast.Lt: operator.lt, ast.LtE: operator.le, ast.Gt: operator.gt, ast.GtE: operator.ge,
            ast.In: lambda a, b: a in b, ast.NotIn: lambda a, b: a not in b}
PART_CHARS = 1 << 16


class TemplateError(ValueError):
    pass


class _Const:
    """A folded expression."""

    def __init__(self, value):
        self.value = value

    def __call__(self, env):
        return self.value


def _expression(tree: ast.AST, filters: dict[str, Callable]) -> Callable:
    def fold(f: Callable, *parts: Callable) -> Callable:
        try:
            return _Const(f({})) if all(isinstance(p, _Const) for p in parts) else f
        except (TypeError, AttributeError) as e:
            raise TemplateError(str(e)) from e

    def go(t: ast.AST) -> Callable:
        if isinstance(t, ast.Constant) and isinstance(t.value, str | int | bool | None):
            return _Const(t.value)
        if isinstance(t, ast.Name):
            return lambda env, name=t.id: _look(env, name)
        if isinstance(t, ast.Attribute):
            inner = go(t.value)
            if t.attr.startswith("_"):
                raise TemplateError(f"no such field: {t.attr}")
            return lambda env, name=t.attr: _look(inner(env), name)
        if isinstance(t, ast.BoolOp):
            parts = [go(v) for v in t.values]
            stop = isinstance(t.op, ast.Or)  # a part whose truth is this one decides
            kept = []
            for p in parts:
                known = isinstance(p, _Const)
                if not known or bool(p.value) == stop or p is parts[-1]:
                    kept.append(p)
                if known and bool(p.value) == stop:
                    break

            def decide(env):
                for p in kept:
                    v = p(env)
                    if bool(v) == stop:
                        break
                return v

            return kept[0] if len(kept) == 1 else fold(decide, *kept)
        if isinstance(t, ast.UnaryOp) and isinstance(t.op, ast.Not):
            inner = go(t.operand)
            return fold(lambda env: not inner(env), inner)
        if isinstance(t, ast.Compare) and len(t.ops) == 1 and type(t.ops[0]) in _COMPARE:
            a, b, f = go(t.left), go(t.comparators[0]), _COMPARE[type(t.ops[0])]
            return fold(lambda env: f(a(env), b(env)), a, b)
        if isinstance(t, ast.IfExp):
            test, a, b = go(t.test), go(t.body), go(t.orelse)
            if isinstance(test, _Const):
                return a if test.value else b
            return lambda env: a(env) if test(env) else b(env)
        if isinstance(t, ast.BinOp) and isinstance(t.op, ast.Add):
            a, b = go(t.left), go(t.right)
            return fold(lambda env: a(env) + b(env), a, b)
        if isinstance(t, ast.BinOp) and isinstance(t.op, ast.BitOr) and isinstance(t.right, ast.Name):
            if t.right.id not in filters:
                raise TemplateError(f"no such filter: {t.right.id}")
            a, f = go(t.left), filters[t.right.id]
            return fold(lambda env: f(a(env)), a)
        raise TemplateError(f"not allowed: {type(t).__name__}")

    return go(tree)


def _look(held, name: str):
    try:
        return held[name]
    except (KeyError, TypeError, IndexError) as e:
        raise TemplateError(f"no such name: {name}") from e


class Template:
    """A compiled template. render(**names) yields (text, learn) pieces; (None, False) after each turn of an outermost loop."""

    def __init__(self, source: str, filters: dict[str, Callable] | None = None):
        self.filters = {"trim": str.strip, "upper": str.upper, "lower": str.lower} | (filters or {})
        tokens = []
        at = 0
        for m in _TAG.finditer(source):
            tokens += [("text", source[at : m.start()]), ("out", m[1].strip()) if m[1] is not None else ("tag", m[2].strip())]
            at = m.end()
        tokens.append(("text", source[at:]))
        self._tokens = iter([t for t in tokens if t[0] != "text" or t[1]])
        self.tree, end = self._block(set())
        self._run = self._compile(self.tree, True)

    def _parse(self, text: str) -> Callable:
        try:
            return _expression(ast.parse(text, mode="eval").body, self.filters)
        except SyntaxError as e:
            raise TemplateError(text) from e

    def _block(self, ends: set[str]) -> tuple[list, str]:
        """Nodes up to one of the closing tags, and that tag."""
        out: list = []

        def text(s: str):
            if out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + s)
            elif s:
                out.append(("text", s))

        for kind, what in self._tokens:
            if kind == "text":
                text(what)
            elif kind == "out":
                e = self._parse(what)
                text(str(e.value)) if isinstance(e, _Const) else out.append(("out", e))
            elif (word := what.split(None, 1)[0] if what else "") in ends:
                return out, what
            elif word == "generation":
                body, _ = self._block({"endgeneration"})
                out.append(("generation", body))
            elif m := re.fullmatch(r"for\s+([A-Za-z]\w*)\s+in\s+(.+)", what, re.S):
                body, _ = self._block({"endfor"})
                out.append(("for", m[1], self._parse(m[2]), body))
            elif word == "if":
                sides, tag = [], what
                while tag != "endif":
                    if tag != "else" and len(tag.split(None, 1)) < 2:
                        raise TemplateError(f"no condition: {tag}")
                    test = _Const(True) if tag == "else" else self._parse(tag.split(None, 1)[1])
                    body, tag = self._block({"endif"} if tag == "else" else {"elif", "else", "endif"})
                    sides.append((test, body))
                sides = [s for s in sides if not (isinstance(s[0], _Const) and not s[0].value)]
                first = next((k for k, s in enumerate(sides) if isinstance(s[0], _Const)), None)
                sides = sides[: first + 1] if first is not None else sides
                if sides and isinstance(sides[0][0], _Const):
                    for node in sides[0][1]:
                        text(node[1]) if node[0] == "text" else out.append(node)
                elif sides:
                    out.append(("if", sides))
            else:
                raise TemplateError(f"unknown or misplaced tag: {what}")
        if ends:
            raise TemplateError(f"missing {' or '.join(sorted(ends))}")
        return out, ""

    def _compile(self, nodes: list, outermost: bool) -> Callable:
        steps = [self._node(n, outermost) for n in nodes]

        def run(env, learn):
            for s in steps:
                yield from s(env, learn)

        return run

    def _node(self, node: tuple, outermost: bool) -> Callable:
        if node[0] == "text":
            return lambda env, learn, s=node[1]: ((s, learn),)
        if node[0] == "out":
            return lambda env, learn, e=node[1]: ((str(e(env)), learn),)
        if node[0] == "generation":
            inner = self._compile(node[1], False)
            return lambda env, learn: inner(env, True)
        if node[0] == "if":
            sides = [(test, self._compile(body, False)) for test, body in node[1]]
            return lambda env, learn: next((body(env, learn) for test, body in sides if test(env)), ())
        name, items, body = node[1], node[2], self._compile(node[3], False)

        def loop(env, learn):
            end = object()
            it = iter(items(env))
            item = next(it, end)
            k = 0
            while item is not end:
                after = next(it, end)
                yield from body(env | {name: item, "loop": {"first": k == 0, "last": after is end, "index": k + 1}}, learn)
                if outermost:
                    yield None, False
                item, k = after, k + 1

        return loop

    def render(self, **names) -> Iterator[tuple[str | None, bool]]:
        try:
            yield from self._run(names, False)
        except (TypeError, AttributeError) as e:
            raise TemplateError(str(e)) from e


# fixed values: the format's control strings, its template, and how its turns read back
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[TEXT]", "[/ROLE]")
TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text|escape }} [/INST]"
    "{% elif m.role == 'assistant' %}<s>{% generation %}{{ m.text|escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ m.role|escape }}[TEXT]{{ m.text|escape }}[/ROLE]{% endif %}"
    "{% endfor %}"
)
TURN = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>|\[ROLE\](?P<role>.*?)\[TEXT\](?P<text>.*?)\[/ROLE\]", re.S)
_CONTROL = re.compile("|".join([r"\\", *(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS)]))
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    # a control's backslash stands before its second character, a doubled one before a backslash
    return _ESCAPED.sub(r"\1", text)


@cache
def _template(source: str) -> Template:
    return Template(source, {"escape": escape})


def _stream(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in columns))


_PART = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("formatted", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _format(source: str, part_chars: int):
    def parts(conv, rows):
        messages = ({"role": role or "", "text": text or ""} for _, role, text in rows)
        pieces, spans, n, k = [], [], 0, 0
        for text, learn in _template(source).render(messages=messages):
            if text is None:
                if n >= part_chars:
                    yield {"conv_id": conv, "part": k, "formatted": "".join(pieces), "spans": spans}
                    pieces, spans, n, k = [], [], 0, k + 1
                continue
            if learn:
                spans.append({"start": n, "end": n + len(text)})
            pieces.append(text)
            n += len(text)
        if pieces or not k:
            yield {"conv_id": conv, "part": k, "formatted": "".join(pieces), "spans": spans}

    def run(batches):
        out, size = [], 0
        for conv, rows in itertools.groupby(_stream(batches, ("conv_id", "role", "text")), key=lambda r: r[0]):
            for p in parts(conv, rows):
                out.append(p)
                size += len(p["formatted"])
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(out, _PART)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, _PART)

    return run


def format_conversations(turns: DataFrame, source: str = TEMPLATE, part_chars: int = PART_CHARS) -> DataFrame:
    """conv_id, part, formatted, spans (start and end of each learned stretch, in code points of the part)."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = rows.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text")
    return rows.mapInArrow(_format(source, part_chars), "conv_id long, part int, formatted string, spans array<struct<start: int, end: int>>")


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a part in the default format."""
    at = 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text between turns")
        at = m.end()
        kind = m.lastgroup
        yield (unescape(m["role"]), unescape(m["text"])) if kind == "text" else (kind, unescape(m[kind]))
    if at != len(formatted):
        raise ValueError("text after the last turn")


def _digest(batches):
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    out = []
    for conv, rows in itertools.groupby(_stream(batches, ("conv_id", "formatted", "spans")), key=lambda r: r[0]):
        turns, loss, n, learned, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        for _, formatted, spans in rows:
            size += len(formatted)
            for role, text in parse_turns(formatted):
                n += 1
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for s in spans:
                text = unescape(formatted[s["start"] : s["end"]])
                learned += len(text)
                loss.update(text.encode("utf-8", "surrogatepass"))
        out.append({"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": learned, "loss_sha256": loss.hexdigest(), "formatted_chars": size})
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def conversation_digests(parts: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its formatted parts."""
    rows = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return rows.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return conversation_digests(materialize(format_conversations(turns.unionByName(extra)), "formatted"))


def _sql_escaped() -> str:
    text = "replace(text, '\\', '\\\\')"
    for c in CONTROLS:
        text = f"replace({text}, '{c}', '{c[0]}\\{c[1:]}')"
    return text


OP4_SQL = f"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -1, k, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(k, r)),
e AS (SELECT *, length({_sql_escaped()}) + CASE role WHEN 'user' THEN length('[INST]  [/INST]') WHEN 'assistant' THEN length('<s></s>') ELSE length(role) + length('[ROLE][TEXT][/ROLE]') END AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
