"""Operator 8, language identification: prediction by partial matching.

Each language has a byte context tree of variable order (up to four bytes of context). A symbol that a context has
seen c times in n, among d kinds, costs -log2(c / (n + d)); one it hasn't costs the escape -log2(d / (n + d)) and is
looked for in the next shorter context, down to 1/256 for any byte. Contexts that a language never saw cost nothing.
The statistics are frozen once learned, so a text's code length is an exact sum over its bytes, found here for all
languages at once: the costs of every gram that some language saw, and of every context's escape, are tabled.

The trees are learned from a sample of labelled rows: distinct rows in the order of a hash of id and text, until `sample_bytes` of
a language are reached (repeated rows count as often as they come) (2 MB by default, less where `total_bytes` is shared by many languages), whatever the table's
size; of one text that many characters at most. Every byte of every text is scored. A label column of more than
MOST_LABELS values is refused with a ValueError: it holds no languages.

Languages are tabled in groups of GROUP: a gram has a row in the groups of the languages that saw it, so that the tables
grow with what was seen and not with grams times languages.

Null text or a text without letters: `und`, score 0. Null ids are predicted, never learned from. Ties: the first
language in order. Without labelled rows all texts are `und`. Repeated rows each get a row; extra columns are ignored
unless kept. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.llm.bpe import _Table
from lexspark.llm.common import tidy, unused

ORDER = 4
SAMPLE_BYTES = 2_000_000
TOTAL_BYTES = 128_000_000
GROUP = 4
MOST_LABELS = 100_000  # a label column of more values holds no languages
_PAD = b" " * ORDER


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the texts, it and the four before it as one number (texts begin after spaces); starts of texts in that array."""
    blobs = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    code = np.frombuffer(b"".join(x for b in blobs for x in (_PAD, b)), np.uint8).astype(np.uint64)
    g = code[ORDER:].copy() if len(code) > ORDER else np.empty(0, np.uint64)
    for k in range(1, ORDER + 1):
        g |= code[ORDER - k : len(code) - k] << np.uint64(8 * k)
    n = np.fromiter(map(len, blobs), np.int64, len(blobs))
    real = np.ones(len(g), bool)
    at = np.cumsum(n + ORDER) - ORDER  # the next text's pad
    for k in range(ORDER):
        real[at[:-1] - 0 + k] = False
    return g[real[: len(g)]], np.concatenate([[0], np.cumsum(n)])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        by: dict[tuple[int, int], list[str]] = {}
        for code, copies, text in zip(b.column("code").to_pylist(), b.column("copies").to_pylist(), b.column("text").to_pylist()):
            by.setdefault((code, copies), []).append(text)
        for (code, copies), texts in by.items():
            kinds, n = np.unique(_grams(texts)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kinds), code), pa.int32()), pa.array(kinds.astype(np.int64)), pa.array(n * copies, pa.int64())], ["code", "g", "n"])


def _hash(g: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (g + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))


class _Group:
    """Frozen costs: for grams of each length 1..ORDER+1 and contexts of each length 1..ORDER, one row of bits a language."""

    def __init__(self, langs: list[str], which: np.ndarray, full: np.ndarray, n: np.ndarray):
        """Language, gram and count of each pair that was seen."""
        self.langs = langs
        size = len(langs)
        shorter = np.full((256, size), 8.0)  # no context: any byte costs eight bits
        shorter_keys = np.arange(256, dtype=np.uint64)
        self.grams, self.escapes = [], []
        for length in range(1, ORDER + 2):
            mask = np.uint64((1 << (8 * length)) - 1)
            keys, at = np.unique(full & mask, return_inverse=True)
            c = np.zeros((len(keys), size))
            np.add.at(c, (at, which), n)
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total = np.zeros((len(contexts), size))
            kinds = np.zeros((len(contexts), size))
            np.add.at(total, of, c)
            np.add.at(kinds, of, c > 0)
            known = total > 0
            escape = np.where(known, -np.log2(np.where(known, kinds / np.maximum(total + kinds, 1), 1)), 0.0)
            below = np.searchsorted(shorter_keys, keys & (mask >> np.uint64(8)) if length > 1 else keys)
            own = -np.log2(np.where(c > 0, c / np.maximum((total + kinds)[of], 1), 1))
            cost = np.where(c > 0, own, escape[of] + shorter[below])
            if length == 1:  # every byte has a row
                every = escape[0] + np.full((256, size), 8.0) if len(contexts) else np.full((256, size), 8.0)
                every[keys.astype(np.int64)] = cost
                cost, keys = every, np.arange(256, dtype=np.uint64)
            self.grams.append((keys, cost.astype(np.float32)))
            self.escapes.append((contexts, escape.astype(np.float32)))
            shorter, shorter_keys = cost, keys
        self._tables = None

    def __getstate__(self):
        return self.__dict__ | {"_tables": None}

    def _ready(self):
        if self._tables is None:
            def table(keys):
                t = _Table(max(12, int(len(keys)).bit_length() + 2))
                t.add(_hash(keys))
                return t

            self._tables = [(table(g[0]), table(e[0])) for g, e in zip(self.grams, self.escapes)]
        return self._tables

    def code_lengths(self, texts: list[str | None]) -> np.ndarray:
        """Bits that each whole text takes under each language."""
        g, cut = _grams(texts)
        tables = self._ready()
        out = np.zeros((len(texts), len(self.langs)))
        if not len(g):
            return out
        sums = np.zeros((len(g), len(self.langs)), np.float32)
        left = np.arange(len(g))
        for length in range(ORDER + 1, 1, -1):
            keys = g[left] & np.uint64((1 << (8 * length)) - 1)
            row = tables[length - 1][0].find(_hash(keys))
            hit = row >= 0
            sums[left[hit]] += self.grams[length - 1][1][row[hit]]
            left, keys = left[~hit], keys[~hit]
            row = tables[length - 1][1].find(_hash(keys >> np.uint64(8)))
            hit = row >= 0
            sums[left[hit]] += self.escapes[length - 1][1][row[hit]]
        sums[left] += self.grams[0][1][(g[left] & np.uint64(255)).astype(np.int64)]
        some = np.flatnonzero(np.diff(cut))
        out[some] = np.add.reduceat(sums, cut[some], axis=0, dtype=np.float64)
        return out


class Model:
    """The languages' groups, in order."""

    def __init__(self, langs: list[str], which: np.ndarray, full: np.ndarray, n: np.ndarray):
        """Language, gram and count of each pair that was seen."""
        self.langs, self.groups = langs, []
        order = np.argsort(which, kind="stable")
        which, full, n = which[order], full[order], n[order]
        for first in range(0, len(langs), GROUP):
            at = slice(*np.searchsorted(which, [first, first + GROUP]))
            self.groups.append(_Group(langs[first : first + GROUP], which[at] - first, full[at], n[at]))

    def code_lengths(self, texts: list[str | None]) -> np.ndarray:
        """Bits that each whole text takes under each language."""
        return np.concatenate([g.code_lengths(texts) for g in self.groups], axis=1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language (or und), score and bits a byte of the best language."""
        names, score, rate = [], np.zeros(len(texts)), np.zeros(len(texts))
        first, held, groups = 0, 0, []
        for k, t in enumerate(texts):
            held += len(t or "")
            if held > 1 << 19:
                groups.append((first, k + 1))
                first, held = k + 1, 0
        groups.append((first, len(texts)))
        for i, j in groups:
            part = texts[i:j]
            if not part:
                continue
            bits = self.code_lengths(part) if self.langs else np.zeros((len(part), 0))
            for k, t in enumerate(part):
                if not self.langs or not t or not any(map(str.isalpha, t)):
                    names.append("und")
                    continue
                b = bits[k]
                best = int(b.argmin())
                names.append(self.langs[best])
                score[i + k] = 1 / np.exp2(np.maximum(b[best] - b, -1000)).sum()
                rate[i + k] = b[best] / max(1, len(t.encode("utf-8", "surrogatepass")))
        return names, score, rate


def learn(docs: DataFrame, where: Column, sample_bytes: int = SAMPLE_BYTES, total_bytes: int = TOTAL_BYTES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from the labelled rows that `where` admits."""
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), where.alias("w")).where("w and lang is not null and text <> '' and i is not null")
    draw = F.shiftrightunsigned(F.xxhash64("i", "text", F.lit("sample")), 2)  # 62 bits, whatever the table's size
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"), F.min(draw).alias("first")).limit(MOST_LABELS + 1).collect()
    if len(sizes) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} values of {lang_col}: not a language column")
    if not sizes:
        return Model([], np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0))
    most = max(1, min(sample_bytes, total_bytes // len(sizes)))
    # half as many bytes again as are wanted, at least the first draw (a language of few long texts has it, if nothing else)
    below = {r["lang"]: max(r["first"], int(min(1.0, 1.5 * most / max(1, r["bytes"])) * (1 << 62))) for r in sizes}
    spark, langs = docs.sparkSession, sorted(below)
    shares = F.broadcast(spark.createDataFrame([(x, k, below[x]) for k, x in enumerate(langs)], "lang string, code int, below long"))  # at most MOST_LABELS rows
    drawn = rows.withColumn("draw", draw).join(shares, "lang").where("draw <= below").select("code", "draw", F.substring("text", 1, most).alias("text")).groupBy("code", "draw").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    before = Window.partitionBy("code").orderBy("draw").rowsBetween(Window.unboundedPreceding, -1)
    sample = drawn.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0))).where(F.col("before") < most).select("code", "copies", "text")
    # grams of a sample of bounded bytes: bounded as well
    counts = sample.mapInArrow(tidy(_count_grams), "code int, g long, n long").groupBy("code", "g").agg(F.sum("n").alias("n")).toArrow()
    return Model(langs, counts.column("code").to_numpy().astype(np.int64), counts.column("g").to_numpy().astype(np.uint64), counts.column("n").to_numpy().astype(np.float64))


def _predict(model, text: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            lang, score, rate = m.predict(b.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), pa.array(lang, pa.string()), pa.array(score), pa.array(rate)], [*keep, "lang_pred", "score", "bits_per_byte"])

    return run


def identify(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns of keep, lang_pred, score (0 to 1) and bits_per_byte of every row. Columns of keep with these names are left out."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)
    keep = [c for c in keep if c.lower() not in ("lang_pred", "score", "bits_per_byte")]
    (text,) = unused(docs, "text")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias(text))
    schema = rows.drop(text).schema.add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    return rows.mapInArrow(tidy(_predict(held, text, keep)), schema)


def known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs, with their own columns alone, whose text is in some language."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, _, _ = held.value.predict(b.column(text_col).to_pylist())
            yield b.filter(pa.array([x != "und" for x in lang], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)


def lettered(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text has a letter; needs no model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([any(map(str.isalpha, t or "")) for t in b.column(text_col).to_pylist()], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 3; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs, fold() != 1)
    out = identify(docs, model, ["doc_id"])
    return out.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "bits_per_byte")
