"""Operator 10, packing: cutting stock by column generation.

Documents are cut at every 2048th token; full pieces are sequences of their own. The other pieces are counted by
length, in steps of `step` tokens: a histogram of at most 2048/step classes, whatever the input's size. A linear
program over patterns (how many pieces of each class share a sequence) is solved on the driver from that histogram: a
knapsack dynamic program prices the columns, the entering pattern leaves by the ratio test. Patterns are used a whole
number of times, rounded down; what remains of each class (fewer pieces than patterns hold, so bounded by the number
of classes too) is placed largest first. Pieces are ranked within their class by partial sums over partitions, and a
piece's rank gives its pattern, the pattern's copy and the slot.

Null text: the end id alone. Null and repeated ids: every row is packed. An empty table gives an empty result. Extra
columns are ignored.
Document ids are 64-bit integers, or strings of such; another id ends in CAST_INVALID_INPUT.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.llm.bpe import encoder, vocabulary
from lexspark.llm.common import materialize, tidy

SEQUENCE, STEP, END_ID = 2048, 16, 1
_PIECES = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary, part int, cls int, local long"
_BATCH_TOKENS = 2_000_000


def _cut(path: str, kind: str, end_id: int, size: int, step: int, with_ids: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("part", pa.int32()), ("cls", pa.int32()), ("local", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(path, kind), TaskContext.get().partitionId()
        end, seen = np.array([end_id], enc.dtype), [0] * (size // step + 1)
        out: list[tuple] = []
        held = 0
        for b in batches:
            for doc, ids in zip(b.column("doc_id").to_pylist(), enc.batch(b.column("text").to_pylist())):
                ids = np.concatenate([ids, end])
                wide = ids.astype("<u4")
                for at in range(0, len(ids), size):
                    piece = ids[at : at + size]
                    c = -(-len(piece) // step)
                    out.append((doc, at, len(piece), len(ids), zlib.crc32(wide[at : at + size]), piece.tobytes() if with_ids else None, part, c, seen[c]))
                    seen[c] += 1
                held += len(ids)
                if held > _BATCH_TOKENS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _best_patterns(sizes: np.ndarray, worth: np.ndarray, capacity: int, most: int = 12) -> list[np.ndarray]:
    """Unbounded knapsack: multisets of sizes within capacity that are worth more than 1, the best of each first size, best first."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fit = np.searchsorted(sizes, np.arange(capacity + 1), "right").tolist()
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := fit[c]:
            v = best[c - sizes[:n]] + worth[:n]
            k = v.argmax()
            if v[k] > best[c]:
                best[c], pick[c] = v[k], k
    value = best[capacity - sizes] + worth
    out = []
    for k in np.argsort(-value)[:most].tolist():
        if value[k] <= 1 + 1e-7:
            break
        a, c = np.zeros(len(sizes)), int(capacity - sizes[k])
        a[k] = 1
        while c > 0:
            if pick[c] < 0:
                c -= 1
            else:
                a[pick[c]] += 1
                c -= int(sizes[pick[c]])
        out.append(a)
    return out


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int, most_rounds: int = 5000, patience: int = 40) -> list[tuple[int, np.ndarray]]:
    """(copies, pieces of each class) that together use every piece: column generation, rounding down, the rest largest first.

    Any basis met on the way is feasible; the search ends when `patience` rounds save less than a sequence in 20,000.
    """
    m = len(sizes)
    if not m:
        return []
    columns = [np.eye(m)[k] * (capacity // sizes[k]) for k in range(m)]
    inverse = np.diag([1 / c[k] for k, c in enumerate(columns)])
    x = inverse @ demand
    totals = [x.sum()]
    for _ in range(most_rounds):
        entered = False
        for a in _best_patterns(sizes, inverse.sum(0), capacity):  # every sequence costs one
            if inverse.sum(0) @ a <= 1 + 1e-7:  # another column took its worth
                continue
            d = inverse @ a
            ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
            out = int(ratio.argmin())
            if not np.isfinite(ratio[out]):
                continue
            t = ratio[out]
            x = np.maximum(x - t * d, 0)
            x[out] = t
            row = inverse[out] / d[out]
            inverse -= np.outer(d, row)
            inverse[out] = row
            columns[out] = a
            entered = True
        totals.append(x.sum())
        if not entered or len(totals) > patience and totals[-1] > totals[-1 - patience] * (1 - 5e-5):
            break
    left = demand.astype(np.int64).copy()
    plan = []
    for n, a in sorted(zip(x, columns), key=lambda p: -p[0]):
        a = a.astype(np.int64)
        n = int(n + 1e-6)
        n = min(n, int((left[a > 0] // a[a > 0]).min()))
        if n > 0:
            plan.append((n, a))
            left -= n * a
    bins: list[list] = []  # room, pieces
    for k in range(m - 1, -1, -1):
        for _ in range(int(left[k])):
            fit = min((b for b in bins if b[0] >= sizes[k]), key=lambda b: b[0], default=None)
            if fit is None:
                bins.append(fit := [capacity, np.zeros(m, np.int64)])
            fit[0] -= sizes[k]
            fit[1][k] += 1
    return plan + [(1, b[1]) for b in bins]


def _slots(histogram: dict[int, int], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each class: ranks at which its patterns begin, pieces of the class in each, its first sequence and its first slot."""
    full = histogram.get(capacity, 0)
    sizes = np.array(sorted(c for c in histogram if c < capacity), np.int64)
    plan = solve_patterns(sizes, np.array([histogram[c] for c in sizes.tolist()], np.float64), capacity)
    rows: dict[int, list[tuple]] = {capacity: [(0, 1, 0, 0)]} if full else {}
    first, used = full, dict.fromkeys(sizes.tolist(), 0)
    for copies, a in plan:
        slot = 0
        for k in np.flatnonzero(a).tolist():
            c, n = int(sizes[k]), int(a[k])
            rows.setdefault(c, []).append((used[c], n, first, slot))
            used[c] += copies * n
            slot += n
        first += copies
    return {c: tuple(np.array(x, np.int64) for x in zip(*r)) for c, r in rows.items()}


def _assign(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = plan.value
        for b in batches:
            cls, rank = b.column("cls").to_numpy(), b.column("rank").to_numpy()
            seq, slot = np.zeros(len(cls), np.int64), np.zeros(len(cls), np.int64)
            for c in np.unique(cls).tolist():
                at = np.flatnonzero(cls == c)
                begin, n, first, base = slots[c]
                k = np.searchsorted(begin, rank[at], "right") - 1
                q = rank[at] - begin[k]
                seq[at], slot[at] = first[k] + q // n[k], base[k] + q % n[k]
            keep = [n for n in b.schema.names if n not in ("cls", "rank")]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), pa.array(seq), pa.array(slot)], [*keep, "sequence_id", "slot"])

    return run


def pack(docs: DataFrame, vocab: str | None = None, kind: str = "byte", end_id: int = END_ID, size: int = SEQUENCE, step: int = STEP, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, as bytes of the vocabulary's width) of every piece."""
    spark = docs.sparkSession
    vocab = vocab or vocabulary("byte_bpe_50k.json")
    capacity = size // step
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = materialize(rows.mapInArrow(tidy(_cut(vocab, kind, end_id, size, step, with_ids)), _PIECES), "pieces")
    counts = materialize(pieces.groupBy("part", "cls").agg(F.count("*").alias("n")), "counts")
    histogram = {r["cls"]: r["n"] for r in counts.groupBy("cls").agg(F.sum("n").alias("n")).collect()}  # at most size/step rows
    plan = spark.sparkContext.broadcast(_slots(histogram, capacity))  # bounded by the square of size/step
    before = Window.partitionBy("cls").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "cls", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    ranked = pieces.join(offsets, ["part", "cls"]).select(*kept, "cls", (F.col("base") + F.col("local")).alias("rank"))
    schema = ranked.drop("cls", "rank").schema.add("sequence_id", "long").add("slot", "long")
    placed = ranked.mapInArrow(_assign(plan), schema)
    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset, *["ids"] * with_ids)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
