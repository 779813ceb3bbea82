"""Operator 9, benchmark decontamination: a prefix-filtered set join of windows with documents.

Each window of an item (13 consecutive words, or all words of a shorter item) is a record of word shingles (five
words, or fewer where the window is shorter). Shingles are ordered by their number of occurrences in all documents;
as a window must be contained whole, its prefix is its rarest shingle alone. A document gives one row for each
place where a prefix shingle may begin: a bit table passes those shingles and a few more (it grows with their number, up to
8 MB), and an equality join on the shingle settles which. Position and length bounds drop windows that would leave the document, and the words
themselves are then compared.

Null text has no words. Items without words have no windows. Repeated documents each get a row; a repeated item id
counts once, with the windows of all its texts; a null item id is left out of item lists, its windows still hit.
Empty tables give results without hits. Extra columns are ignored.
Document and item ids are 64-bit integers, or strings of such; another id ends in CAST_INVALID_INPUT.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.llm.bpe import span_hashes
from lexspark.llm.common import materialize, tidy, unused

WINDOW, SHINGLE = 13, 5
LEAST_BITS, MOST_BITS = 20, 26  # of the bit table: 128 KB to 8 MB
_ROWS = 4_096
_TABLE = np.zeros(256, np.uint8)
_TABLE[0x30:0x3A] = np.arange(0x30, 0x3A)
_TABLE[0x41:0x5B] = np.arange(0x61, 0x7B)
_TABLE[0x61:0x7B] = np.arange(0x61, 0x7B)
_TABLE[0x80:] = np.arange(0x80, 0x100)


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, starts and ends of the words, and the first word of each text (and the last's end)."""
    blobs = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    code = _TABLE[np.frombuffer(b"\0".join(blobs) + b"\0", np.uint8)]
    inside = code != 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    bounds = np.cumsum([0] + [len(b) + 1 for b in blobs])
    return code, starts, ends, np.searchsorted(starts, bounds)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive word hashes, as signed 64 bits."""
    if len(words) < n:
        return np.empty(0, np.int64)
    h = np.full(len(words) - n + 1, 0x1B873593 + n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ words[k : k + len(h)]) * np.uint64(0x9FB21C651E98DF25)
            h ^= h >> np.uint64(32)
    return h.view(np.int64)


def _parts(texts: list[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive runs of texts of about limit characters, each with its first index."""
    first, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t or "")
        if held > limit:
            yield first, texts[first : k + 1]
            first, held = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item_id, words (space-joined, lower-cased), n (words in it), shingles (hashes in order) and size of a shingle, for each distinct window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = b.column("item_id").to_pylist(), []
            for first, texts in _parts(b.column("text").to_pylist()):
                code, starts, ends, cut = words_of(texts)
                raw, h = code.tobytes(), span_hashes(code, starts, ends)
                for k in range(len(texts)):
                    i, j = int(cut[k]), int(cut[k + 1])
                    n = min(window, j - i)
                    if not n:
                        continue
                    size = min(shingle, n)
                    sh = shingle_hashes(h[i:j], size)
                    words = [raw[x:y].decode("utf-8", "surrogatepass") for x, y in zip(starts[i:j].tolist(), ends[i:j].tolist())]
                    out += [(ids[first + k], " ".join(words[x : x + n]), n, size, sh[x : x + n - size + 1].tolist()) for x in range(j - i - n + 1)]
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64())))], ["item_id", "words", "n", "size", "shingles"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return rows.mapInArrow(run, "item_id long, words string, n int, size int, shingles array<long>").distinct()


def _filter_of(tokens: DataFrame) -> tuple[np.ndarray, int]:
    """Bit table of the tokens' leading bits, 16 for each token, and its size as a power of two: 16-bit words are OR-ed in Spark, so at most 2**22 of them reach the driver."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * tokens.count()).bit_length()))
    lead = F.shiftrightunsigned("h", 64 - bits)
    rows = tokens.groupBy(F.shiftright(lead, 4).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1), lead.bitwiseAND(F.lit(15)).cast("int"))).cast("int").alias("b")).toArrow()
    words = np.zeros(1 << (bits - 4), "<u2")
    words[rows.column("w").to_numpy()] = rows.column("b").to_numpy().astype(np.uint16)
    return words.view(np.uint8), bits


def _passes(table: tuple[np.ndarray, int], h: np.ndarray) -> np.ndarray:
    at = (h.view(np.uint64) >> np.uint64(64 - table[1])).astype(np.int64)
    return np.flatnonzero(table[0][at >> 3] >> (at & 7).astype(np.uint8) & 1)


def _count_shingles(table, sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for b in batches:
            for _, texts in _parts(b.column("text").to_pylist()):
                code, starts, ends, _cut = words_of(texts)
                words = span_hashes(code, starts, ends)
                for size in sizes:  # shingles over two texts add to a count now and then: it only orders shingles
                    h = shingle_hashes(words, size)
                    kinds, n = np.unique(h[_passes(bits, h)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(n, pa.int64())], ["h", "n"])

    return run


_FOUND = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_words", pa.int64()), ("h", pa.int64()), ("at", pa.int64()), ("around", pa.list_(pa.string())), ("left", pa.int32())])


def _find_places(table, sizes: list[int], window: int, shingle: int):
    """A row for each document, and one for each place where a passing shingle begins: h, the place, and the words around it that its windows may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for b in batches:
            ids, hashes = b.column("doc_id").to_pylist(), b.column("row").to_pylist()
            for first, texts in _parts(b.column("text").to_pylist()):
                code, starts, ends, cut = words_of(texts)
                raw, words, n = code.tobytes(), span_hashes(code, starts, ends), np.diff(cut)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(first, len(texts)), b.column("row").slice(first, len(texts)), pa.array(n, pa.int64()), *[pa.nulls(len(texts), f.type) for f in list(_FOUND)[3:]]], schema=_FOUND)
                for size in sizes:
                    h = shingle_hashes(words, size)
                    hit = _passes(bits, h)
                    of = np.searchsorted(cut, hit, "right") - 1
                    whole = hit + size <= cut[of + 1]
                    hit, of = hit[whole], of[whole]
                    reach = window - size if size == shingle else 0  # a shorter shingle is its window
                    for at in range(0, len(hit), _ROWS):
                        p, k = hit[at : at + _ROWS], of[at : at + _ROWS]
                        x, y = np.maximum(cut[k], p - reach), np.minimum(cut[k + 1], p + size + reach)
                        around = [[raw[s:e].decode("utf-8", "surrogatepass") for s, e in zip(starts[i:j].tolist(), ends[i:j].tolist())] for i, j in zip(x.tolist(), y.tolist())]
                        docs = (first + k).tolist()
                        yield pa.RecordBatch.from_arrays([pa.array([ids[d] for d in docs], pa.int64()), pa.array([hashes[d] for d in docs], pa.int64()), pa.array(n[k], pa.int64()), pa.array(h[p], pa.int64()), pa.array(p - cut[k], pa.int64()), pa.array(around, pa.list_(pa.string())), pa.array(p - x, pa.int32())], schema=_FOUND)

    return run


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: doc_id, row, n_words of every document; and doc_id, row, start, n, item_id of every occurrence of a window."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row"), F.col(text_col).alias("text"))
    windows = materialize(item_windows(items, window, shingle), "windows")
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # at most `shingle` numbers
    shingles = windows.select(F.explode("shingles").alias("h")).distinct()
    table = spark.sparkContext.broadcast(_filter_of(shingles))
    counts = rows.select("text").mapInArrow(tidy(_count_shingles(table, sizes)), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    # rarest shingle of each window, the leftmost of equals
    order = F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "at", "h"))
    flat = windows.select("item_id", "words", "n", F.posexplode("shingles").alias("at", "h"))
    prefix = flat.join(counts.select("h", F.col("n").alias("c")), "h", "left").groupBy("item_id", "words", "n").agg(order.alias("p"))
    prefix = materialize(prefix.select("item_id", "words", "n", "p.at", "p.h"), "prefixes")
    table = spark.sparkContext.broadcast(_filter_of(prefix.select("h").distinct()))
    schema = "doc_id long, row long, n_words long, h long, at long, around array<string>, left int"
    scanned = materialize(rows.mapInArrow(tidy(_find_places(table, sizes, window, shingle)), schema), "places")
    places = scanned.where("h is not null")
    w = prefix.select("item_id", "words", "n", F.col("at").alias("before"), "h")
    found = places.join(w, "h").where(
        (F.col("at") >= F.col("before")) & (F.col("at") - F.col("before") + F.col("n") <= F.col("n_words"))
        & (F.array_join(F.slice("around", F.col("left") - F.col("before") + 1, F.col("n")), " ") == F.col("words")))
    return scanned.where("h is null").select("doc_id", "row", "n_words"), found.select("doc_id", "row", (F.col("at") - F.col("before")).alias("start"), "n", "item_id")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, n_words, n_hit, items (sorted item ids as strings) and contaminated of every document."""
    base, found = occurrences(docs, items, window, shingle, id_col, text_col)
    found = materialize(found.select("doc_id", "row", "start", "n", F.col("item_id").cast("string").alias("item")).distinct(), "occurrences")
    # words of a window count from the end of the windows that begin before it
    spots = found.groupBy("doc_id", "row", "start").agg(F.max("n").alias("n"))
    end, before = F.col("start") + F.col("n"), Window.partitionBy("doc_id", "row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spots = spots.withColumn("fresh", F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0)))))
    counts = spots.groupBy("doc_id", "row").agg(F.sum("fresh").cast("long").alias("n_hit"))
    # at most as many as the benchmark has items
    named = found.select("doc_id", "row", "item").distinct().groupBy("doc_id", "row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    hits = counts.withColumnsRenamed({"doc_id": "__d", "row": "__r"}).join(named, F.col("__d").eqNullSafe(F.col("doc_id")) & (F.col("__r") == F.col("row"))).select("__d", "__r", "n_hit", "items")
    hits = materialize(hits, "hits", "uncompressed")
    out = base.join(hits, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("row") == F.col("__r")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "row", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those that are contaminated."""
    d, r = unused(docs, "hit_doc", "hit_row")
    bad = contamination(docs, items, id_col=id_col, text_col=text_col).where("contaminated").select(F.col("doc_id").alias(d), F.col("row").alias(r)).distinct()
    bad = materialize(bad, "contaminated", "uncompressed")  # few are broadcast by their size as Spark finds it; documents move only where they are many
    return docs.join(bad, F.col(id_col).cast("long").eqNullSafe(F.col(d)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(r)), "left_anti")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
