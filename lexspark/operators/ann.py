"""Search beyond exact scans: inverted lists over cells, residual product codes, and an exact re-rank of a shortlist.

Vectors are compared by cosine. Cells and code books are fitted on a sample of `sample_bytes` at most (documented, by a
hash of the id); every row of the store is filed under its nearest cell with the codes of what it differs from it. The lists
are dealt by id into parts of at most `part` rows, so that a cell of many rows is spread; a query meets its `probes` nearest cells in
each part, which gives its `shortlist` best by codes over all of them, and the best of all parts are compared exactly, their vectors
fetched by id. What moves grows with queries times parts (16 at least), not with probes. Nothing is compared with whole copies of
the store. Null and zero vectors, and those with null or non-finite components, are in no list and near nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.operators.search import cosine_distance, nearest_to_each

SAMPLE_BYTES, CODES, PARTS = 32_000_000, 256, 16


@dataclass
class Index:
    """cells: a row each; books: for each subspace CODES code words; lists: id, cell and codes of every filed row."""

    cells: np.ndarray
    books: np.ndarray
    lists: DataFrame

    def split(self, x: np.ndarray) -> np.ndarray:
        m, _, width = self.books.shape
        return np.pad(x, ((0, 0), (0, m * width - x.shape[1]))).reshape(len(x), m, width)


def usable(v: Column) -> Column:
    return F.coalesce(F.exists(v, lambda x: x != 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def _unit(vectors: pa.Array) -> np.ndarray:
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _nearest(x: np.ndarray, centres: np.ndarray, k: int = 1) -> np.ndarray:
    """The k nearest centres of each row, best first."""
    half = (centres * centres).sum(1) / 2
    out = np.empty((len(x), k), np.int32)
    for i in range(0, len(x), 4_096):
        far = half - x[i : i + 4_096] @ centres.T
        some = np.argpartition(far, k - 1, axis=1)[:, :k]
        out[i : i + 4_096] = np.take_along_axis(some, np.argsort(np.take_along_axis(far, some, 1), axis=1), 1)
    return out


def centres_of(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """k-means centres; a centre that loses all its rows is put on a row."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = _nearest(x, c)[:, 0]
        n = np.bincount(at, minlength=len(c))
        order = np.argsort(at, kind="stable")
        full = np.flatnonzero(n)
        c[full] = np.add.reduceat(x[order], (np.cumsum(n) - n)[full], axis=0) / n[full, None]
        c[n == 0] = x[rng.integers(0, len(x), int((n == 0).sum()))]
    return c


def build(store: DataFrame, path: str, cells: int | None = None, subspaces: int = 16, sample_bytes: int = SAMPLE_BYTES, id_col: str = "vec_id", vector_col: str = "embedding") -> Index:
    """File every row of the store (vectors of one length) in lists written to path, ordered by cell."""
    spark = store.sparkSession
    rows = store.select(F.col(id_col).alias("i"), F.col(vector_col).alias("v")).where(F.col("i").isNotNull() & usable(F.col("v")))
    n, dim, least = rows.agg(F.count("*"), F.max(F.size("v")), F.min(F.size("v"))).first()
    if n and dim != least:
        raise ValueError(f"vectors of {least} to {dim} dimensions")
    if not n:
        return Index(np.zeros((1, 1), np.float32), np.zeros((1, CODES, 1), np.float32), spark.createDataFrame([], f"i {store.schema[id_col].dataType.simpleString()}, cell int, codes binary"))
    take = max(1, sample_bytes // (4 * dim))
    x = _unit(rows.select("v", F.xxhash64("i").alias("h")).orderBy("h").limit(take).toArrow().column("v").combine_chunks())  # of bounded bytes
    centres = centres_of(x, cells or max(1, min(4_096, int(n**0.5))))
    width = -(-dim // subspaces)
    index = Index(centres, np.zeros((-(-dim // width), CODES, width), np.float32), rows)
    rest = index.split(x - centres[_nearest(x, centres)[:, 0]])
    for m in range(len(index.books)):
        book = centres_of(np.ascontiguousarray(rest[:, m]), CODES)
        index.books[m, : len(book)] = book
        index.books[m, len(book) :] = 1e6  # no code
    held = spark.sparkContext.broadcast((index.cells, index.books))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, books = held.value
        own = Index(cells, books, None)
        for b in batches:
            x = _unit(b.column("v"))
            at = _nearest(x, cells)[:, 0]
            rest = own.split(x - cells[at])
            codes = np.stack([_nearest(np.ascontiguousarray(rest[:, m]), books[m])[:, 0] for m in range(len(books))], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([b.column("i"), pa.array(at), pa.array([c.tobytes() for c in codes], pa.binary())], ["i", "cell", "codes"])

    lists = rows.mapInArrow(file, f"i {rows.schema['i'].dataType.simpleString()}, cell int, codes binary")
    lists.repartitionByRange("cell", F.xxhash64("i")).sortWithinPartitions("cell").write.mode("overwrite").parquet(path)
    index.lists = spark.read.parquet(path)
    return index


def search(index: Index, store: DataFrame, queries: DataFrame, k: int = 10, probes: int = 16, shortlist: int = 100, part: int = 262_144, block: int = 16_384, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """q, id, distance and place of the k nearest of every query that its cells' lists give, ties by id."""
    spark = store.sparkSession
    held = spark.sparkContext.broadcast((index.cells, index.books))
    kind = store.schema[id_col].dataType.simpleString()
    asked = queries.select(F.col(id_col).alias("q"), F.col(vector_col).alias("v")).where(F.col("q").isNotNull() & usable(F.col("v")))
    blocks, parts = max(1, -(-asked.count() // block)), max(PARTS, -(-index.lists.count() // part))
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = asked.select("q", "v", dealt("q", blocks).alias("b"), copies(parts).alias("p"))
    right = index.lists.select("i", "cell", "codes", dealt("i", parts).alias("p"), copies(blocks).alias("b"))

    def compare(q: pa.Table, lists: pa.Table) -> pa.Table:
        out = [], [], []
        if q.num_rows and lists.num_rows:
            cells, books = held.value
            own = Index(cells, books, None)
            at = lists.column("cell").to_numpy()
            order = np.argsort(at, kind="stable")
            first = np.searchsorted(at[order], np.arange(len(cells) + 1))
            ids = lists.column("i").combine_chunks().take(pa.array(order))
            codes = np.frombuffer(b"".join(lists.column("codes").to_pylist()), np.uint8).reshape(lists.num_rows, len(books))[order]
            places = codes.astype(np.int32) + np.arange(len(books), dtype=np.int32) * CODES
            asks, x = q.column("q").combine_chunks(), _unit(q.column("v").combine_chunks())
            for a in range(0, len(x), 256):
                some = x[a : a + 256]
                near_cells = np.sort(_nearest(some, cells, min(probes, len(cells))), axis=1)
                tables = np.einsum("qmw,mcw->qmc", own.split(some), books).reshape(len(some), -1)
                for n in range(len(some)):
                    c = near_cells[n]
                    many = first[c + 1] - first[c]
                    rows = np.repeat(first[c] - np.cumsum(many) + many, many) + np.arange(many.sum())
                    if not len(rows):
                        continue
                    near = np.repeat(cells[c] @ some[n], many) + tables[n][places[rows]].sum(1)
                    best = np.argpartition(-near, min(shortlist, len(near)) - 1)[:shortlist]
                    out[0].append(asks.take(pa.array(np.full(len(best), a + n))))
                    out[1].append(ids.take(pa.array(rows[best])))
                    out[2].append(near[best].astype(np.float64))
        if not out[0]:
            return pa.table({"q": q.column("q").slice(0, 0), "i": lists.column("i").slice(0, 0), "near": pa.array([], pa.float64())})
        return pa.table({"q": pa.concat_arrays(out[0]), "i": pa.concat_arrays(out[1]), "near": pa.array(np.concatenate(out[2]))})

    found = left.groupBy("b", "p").cogroup(right.groupBy("b", "p")).applyInArrow(compare, f"q {kind}, i {kind}, near double")
    best = Window.partitionBy("q").orderBy(F.desc("near"), "i")
    short = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= shortlist).select("q", "i")
    exact = short.join(asked, "q").join(store.select(F.col(id_col).alias("i"), F.col(vector_col).alias("w")), "i").select("q", F.col("i").alias("id"), cosine_distance(F.col("v"), F.col("w")).alias("distance"))
    place = Window.partitionBy("q").orderBy("distance", "id")
    return exact.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k)


def audit(index: Index, store: DataFrame, k: int = 10, target: float = 0.97, queries: int = 64, probes: int = 8, shortlist: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[int, int, float]:
    """(probes, shortlist, recall) with which some rows of the store, by a hash of the id, find so many of their exact k nearest.

    Probes are what their neighbours' cells ask for: half of what may be missed is left to them. The shortlist is
    doubled then, and probes with it only once it has all that they reach; with all cells and a long list the search is exact.
    """
    rows = store.where(usable(F.col(vector_col)))
    asked = rows.orderBy(F.xxhash64(F.lit("audit"), F.col(id_col))).limit(queries).cache()
    exact = nearest_to_each(rows, asked, k, id_col, vector_col).cache()
    total = index.lists.count()
    try:
        probes = min(len(index.cells), max(probes, _reached(index, asked, exact, (1 + target) / 2, id_col, vector_col)))
        while True:
            got = recall(search(index, store, asked, k, probes, shortlist, id_col=id_col, vector_col=vector_col), exact, k).agg(F.avg("recall")).first()[0]
            if got is None or got >= target or probes >= len(index.cells) and shortlist >= total:
                return probes, shortlist, got if got is not None else 1.0
            if shortlist >= total:
                probes = min(2 * probes, len(index.cells))
            shortlist = min(2 * shortlist, max(total, 1))
    finally:
        exact.unpersist()
        asked.unpersist()


def _reached(index: Index, asked: DataFrame, exact: DataFrame, share: float, id_col: str, vector_col: str) -> int:
    """So many nearest cells of a query hold this share of the exact neighbours."""
    held = asked.sparkSession.sparkContext.broadcast(index.cells)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = (held.value * held.value).sum(1) / 2
        for b in batches:
            far = half - _unit(b.column("v")) @ held.value.T
            own = far[np.arange(b.num_rows), b.column("cell").to_numpy()]
            yield pa.RecordBatch.from_arrays([pa.array((far <= own[:, None]).sum(1).astype(np.int32))], ["place"])

    pairs = exact.select("q", "id").join(asked.select(F.col(id_col).alias("q"), F.col(vector_col).alias("v")), "q")
    found = index.lists.join(F.broadcast(pairs), F.col("i") == F.col("id")).select("v", "cell").mapInArrow(places, "place int")
    return math.ceil(found.agg(F.percentile("place", share)).first()[0] or 1)  # of queries times k rows


def recall(found: DataFrame, exact: DataFrame, k: int = 10) -> DataFrame:
    """q and recall: the share of the exact k nearest that were found, for each query of exact."""
    hits = exact.where(F.col("place") <= k).select("q", "id").join(found.where(F.col("place") <= k).select("q", "id", F.lit(1).alias("hit")), ["q", "id"], "left")
    return hits.groupBy("q").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
