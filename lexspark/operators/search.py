"""Nearest neighbours by cosine distance, exact."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


PARTS = 16  # parts of a store at least, for as many tasks
CELLS = 1 << 22  # distances that a worker holds at a time


def at_a_time(n: int) -> int:
    """So many queries are compared with n rows at once: a worker's distances stay within CELLS, whatever the sizes of blocks."""
    return max(1, CELLS // max(1, n))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, F.lit(1.0) - dot(a, b) / size)


def nearest(store: DataFrame, query: list[float], k: int, where: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows nearest to query, ties by id; `where` limits the rows first."""
    rows = store if where is None else store.where(where)
    q = F.array(*[F.lit(float(x)) for x in query])
    return rows.withColumn("distance", cosine_distance(F.col(vector_col), q)).where("distance is not null").orderBy("distance", id_col).limit(k)


def nearest_to_each(store: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 32_768, part: int = 131_072) -> DataFrame:
    """q, id, distance and place of the k nearest of every query, ties by id. Null and zero vectors are near nothing, and vectors of different lengths aren't near each other.

    Queries are dealt into blocks and the store into parts; each block meets each part in one task, which keeps k of each query.
    """
    import numpy as np
    import pyarrow as pa

    whole = lambda v: v.isNotNull() & F.exists(v, lambda x: x != 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x))
    take = lambda df: df.select(F.col(id_col).alias("i"), F.col(vector_col).alias("v")).where(F.col("i").isNotNull() & F.coalesce(whole(F.col("v")), F.lit(False)))
    rows, asked = take(store), take(queries)
    blocks, parts = max(1, -(-asked.count() // block)), max(PARTS, -(-rows.count() // part))
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda salt, n: F.pmod(F.xxhash64("i", F.lit(salt)), F.lit(n)).cast("int")
    dim = F.size("v").alias("d")
    left = asked.select("i", "v", dim, dealt("q", blocks).alias("b"), copies(parts).alias("p"))
    right = rows.select("i", "v", dim, copies(blocks).alias("b"), dealt("s", parts).alias("p"))

    def unit(table: pa.Table) -> np.ndarray:
        v = table.column("v").combine_chunks()
        x = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(v), -1)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def local(q: pa.Table, s: pa.Table) -> pa.Table:
        if not q.num_rows or not s.num_rows:
            return pa.table({"q": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})
        s = s.take(pa.array(np.argsort(s.column("i").to_numpy())))
        ids, x, y, out = s.column("i").to_numpy(), unit(s), unit(q), []
        step = at_a_time(len(x))
        for n in range(0, len(y), step):
            d = 1 - y[n : n + step] @ x.T
            m = min(k, d.shape[1])
            edge = np.partition(d, m - 1, axis=1)[:, m - 1 : m]
            near, tied = d < edge, d == edge  # of ties at the edge the smallest ids stay
            keep = near | (tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= m - near.sum(1, keepdims=True)))
            r, c = np.nonzero(keep)
            out.append((q.column("i").to_numpy()[n + r], ids[c], d[r, c]))
        return pa.table({c: pa.array(np.concatenate(v)) for c, v in zip(("q", "id", "distance"), zip(*out))})

    found = left.groupBy("d", "b", "p").cogroup(right.groupBy("d", "b", "p")).applyInArrow(local, "q long, id long, distance double")
    rank = Window.partitionBy("q").orderBy("distance", "id")
    return found.withColumn("place", F.row_number().over(rank)).where(F.col("place") <= k)


def keyword_scores(docs: DataFrame, words: list[str], id_col: str = "doc_id", text_col: str = "text", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 score of every row for some words (lower case, blanks between); rows without any of them are left out."""
    rows = docs.select(F.col(id_col), F.split(F.lower(text_col), " ").alias("w"))
    times = lambda t: F.size(F.filter("w", lambda x: x == t)).cast("double")
    rows = rows.select(id_col, F.size("w").cast("double").alias("len"), *[times(t).alias(f"tf{k}") for k, t in enumerate(words)])
    # two numbers and one of each word come to the driver
    stats = rows.agg(F.count("*").cast("double").alias("docs"), F.avg("len").alias("mean"), *[F.count_if(F.col(f"tf{k}") > 0).cast("double").alias(f"df{k}") for k in range(len(words))]).first()
    score = F.lit(0.0)
    for k in range(len(words)):
        idf = math.log(1 + (stats["docs"] - stats[f"df{k}"] + 0.5) / (stats[f"df{k}"] + 0.5))
        tf = F.col(f"tf{k}")
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("len") / (stats["mean"] or 1.0)))
    some = F.lit(False)
    for k in range(len(words)):
        some = some | (F.col(f"tf{k}") > 0)
    return rows.where(some).select(id_col, score.alias("score"))
