"""Operator 11, ranked lexical search: exact maximum inner products by sparse ball trees.

A document is a sparse vector of integer term parts, an item a sparse vector of integer weights; the score is their
inner product. Documents are cut in blocks of SHARD as they come to a task. Each block gets a ball tree (split by the
two ends that lie farthest apart): a node has a centroid and a radius, and no document below it scores more than
item . centroid + |item| * radius. Bounds are doubles, rounded up by more than their error can be, so that no subtree
with a document among the best is left out; a subtree is left when its bound lies below the k-th best score so far.
Nodes are taken best bound first, scores at leaves are 64-bit integers. The best of one block go on to a task's next
block. Tasks hand over k rows an item, from which the k best are taken.

Items are the query set: their distinct terms go to the tasks in blocks of TERMS rows; each block is a pass over the
documents, so a larger query set takes more passes and no more memory. Rows of one item id are one item (their terms
add up), null ids too. Null and empty texts have no terms. Repeated documents are ranked each for itself; equal scores go by
ascending id, null ids last. Extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.llm.common import materialize, tidy, union_all

SHARD, LEAF, TERMS = 8_192, 24, 1 << 15
SLACK = 1e-9  # relative; the error of a sum of n doubles is below n * 2**-52

_LETTERS = bytearray(b" " * 256)
_LETTERS[0x30:0x3A] = range(0x30, 0x3A)
_LETTERS[0x41:0x5B] = range(0x61, 0x7B)
_LETTERS[0x61:0x7B] = range(0x61, 0x7B)
_LETTERS[0x80:] = range(0x80, 0x100)
_LETTERS = bytes(_LETTERS)


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and all characters beyond ASCII; A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """item, term, n: occurrences of each term in each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, text in enumerate(b.column(1).to_pylist()):
                n = Counter(terms_of(text))
                yield pa.RecordBatch.from_arrays([pa.repeat(b.column(0)[k], len(n)), pa.array([t.decode("utf-8", "surrogatepass") for t in n], pa.string()), pa.array(list(n.values()), pa.int64())], ["item", "term", "n"])

    kind = items.schema[item_col].dataType.simpleString()
    found = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).mapInArrow(run, f"item {kind}, term string, n long")
    return found.groupBy("item", "term").agg(F.sum("n").alias("n"))


def vectors(docs: DataFrame, place: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """doc, n (terms of the whole text), at and tf (places of the known terms in it, and their occurrences) of every document with a term."""
    known = docs.sparkSession.sparkContext.broadcast(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = known.value.get
        for b in batches:
            ns, sizes, at, tf = [], [], [], []
            for text in b.column(1).to_pylist():
                terms = terms_of(text)
                found = Counter(map(of, terms))
                found.pop(None, None)
                ns.append(len(terms))
                sizes.append(len(found))
                at.extend(found)
                tf.extend(found.values())
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (at, tf)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ns, pa.int64()), *lists], ["doc", "n", "at", "tf"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"doc {kind}, n long, at array<int>, tf array<int>").where("n > 0")


class Rows:
    """Sparse rows: places and values of row k at first[k]:first[k + 1]."""

    def __init__(self, first: np.ndarray, at: np.ndarray, value: np.ndarray):
        self.first, self.at, self.value = first, at, value

    def __len__(self) -> int:
        return len(self.first) - 1

    def take(self, rows: np.ndarray) -> Rows:
        size = self.first[rows + 1] - self.first[rows]
        first = np.concatenate([[0], np.cumsum(size)])
        places = np.arange(first[-1]) + np.repeat(self.first[rows] - first[:-1], size)
        return Rows(first, self.at[places], self.value[places])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """Inner products with a dense vector, in its type; rows are not empty."""
        return np.add.reduceat(self.value * dense[self.at], self.first[:-1])


class BallTree:
    """Nodes in one array each: centroid, radius, children (or -1), and the leaf's rows first:last of `rows`, which are put in the leaves' order."""

    def __init__(self, rows: Rows, width: int, leaf: int = LEAF):
        self.centroid: list[np.ndarray] = []
        self.radius: list[float] = []
        self.child: list[tuple[int, int]] = []
        self.span: list[tuple[int, int]] = []
        order = np.arange(len(rows))
        todo = [(0, len(rows), -1, 0)]
        while todo:
            i, j, parent, side = todo.pop()
            node, held = len(self.radius), rows.take(order[i:j])
            if parent >= 0:
                self.child[parent] = (node, self.child[parent][1]) if side == 0 else (self.child[parent][0], node)
            real = Rows(held.first, held.at, held.value.astype(np.float64))
            centroid = np.bincount(real.at, real.value, width) / (j - i)
            norms = np.add.reduceat(real.value * real.value, real.first[:-1])
            apart = norms - 2 * real.dot(centroid) + centroid @ centroid
            # the squares' difference loses digits that the squares have: SLACK of their size covers it
            self.radius.append(math.sqrt(max(0.0, float(apart.max())) + SLACK * float(norms.max() + centroid @ centroid)))
            self.centroid.append(centroid)
            self.child.append((-1, -1))
            self.span.append((i, j))
            if j - i <= leaf or apart.max() <= SLACK * norms.max():  # small, or copies of one vector
                continue
            one = self._dense(real, int(apart.argmax()), width)
            from_one = norms - 2 * real.dot(one)
            two = self._dense(real, int(from_one.argmax()), width)
            lean = real.dot(two - one)
            cut = (j - i) // 2
            way = np.argpartition(lean, cut)
            order[i:j] = order[i:j][way]
            todo += [(i, i + cut, node, 0), (i + cut, j, node, 1)]
        self.order, self.rows = order, rows.take(order)
        self.centroids, self.radii = np.array(self.centroid), np.array(self.radius)

    @staticmethod
    def _dense(rows: Rows, k: int, width: int) -> np.ndarray:
        out = np.zeros(width)
        out[rows.at[rows.first[k] : rows.first[k + 1]]] = rows.value[rows.first[k] : rows.first[k + 1]]
        return out

    def bounds(self, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """For every node a double that no inner product below it exceeds."""
        w = weight.astype(np.float64)
        return (self.centroids[:, at] @ w + math.sqrt(float(w @ w)) * self.radii) * (1 + SLACK) + 1

    def search(self, at: np.ndarray, weight: np.ndarray, k: int, ids: list, best: list[tuple], dense: np.ndarray) -> list[tuple]:
        """The k least of (-score, id is null, id) among best and the tree's rows. dense: zeros, given back as such."""
        bound = self.bounds(at, weight)
        dense[at] = weight
        heap = [(-bound[0], 0)]
        while heap:
            most, node = heapq.heappop(heap)
            if len(best) == k and -most < -best[-1][0]:
                break
            left, right = self.child[node]
            if left >= 0:
                heapq.heappush(heap, (-bound[left], left))
                heapq.heappush(heap, (-bound[right], right))
                continue
            i, j = self.span[node]
            a, b = self.rows.first[i], self.rows.first[j]
            score = np.add.reduceat(self.rows.value[a:b] * dense[self.rows.at[a:b]], self.rows.first[i:j] - a)
            good = np.flatnonzero(score >= (-best[-1][0] if len(best) == k else 1))
            if len(good):
                best = heapq.nsmallest(k, best + [(-int(score[g]), (d := ids[self.order[i + g]]) is None, d) for g in good.tolist()])
        dense[at] = 0
        return best


def _search(queries, k: int):
    """mapInArrow over vectors: the k best of a task's documents for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, width, docs_n, terms_n = queries.value
        best: list[list[tuple]] = [[] for _ in asked]
        dense = np.zeros(width, np.int64)
        kind = None
        for b in _blocks(batches):
            kind = b.schema.field("doc").type
            at, tf = b.column("at").combine_chunks(), b.column("tf").combine_chunks()
            size = np.asarray(at.value_lengths())
            m = 25 + 75 * b.column("n").to_numpy() * docs_n // terms_n
            t = tf.flatten().to_numpy().astype(np.int64)
            value = 1_000_000_000 * t // (1000 * t + 8 * np.repeat(m, size))
            tree = BallTree(Rows(np.concatenate([[0], np.cumsum(size)]), at.flatten().to_numpy().astype(np.int64), value), width)
            ids = b.column("doc").to_pylist()
            best = [tree.search(x, w, k, ids, held, dense) for (x, w), held in zip(asked, best)]
        rows = [(q, d, -s) for q, held in enumerate(best) for s, _, d in held]
        if rows:
            q, d, s = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(d, kind), pa.array(s, pa.int64())], ["query", "doc", "score"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of at most SHARD rows and at least half of that, but for the last."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        for part in (b.slice(i, SHARD // 2) for i in range(0, b.num_rows, SHARD // 2)):
            held.append(part)
            n += part.num_rows
            if n >= SHARD // 2:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0."""
    spark = docs.sparkSession
    wanted = materialize(item_terms(items, item_col, item_text_col), "terms")
    blocks = max(1, -(-wanted.count() // TERMS))
    found = [part for x in range(blocks) if (part := _rank_block(docs, wanted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == x), k, id_col, text_col)) is not None]
    if not found:
        kinds = items.schema[item_col].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"{item_col} {kinds[0]}, rank int, {id_col} {kinds[1]}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    return union_all(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")


def _rank_block(docs: DataFrame, wanted: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame | None:
    spark = docs.sparkSession
    asked = wanted.toArrow()
    place = {t: i for i, t in enumerate(dict.fromkeys(asked.column("term").to_pylist()))}
    if not place:
        return None
    held = materialize(vectors(docs, {t.encode("utf-8", "surrogatepass"): i for t, i in place.items()}, id_col, text_col), "vectors")
    docs_n, terms_n = held.agg(F.count("*"), F.sum("n")).first()
    if not docs_n:
        return None
    df = dict(held.select(F.explode("at").alias("t")).groupBy("t").count().toArrow().to_pandas().itertuples(index=False, name=None))
    weight = {t: math.floor(1000 * math.log((2 * docs_n + 2) / (2 * df.get(i, 0) + 1))) for t, i in place.items()}
    queries: dict = {}
    for item, term, n in zip(*(asked.column(c).to_pylist() for c in ("item", "term", "n"))):
        queries.setdefault(item, []).append((place[term], n * weight[term]))
    names = list(queries)
    sides = [tuple(np.array(x, np.int64) for x in zip(*sorted(queries[i]))) for i in names]
    shared = spark.sparkContext.broadcast((sides, len(place), docs_n, terms_n))
    kind = held.schema["doc"].dataType.simpleString()
    best = held.where(F.size("at") > 0).mapInArrow(tidy(_search(shared, k)), f"query int, doc {kind}, score long")
    named = spark.createDataFrame(list(enumerate(names)), f"query int, item {wanted.schema['item'].dataType.simpleString()}")
    return best.join(F.broadcast(named), "query").select("item", "doc", "score")  # at most TERMS items


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents), k AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
s AS (SELECT item_id, doc_id, sum(q * floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score FROM t JOIN q USING (term) JOIN f USING (term), k GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""
