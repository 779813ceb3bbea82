"""Operator 13, phrase collocation mining: phrases are counted in HAT-tries, scored by their worst cut.

A task numbers the words it meets and counts phrases in a shallow trie over word ids: a hash of the first word leads to
a hybrid container, a hash table for the phrases of many first words; one of more than BURST entries bursts into a table
for each first word. When the trie holds ENTRIES phrases, whole subtrees, the largest first, are spilled as sorted runs, one for each
prefix: the language and a hash of the first word (for words that take more than a SHARE-th of all, of the rest, too).
The number of prefixes grows with the words. Runs meet by prefix and are merged there.

Lengths are counted in turn, as a phrase is no more frequent than its parts: words of fewer than `least` occurrences
end a stretch, and of three words only those are counted whose pairs are frequent. Bit tables (8 MB at most) tell; they
let some rare ones through and never stop a frequent one, so counts are exact at any size.

Null text counts as empty, null group as `und`, together with groups of that name. Repeated documents count each. An empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.llm.bits import BitTable, bit_table
from lexspark.llm.common import materialize, tidy

BURST, ENTRIES, VOCABULARY, TOKENS, SHARE, ROOT = 4_096, 500_000, 1 << 19, 1 << 21, 1_024, 1_024
ID_BITS = 21  # of a word's number in a task, more than VOCABULARY needs
_MASK = (1 << ID_BITS) - 1
_MIX, _STEP = 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93

_FOLD = bytearray(range(256))
_FOLD[0x41:0x5B] = range(0x61, 0x7B)
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _FOLD[_c] = 0x0A
_FOLD = bytes(_FOLD)
_BREAK = b"\xff"  # in no UTF-8 text


def tokens_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a text, _BREAK between pieces."""
    return (text or b"").translate(_FOLD).replace(b"\n", b" " + _BREAK + b" ").split()


def group_hash(group: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(group.encode("utf-8", "surrogatepass"))


def word_hash(seed: int, word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word, seed)


def pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (a * np.uint64(_MIX)) ^ (b + np.uint64(_STEP))
        h = (h ^ (h >> np.uint64(31))) * np.uint64(_STEP)
        return h ^ (h >> np.uint64(32))


class Words:
    """Numbers of a task's words, 0 for breaks and words that `allowed` stops. A number belongs to one group."""

    def __init__(self, allowed: BitTable | None, shares: dict[tuple[str, bytes], int]):
        self.allowed, self.shares = allowed, shares
        self.clear()

    def clear(self) -> None:
        self.groups: dict[str, _Group] = {}
        self.names: list[bytes] = [b""]
        self.group: list[int] = [0]
        self.hashes: list[int] = [0]
        self.share: list[int] = [1]
        self.seen = 0

    def number(self, group: str, tokens: list[bytes]) -> list[int]:
        held = self.groups.get(group)
        if held is None:
            held = self.groups[group] = _Group(self, group)
        return list(map(held.__getitem__, tokens))


class _Group(dict):
    def __init__(self, words: Words, name: str):
        self.words, self.name, self.place, self.seed = words, name, len(words.groups), group_hash(name)
        self[_BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        words, h = self.words, word_hash(self.seed, word)
        words.seen += 1
        if words.allowed is not None and not words.allowed.holds(h):
            self[word] = 0
            return 0
        words.names.append(word)
        words.group.append(self.place)
        words.hashes.append(h)
        words.share.append(words.shares.get((self.name, word), 1))
        self[word] = n = len(words.names) - 1
        return n


class Trie:
    """Counts of phrases as packed word numbers. The root leads by a hash of the first word to hybrid containers, which hold the phrases of many first words; one that grows beyond BURST entries bursts into a container for each first word."""

    def __init__(self, length: int):
        self.first = ID_BITS * (length - 1)
        self.root: list[Counter | dict[int, Counter] | None] = [None] * ROOT
        self.sizes = [0] * ROOT
        self.entries = 0

    def add(self, keys: np.ndarray, way: np.ndarray) -> None:
        """keys: packed numbers of phrases, repeats included; way: the root's place for each."""
        order = np.argsort(way, kind="stable")  # a radix sort
        keys, way = keys[order], way[order]
        cut = np.flatnonzero(np.diff(way.astype(np.int32), prepend=-1)).tolist() + [len(keys)]
        for k, i, j in zip(way[cut[:-1]].tolist(), cut, cut[1:]):
            node = self.root[k]
            if node is None:
                node = self.root[k] = Counter()
            if type(node) is Counter:
                before = len(node)
                node.update(keys[i:j].tolist())
                added = len(node) - before
                if len(node) > BURST:
                    self.root[k] = self._burst(node)
            else:
                added = self._deal(node, np.sort(keys[i:j]))
            self.sizes[k] += added
            self.entries += added

    def _burst(self, held: Counter) -> dict[int, Counter]:
        node: dict[int, Counter] = {}
        for key, n in held.items():
            node.setdefault(key >> self.first, Counter())[key] = n
        return node

    def _deal(self, node: dict[int, Counter], keys: np.ndarray) -> int:
        first, added = keys >> self.first, 0
        cut = np.flatnonzero(np.diff(first, prepend=-1)).tolist() + [len(keys)]
        for k, i, j in zip(first[cut[:-1]].tolist(), cut, cut[1:]):
            held = node.setdefault(k, Counter())
            before = len(held)
            held.update(keys[i:j].tolist())
            added += len(held) - before
        return added

    def spill(self, down_to: int) -> tuple[np.ndarray, np.ndarray]:
        """Phrases and counts of whole subtrees, which leave the trie, largest first, until so many entries are left."""
        out: list[Counter] = []
        for k in sorted(range(ROOT), key=self.sizes.__getitem__, reverse=True):
            node = self.root[k]
            if self.entries <= down_to or node is None:
                break
            out += [node] if type(node) is Counter else list(node.values())
            self.entries -= self.sizes[k]
            self.root[k], self.sizes[k] = None, 0
        n = sum(map(len, out))
        return np.fromiter(chain.from_iterable(out), np.int64, n), np.fromiter(chain.from_iterable(c.values() for c in out), np.int64, n)


_RUN = pa.schema([("lang", pa.string()), ("prefix", pa.int64()), ("phrases", pa.binary()), ("counts", pa.binary())])


def _runs(words: Words, trie: Trie, down_to: int, prefixes: int) -> Iterator[pa.RecordBatch]:
    """Spilled subtrees as a sorted run for each prefix: its phrases, joined by line feeds, and their counts."""
    keys, counts = trie.spill(down_to)
    if not len(keys):
        return
    names = pa.array(words.names, pa.binary())
    order = pc.array_sort_indices(names).to_numpy().astype(np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    parts = [keys >> shift & _MASK for shift in range(trie.first, -1, -ID_BITS)]
    hashes, share = np.array(words.hashes, np.uint64), np.array(words.share, np.uint64)
    prefix = hashes[parts[0]] % np.uint64(prefixes)
    rest = hashes[parts[1]] if len(parts) == 2 else pair_hashes(hashes[parts[1]], hashes[parts[2]])
    prefix = (prefix << np.uint64(12) | rest % share[parts[0]]).astype(np.int64)
    group = np.array(words.group, np.int64)[parts[0]]
    packed = rank[parts[0]]
    for p in parts[1:]:
        packed = packed << ID_BITS | rank[p]
    at = np.argsort(packed)
    at = at[np.argsort(prefix[at], kind="stable")]
    at = at[np.argsort(group[at].astype(np.uint16), kind="stable")]
    prefix, group = prefix[at], group[at]
    cut = np.flatnonzero(np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (group[1:] != group[:-1])]))
    said = pc.binary_join_element_wise(*[names.take(pa.array(p[at])) for p in parts], pa.scalar(b" ", pa.binary()))
    ends = np.append(cut, len(at)).astype(np.int32)
    phrases = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), said), pa.scalar(b"\n", pa.binary()))
    numbers = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer((ends * 8).astype("<i4")), pa.py_buffer(counts[at].astype("<i8"))])
    langs = pa.array(list(words.groups), pa.string()).take(pa.array(group[cut]))
    run = pa.RecordBatch.from_arrays([langs, pa.array(prefix[cut]), phrases, numbers], schema=_RUN)
    for i in range(0, run.num_rows, 1_000):
        yield run.slice(i, 1_000)


def _numbered(batches: Iterator[pa.RecordBatch], words: Words) -> Iterator[tuple[np.ndarray, bool]]:
    """Numbers of about TOKENS tokens of whole texts at a time, 0 between texts; and whether the words are forgotten after them."""
    held, n = [], 0
    for b in batches:
        for group, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            ids = words.number(group, tokens_of(text))
            ids.append(0)
            held.append(np.array(ids, np.int64))
            n += len(ids)
            full = words.seen > VOCABULARY
            if n > TOKENS or full:
                yield np.concatenate(held), full
                held, n = [], 0
                if full:
                    words.clear()
    yield np.concatenate([*held, np.zeros(1, np.int64)]), True


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, total = Words(None, {}), np.zeros(0, np.int64)
    for ids, last in _numbered(batches, words):
        total = np.bincount(ids, minlength=len(words.names)) + np.pad(total, (0, max(0, len(words.names) - len(total))))
        if last:
            groups, names, place = pa.array(list(words.groups), pa.string()), words.names, np.array(words.group)
            for i in range(1, len(names), 50_000):
                j = min(len(names), i + 50_000)
                yield pa.RecordBatch.from_arrays([groups.take(pa.array(place[i:j])), pa.array(names[i:j], pa.binary()), pa.array(total[i:j], pa.int64())], ["lang", "word", "n"])
            total = np.zeros(0, np.int64)


def _count_phrases(length: int, tables, shares, prefixes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, pairs = tables.value
        words, trie = Words(single, shares.value), Trie(length)
        for ids, last in _numbered(batches, words):
            ok = (ids[:-1] > 0) & (ids[1:] > 0)
            h = np.array(words.hashes, np.uint64)
            if length == 3:
                at = np.flatnonzero(ok)
                ok[at] = pairs.passes(pair_hashes(h[ids[at]], h[ids[at + 1]]))
                at = np.flatnonzero(ok[:-1] & ok[1:])
                keys = ids[at] << 2 * ID_BITS | ids[at + 1] << ID_BITS | ids[at + 2]
            else:
                at = np.flatnonzero(ok)
                keys = ids[at] << ID_BITS | ids[at + 1]
            way = (h % np.uint64(ROOT)).astype(np.uint16)[ids[at]]
            for i in range(0, len(keys), ENTRIES):
                trie.add(keys[i : i + ENTRIES], way[i : i + ENTRIES])
                if trie.entries > ENTRIES:
                    yield from _runs(words, trie, ENTRIES // 2, prefixes)
            if last:
                yield from _runs(words, trie, 0, prefixes)

    return run


_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("n", pa.int64())])


def _merge(least: int):
    """The runs of one prefix after the other, merged and summed; phrases of `least` and more are kept."""

    def total(held: list[tuple]) -> pa.RecordBatch:
        code = pa.array(b"\n".join([r[2] for r in held]).split(b"\n"), pa.binary()).dictionary_encode()
        n = np.zeros(len(code.dictionary), np.int64)
        np.add.at(n, code.indices.to_numpy(), np.frombuffer(b"".join([r[3] for r in held]), "<i8"))
        often = np.flatnonzero(n >= least)
        return pa.RecordBatch.from_arrays([pa.repeat(held[0][0], len(often)), code.dictionary.take(pa.array(often)), pa.array(n[often])], schema=_COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
        out, n = [], 0
        for _, held in groupby(rows, lambda r: r[:2]):
            out.append(total(list(held)))
            n += out[-1].num_rows
            if n > 20_000:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out, n = [], 0
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return run


def _hashed(counts: DataFrame) -> DataFrame:
    """h of each word or pair of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seed = {g: group_hash(g) for g in b.column(0).unique().to_pylist()}
            parts = [(seed[g], p.split(b" ")) for g, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            h = np.array([word_hash(g, p[0]) for g, p in parts], np.uint64)
            if parts and len(parts[0][1]) == 2:
                h = pair_hashes(h, np.array([word_hash(g, p[1]) for g, p in parts], np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    return counts.mapInArrow(run, "h long")


def phrase_counts(docs: DataFrame, least: int = 10, text_col: str = "text", group_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts of all words (lang, a, n), and of the pairs (a, b) and triples (a, b, c) that occur `least` times or more; words as binaries."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(group_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    words = rows.mapInArrow(tidy(_count_words), "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = materialize(words, "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    large = words.where(F.col("n") * SHARE >= total).collect()  # SHARE at most
    shares = spark.sparkContext.broadcast({(r["lang"], bytes(r["word"])): 1 + 2 * SHARE * r["n"] // total for r in large})
    prefixes = min(1 << 20, max(512, total >> 18))
    allowed, counted = [bit_table(_hashed(words.where(F.col("n") >= least).select("lang", "word"))), None], []
    for length in (2, 3):
        tables = spark.sparkContext.broadcast(tuple(allowed))
        runs = rows.mapInArrow(tidy(_count_phrases(length, tables, shares, prefixes)), "lang string, prefix long, phrases binary, counts binary")
        runs = runs.repartition("lang", "prefix").sortWithinPartitions("lang", "prefix")
        counted.append(materialize(runs.mapInArrow(tidy(_merge(least)), "lang string, phrase binary, n long"), f"phrases{length}"))
        if length == 2:
            allowed[1] = bit_table(_hashed(counted[0].select("lang", "phrase")))
    word = lambda k: F.split_part(F.col("phrase").cast("string"), F.lit(" "), F.lit(k))
    return (words.select("lang", F.col("word").cast("string").alias("a"), "n"), counted[0].select("lang", word(1).alias("a"), word(2).alias("b"), "n"),
            counted[1].select("lang", word(1).alias("a"), word(2).alias("b"), word(3).alias("c"), "n"))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in decimals of 38 digits."""
    big = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (big(a) * big(a)).cast("decimal(31,0)"), (big(left) * big(right)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, least: int = 10, top: int = 2_000, inside_percent: int = 50, text_col: str = "text", group_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best `top` phrases of two or three words of each group, without those of which inside_percent or more lie in a longer one."""
    words, pairs, triples = phrase_counts(docs, least, text_col, group_col)
    size = words.groupBy("lang").agg(F.sum("n").alias("size"))
    single = words.where(F.col("n") >= least)

    def side(counts: DataFrame, name: str, *keys: str) -> DataFrame:
        return counts.select("lang", *[F.col(c).alias(k) for c, k in zip("abc", keys)], F.col("n").alias(name))

    two = pairs.join(side(single, "l", "a"), ["lang", "a"]).join(side(single, "r", "b"), ["lang", "b"])
    covered = triples.select("lang", "n", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("c").alias("b")))).alias("p")).groupBy("lang", "p.a", "p.b").agg(F.max("n").alias("longer"))
    two = two.join(covered, ["lang", "a", "b"], "left").where(F.coalesce(100 * F.col("longer") < inside_percent * F.col("n"), F.lit(True)))
    two = two.select("lang", F.concat_ws(" ", "a", "b").alias("phrase"), F.col("n").alias("a"), "l", "r", _score(F.col("n"), F.col("l"), F.col("r")).alias("score"))
    three = triples.join(side(single, "l1", "a"), ["lang", "a"]).join(side(pairs, "r1", "b", "c"), ["lang", "b", "c"]).join(side(pairs, "l2", "a", "b"), ["lang", "a", "b"]).join(side(single, "r2", "c"), ["lang", "c"])
    three = three.withColumns({f"s{k}": _score(F.col("n"), F.col(f"l{k}"), F.col(f"r{k}")) for k in (1, 2)})
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", "a", "b", "c").alias("phrase"), F.col("n").alias("a"), F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = two.unionByName(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(size, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("size").alias("n"), "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (SELECT lang, w, len(w) AS m, unnest(range(1, len(w) + 1)) AS i FROM p),
f1 AS (SELECT lang, w[i] AS x, count(*) AS f FROM g GROUP BY ALL), n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
f2 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f FROM g WHERE i + 1 <= m GROUP BY ALL),
f3 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM g WHERE i + 2 <= m GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, f2.f AS a, l.f AS l, r.f AS r, 1 AS k FROM f2 JOIN f1 l ON l.lang = f2.lang AND l.x = f2.x JOIN f1 r ON r.lang = f2.lang AND r.x = f2.y
  WHERE f2.f >= 10 AND NOT EXISTS (FROM f3 WHERE f3.lang = f2.lang AND f3.x = f2.x AND f3.y = f2.y AND 100 * f3.f >= 50 * f2.f) AND NOT EXISTS (FROM f3 WHERE f3.lang = f2.lang AND f3.y = f2.x AND f3.z = f2.y AND 100 * f3.f >= 50 * f2.f)
  UNION ALL SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, l.f, r.f, 1 FROM f3 JOIN f1 l ON l.lang = f3.lang AND l.x = f3.x JOIN f2 r ON r.lang = f3.lang AND r.x = f3.y AND r.y = f3.z
  UNION ALL SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, l.f, r.f, 2 FROM f3 JOIN f2 l ON l.lang = f3.lang AND l.x = f3.x AND l.y = f3.y JOIN f1 r ON r.lang = f3.lang AND r.x = f3.z),
s AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM c),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""
