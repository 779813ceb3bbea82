"""Operator 12, suffix-array dedup: bytes of strings that also start elsewhere, found by common prefixes up to a threshold.

A string of LENGTH bytes starts at p. Its anchor is the least rolling hash of the GRAM-byte grams in it, which the string alone
decides: equal strings have equal anchors, wherever they stand. Consecutive starts with one anchor make a stretch (some 80 starts,
read with the LENGTH - 1 bytes after the last). Stretches whose anchor occurs once are done: nothing in them repeats.
Equal stretches are one, with a count; the texts of what is left are fetched for one place of each.

Stretches are grouped by anchor and put together, some 2 MB at a time, in one text whose suffixes are sorted by more than
LENGTH bytes. On its Burrows-Wheeler transform intervals are extended backwards, breadth first: those of strings of l + 1
bytes settle the common prefixes of l bytes, in rising order, each boundary once. It ends at LENGTH: boundaries that are
still open then have longer common prefixes, and the suffixes beside them start a string that starts elsewhere, too.

An anchor with more than FILE different stretches isn't sent to one task: its stretches are cut into blocks of BLOCK
starts keyed by the bytes that all strings of a block share; blocks whose key occurs again are taken apart into their
strings, which are counted by a 128-bit digest.

Null text counts as empty; texts below LENGTH bytes keep all. Repeated rows (equal id and text) count each and get the
same result; ids may be null and of any type that can be compared. Matches never cross documents. An empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexspark.llm.common import materialize, tidy

LENGTH, GRAM, BLOCK, FILE, BATCH, SEGMENT = 200, 32, 16, 4_096, 1 << 21, 1 << 18
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2**64
_END = b"\xff"  # in no UTF-8 text


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (1 << 64) - 1, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Grams:
    """Rolling hashes of all grams of a byte array."""

    def __init__(self, gram: int = GRAM):
        self.gram, self.up, self.down = gram, _powers(_BASE, 1), _powers(1, 1)

    def hashes(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            if len(x) > len(self.up):
                self.up, self.down = _powers(_BASE, len(x)), _powers(pow(_BASE, -1, 1 << 64), len(x))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * self.up[: len(x)])])
            h = (sums[self.gram :] - sums[: -self.gram]) * self.down[: len(sums) - self.gram]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            return h ^ (h >> np.uint64(29))


def least_of(h: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive values."""
    done = 1
    while done * 2 <= width:
        h = np.minimum(h[:-done], h[done:])
        done *= 2
    return np.minimum(h[: len(h) - (width - done)], h[width - done :]) if done < width else h


def _segments(texts: list[bytes | None], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Blobs of about SEGMENT bytes and their parts (text, offset in the text, place in the blob, starts): whole short texts, or pieces of long ones that overlap by length - 1."""
    held, parts, size = [], [], 0
    for k, text in enumerate(texts):
        for i in range(0, max(0, len(text or b"") - length + 1), SEGMENT):
            piece = text[i : i + SEGMENT + length - 1]
            parts.append((k, i, size, len(piece) - length + 1))
            held.append(piece)
            size += len(piece)
            if size >= SEGMENT:
                yield b"".join(held), parts
                held, parts, size = [], [], 0
    if held:
        yield b"".join(held), parts


def _stretches(length: int, gram: int, kind: pa.DataType):
    """mapInArrow over (doc, row, text): a row for each stretch, with its anchor h, the digest g of its bytes, its first start and number of starts; many: the anchor may stand in it twice."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(gram)
        for b in batches:
            docs, rows = b.column(0), b.column(1)
            for blob, parts in _segments(b.column(2).to_pylist(), length):
                h = grams.hashes(np.frombuffer(blob, np.uint8))
                low = least_of(h, length - gram + 1)
                text, offset, place, starts = np.array(parts, np.int64).T
                cut = np.unique(np.concatenate([np.flatnonzero(low[1:] != low[:-1]) + 1, place, place + starts]))
                first, end = cut[:-1], cut[1:]
                of = np.searchsorted(place, first, "right") - 1
                whole = first < place[of] + starts[of]
                first, end, of = first[whole], end[whole], of[whole]
                anchor, ordered = low[first], np.sort(h)
                twice = np.searchsorted(ordered, anchor, "right") - np.searchsorted(ordered, anchor) > 1
                view, digest = memoryview(blob), xxhash.xxh64_intdigest
                g = np.fromiter((digest(view[i : j + length - 1]) for i, j in zip(first.tolist(), end.tolist())), np.uint64, len(first))
                at = pa.array(text[of])
                yield pa.RecordBatch.from_arrays([docs.take(at), rows.take(at), pa.array(anchor.view(np.int64)), pa.array(g.view(np.int64)), pa.array(first - place[of] + offset[of], pa.int32()), pa.array(end - first, pa.int32()), pa.array(twice)],
                                                 schema=pa.schema([("doc", kind), ("row", pa.int64()), ("h", pa.int64()), ("g", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("many", pa.bool_())]))

    return run


def suffix_order(x: np.ndarray, depth: int) -> np.ndarray:
    """Places of x, read as a ring, in the order of what follows: of the first `depth` bytes at least; beyond twice that ties stand in any order."""
    n = len(x)
    ring = np.concatenate([x, x[: min(7, n)], np.zeros(max(0, 7 - n), np.uint8)]) if n >= 7 else np.resize(x, n + 7)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | ring[k : k + n]
    order = np.argsort(key)
    have, rank = 8, np.empty(n, np.int64)
    while have < depth:
        held = key[order]
        rank[order] = np.cumsum(np.concatenate([[0], held[1:] != held[:-1]]))
        key = rank << 32 | np.roll(rank, -have)
        order = np.argsort(key)
        have *= 2
    return order


class Transform:
    """The Burrows-Wheeler transform of a text, as bit planes from the lowest bit up: a place goes through all planes to where its byte's suffix stands."""

    def __init__(self, x: np.ndarray, order: np.ndarray):
        kinds = np.flatnonzero(np.bincount(x, minlength=256))
        code = np.zeros(256, np.uint8)
        code[kinds] = np.arange(len(kinds))
        last = code[x[order - 1]]
        moved = np.argsort(last, kind="stable")  # a radix sort
        self.n, self.last = len(x), last
        self.to = np.empty(self.n, np.int64)
        self.to[moved] = np.arange(self.n)
        self.planes = []
        for bit in range(max(1, int(len(kinds) - 1).bit_length())):
            one = last >> bit & 1
            zeros = np.concatenate([[0], np.cumsum(1 - one.astype(np.int32), dtype=np.int32)])
            self.planes.append((zeros, int(zeros[-1])))
            last = np.concatenate([last[one == 0], last[one == 1]])

    def extend(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of all strings that are one byte longer, to the left, than those of the intervals low:high."""
        for zeros, middle in self.planes:
            i, j = zeros[low], zeros[high]
            a, b = i < j, low - i < high - j
            low, high = np.concatenate([i[a], (middle + low - i)[b]]), np.concatenate([j[a], (middle + high - j)[b]])
        return low, high


def open_boundaries(bwt: Transform, length: int) -> np.ndarray:
    """For each place in suffix order (and the end), whether the common prefix with the place before is `length` or longer."""
    n = bwt.n
    unset = np.ones(n + 1, bool)
    unset[0] = unset[n] = False
    low, high, single = np.array([0], np.int32), np.array([n], np.int32), np.empty(0, np.int64)
    for _ in range(length):  # strings of l + 1 bytes settle common prefixes of l
        two = high - low == 2
        pair = low[two].astype(np.int64)
        same = bwt.last[pair] == bwt.last[pair + 1]
        near, lone = bwt.to[pair[same]], np.concatenate([single, pair[~same], pair[~same] + 1])
        lone = bwt.to[lone]
        wide_low, wide_high = bwt.extend(low[~two], high[~two])
        one = wide_high - wide_low == 1
        lone = np.concatenate([lone, wide_low[one]])
        low, high = np.concatenate([near.astype(np.int32), wide_low[~one]]), np.concatenate([(near + 2).astype(np.int32), wide_high[~one]])
        fresh, alone = unset[high], unset[lone + 1]
        low, high, single = low[fresh], high[fresh], lone[alone]
        unset[high] = unset[single + 1] = False
        if not len(high) and not len(single):
            break
    return unset


def repeated_starts(pieces: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each piece, booleans over its starts: whether the string there starts a second time in any of the pieces, itself included."""
    x = np.frombuffer(_END.join(pieces) + _END, np.uint8)
    order = suffix_order(x, length)
    far = open_boundaries(Transform(x, order), length)
    found = np.zeros(len(x), bool)
    found[order] = far[:-1] | far[1:]
    out, at = [], 0
    for p in pieces:
        out.append(found[at : at + max(0, len(p) - length + 1)])
        at += len(p) + 1
    return out


def _runs(found: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(found.view(np.int8), prepend=0, append=0))
    return edge[::2].tolist(), edge[1::2].tolist()


_VERDICT = "h long, g long, first array<int>, last array<int>"


def _settle(length: int):
    """mapInArrow over (h, g, n, whole, bytes) in the order of h: the repeated starts of each stretch. All stretches of an anchor are in one batch."""

    def batch(held: list[tuple]) -> pa.RecordBatch:
        out = []
        for (h, g, n, whole, _), found in zip(held, repeated_starts([r[4] for r in held], length)):
            first, last = ([0], [n]) if whole else _runs(found)
            if first:
                out.append((h, g, first, last))
        cols = list(zip(*out)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))], ["h", "g", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns]):
                if size >= BATCH and r[0] != held[-1][0]:
                    yield batch(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4]) + 1
        if held:
            yield batch(held)

    return run


def _cut_out(length: int):
    """mapInArrow over (text, parts): the bytes of the stretches for which a text was chosen, of equal rows once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for text, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if parts[0]["g"] in seen and all(p["g"] in seen for p in parts):
                    continue
                seen = seen if len(seen) < 1 << 18 else set()
                seen.update(p["g"] for p in parts)
                rows = [(p["h"], p["g"], p["n"], p["whole"], p["large"], text[p["at"] : p["at"] + p["n"] + length - 1]) for p in parts]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()))], ["h", "g", "n", "whole", "large", "bytes"])

    return run


def _blocks(length: int, gram: int, block: int):
    """mapInArrow over (h, g, bytes): for each stretch its blocks of starts whose strings hold the anchor equally far in, and a hash of what they all hold."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(gram)
        for b in batches:
            out = []
            for h, g, raw in zip(*[c.to_pylist() for c in b.columns]):
                starts, low = len(raw) - length + 1, 0
                seed = h & (1 << 64) - 1
                for a in np.flatnonzero(grams.hashes(np.frombuffer(raw, np.uint8)).view(np.int64) == h).tolist():
                    # strings that start after the anchor before this one and hold this one first
                    for j in range((a - low) // block, -1, -1):
                        i, end = max(low, a - block * j - block + 1), min(a - block * j + 1, starts)
                        if i < end:
                            at = a - block * j
                            out.append((xxhash.xxh64_intdigest(raw[at : at + length - block + 1], (seed + j) & (1 << 64) - 1), h, g, i, end))
                    low = a + 1
            cols = list(zip(*out)) or [[]] * 5
            key = pa.array(np.array(cols[0], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([key, *[pa.array(c, t) for c, t in zip(cols[1:], (pa.int64(), pa.int64(), pa.int32(), pa.int32()))]], ["key", "h", "g", "i", "j"])

    return run


def _strings(length: int):
    """mapInArrow over (h, g, bytes, parts): a digest of each string of the parts."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, g, raw, parts in zip(*[c.to_pylist() for c in b.columns]):
                at = [p for r in parts for p in range(r["i"], r["j"])]
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(raw[p : p + length]) for p in at], pa.binary()), pa.array([h] * len(at), pa.int64()), pa.array([g] * len(at), pa.int64()), pa.array(at, pa.int32())], ["key", "h", "g", "p"])

    return run


def _large_anchors(pieces: DataFrame, length: int, gram: int, block: int) -> DataFrame:
    """Repeated starts of the stretches (h, g, bytes) of anchors that have too many for one task."""
    blocks = materialize(pieces.select("h", "g", "bytes").mapInArrow(_blocks(length, gram, block), "key long, h long, g long, i int, j int"), "blocks")
    again = materialize(blocks.groupBy("key").count().where("count > 1").select("key"), "again")
    parts = blocks.join(again, "key").groupBy("h", "g").agg(F.collect_list(F.struct("i", "j")).alias("parts"))  # as many as a stretch has blocks
    strings = pieces.select("h", "g", "bytes").join(parts, ["h", "g"]).mapInArrow(_strings(length), "key binary, h long, g long, p int")
    strings = materialize(strings, "strings")
    twice = materialize(strings.groupBy("key").count().where("count > 1").select("key"), "twice")
    found = strings.join(twice, "key").groupBy("h", "g").agg(F.sort_array(F.collect_list("p")).alias("first"))
    return found.select("h", "g", "first", F.transform("first", lambda p: p + 1).alias("last"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, file: int = FILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, row (hash of the text) and first, last (arrays of equal length: runs of bytes that lie in repeated strings, in no order, overlapping) of the documents that have such bytes."""
    if gram > length - BLOCK:
        raise ValueError("gram must be shorter than length by the size of a block")
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row"), F.col(text_col).cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType
    schema = f"doc {kind.simpleString()}, row long, h long, g long, at int, n int, many boolean"
    stretches = materialize(rows.mapInArrow(tidy(_stretches(length, gram, to_arrow_type(kind))), schema), "stretches")
    anchors = materialize(stretches.groupBy("h").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("c")).where("c > 1").select("h"), "anchors")
    places = materialize(stretches.join(anchors, "h"), "places")
    # one place for each different stretch, and the number of different stretches of each anchor
    one = materialize(places.groupBy("h", "g").agg(F.count("*").alias("c"), F.bool_or("many").alias("many"), F.min(F.struct("row", "doc", "at", "n")).alias("p")), "different")
    groups = materialize(one.groupBy("h").agg(F.count("*").alias("k")), "groups")
    one = one.join(groups, "h").select("h", "g", "k", (F.col("c") > 1).alias("whole"), "many", "p.*")
    settled = (F.col("k") == 1) & F.col("whole")
    alone = one.where(settled).select("h", "g", F.array(F.lit(0)).alias("first"), F.array("n").alias("last"))
    chosen = one.where((F.col("k") > 1) | F.col("many") & ~F.col("whole")).groupBy("row", "doc").agg(F.collect_list(F.struct("h", "g", "at", "n", "whole", (F.col("k") > file).alias("large"))).alias("parts"))
    chosen = materialize(chosen.withColumnRenamed("doc", "of"), "chosen")
    cut = rows.join(chosen, "row").where(F.col("doc").eqNullSafe(F.col("of"))).select("text", "parts").mapInArrow(tidy(_cut_out(length)), "h long, g long, n int, whole boolean, large boolean, bytes binary")
    cut = materialize(cut, "cut")
    small = cut.where("not large").select("h", "g", "n", "whole", "bytes").repartition("h").sortWithinPartitions("h").mapInArrow(tidy(_settle(length)), _VERDICT)
    large = cut.where("large")
    several = large.where("whole").select("h", "g", F.array(F.lit(0)).alias("first"), F.array("n").alias("last"))
    verdicts = alone.unionByName(several).unionByName(small)
    if large.limit(1).count():
        verdicts = verdicts.unionByName(_large_anchors(large.dropDuplicates(["h", "g"]), length, gram, BLOCK))
    verdicts = materialize(verdicts, "verdicts")
    marks = places.select("doc", "row", "h", "g", "at").join(verdicts, ["h", "g"])
    marks = marks.select("doc", "row", F.transform("first", lambda p: p + F.col("at")).alias("first"), F.transform("last", lambda p: p + F.col("at") + (length - 1)).alias("last"))
    spans = marks.groupBy("row", "doc").agg(F.collect_set(F.struct("first", "last")).alias("s"))  # as many as a text has stretches
    return spans.select("doc", "row", F.flatten("s.first").alias("first"), F.flatten("s.last").alias("last"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, first, last) to the kept bytes and the removed runs, in order and apart."""
    for b in batches:
        kept, starts, ends = [], [], []
        for text, first, last in zip(*[b.column(k).to_pylist() for k in (1, 2, 3)]):
            text = text or b""
            runs: list[list[int]] = []
            for i, j in sorted(zip(first or (), last or ())):
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = max(j, runs[-1][1])
                else:
                    runs.append([i, j])
            edges = [0, *[x for r in runs for x in r], len(text)]
            kept.append(b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2])))
            starts.append([r[0] for r in runs])
            ends.append([r[1] for r in runs])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t or b"") for t in b.column(1).to_pylist()], pa.int64()), pa.array(kept, pa.binary()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))], ["doc", "n_bytes", "kept", "starts", "ends"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, file: int = FILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, kept (the bytes that are left, which need not be UTF-8), starts and ends of the removed runs, for every document."""
    spans = materialize(repeated_spans(docs, length, gram, file, id_col, text_col).withColumnsRenamed({"doc": "of", "row": "of_row"}), "spans")
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row"), F.col(text_col).cast("binary").alias("text"))
    met = rows.join(spans, (F.col("row") == F.col("of_row")) & F.col("doc").eqNullSafe(F.col("of")), "left").select("doc", "text", "first", "last")
    kind = docs.schema[id_col].dataType.simpleString()
    return met.mapInArrow(tidy(_remove), f"doc {kind}, n_bytes long, kept binary, starts array<int>, ends array<int>").withColumnRenamed("doc", id_col)


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
p AS (SELECT doc_id, n, j, substring(x, 2000 * j + 1, 2400) AS x FROM (SELECT doc_id, x, n, unnest(range(0, (n - 200) // 1000 + 1)) AS j FROM d WHERE n >= 200)),
s AS (SELECT doc_id, 1000 * j + i AS i, md5(substring(x, 2 * i - 1, 400)) AS k FROM (SELECT doc_id, x, j, unnest(range(1, least(1000, n - 199 - 1000 * j) + 1)) AS i FROM p)),
r AS (SELECT doc_id, i FROM s SEMI JOIN (SELECT k FROM s GROUP BY k HAVING count(*) > 1) USING (k)),
b AS (SELECT doc_id, i, coalesce(i > lag(i) OVER w + 200, true) AS fresh FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b) GROUP BY doc_id, run),
l AS (SELECT doc_id, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z FROM g GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(list_sum(z) - list_sum(a), 0)::BIGINT AS n_removed, coalesce(len(a), 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN a IS NULL THEN x ELSE array_to_string(list_transform(range(1, len(a) + 2), lambda k: substring(x, 2 * (CASE WHEN k = 1 THEN 1 ELSE z[k - 1] END) - 1, 2 * ((CASE WHEN k > len(a) THEN n + 1 ELSE a[k] END) - (CASE WHEN k = 1 THEN 1 ELSE z[k - 1] END)))), '') END)) AS kept_sha256
FROM d LEFT JOIN l USING (doc_id)
"""
