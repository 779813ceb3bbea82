"""Operator 3, SimHash near-dedup: pigeonring filtering of 64-bit fingerprints.

A fingerprint's 64 bits are dealt into tau+1 segments on a ring. If two fingerprints differ in at most tau bits, then
from some segment on, the first has no difference, the first two at most 2*tau/(tau+1), and so on: every run of l
segments stays within l*tau/(tau+1). A fingerprint is therefore filed under each pair of neighbouring segments and
looked up there as it is and with one 0 bit of the second segment set; a joined candidate must keep the longer chains'
budgets before its full Hamming distance is taken. Copies meet in one fingerprint before that. In a file, members
near the file's smallest fingerprint link to it alone, so a dense group makes a star of links, not all its pairs. A
file of more than FILE members is filed again under each of its other segments: these have tau differences at most
between them, so one of them has at most one. Of such a file again, one of more than REFILED members is filed a third
time, under each segment that is left, within the differences that one of them must keep (two of the usual five
segments): its members share all bits but one segment's, so that no file has more than 2^13, however many texts there are.

Null text counts as empty (fingerprint zero, linked like any other). Ids may repeat or be null: a class id is the
smallest id in it, null only where no member has one. An empty table gives an empty result; extra columns are ignored.
Document ids are 64-bit integers, or strings of such; another id ends in CAST_INVALID_INPUT.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.common import connected_components, for_join, materialize, tidy, unused

FILE = 64
REFILED = 1024
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, width: int = 4) -> int:
    """64-bit SimHash of word shingles, repeats included, under XXH64 with seed 42."""
    import xxhash

    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())  # bytes.lower() changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < width:
        h = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1).tolist()
        digest = xxhash.xxh64_intdigest
        h = [digest(joined[i : j - 1], 42) for i, j in zip([0, *ends], ends[width - 1 :])]
    count = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        part = np.array(h[k : k + (1 << 16)], np.uint64)
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, width) for t in b.column("text").to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(fp.view(np.int64))], ["doc_id", "row", "fp"])

    return run


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row (a hash that tells texts apart) and fp (signed 64 bits) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tidy(_fingerprints(width)), "doc_id long, row long, fp long")


def _segments(tau: int) -> list[tuple[int, int]]:
    """(first bit, width) of tau+1 segments of nearly equal width."""
    cut = [round(64 * k / (tau + 1)) for k in range(tau + 2)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def _bits(c: Column, seg: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(c, seg[0]).bitwiseAND(F.lit((1 << seg[1]) - 1))


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _chain(a: str, b: str, segs: list[tuple[int, int]], start: Column, tau: int) -> Column:
    """Whether every chain from segment `start` on keeps its budget."""
    m, x = len(segs), F.col(a).bitwiseXOR(F.col(b))
    out = F.lit(False)
    for s in range(m):
        ok, total = start == s, F.lit(0)
        for n in range(1, m + 1):
            total = total + F.bit_count(_bits(x, segs[(s + n - 1) % m]))
            if n >= 2:
                ok = ok & (total <= n * tau // m)
        out = out | ok
    return out


def _flips(c: Column, seg: tuple[int, int], make) -> Column:
    """make(bits of the segment with one more bit set), for each bit of it that isn't."""
    v = _bits(c, seg)
    return F.array_compact(F.array(*[F.when(v.bitwiseAND(F.lit(1 << j)) == 0, make(v.bitwiseOR(F.lit(1 << j)))) for j in range(seg[1])]))


def _met(rows: DataFrame, keys: list[str], tau: int, name: str) -> DataFrame:
    """rows (fp, guest and keys of a file) with the file's smallest member (lead), its number of members and `near`: within tau of the lead.

    Guests aren't members. A file of one member is settled by its lead; of fuller ones all rows stay. The files are
    written before they are joined, so that Spark may split one that many rows ask for; exploded rows are shuffled, as they come from few tasks.
    """
    files = materialize(rows.where("not guest").groupBy(*keys).agg(F.min("fp").alias("lead"), F.count("*").alias("n")), f"{name}-files")
    near = _distance("fp", "lead") <= tau
    return materialize(rows.join(files.hint("merge"), keys).where((F.col("fp") != F.col("lead")) & (near | (F.col("n") > 1))).withColumn("near", near), name)


def _pairs(met: DataFrame, keys: list[str], segs: list[tuple[int, int]], tau: int, n: int) -> DataFrame:
    """Verified links (u, v) of rows (n at most) with members of their file, unless both are near its lead."""
    hosts = met.where("not guest").select(*keys, F.col("fp").alias("host"), F.col("near").alias("host_near"))
    return met.join(for_join(hosts, n), keys).where(
        ~(F.col("near") & F.col("host_near")) & (F.col("guest") | (F.col("fp") < F.col("host")))
        & _chain("fp", "host", segs, F.col("s"), tau) & (_distance("fp", "host") <= tau)).select(F.col("fp").alias("u"), F.col("host").alias("v"))


def links(fps: DataFrame, tau: int = 4, file: int = FILE, refiled: int = REFILED) -> DataFrame:
    """Undirected links (u, v) whose components are those of all pairs of distinct fps at distance <= tau.

    tau is at least 1 and at most 15. A pair in a file is left out only if both link to the file's leader.
    """
    segs = _segments(tau)
    m = len(segs)
    # the first two segments' budget is one difference, as tau is at least 1
    if not 1 <= tau <= 15:
        raise ValueError("tau from 1 to 15")

    def key(s: int, second: Column) -> Column:
        return F.struct(F.lit(s).cast("byte").alias("s"), F.shiftleft(_bits(F.col("fp"), segs[s]), segs[(s + 1) % m][1]).bitwiseOR(second).alias("k"))

    own = F.array(*[key(s, _bits(F.col("fp"), segs[(s + 1) % m])) for s in range(m)])
    flips = F.concat(*[_flips(F.col("fp"), segs[(s + 1) % m], lambda v, s=s: key(s, v)) for s in range(m)])
    home = fps.select("fp", F.lit(False).alias("guest"), F.explode(own).alias("at")).select("fp", "guest", "at.s", "at.k")
    visit = fps.select("fp", F.lit(True).alias("guest"), F.explode_outer(flips).alias("at")).where("at is not null").select("fp", "guest", "at.s", "at.k")
    met = _met(home.unionByName(visit), ["s", "k"], tau, "files")
    n_met = met.count()
    star = met.where("near").select(F.col("fp").alias("u"), F.col("lead").alias("v"))
    if m < 4 or tau // (m - 2) > 1:  # no other segment is sure to have one difference at most
        return star.unionByName(_pairs(met.where("n > 1"), ["s", "k"], segs, tau, n_met))
    out = star.unionByName(_pairs(met.where((F.col("n") > 1) & (F.col("n") <= file)), ["s", "k"], segs, tau, n_met))
    large = met.where(F.col("n") > file)

    def under(make) -> Column:
        """For a row filed under s: make(t, segment) of the m - 2 segments that s doesn't cover."""
        kinds = [(s, F.concat(*[make(t, segs[t]) for t in range(m) if t not in (s, (s + 1) % m)])) for s in range(m)]
        c = None
        for s, a in kinds:
            c = F.when(F.col("s") == s, a) if c is None else c.when(F.col("s") == s, a)
        return c

    again = lambda t, v: F.struct(F.lit(t).cast("byte").alias("t"), v.alias("l"))
    base = large.select("fp", "s", "k", "guest")
    # a row meets the members with its own bits, and those with one more set; members with one fewer meet it from their side, or a guest looks for them itself
    own2 = under(lambda t, seg: F.array(again(t, _bits(F.col("fp"), seg))))
    more = under(lambda t, seg: _flips(F.col("fp"), seg, lambda v: again(t, v)))
    less = under(lambda t, seg: F.array_compact(F.array(*[F.when(_bits(F.col("fp"), seg).bitwiseAND(F.lit(1 << j)) != 0, again(t, _bits(F.col("fp"), seg).bitwiseXOR(F.lit(1 << j)))) for j in range(seg[1])])))
    spread = lambda rows, guest, at: rows.select("fp", "s", "k", guest.alias("guest"), F.explode(at).alias("at")).select("fp", "s", "k", "guest", "at.t", "at.l")
    rows = spread(base, F.col("guest"), own2).unionByName(spread(base, F.lit(True), more)).unionByName(spread(base.where("guest"), F.lit(True), less))
    keys = ["s", "k", "t", "l"]
    met2 = _met(rows, keys, tau, "refiled")
    n_met2 = met2.count()
    out = out.unionByName(met2.where("near").select(F.col("fp").alias("u"), F.col("lead").alias("v")))
    crowded = met2.where(F.col("n") > refiled)
    if m < 5 or crowded.isEmpty():  # four segments leave one, which may hold all differences
        return out.unionByName(_pairs(met2.where("n > 1"), keys, segs, tau, n_met2))
    out = out.unionByName(_pairs(met2.where((F.col("n") > 1) & (F.col("n") <= refiled)), keys, segs, tau, n_met2))

    def under_rest(masks) -> Column:
        """For a row filed under s and t: (segment, its bits changed by each of masks(width)) of the segments that are left."""
        kind = "array<struct<v:tinyint,w:bigint>>"
        kinds = []
        for v in range(m):
            bits = F.transform(F.array(*[F.lit(x).cast("long") for x in masks(segs[v][1])]), lambda x: F.struct(F.lit(v).cast("byte").alias("v"), _bits(F.col("fp"), segs[v]).bitwiseXOR(x).alias("w")))  # noqa: B023
            kinds.append(F.when(~F.col("s").isin(v, (v - 1) % m) & (F.col("t") != v), bits.cast(kind)).otherwise(F.array().cast(kind)))
        return F.concat(*kinds)

    def changed(width: int) -> list[int]:
        """Numbers of one bit and more, up to the differences that one of the m - 3 segments must keep."""
        return [sum(1 << b for b in c) for n in range(1, tau // (m - 3) + 1) for c in combinations(range(width), n)]

    third = lambda guest, masks: crowded.select("fp", *keys, guest.alias("guest"), F.explode(under_rest(masks)).alias("at")).select("fp", *keys, "guest", "at.v", "at.w")
    keys3 = [*keys, "v", "w"]
    met3 = _met(third(F.col("guest"), lambda _: [0]).unionByName(third(F.lit(True), changed)), keys3, tau, "refiled-again")
    return out.unionByName(met3.where("near").select(F.col("fp").alias("u"), F.col("lead").alias("v"))).unionByName(_pairs(met3.where("n > 1"), keys3, segs, tau, met3.count()))


def near_duplicates(docs: DataFrame, tau: int = 4, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, fp and component_id (smallest id reachable) of every row."""
    rows = materialize(fingerprints(docs, width, id_col, text_col), "fingerprints")
    n = rows.count()
    reps = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = connected_components(links(reps.select("fp"), tau))
    named = reps.join(for_join(roots.withColumnRenamed("node", "fp"), n), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialize(named, "classes")
    # written, so that Spark may split the fingerprints of one root
    ids = materialize(named.groupBy("root").agg(F.min("low").alias("component_id")), "class-ids")
    return rows.join(for_join(named.join(for_join(ids, n), "root").select("fp", "component_id"), n), "fp").select("doc_id", "row", "fp", "component_id")


def keep_one(docs: DataFrame, tau: int = 4, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component: that of the smallest id (nulls last), then of the smallest text hash."""
    found = near_duplicates(docs, tau, width, id_col, text_col)
    first = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("row").alias("r"))
    # a component of nulls only has a null id; its smallest fingerprint names it
    found = found.withColumn("part", F.when(F.col("component_id").isNull(), F.col("fp")))
    rows = found.groupBy("component_id", "part", "doc_id", "row").agg(F.count("*").alias("n"), F.min(first).alias("f"))
    kept = rows.groupBy("component_id", "part").agg(F.min(F.struct("f", "n")).alias("k"))
    k_id, k_row, k_n, row = unused(docs, "kept_id", "kept_row", "kept_n", "row")
    kept = materialize(kept.select(F.col("k.f.i").alias(k_id), F.col("k.f.r").alias(k_row), F.col("k.n").alias(k_n)), "kept")
    marked = docs.withColumn(row, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    mine = F.col(id_col).cast("long").eqNullSafe(F.col(k_id)) & (F.col(row) == F.col(k_row))
    out = marked.join(for_join(kept.where(F.col(k_n) == 1), kept.count()), mine, "left_semi").drop(row)
    again = kept.where(F.col(k_n) > 1)
    if again.isEmpty():
        return out
    return out.unionByName(marked.join(for_join(again, again.count()), mine, "left_semi").dropDuplicates([id_col, row]).drop(row))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
