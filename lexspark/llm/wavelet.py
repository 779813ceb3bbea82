"""Operator 2, token-id output: one wavelet matrix for each shard.

A shard holds the ids of consecutive documents as bit planes, most significant first. Each plane keeps the stable
order of the partition by the plane above, its ones counted at every 512th place, so that access, counts (rank) and
places of occurrence (select) need no decoding. A plane is stored in zstd frames of FRAME bytes behind a small header of
their sizes: a look-up inflates the frames that it touches and no others. A shard is one row of a Parquet table, which
Spark's committer writes whole or not at all on any store.

Null text: only the end id. Null ids sort first. Repeated ids are told apart by their text; equal rows follow each
other. An empty table gives a table without shards. Extra columns are ignored.
Document ids are 64-bit integers, or strings of such; another id ends in CAST_INVALID_INPUT.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.llm.bpe import encoder, vocabulary
from lexspark.llm.common import scratch_path, tidy

MAGIC = b"LXW2"
BLOCK = 512
FRAME = 8192  # bytes of a plane that are compressed on their own
SHARD_TOKENS = 1 << 20
SHARD_SCHEMA = "part int, ord int, n_docs long, n_tokens long, payload binary"


class _Plane:
    """Bits of one level: in memory, or as frames that are inflated when they are looked at."""

    def __init__(self, packed: np.ndarray | None = None, frames: list[memoryview] | None = None, z=None):
        self.packed, self.frames, self.z, self.held = packed, frames, z, {}

    def _frame(self, k: int) -> np.ndarray:
        if k not in self.held:
            self.held[k] = np.frombuffer(self.z.decompress(self.frames[k]), np.uint8)
        return self.held[k]

    def bytes(self, i: int, j: int) -> np.ndarray:
        """Bytes i to j, within one frame where the plane is stored."""
        if self.packed is not None:
            return self.packed[i:j]
        at = i // FRAME * FRAME
        return self._frame(i // FRAME)[i - at : j - at]

    def whole(self) -> np.ndarray:
        if self.packed is None:
            parts = [self._frame(k) for k in range(len(self.frames))]
            self.packed = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        return self.packed


class WaveletMatrix:
    """Immutable sequence of small ints with access, rank and select on its bit planes."""

    def __init__(self, n: int, zeros: list[int], planes: list[_Plane], ranks: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.ranks = n, zeros, planes, ranks

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        a = np.ascontiguousarray(values)
        zeros, planes, ranks = [], [], []
        for k in range(bits - 1, -1, -1):
            one = (a & a.dtype.type(1 << k)) != 0
            packed = np.packbits(one)
            low, high = a[~one], a[one]
            zeros.append(len(low))
            planes.append(_Plane(packed))
            ranks.append(cls._directory(packed))
            a = np.concatenate([low, high])
        return cls(len(values), zeros, planes, ranks)

    @staticmethod
    def _directory(packed: np.ndarray) -> np.ndarray:
        """Ones before each block of 512 places."""
        step = BLOCK // 8
        ones = np.bitwise_count(packed)
        sums = np.add.reduceat(ones, np.arange(0, len(ones), step), dtype=np.uint32) if len(ones) else np.zeros(0, np.uint32)
        return np.concatenate([[0], np.cumsum(sums)]).astype(np.uint32)

    def _bit(self, k: int, i: int) -> int:
        return int(self.planes[k].bytes(i >> 3, (i >> 3) + 1)[0] >> (7 - (i & 7))) & 1

    def _ones(self, k: int, i: int) -> int:
        """Ones among the first i places of plane k."""
        b = i // BLOCK
        n, at = int(self.ranks[k][b]), b * BLOCK // 8
        if i % BLOCK:
            part = self.planes[k].bytes(at, (i >> 3) + (i & 7 > 0))
            n += int(np.bitwise_count(part[: (i >> 3) - at]).sum()) + (int(part[-1] >> (8 - (i & 7))).bit_count() if i & 7 else 0)
        return n

    def access(self, i: int) -> int:
        v = 0
        for k, z in enumerate(self.zeros):
            bit, ones = self._bit(k, i), self._ones(k, i)
            v, i = v << 1 | bit, z + ones if bit else i - ones
        return v

    def _range(self, value: int, i: int) -> tuple[int, int]:
        """Where value's occurrences among the first i places lie below the last plane."""
        lo, hi = 0, i
        for k, z in enumerate(self.zeros):
            a, b = self._ones(k, lo), self._ones(k, hi)
            lo, hi = (z + a, z + b) if value >> (len(self.zeros) - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, value: int, i: int) -> int:
        """Occurrences of value among the first i places."""
        lo, hi = self._range(value, i)
        return hi - lo

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def _select_bits(self, k: int, bit: int, j: np.ndarray) -> np.ndarray:
        """Places of the j-th (from 0) ones or zeros of plane k: each block that holds some is opened once."""
        d = self.ranks[k].astype(np.int64)
        d = d if bit else np.arange(len(d)) * BLOCK - d
        b = np.minimum(np.searchsorted(d, j, "right") - 1, len(d) - 2)
        blocks, of = np.unique(b, return_inverse=True)
        step, plane = BLOCK // 8, self.planes[k]
        parts = [plane.bytes(at, at + step) for at in (blocks * step).tolist()]
        if len(parts[-1]) < step:
            parts[-1] = np.concatenate([parts[-1], np.zeros(step - len(parts[-1]), np.uint8)])
        inside, column = np.nonzero(np.unpackbits(np.stack(parts), axis=1) == bit)
        first = np.searchsorted(inside, np.arange(len(blocks)))
        return b * BLOCK + column[first[of] + j - d[b]]

    def selects(self, value: int, j: np.ndarray) -> np.ndarray:
        """Places of the j-th (from 0) occurrences of value, all at once."""
        lo, hi = self._range(value, self.n)
        if len(j) and not (0 <= j.min() and j.max() < hi - lo):
            raise IndexError("no such occurrence")
        i = lo + j.astype(np.int64)
        for k in range(len(self.zeros) - 1, -1, -1):
            bit = value >> (len(self.zeros) - 1 - k) & 1
            if len(i):
                i = self._select_bits(k, bit, i - self.zeros[k] if bit else i)
        return i

    def select(self, value: int, j: int) -> int:
        """Place of the j-th (from 0) occurrence of value."""
        return int(self.selects(value, np.array([j], np.int64))[0])

    def decode(self, dtype) -> np.ndarray:
        """All values, from the last plane up."""
        a = np.zeros(self.n, dtype)
        for k in range(len(self.zeros) - 1, -1, -1):
            one = np.unpackbits(self.planes[k].whole(), count=self.n).view(bool)
            out = np.empty_like(a)
            out[~one] = a[: self.zeros[k]]
            out[one] = a[self.zeros[k] :] | a.dtype.type(1 << (len(self.zeros) - 1 - k))
            a = out
        return a

    def dump(self, z) -> bytes:
        parts = [struct.pack("<QB", self.n, len(self.zeros))]
        for zero, plane, rank in zip(self.zeros, self.planes, self.ranks):
            packed = plane.whole()
            frames, r = [z.compress(packed[i : i + FRAME].tobytes()) for i in range(0, len(packed), FRAME)], z.compress(rank.tobytes())
            parts.append(struct.pack(f"<QII{len(frames)}I", zero, len(frames), len(r), *map(len, frames)) + r + b"".join(frames))
        return b"".join(parts)

    @classmethod
    def load(cls, blob: memoryview, z) -> WaveletMatrix:
        n, bits = struct.unpack_from("<QB", blob)
        at, zeros, planes, ranks = 9, [], [], []
        for _ in range(bits):
            zero, m, r = struct.unpack_from("<QII", blob, at)
            sizes = struct.unpack_from(f"<{m}I", blob, at + 16)
            at += 16 + 4 * m
            zeros.append(zero)
            ranks.append(np.frombuffer(z.decompress(blob[at : at + r]), np.uint32))
            at += r
            frames = []
            for size in sizes:
                frames.append(blob[at : at + size])
                at += size
            planes.append(_Plane(frames=frames, z=z))
        return cls(n, zeros, planes, ranks)


class Shard:
    """Documents' ids (None allowed), their token counts, and the wavelet matrix of all their tokens."""

    def __init__(self, doc_ids: list[int | None], lengths: np.ndarray, matrix: WaveletMatrix):
        self.doc_ids, self.lengths, self.matrix = doc_ids, lengths, matrix
        self.starts = np.cumsum(lengths) - lengths

    def dump(self) -> bytes:
        import zstandard

        z = zstandard.ZstdCompressor(level=1)
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        head = z.compress(known.tobytes() + np.array([d or 0 for d in self.doc_ids], "<i8").tobytes() + self.lengths.astype("<i8").tobytes())
        return MAGIC + struct.pack("<QI", len(self.doc_ids), len(head)) + head + self.matrix.dump(z)

    @classmethod
    def load(cls, blob: bytes) -> Shard:
        import zstandard

        if blob[:4] != MAGIC:
            raise ValueError("not a shard")
        z = zstandard.ZstdDecompressor()
        n, size = struct.unpack_from("<QI", blob, 4)
        head = z.decompress(blob[16 : 16 + size])
        ids = np.frombuffer(head, "<i8", n, n)
        known = np.frombuffer(head, np.uint8, n)
        return cls([int(d) if k else None for d, k in zip(ids, known)], np.frombuffer(head, "<i8", n, 9 * n), WaveletMatrix.load(memoryview(blob)[16 + size :], z))


def _build_shards(path: str, kind: str, end_id: int, bits: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, ordinal = encoder(path, kind), TaskContext.get().partitionId(), 0
        end = np.array([end_id], enc.dtype)
        docs, ids, held = [], [], 0

        def shard() -> pa.RecordBatch:
            lengths = np.array([len(x) + 1 for x in ids], np.int64)
            tokens = np.concatenate([y for x in ids for y in (x, end)])
            blob = Shard(docs, lengths, WaveletMatrix.build(tokens, bits)).dump()
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([ordinal], pa.int32()), pa.array([len(docs)]), pa.array([len(tokens)]), pa.array([blob], pa.binary())], ["part", "ord", "n_docs", "n_tokens", "payload"])

        for b in batches:
            for doc, x in zip(b.column("doc_id").to_pylist(), enc.batch(b.column("text").to_pylist())):
                docs.append(doc)
                ids.append(x)
                held += len(x) + 1
                if held >= shard_tokens:
                    yield shard()
                    docs, ids, held, ordinal = [], [], 0, ordinal + 1
        if docs:
            yield shard()

    return run


def write_shards(docs: DataFrame, out_path: str, vocab: str | None = None, kind: str = "byte", end_id: int = 2, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts in ascending id order and write shards of about shard_tokens ids to out_path."""
    vocab = vocab or vocabulary("byte_bpe_50k.json")
    size = encoder(vocab, kind).tokenizer.get_vocab_size()
    bits = max(size - 1, end_id).bit_length()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    ordered.mapInArrow(tidy(_build_shards(vocab, kind, end_id, bits, shard_tokens)), SHARD_SCHEMA).write.option("compression", "uncompressed").mode("overwrite").parquet(out_path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def _read_documents(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, ordinal, blob in zip(*(b.column(c).to_pylist() for c in ("part", "ord", "payload"))):
                s = Shard.load(blob)
                ids = s.matrix.decode(np.uint16 if len(s.matrix.zeros) <= 16 else np.uint32).astype("<u4")
                cut = list(zip(s.starts.tolist(), (s.starts + s.lengths).tolist()))
                crc = [zlib.crc32(ids[i:j]) for i, j in cut]
                n = len(cut)
                cols = [pa.array([part] * n, pa.int32()), pa.array([ordinal] * n, pa.int32()), pa.array(s.doc_ids, pa.int64()), pa.array(s.starts), pa.array(s.lengths), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array([0] + [j for _, j in cut], pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, ["part", "ord", "doc_id", "local_start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    return run


def shard_documents(shards: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document, read back from its shard."""
    schema = "part int, ord int, doc_id long, local_start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    rows = shards.select("part", "ord", "payload").mapInArrow(tidy(_read_documents(with_ids)), schema)
    # the parts' sums (one row for each task that wrote) are put in order; the shards of a part, within it
    sums = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    first = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    before = Window.partitionBy("part").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("part", "ord", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("inside")).join(first, "part").select("part", "ord", (F.col("first") + F.col("inside")).alias("base"))
    return rows.join(offsets, ["part", "ord"]).select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def token_occurrences(shards: DataFrame, token: int, row_places: int = 100_000) -> DataFrame:
    """part, ord, n and places (within the shard) of a token, by rank and select without decoding; a row lists row_places at most, further ones follow in rows of their own."""

    def run(batches):
        for b in batches:
            for part, ordinal, blob in zip(*(b.column(c).to_pylist() for c in ("part", "ord", "payload"))):
                m = Shard.load(blob).matrix
                n = m.count(token)
                for j in range(0, max(n, 1), row_places):
                    places = m.selects(token, np.arange(j, min(n, j + row_places)))
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([ordinal], pa.int32()), pa.array([n]), pa.ListArray.from_arrays(pa.array([0, len(places)], pa.int32()), pa.array(places, pa.int64()))], ["part", "ord", "n", "places"])

    return shards.select("part", "ord", "payload").mapInArrow(run, "part int, ord int, n long, places array<long>")


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    write_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return shard_documents(read_shards(spark, path))
