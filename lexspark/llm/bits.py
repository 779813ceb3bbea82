"""Bit tables: a bounded set of hashes that lets every member through and few others."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, MOST = 20, 26  # powers of two: 128 KB to 8 MB


class BitTable:
    """One bit for each hash of 64 signed bits, by its leading bits. A full table lets everything through: callers count on members only."""

    def __init__(self, table: np.ndarray, bits: int):
        self.table, self.bits, self.raw = table, bits, table.tobytes()

    def passes(self, h: np.ndarray) -> np.ndarray:
        """Booleans, one for each hash."""
        at = (h.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64)
        return (self.table[at >> 3] >> (at & 7).astype(np.uint8) & 1).view(bool)

    def holds(self, h: int) -> bool:
        at = h >> (64 - self.bits)
        return self.raw[at >> 3] >> (at & 7) & 1 == 1


def bit_table(hashes: DataFrame, col: str = "h", most: int = MOST) -> BitTable:
    """Table of a column of longs, 16 bits for each up to `most`: words of 16 bits are OR-ed in Spark, so that at most 2**(most - 4) rows reach the driver."""
    bits = min(most, max(LEAST, (16 * hashes.count()).bit_length()))
    lead = F.shiftrightunsigned(col, 64 - bits)
    bit = F.call_function("shiftleft", F.lit(1), lead.bitwiseAND(F.lit(15)).cast("int"))
    rows = hashes.groupBy(F.shiftright(lead, 4).alias("w")).agg(F.bit_or(bit).cast("int").alias("b")).toArrow()
    words = np.zeros(1 << (bits - 4), "<u2")
    words[rows.column("w").to_numpy()] = rows.column("b").to_numpy().astype(np.uint16)
    return BitTable(words.view(np.uint8), bits)
