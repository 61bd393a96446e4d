"""A set of 64-bit hashes as bits of a fixed greatest size: it says yes for all that are in it, and for a few others."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ironsift.llm.arrowtext import U


@dataclass(frozen=True)
class BitFilter:
    """Two bits stand for each hash."""

    bits: Broadcast[bytes]
    size: int

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        table = np.frombuffer(self.bits.value, np.uint8)
        out = np.ones(len(hashes), bool)
        for x in (hashes, hashes >> U(32)):
            cell = (x & U(self.size - 1)).astype(np.int64)
            out &= (table[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
        return out


def filter_of(hashes: DataFrame, size: int) -> BitFilter:
    """The filter of a column h (long), with size bits (a power of two, 32768 or more); that much comes to the driver at most."""
    cells = hashes.select(F.explode(F.array(F.col("h"), F.shiftrightunsigned("h", 32))).alias("x")).select((F.col("x").bitwiseAND(size - 1) + 1).alias("cell"))
    blocks = cells.groupBy(F.bitmap_bucket_number("cell").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    bits = bytearray(size // 8)
    for block, part in blocks.collect():
        bits[(block - 1) * 4096 : block * 4096] = part
    return BitFilter(hashes.sparkSession.sparkContext.broadcast(bytes(bits)), size)
