"""Bitmaps of fixed size that tell which rows may matter (never used to decide a result)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Bitmap:
    """Broadcast bitmap over ``bits`` values; ``may_contain`` has false positives only."""

    def __init__(self, hashes: DataFrame, column: str, bits: int):
        spot = f"pmod({column}, {bits})"
        parts = hashes.groupBy(F.expr(f"bitmap_bucket_number({spot})").alias("part")).agg(
            F.expr(f"bitmap_construct_agg(bitmap_bit_position({spot}))").alias("map"))
        data = np.zeros(bits // 8 + 4096, dtype=np.uint8)
        for r in parts.toLocalIterator():  # bits / 32768 + 1 rows of 4 KB at most, whatever the input
            found = np.frombuffer(bytes(r["map"]), dtype=np.uint8)
            at = max(r["part"] - 1, 0) * 4096
            data[at:at + len(found)] |= found
        self.bits, self.shared = bits, hashes.sparkSession.sparkContext.broadcast(data)

    def may_contain(self, hashes: np.ndarray) -> np.ndarray:
        w = hashes.view(np.int64) % self.bits
        # Spark's bucket k >= 1 holds the values (k - 1) * 32768 + 1 to k * 32768; the value 0 always passes
        at = np.maximum(w - 1, 0)
        bit = self.shared.value[at // 32768 * 4096 + at % 32768 // 8] >> (at % 8).astype(np.uint8)
        return (w == 0) | ((bit & 1) != 0)
