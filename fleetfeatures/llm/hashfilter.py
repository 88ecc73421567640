"""A set of 64-bit hashes as a bit field of fixed size: what is in the set is found in it, little else is.

It is used where rows are left out before a shuffle and an exact step follows, so a wrong hit costs time and never
changes a result. Its size is a parameter and does not grow with the data: a filter of ``2 ** LOG_BITS`` bits takes 16 MB
on the driver and in a worker. With very many hashes it fills up and lets more rows pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_BITS = 27
#: Bits of one row of the field; Spark's bitmap functions build blocks of this size.
_BLOCK = 32_768


def bit_field(hashes: DataFrame, column: str, log_bits: int = LOG_BITS) -> np.ndarray:
    """The field with the bit of every hash set; at most ``2 ** log_bits / 32,768`` rows of 4 KB reach the driver."""
    bit = F.shiftrightunsigned(column, 64 - log_bits)
    blocks = hashes.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    field = np.zeros((max(1, (1 << log_bits) // _BLOCK) + 1, _BLOCK // 8), np.uint8)
    for row in blocks.collect():
        field[row.bucket] |= np.frombuffer(bytes(row.bits), np.uint8)
    # the bucket of bit x is 1 + (x - 1) div 32,768 for x > 0 and its position (x - 1) mod 32,768; bit 0 is alone in bucket 0
    return field.reshape(-1)


def among(field: np.ndarray, hashes: np.ndarray, log_bits: int = LOG_BITS) -> np.ndarray:
    """Which of the hashes have their bit set."""
    bit = (hashes.view(np.uint64) >> np.uint64(64 - log_bits)).astype(np.int64)
    at = bit + (_BLOCK - 1)  # bucket * 32,768 + position, for bit > 0
    at[bit == 0] = 0
    return (field[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
