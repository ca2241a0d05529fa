"""Rows that an equi-join will drop are left out before they are shuffled.

A join that keeps few rows of a wide side still shuffles all of it. Here the hashes of the
narrow side's keys become a bitmap of bounded size (a Bloom filter), which is broadcast, and a
filter on it goes down with the other filters, below the wide side's joins and shuffles. The
bitmap keeps every row whose key is among the keys and few others; the join that follows
decides, so results are those of the join alone.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType

#: Bits of a bitmap (16 MB), and bits a key: beyond so many keys no filter is made.
BITS, BITS_A_KEY = 1 << 27, 4
PLACES = 2


def bitmap(keys: DataFrame, name: Column, bits: int) -> np.ndarray:
    """The places of all key hashes as 64-bit words; made by Spark, at most ``bits`` / 64 rows reach the driver."""
    at = F.explode(F.array(*[F.shiftrightunsigned(name, 32 * i).bitwiseAND(F.lit(bits - 1)) for i in range(PLACES)]))
    words = keys.select(at.alias("_at")).groupBy(F.shiftright("_at", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(_at & 63 AS INT))")).alias("_bits")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[words.column("_word").to_numpy()] = words.column("_bits").to_numpy().view(np.uint64)
    return out


def may_match(df: DataFrame, keys: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """``df`` without most rows whose columns ``on`` equal those of no row of ``keys`` (own column: column of ``keys``).

    ``keys`` is read twice here (a count and the bitmap), so it should be kept or stored. Columns
    of other types than the keys' hash otherwise, and floating ones may be equal with different
    bits: then, and where the keys are too many for the bitmap, ``df`` comes back as it is.
    """
    own, theirs = [df.schema[c].dataType for c in on], [keys.schema[c].dataType for c in on.values()]
    if own != theirs or any(isinstance(t, (DoubleType, FloatType)) for t in own):
        return df
    n = keys.count()
    if n * BITS_A_KEY > BITS:
        return df
    bits = min(BITS, max(1 << 10, 1 << (16 * n).bit_length()))
    shared = df.sparkSession.sparkContext.broadcast(bitmap(keys, F.xxhash64(*on.values()), bits))

    @F.pandas_udf(BooleanType())
    def held(name: pd.Series) -> pd.Series:
        words, out = shared.value, True
        h = name.to_numpy(dtype=np.int64).view(np.uint64)
        for i in range(PLACES):
            at = (h >> np.uint64(32 * i)) & np.uint64(bits - 1)
            out = out & ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
        return pd.Series(out)

    return df.where(held(F.xxhash64(*on)))
