"""Sets of numbers as bitmaps of a fixed size, to look up what may be in a table.

A bitmap never misses a number. With many numbers it lets through ever more others, so
what passes is still joined with the table; the bitmap only keeps most rows out of it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24  # a bitmap has two to this power bits, 2 MB
_PAGE = 15  # a row of it has two to this power bits


def bitmap(values: DataFrame, column: str) -> np.ndarray:
    """The lowest bits of the values, as a set of bits; at most 2 ** BITS of them."""
    low = F.col(column).bitwiseAND((1 << BITS) - 1)
    pages = (
        values.select(F.shiftright(low, _PAGE).alias("page"), low.bitwiseAND((1 << _PAGE) - 1).alias("bit"))
        .groupBy("page")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()  # 2 ** (BITS - _PAGE) pages of 4 KB at most
    )
    out = np.zeros((1 << (BITS - _PAGE), 1 << (_PAGE - 3)), np.uint8)
    for row in pages:
        out[row["page"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def contained(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which unsigned values may be in the bitmap."""
    low = values & np.uint64((1 << BITS) - 1)
    return bits[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8) & 1 == 1


def maybe_in(values: DataFrame, value: str, key: Column) -> Column:
    """Whether ``key``, a 64-bit number, may be among the values of a column."""
    shared = values.sparkSession.sparkContext.broadcast(bitmap(values, value))  # of fixed size

    def run(keys: pd.Series) -> pd.Series:
        return pd.Series(contained(shared.value, keys.to_numpy(np.int64).view(np.uint64)))

    return F.pandas_udf(run, "boolean")(key)
