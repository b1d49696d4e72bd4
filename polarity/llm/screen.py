"""A bit table of fixed size that lets rows of a large table be dropped early.

The table marks the places of some keys; rows whose place is unmarked can't
match and need not be shuffled.  Its size doesn't depend on the keys: the more
there are, the fewer rows it drops, and the exact join that follows decides.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23      # a power of two; 1 MB


def bit_table(keys: DataFrame, bits: int = BITS) -> bytes:
    """``keys`` has one bigint column; its low bits give the place.  At most
    ``bits`` distinct numbers reach the driver."""
    places = (keys.select(F.col(keys.columns[0]).bitwiseAND(F.lit(bits - 1)).cast("int").alias("bit"))
              .distinct().toArrow())
    table = np.zeros(bits, dtype=bool)
    table[places.column("bit").to_numpy()] = True
    return np.packbits(table, bitorder="little").tobytes()


def marked(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the place of each uint64 key is marked; ``table`` as uint8."""
    bit = keys & np.uint64(len(table) * 8 - 1)
    return (table[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def may_match(key: Column, table: bytes) -> Column:
    """The same for a bigint column."""
    def run(keys: pd.Series) -> pd.Series:
        return pd.Series(marked(np.frombuffer(table, np.uint8), keys.to_numpy(np.int64).view(np.uint64)))

    return F.pandas_udf(run, "boolean")(key)
