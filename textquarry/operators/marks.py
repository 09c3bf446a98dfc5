"""A set of 64-bit keys as a bitmap of bounded size: what may be in it, and surely all that is.

A join keeps few of very many wide rows only after both sides have moved.  Rows
that a bitmap leaves out never move; a key that shares another one's bit stays,
so an exact join or comparison follows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a page, bits for each key, and the most bits there are (16 MB on the driver and in each task).
PAGE, ROOM, MOST = 1 << 15, 64, 1 << 27


class Marks:
    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = keys.astype(np.int64).view(np.uint64) & self.mask
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def column(self, key: Column) -> Column:
        """Whether a key may be in the set; a null key is not."""

        def run(keys: pd.Series) -> pd.Series:
            none = keys.isna().to_numpy()
            return pd.Series(self.holds(keys.fillna(0).to_numpy(np.int64)) & ~none)

        run.__annotations__ = {"keys": pd.Series, "return": pd.Series}
        return F.pandas_udf(run, "boolean")(key)


def marks(keys: DataFrame, key: str) -> Marks:
    """The set of the hashes in column ``key``; 4096 pages of 4 KB at most are collected."""
    n = keys.count()
    bits = PAGE
    while bits < min(MOST, ROOM * n):
        bits *= 2

    def page(t: pa.Table) -> pa.Table:
        held = np.zeros(PAGE, dtype=bool)
        held[t["at"].to_numpy()] = True
        return pa.table({"page": t["page"].slice(0, 1), "data": pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())})

    at = F.col(key).bitwiseAND(F.lit(bits - 1))
    placed = keys.where(F.col(key).isNotNull()).select((F.shiftright(at, 15)).cast("int").alias("page"), at.bitwiseAND(F.lit(PAGE - 1)).cast("int").alias("at")).distinct()
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in placed.groupBy("page").applyInArrow(page, "page int, data binary").collect():  # MOST / PAGE rows at most
        out[r["page"] * PAGE // 8 : (r["page"] + 1) * PAGE // 8] = np.frombuffer(r["data"], dtype=np.uint8)
    return Marks(out)
