"""Vectors of a table, cleaned, numbered and dealt to blocks of near rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.words import release
from textquarry.storage import small_batches, written

#: Cells at most, so that what every task holds of them has a bound: one point each.
CELLS = 4096
#: Rows drawn for each pivot.
DRAWN = 8


def numbered(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, row, vector, able``: every row with a number of its own; ``able`` without null or non-finite components."""
    small_batches(rows.sparkSession)
    v = F.col(column).cast("array<double>")
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    out = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fine, v).alias("vector"), fine.alias("able"))
    return written(out.withColumn("row", F.monotonically_increasing_id()), "vectors")


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """An Arrow column of lists as rows, padded with zeros to ``width``."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(whole.offsets.to_numpy()) if len(whole) else np.empty(0, dtype=np.int64)
    flat = whole.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(whole), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


@dataclass
class Cells:
    """Pivots, the largest distance of a cell's rows from its pivot, its first block and how many it has."""

    pivots: np.ndarray
    radii: np.ndarray
    first: np.ndarray
    parts: np.ndarray

    def blocks(self, some: np.ndarray) -> np.ndarray:
        """The blocks of the cells in the mask."""
        picked = np.flatnonzero(some)
        return np.concatenate([np.arange(self.first[c], self.first[c] + self.parts[c]) for c in picked]) if len(picked) else np.empty(0, dtype=np.int64)


def spread(x: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` different rows, from the first on each time the farthest from those taken."""
    taken, away = [], np.full(len(x), np.inf)
    while len(taken) < n and len(x) and away.max() > 0:
        taken.append(int(away.argmax()))
        away = np.minimum(away, ((x - x[taken[-1]]) ** 2).sum(axis=1))
    return x[taken]


def in_cells(able: DataFrame, n: int, width: int, size: int, points: Callable[[np.ndarray], np.ndarray], kept: list[str]) -> tuple[DataFrame, Cells]:
    """The rows with a ``block`` of about ``size`` rows, and the cells that the blocks are parts of.

    Pivots, one for each block that is needed and ``CELLS`` at most, are taken
    from ``DRAWN`` times as many rows, those of smallest hash: each time the one
    farthest from the pivots so far, so that clusters get their own.  A row's cell is that of its nearest pivot; a cell of more
    than ``size`` rows is cut into parts by a hash of the row, so rows that are
    all alike still make blocks of bounded size.
    """
    spark, wanted = able.sparkSession, min(CELLS, max(1, -(-n // size)))
    drawn = able.select("vector", "row").orderBy(F.xxhash64(F.lit(7), "row"), "row").limit(DRAWN * wanted).select("vector").collect()  # DRAWN * CELLS rows at most
    pivots = spread(points(matrix(pa.array([r["vector"] for r in drawn], pa.list_(pa.float64())), width)), wanted)
    squares = (pivots * pivots).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = points(matrix(batch.column("vector"), width))
            cell = (squares - 2 * (x @ pivots.T)).argmin(axis=1) if len(pivots) else np.zeros(len(x), dtype=np.int64)
            away = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1)) if len(pivots) else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], names=[*batch.schema.names, "cell", "away"])
        release()

    rows = able.select(*kept)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", cell int, away double"
    placed = written(rows.mapInArrow(run, schema), "placed")
    held = {r["cell"]: (r["n"], r["far"]) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("far")).collect()}  # a row a cell
    counts = np.array([held.get(c, (0, 0.0))[0] for c in range(len(pivots))], dtype=np.int64)
    parts = -(-counts // size)
    cells = Cells(pivots, np.array([held.get(c, (0, 0.0))[1] for c in range(len(pivots))]), np.cumsum(parts) - parts, parts)
    named = spark.createDataFrame([(c, int(cells.first[c]), int(parts[c])) for c in range(len(pivots)) if parts[c]], "cell int, first int, parts int")
    dealt = placed.join(F.broadcast(named), "cell")  # a row a cell
    return dealt.withColumn("block", (F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int")).drop("away", "first", "parts"), cells
