"""Rows that can have a near copy at all, found from a part of their shingles.

In an order that all rows share (that of a hash), sets of sizes m and n with
Jaccard similarity t or more have ``o >= ceil(t * max(m, n))`` elements in common, so
the k-th of these is among the first ``n - ceil(t * n) + k`` of either.  Each row
sends its first ``n - ceil(t * n) + k(n)`` shingles, ``k(n) = 1 + n // 8``.  A near copy
of it has ``ceil(t * n)`` shingles at least, so ``k(ceil(t * n))`` of what a row sends
must have been sent by another row too; rows with less have no near copy.

Shingles move as four bytes of their place in a block and two of the row's place
in its portion; a mistaken shingle can only keep a row.  Equal keys in one portion
are one row.  A block answers with counts by portion, so a row's key moves once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.functions.portions import portions, release
from textquarry.storage import written

M2, M3 = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
S29, S32 = np.uint64(29), np.uint64(32)
#: Characters and rows of a portion, and characters of the input for each block.
PORTION, ROWS, BLOCK = 4_000_000, 60_000, 24_000_000
MOVED = "kind int, block int, portion long, data binary, rows binary"
SCHEMA = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("portion", pa.int64()), ("data", pa.binary()), ("rows", pa.binary())])
STATE, ASK, ANSWER = range(3)


def needed(n: np.ndarray, threshold: float) -> np.ndarray:
    """Shingles that a row of ``n`` has in common with any near copy."""
    return np.ceil(n * (threshold - 1e-12) - 1e-9).astype(np.int64)


def extra(n: np.ndarray) -> np.ndarray:
    return 1 + n // 8


def prefix(shingles: np.ndarray, threshold: float) -> np.ndarray:
    """The first shingles of a set in the order of a hash."""
    n = len(shingles)
    size = int(min(n, n - needed(n, threshold) + extra(n)))
    h = shingles * M2
    h = (h ^ (h >> S32)) * M3
    h ^= h >> S29
    return shingles[np.argpartition(h, size - 1)[:size]] if size < n else shingles


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, SCHEMA.types, strict=True)], schema=SCHEMA)


def _asks(sets: list[np.ndarray], portion: int, threshold: float, blocks: int) -> list[tuple]:
    parts = [prefix(s, threshold) for s in sets]
    flat, of = np.concatenate(parts), np.repeat(np.arange(len(parts), dtype=np.uint16), [len(p) for p in parts])
    wide = (flat >> S32) * np.uint64(blocks)
    block, place = (wide >> S32).astype(np.int32), ((flat & np.uint64(0xFFFFFFFF)) ^ wide).astype(np.uint32)
    order = np.argsort(block, kind="stable")
    block, place, of = block[order], place[order], of[order]
    some, begin = np.unique(block, return_index=True)
    ends = [*begin[1:].tolist(), len(block)]
    return [(ASK, b, portion, place[i:j].tobytes(), of[i:j].tobytes()) for b, i, j in zip(some.tolist(), begin.tolist(), ends, strict=True)]


def _answered(table: pa.Table) -> pa.Table:
    """One block: by portion the rows that sent a shingle which another row sent too, once for each."""
    passed = table.filter(pc.equal(table["kind"], STATE))
    asks = table.filter(pc.equal(table["kind"], ASK))
    out = []
    if len(asks):
        read = lambda c, kind: [np.frombuffer(x.as_buffer(), dtype=kind) for x in asks[c]]
        places, of = read("data", np.uint32), read("rows", np.uint16)
        flat = np.concatenate(places)
        order = np.argsort(flat)
        sorted_ = flat[order]
        same = sorted_[1:] == sorted_[:-1]
        many = np.zeros(len(flat), dtype=bool)
        many[order[1:][same]] = True
        many[order[:-1][same]] = True
        at = 0
        for portion, own in zip(asks["portion"].to_pylist(), of, strict=True):
            shared = own[many[at : at + len(own)]]
            at += len(own)
            if len(shared):
                out.append((ANSWER, 0, portion, None, shared.tobytes()))
    release()
    return pa.concat_tables([passed.cast(SCHEMA), pa.Table.from_batches([_batch(out)], schema=SCHEMA)])


def _kept(table: pa.Table, threshold: float) -> pa.Table:
    """One portion: the rows of which enough shingles are shared."""
    state = table.filter(pc.equal(table["kind"], STATE))
    keys, n = np.frombuffer(state["data"][0].as_buffer(), dtype=np.int64), np.frombuffer(state["rows"][0].as_buffer(), dtype=np.int64)
    answers = [np.frombuffer(x.as_buffer(), dtype=np.uint16) for x in table.filter(pc.equal(table["kind"], ANSWER))["rows"]]
    shared = np.bincount(np.concatenate([np.empty(0, np.uint16), *answers]), minlength=len(keys))
    good = shared >= extra(needed(n, threshold))
    return pa.table({"key": keys[good], "n": n[good]})


Sets = Callable[[list[str | None], list[int]], tuple[np.ndarray, list[np.ndarray]]]


def able(rows: DataFrame, key: str, text: str, sets: Sets, threshold: float) -> DataFrame:
    """``key, n`` of the rows that may have a near copy, and of all that have one, written; ``n`` is the size of the set.

    ``sets`` gives the keys and the distinct shingles (unsigned 64-bit hashes) of
    some texts with their values of ``key``; rows without shingles drop out.
    """
    chars = rows.agg(F.sum(F.length(text))).first()[0] or 0
    blocks = max(8, -(-chars // BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in portions(batches, lambda r: len(r[2] or ""), PORTION, ROWS):
            number = some[0][0]
            keys, found = sets([r[2] for r in some], [r[1] for r in some])
            del some
            n = np.array([len(s) for s in found], dtype=np.int64)
            _, first = np.unique(keys, return_index=True)
            first = first[n[first] > 0]
            if len(first):
                yield _batch([(STATE, number % blocks, number, keys[first].astype(np.int64).tobytes(), n[first].tobytes())])
                yield _batch(_asks([found[k] for k in first.tolist()], number, threshold, blocks))
            del found
        release()

    moved = rows.select(F.monotonically_increasing_id(), key, text).mapInArrow(run, MOVED).repartition(blocks, "block")
    answered = moved.groupBy("block").applyInArrow(_answered, MOVED)
    return written(answered.groupBy("portion").applyInArrow(lambda t: _kept(t, threshold), "key long, n long"), "able")
