"""Exact top-k inner products by best-first search in M-trees.

Components become ``floor(256 * x)``.  Giving each vector one more component
makes all of a block equally long; the largest inner products are then the
nearest neighbours in Euclidean distance, a metric.  Each block of rows has an
M-tree: pages of routing entries with a centre, a covering radius and the
distance to the parent's centre, and leaf pages of vectors with theirs.  A query
takes pages from a queue by the smallest distance they allow.  A routing entry
whose ``|d(query, parent) - d(entry, parent)| - radius`` exceeds the k-th distance
so far is dropped without computing its distance, and so is a leaf's vector.
Scores are exact integers; bounds carry a margin, so rounding never drops a
result, and ties are kept for the smaller id.

Rows are dealt to the cell of their nearest pivot, large cells in blocks.  The
index is a written table of pages.  A query is first answered in the blocks of
the cell whose pivot has the largest product with it; its k-th score there is a
bound for the rest: with a pivot ``p`` and a radius ``r``, no product in a cell
exceeds ``q . p + |q| r``, and cells that cannot reach the bound are not visited.
Each (query, block) gives at most k rows, merged by a sum of sorted tops.  Where
data has no clusters, radii are as large as distances and all cells are left.

Edge cases: null vectors and those with null or non-finite components take no
part; shorter vectors are padded with zeros; repeated rows are rows of their own
and find each other; null ids are never queries and lose every tie; rows that
share a query's id are queries of their own; an empty table gives an empty
result; further columns are ignored.  Scores are exact for components of any
size as long as they fit 64 bits, beyond which an error is raised: sums that
doubles do not hold are taken in whole numbers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textquarry.llm.vectors import Cells, in_cells, matrix, numbered
from textquarry.llm.words import release
from textquarry.storage import written

BLOCK, PAGE, FANOUT, PORTION = 16_384, 1024, 16, 4_096
#: Whole numbers up to which sums of doubles are exact.
EXACT = float(1 << 53)
NO_ID = np.iinfo(np.int64).max


def build(x: np.ndarray) -> list[dict]:
    """Pages of one block's M-tree, the root first; ``x`` has the extra component."""
    pages: list[dict] = []

    def split(members: np.ndarray, centre: np.ndarray) -> int:
        at = len(pages)
        pages.append({})
        own = np.sqrt(((x[members] - centre) ** 2).sum(axis=1))
        if len(members) <= PAGE:
            pages[at] = {"rows": members, "parent": own}
            return at
        # centres far from each other, starting with the one farthest from the parent's
        picked, near, part = [int(own.argmax())], np.full(len(members), np.inf), np.zeros(len(members), dtype=int)
        while True:
            d = np.sqrt(((x[members] - x[members[picked[-1]]]) ** 2).sum(axis=1))
            part[d < near] = len(picked) - 1
            near = np.minimum(near, d)
            if len(picked) == FANOUT or near.max() == 0:
                break
            picked.append(int(near.argmax()))
        if len(picked) == 1:  # all members are equal
            pages[at] = {"rows": members, "parent": own}
            return at
        groups = [np.flatnonzero(part == k) for k in range(len(picked))]
        children = [split(members[g], x[members[p]]) for g, p in zip(groups, picked, strict=True)]
        pages[at] = {"pages": np.array(children), "centres": x[members[picked]], "radii": np.array([near[g].max() for g in groups]), "parent": own[picked]}
        return at

    if len(x):
        split(np.arange(len(x)), x.mean(axis=0))
    return pages


def lengthened(v: np.ndarray) -> tuple[np.ndarray, float]:
    squares = (v * v).sum(axis=1)
    top = float(squares.max(initial=0.0))
    return np.column_stack([v, np.sqrt(top - squares)]), top


def quantised(x: np.ndarray) -> np.ndarray:
    """``floor(256 * x)`` as doubles, which hold all of these exactly."""
    return np.floor(256.0 * x)


def products(v: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; as Python's numbers where doubles would round."""
    if len(v) and float(np.abs(v).max()) * float(np.abs(query).max(initial=0.0)) * max(1, v.shape[1]) >= EXACT:
        q = list(map(int, query.tolist()))
        return np.array([sum(int(x) * y for x, y in zip(row, q, strict=True)) for row in v.tolist()], dtype=object)
    return v @ query


def leaf(v: np.ndarray, ids: np.ndarray, numbers: np.ndarray, parent: np.ndarray) -> dict:
    return {"v": v, "ids": ids, "numbers": numbers, "parent": parent}


def search(pages: list[dict], root: np.ndarray, top: float, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The k best ``(score, vec_id)`` for one query but the row numbered ``own``, best first.

    ``root`` is the centre of the first page, ``top`` the block's largest square.
    """
    q = np.append(query, 0.0)
    square = float(query @ query)
    margin = 1e-7 * (1.0 + square + top)
    best: list[tuple[float, int, int]] = []  # (score, -id, number), the worst first
    limit = np.inf  # the largest distance that can still matter
    queue = [(0.0, 0, float(np.sqrt(((q - root) ** 2).sum())))] if pages else []
    while queue:
        least, at, from_parent = heapq.heappop(queue)
        if least > limit:
            break
        page = pages[at]
        if "v" in page:
            near = np.abs(from_parent - page["parent"]) <= limit + margin
            some = None if 2 * np.count_nonzero(near) > len(near) else np.flatnonzero(near)
            scores = products(page["v"] if some is None else page["v"][some], query)
            if len(best) == k:
                good = np.flatnonzero(scores >= best[0][0])
            else:  # ties of the k-th score stay in
                good = np.arange(len(scores)) if len(scores) <= k else np.flatnonzero(scores >= np.sort(scores)[-k - 1])
            members = good if some is None else some[good]
            for s, i, m in zip(scores[good].tolist(), page["ids"][members].tolist(), page["numbers"][members].tolist(), strict=True):
                entry = (s, -i, m)
                if m == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                limit = float(np.sqrt(max(0.0, square + top - 2 * best[0][0] + margin)))
        else:
            some = np.flatnonzero(np.abs(from_parent - page["parent"]) - page["radii"] <= limit + margin)
            away = np.sqrt(((page["centres"][some] - q) ** 2).sum(axis=1))
            low = np.maximum(0.0, away - page["radii"][some] - margin)
            for d, a, child in zip(low.tolist(), away.tolist(), page["pages"][some].tolist(), strict=True):
                if d <= limit:
                    heapq.heappush(queue, (d, child, a))
    return [(int(s), -i) for s, i, _ in sorted(best, reverse=True)]


INDEX = "block int, page int, leaf boolean, members binary, vec_ids binary, numbers binary, radii binary, parent binary, width int, root binary, top double"
ANSWERS = "query_row long, query_id long, vec_id long, score long"


def _pages_of(table: pa.Table, width: int) -> pa.Table:
    """One block's rows -> its pages."""
    block = table["block"][0].as_py()
    v = quantised(matrix(table["vector"], width))
    ids = table["vec_id"].fill_null(NO_ID).to_numpy()
    numbers = table["row"].to_numpy()
    x, top = lengthened(v)
    out = []
    for at, page in enumerate(build(x)):
        is_leaf = "rows" in page
        out.append({
            "block": block, "page": at, "leaf": is_leaf, "members": (v[page["rows"]] if is_leaf else page["centres"]).tobytes(), "vec_ids": ids[page["rows"]].tobytes() if is_leaf else None,
            "numbers": (numbers[page["rows"]] if is_leaf else page["pages"]).astype(np.int64).tobytes(), "radii": None if is_leaf else page["radii"].tobytes(), "parent": page["parent"].tobytes(), "width": width,
            "root": x.mean(axis=0).tobytes() if at == 0 else None, "top": top,
        })
    kinds = [pa.int32(), pa.int32(), pa.bool_(), *[pa.binary()] * 5, pa.int32(), pa.binary(), pa.float64()]
    return pa.Table.from_pylist(out, schema=pa.schema(list(zip([c.split()[0] for c in INDEX.split(", ")], kinds, strict=True))))


def _answer(table: pa.Table, k: int) -> pa.Table:
    """One block's pages with one portion of queries."""
    stored = sorted((r for r in table.filter(pc.is_valid(table["page"])).to_pylist()), key=lambda r: r["page"])
    queries = table.filter(pc.is_null(table["page"]))
    found = []
    if stored:
        width = stored[0]["width"]
        pages = []
        for r in stored:
            parent = np.frombuffer(r["parent"])
            if r["leaf"]:
                pages.append(leaf(np.frombuffer(r["members"]).reshape(-1, width), np.frombuffer(r["vec_ids"], dtype=np.int64), np.frombuffer(r["numbers"], dtype=np.int64), parent))
            else:
                pages.append({"pages": np.frombuffer(r["numbers"], dtype=np.int64), "centres": np.frombuffer(r["members"]).reshape(-1, width + 1), "radii": np.frombuffer(r["radii"]), "parent": parent})
        root, top = np.frombuffer(stored[0]["root"]), stored[0]["top"]
        asked = quantised(matrix(queries["vector"], width))
        for q, row, query_id in zip(asked, queries["row"].to_pylist(), queries["vec_id"].to_pylist(), strict=True):
            found += [(row, query_id, None if i == NO_ID else i, s) for s, i in search(pages, root, top, q, row, k)]
    if any(abs(f[3]) >= 1 << 63 for f in found):
        raise OverflowError("a score exceeds 64 bits")
    columns = list(zip(*found, strict=True)) or [()] * 4
    release()
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in ANSWERS.split(", ")])


def visits(queries: DataFrame, cells: Cells, width: int, first: bool) -> DataFrame:
    """The queries once for each block to visit: of the best cell, or of all others that the ``bound`` leaves open (null: all)."""
    lengths = np.sqrt((cells.pivots**2).sum(axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = quantised(matrix(batch.column("vector"), width))
            at = x @ cells.pivots.T
            best = np.where(cells.parts > 0, at, -np.inf).argmax(axis=1) if len(cells.pivots) else np.zeros(len(x), dtype=np.int64)
            norm = np.sqrt((x * x).sum(axis=1))
            most = at + norm[:, None] * cells.radii + 1e-9 * (1 + norm[:, None] * (lengths + cells.radii))
            bound = None if first else batch.column("bound").fill_null(np.iinfo(np.int64).min).to_numpy().astype(float)
            rows, blocks = [], []
            for k in range(len(x)):
                open_cells = np.zeros(len(cells.pivots), dtype=bool) if first else most[k] >= bound[k]
                if len(best):
                    open_cells[best[k]] = first
                some = cells.blocks(open_cells)
                rows.append(np.full(len(some), k))
                blocks.append(some)
            for k in range(0, len(rows), 64):
                picked, where = np.concatenate(rows[k : k + 64]), np.concatenate(blocks[k : k + 64]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(picked)) for c in ("row", "vec_id", "vector")), pa.array(where)], names=["row", "vec_id", "vector", "block"])

    return queries.mapInArrow(run, "row long, vec_id long, vector array<double>, block int")


def _best(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_k(rows: DataFrame, is_query: Column, *, k: int = 5, block: int = BLOCK, portion: int = PORTION) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vec_id, embedding`` for which ``is_query`` holds."""
    able = numbered(rows).where("able")
    n, width = able.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    width = max(1, width or 1)
    dealt, cells = in_cells(able, n, width, block, quantised, ["row", "vec_id", "vector"])
    index = written(dealt.groupBy("block").applyInArrow(lambda t: _pages_of(t, width), INDEX), "m-tree")
    queries = written(able.where(is_query & F.col("vec_id").isNotNull()).select("row", "vec_id", "vector"), "queries")
    portions = max(1, -(-queries.count() // portion))

    def answers(asked: DataFrame) -> DataFrame:
        asked = asked.withColumn("portion", F.pmod(F.xxhash64("row"), F.lit(portions)).cast("int"))
        wanted = asked.select("block", "portion").distinct()
        both = index.join(wanted, "block").unionByName(asked, allowMissingColumns=True)
        return both.groupBy("block", "portion").applyInArrow(lambda t: _answer(t, k), ANSWERS)

    near = written(_best(answers(visits(queries, cells, width, True)), k), "near-answers")
    bounds = near.where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("bound"))
    far = answers(visits(queries.join(bounds, "row", "left").select("row", "vec_id", "vector", "bound"), cells, width, False))
    ranked = _best(near.drop("rank").union(far), k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
