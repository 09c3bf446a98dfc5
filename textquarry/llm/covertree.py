"""Near copies among embeddings by dual traversal of cover trees.

Directions (vectors of length 1) are compared by Euclidean distance: a cosine of
at least ``t`` is a distance of at most ``sqrt(2 - 2t)``.  Equal vectors are one,
with their number.  Rows are dealt to the cell of their nearest pivot, large
cells in blocks, and a pair of cells is dropped when the pivots are further apart
than the threshold and both radii: its blocks never meet.

Each block has a cover tree: on a level of radius ``r`` every node's members lie
within ``r`` of its centre, a node's centre is also the centre of its first
child, and radii halve from level to level.  Two trees are walked together.  A
pair of nodes is dropped when centres are further apart than the threshold and
both covering radii; it is accepted whole, without looking inside, when even the
farthest members are near; otherwise both nodes' descendants are paired, down to
single vectors, which are compared by cosine in double precision.  Wide levels
that have nearly as many nodes as the fine ones drop next to nothing and are
passed over.  A level's centres are compared by matrix products, in single
precision with a margin; only the margin's pairs are listed, in runs of bounded
size, and go on to double precision.

A pair of blocks is one task of bounded size.  It returns a link count for each
vector and the edges of a spanning forest, never the pairs themselves, so a
large group of near copies costs rows in proportion to its members.  Where data
has no clusters at all, no ball around a pivot is small against the distances,
all pairs of blocks are left, and the cost of exact results is quadratic.

Edge cases: vectors that are null, zero, or hold null or non-finite components
link with nothing; shorter vectors are padded with zeros; vectors are scaled by
powers of two first, so very small and very large components keep their
directions; repeated rows are rows of their own; a null id never names a
component (null if no member has an id) and is never kept; ids that repeat are
kept in each row; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.vectors import Cells, in_cells, matrix, numbered
from textquarry.llm.words import release
from textquarry.operators.components import connected_components
from textquarry.storage import written

BLOCK, MARGIN, CHUNK, BATCH, TILE = 8192, 1e-3, 1 << 17, 64, 512


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest components near 1: directions to the last bit."""
    top = np.abs(x).max(axis=1, initial=0.0)
    return np.ldexp(x, -np.frexp(top)[1][:, None])


def directions(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


class Tree:
    """A cover tree over rows, level by level.

    ``order`` lists the rows so that each node's members are consecutive;
    ``levels`` holds arrays ``centre, start, stop, radius, parent`` of the nodes,
    radii being the largest distance that occurs.
    """

    def __init__(self, x: np.ndarray, least: float) -> None:
        self.x = x
        self.unit = directions(x).astype(np.float32)
        self.order = np.arange(len(x))
        self.levels = [(np.array([0]), np.array([0]), np.array([len(x)]), np.array([2.0]), np.array([0]))]
        scale = 1.0
        while self.levels[-1][3].max(initial=0.0) > 0 and scale > least / 16:
            centres, starts, stops, radii, parents = [], [], [], [], []
            order = self.order.copy()
            for node, (c, a, b, r) in enumerate(zip(*(z.tolist() for z in self.levels[-1][:4]), strict=True)):
                members = self.order[a:b]
                at = a
                for centre, own, radius in [(c, members, 0.0)] if r == 0 else self._cover(c, members, scale):
                    order[at : at + len(own)] = own
                    centres.append(centre)
                    starts.append(at)
                    at += len(own)
                    stops.append(at)
                    radii.append(radius)
                    parents.append(node)
            self.order = order
            self.levels.append(tuple(map(np.array, (centres, starts, stops, radii, parents))))
            scale /= 2
        self._index()

    def _cover(self, first: int, members: np.ndarray, scale: float) -> list[tuple[int, np.ndarray, float]]:
        """Groups ``centre, members, radius`` within ``scale`` of their centres, taken in turn from what no centre before covers.

        Some candidates at a time are compared with all that is left; members
        that a centre covers are compared no more.
        """
        groups, near = [], 1.0 - (scale * scale) / 2
        left = np.concatenate(([first], members[members != first]))
        while len(left):
            some = left[:BATCH]
            cosine = self.unit[some] @ self.unit[left].T
            free = np.ones(len(left), dtype=bool)
            for k, centre in enumerate(some.tolist()):
                if free[k]:
                    inside = free & (cosine[k] >= near)
                    inside[k] = True
                    low = float(cosine[k][inside].min())
                    own = left[inside]
                    groups.append((centre, own, float(np.sqrt(max(0.0, 2 - 2 * low))) if len(own) > 1 else 0.0))
                    free &= ~inside
            left = left[free]
        return groups

    def _index(self) -> None:
        """For each level, where each node's children begin on the next."""
        self.first = [np.searchsorted(below[4], np.arange(len(level[0]) + 1)) for level, below in zip(self.levels, self.levels[1:], strict=False)]

    def level(self, k: int) -> tuple:
        return self.levels[min(k, len(self.levels) - 1)]

    def descendants(self, level: int, k: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the nodes' descendants on level ``k`` begin, and how many they are; nodes of the last level stand for themselves."""
        begin, end = nodes, nodes + 1
        for z in range(level, min(k, len(self.levels) - 1)):
            begin, end = self.first[z][begin], self.first[z][end]
        return begin, end - begin

    def packed(self) -> bytes:
        small = self.x.astype(np.float32)
        x = small if (small == self.x).all() else self.x  # nothing is lost
        return pickle.dumps((x, self.order.astype(np.int32), [tuple(z.astype(np.float32 if k == 3 else np.int32) for k, z in enumerate(level)) for level in self.levels]))

    @classmethod
    def unpacked(cls, data: bytes) -> Tree:
        out = cls.__new__(cls)
        x, out.order, out.levels = pickle.loads(data)  # noqa: S301
        out.x = x.astype(np.float64)
        out.unit = directions(out.x).astype(np.float32)
        out._index()
        return out


def steps(a: Tree, b: Tree, limit: float) -> list[int]:
    """The levels at which two trees are compared.

    Nodes that are wide against the limit and nearly as many as the first fine
    ones keep almost every pair: such levels are passed over.
    """
    depth = max(len(a.levels), len(b.levels))
    fine = next((k for k in range(depth) if max(t.level(k)[3].max() for t in (a, b)) <= limit / 2), depth - 1)
    number = lambda k: len(a.level(k)[0]) * len(b.level(k)[0])
    return [k for k in range(1, depth) if k >= fine or 4 * number(k) <= number(fine)] or [depth - 1]


def dual(a: Tree, b: Tree, cosine: float, same: bool):
    """Groups that may link: yields ``(nodes of a, nodes of b, level, whole)`` in arrays.

    ``whole`` groups link entirely, of others each pair is still to be compared;
    with one tree, equal nodes are pairs within one set of rows.
    """
    limit = float(np.sqrt(2 - 2 * cosine))
    levels = steps(a, b, limit)

    def walk(at: int, level: int, i: np.ndarray, j: np.ndarray):
        # (i, j) are the pairs of this level whose descendants are still to be compared
        k, last = levels[at], at + 1 == len(levels)
        (ca, _, _, ra, _), (cb, _, _, rb, _) = a.level(k), b.level(k)
        for m, n in _paired(a, b, level, k, i, j, limit, same):
            away = np.einsum("nd,nd->n", a.unit[ca[m]], b.unit[cb[n]])
            away = np.sqrt(np.maximum(0.0, 2 - 2 * away.astype(np.float64)))
            near = away - ra[m] - rb[n] <= limit + MARGIN
            m, n, away = m[near], n[near], away[near]
            own = (m == n) & same
            whole = (away + ra[m] + rb[n] <= limit - MARGIN) & (~own | (2 * ra[m] <= limit - MARGIN))
            exact = ~whole & (last | ((ra[m] == 0) & (rb[n] == 0)))
            for mask in (whole, exact):
                if mask.any():
                    yield m[mask], n[mask], k, mask is whole
            m, n = m[~whole & ~exact], n[~whole & ~exact]
            if len(m):
                yield from walk(at + 1, k, m, n)

    yield from walk(0, 0, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))


def _paired(a: Tree, b: Tree, level: int, k: int, i: np.ndarray, j: np.ndarray, limit: float, same: bool):
    """Pairs of descendants on level ``k`` of the given pairs of nodes, in runs of bounded size; where a node has very many, only those near enough, by products of centres."""
    (fa, na), (fb, nb) = a.descendants(level, k, i), b.descendants(level, k, j)
    order = np.argsort(i, kind="stable")
    i, fa, na, fb, nb = i[order], fa[order], na[order], fb[order], nb[order]
    begin = np.flatnonzero(np.diff(i, prepend=-1))
    size = np.add.reduceat(na * nb, begin)
    ends = np.append(begin[1:], len(i))
    few = np.repeat(size < CHUNK, ends - begin)
    total = na * nb
    cuts = np.cumsum(np.where(few, total, 0)) // (8 * CHUNK)
    for part in np.unique(cuts[few]):
        some = few & (cuts == part)
        n = total[some]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat(nb[some], n)
        x, y = np.repeat(fa[some], n) + at // wide, np.repeat(fb[some], n) + at % wide
        kept = x <= y if same else slice(None)
        yield x[kept], y[kept]
    (ca, _, _, ra, _), (cb, _, _, rb, _) = a.level(k), b.level(k)
    for g in np.flatnonzero(size >= CHUNK):
        s, e = begin[g], ends[g]
        x = fa[s] + np.arange(na[s])
        y = np.repeat(fb[s:e] - np.cumsum(nb[s:e]) + nb[s:e], nb[s:e]) + np.arange(nb[s:e].sum())
        # single vectors apart from nodes with a radius: their bounds differ
        for u in (x[ra[x] == 0], x[ra[x] > 0]):
            for v in (y[rb[y] == 0], y[rb[y] > 0]):
                for m, n in _near(a.unit, b.unit, ca, cb, u, v, ra, rb, limit):
                    kept = m <= n if same else slice(None)
                    yield m[kept], n[kept]


def _near(x: np.ndarray, y: np.ndarray, ca, cb, u: np.ndarray, v: np.ndarray, ra, rb, limit: float):
    """Pairs of nodes whose centres are near enough, found by products of their centres, TILE x TILE at a time."""
    if not len(u) or not len(v):
        return
    left, widest = x[ca[u]], min(2.0, limit + MARGIN + float(ra[u].max()) + float(rb[v].max()))
    floor = np.float32(1 - widest * widest / 2 - MARGIN)
    for c in range(0, len(v), TILE):
        others = v[c : c + TILE]
        right = y[cb[others]].T
        for s in range(0, len(u), TILE):
            cosine = left[s : s + TILE] @ right
            if cosine.max() >= floor:
                at = np.flatnonzero(cosine >= floor)
                i, j = u[s + at // len(others)], others[at % len(others)]
                d = np.sqrt(np.maximum(0.0, 2 - 2 * cosine.ravel()[at].astype(np.float64)))
                good = d - ra[i] - rb[j] <= limit + MARGIN
                yield i[good], j[good]


def links(a: Tree, b: Tree, cosine: float, same: bool, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links of the rows of ``a`` and of ``b``, each row counted ``weights`` times, and a spanning forest as edges (row of a, row of b with ``len(a)`` added)."""
    shift = 0 if same else len(a.x)
    count = np.zeros(len(a.x) + (0 if same else len(b.x)), dtype=np.int64)
    root = np.arange(len(count))
    edges: list[tuple[int, int]] = []

    def top(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    def join(x: int, y: int) -> None:
        u, v = top(x), top(y)
        if u != v:
            root[max(u, v)] = min(u, v)
            edges.append((x, y))

    na, nb = (np.sqrt((t.x * t.x).sum(axis=1)) for t in (a, b))
    for i, j, k, whole in dual(a, b, cosine, same):
        (_, sa, ea, _, _), (_, sb, eb, _, _) = a.level(k), b.level(k)
        single = (ea[i] - sa[i] == 1) & (eb[j] - sb[j] == 1)
        if not whole and single.any():
            p, q = a.order[sa[i[single]]].astype(np.int64), b.order[sb[j[single]]].astype(np.int64)
            if same:
                p, q = p[p != q], q[p != q]
            good = np.einsum("nd,nd->n", a.x[p], b.x[q]) / (na[p] * nb[q]) >= cosine
            p, q = p[good], q[good] + shift
            np.add.at(count, p, weights[q])
            np.add.at(count, q, weights[p])
            for x, y in zip(p.tolist(), q.tolist(), strict=True):
                join(x, y)
            i, j = i[~single], j[~single]
        for m, n in zip(i.tolist(), j.tolist(), strict=True):
            p, q, own = a.order[sa[m] : ea[m]], b.order[sb[n] : eb[n]], same and m == n
            if whole:
                if own:
                    count[p] += weights[p].sum() - weights[p]
                else:
                    count[p] += weights[q + shift].sum()
                    count[q + shift] += weights[p].sum()
                for y in q.tolist():
                    join(int(p[0]), y + shift)
                for x in p.tolist()[1:]:
                    join(x, int(q[0]) + shift)
            else:
                good = (a.x[p] @ b.x[q].T) / (na[p][:, None] * nb[q][None, :]) >= cosine
                if own:
                    good = np.triu(good, 1)
                if good.any():
                    count[p] += good @ weights[q + shift]
                    count[q + shift] += weights[p] @ good
                    for x, y in zip(*np.nonzero(good), strict=True):
                        join(int(p[x]), int(q[y]) + shift)
    return count, root, edges


PACKED = "block int, cell int, numbers binary, weights binary, tree binary"
FOUND = "row long, links long, other long"


def _pack(table: pa.Table, width: int, limit: float) -> pa.Table:
    """One block's rows -> its cover tree."""
    x = scaled(matrix(table["vector"], width))
    schema = pa.schema([("block", pa.int32()), ("cell", pa.int32()), ("numbers", pa.binary()), ("weights", pa.binary()), ("tree", pa.binary())])
    row = {"block": table["block"][0].as_py(), "cell": table["cell"][0].as_py(), "numbers": table["row"].to_numpy().tobytes(), "weights": table["weight"].to_numpy().tobytes(), "tree": Tree(x, limit).packed()}
    release()
    return pa.Table.from_pylist([row], schema=schema)


def _tile(table: pa.Table, cosine: float) -> pa.Table:
    """One block with itself, or two blocks: links (``other`` null) and forest edges (``links`` null)."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    numbers, weights = (np.concatenate([np.frombuffer(r[c], dtype=np.int64) for r in rows]) for c in ("numbers", "weights"))
    trees = [Tree.unpacked(r["tree"]) for r in rows]
    count, _, edges = links(trees[0], trees[-1], cosine, len(rows) == 1, weights)
    some = np.flatnonzero(count)
    ends = np.array(edges, dtype=np.int64).reshape(-1, 2)
    del trees, rows
    release()
    return pa.Table.from_arrays([
        pa.array(np.concatenate([numbers[some], numbers[ends[:, 0]]])), pa.array([*count[some].tolist(), *[None] * len(ends)], pa.int64()), pa.array([*[None] * len(some), *numbers[ends[:, 1]].tolist()], pa.int64()),
    ], names=["row", "links", "other"])


def tiles(packed: DataFrame, cells: Cells, limit: float) -> DataFrame:
    """Each block once for every pair of blocks, itself included, whose cells can hold a link: with ``low, high`` of the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                block, cell = one.column("block")[0].as_py(), one.column("cell")[0].as_py()
                away = np.sqrt(((cells.pivots - cells.pivots[cell]) ** 2).sum(axis=1))
                for other in cells.blocks(away - cells.radii - cells.radii[cell] <= limit + MARGIN).tolist():
                    ends = [pa.array([f(block, other)], pa.int32()) for f in (min, max)]
                    yield pa.RecordBatch.from_arrays([*one.columns, *ends], names=[*one.schema.names, "low", "high"])

    return packed.mapInArrow(run, PACKED + ", low int, high int")


def near_copies(rows: DataFrame, *, cosine: float = 0.9, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding``."""
    every = numbered(rows)
    able = every.where("able and exists(vector, x -> x <> 0)")
    # equal vectors, told by two 64-bit hashes, are one
    keys = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2")]
    alike = written(able.select("row", F.size("vector").alias("width"), *keys).groupBy("h1", "h2").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("weight"), F.max("width").alias("width")), "alike")
    n, width = alike.agg(F.count(F.lit(1)), F.max("width")).first()
    width, limit = max(1, width or 1), float(np.sqrt(2 - 2 * cosine))
    single = able.join(alike.select(F.col("first").alias("row"), "weight"), "row")
    dealt, cells = in_cells(single, n, width, block, directions, ["row", "vector", "weight"])
    packed = written(dealt.groupBy("block").applyInArrow(lambda t: _pack(t, width, limit), PACKED), "blocks")
    found = written(tiles(packed, cells, limit).groupBy("low", "high").applyInArrow(lambda t: _tile(t, cosine), FOUND), "links")
    counts = found.where("links is not null").groupBy("row").agg(F.sum("links").alias("n_links"))
    roots = connected_components(found.where("other is not null"), "row", "other").select(F.col("node").alias("row"), F.col("component").alias("root"))
    named = alike.withColumnRenamed("first", "row").join(counts, "row", "left").join(written(roots, "roots"), "row", "left")
    named = named.select("h1", "h2", (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "row").alias("root"))
    out = able.select("vec_id", *keys).join(named, ["h1", "h2"]).select("vec_id", "n_links", "root")
    others = every.where("not able or forall(vector, x -> x = 0)").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("row").alias("root"))
    out = written(out.union(others), "members")
    names = out.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return out.join(names, "root").select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
