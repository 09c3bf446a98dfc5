"""Ordered duplicate removal: exact, contained, near, and by sentences.

Rows are visited from long to short, then by id as text.  Equality, containment
and subset are transitive, so "matches an earlier kept row" is "matches an
earlier row", a semi-join; only near matches need rounds.  Every join is an
equi-join on a blocking key that no match can avoid, and the rarest such key is
taken, so a frequent passage does not pair all rows that have it.

All operators take ``id, text`` under given names, treat a null text as empty,
and give an empty result for an empty table.  Rows must have distinct ids, as
``records`` verifies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions import hashing
from textquarry.functions import text as T
from textquarry.functions.portions import release
from textquarry.operators import prefixes
from textquarry.operators.components import connected_components
from textquarry.operators.marks import marks
from textquarry.storage import forget, written

ANCHOR, PLACES = 32, 3
#: Rows of a tile of pairs to each side, keys of the sets in one task (about), and what is counted or given back at once.
TILE, ENTRIES, AT_ONCE = 2048, 2_000_000, 4_000_000


def records(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """``id`` (as text), ``norm``, ``n``, ``h`` and further columns, written once; distinct ids are required."""
    out = df.select(F.col(id_col).cast("string").alias("id"), T.folded(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"), *[c.alias(k) for k, c in more.items()])
    out = written(out.withColumns({"n": F.length("norm").cast("long"), "h": F.sha2("norm", 256)}), "records")
    rows, ids = out.agg(F.count(F.lit(1)), F.count_distinct("id")).first()
    if rows != ids:
        raise ValueError(f"{rows - ids} rows have a null or repeated id")
    return out


def exact(rows: DataFrame) -> DataFrame:
    """``id, keeper_id, removed``: equal normalised texts keep the smallest id."""
    keepers = rows.groupBy("h").agg(F.min("id").alias("keeper_id"))
    return rows.select("id", "h").join(keepers, "h").select("id", "keeper_id", (F.col("id") != F.col("keeper_id")).alias("removed"))


def survivors(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """The rows that are not removed; only those move that the bitmaps of the removed and of the kept ids both let pass."""
    gone = written(removed.where("removed").select("id"), "removed")
    kept = written(rows.select("id").join(gone, "id", "left_anti"), "kept")
    key = F.xxhash64("id")
    out, stays = (marks(t.select(key.alias("key")), "key").column(key) for t in (gone, kept))
    return rows.where(~out).unionByName(rows.where(out & stays).join(gone, "id", "left_anti"))


def _ends(rows: DataFrame, pairs: DataFrame, left: str, right: str) -> DataFrame:
    """The rows that stand in a pair, and perhaps a few more: others need not move to a join."""
    ends = pairs.select(F.explode(F.array(F.xxhash64(left), F.xxhash64(right))).alias("key")).distinct()
    return rows.where(marks(ends, "key").column(F.xxhash64("id")))


def contained(rows: DataFrame, least: int = 240) -> DataFrame:
    """``id, keeper_id`` of rows whose text stands inside an earlier row's, both of at least ``least`` characters.

    Of any ANCHOR consecutive windows of ANCHOR characters the one of least hash
    is an anchor.  A contained text's runs of windows are its container's as well,
    so it asks for one anchor at each of PLACES places and uses the rarest; texts
    send only the anchors that are asked for, by a bitmap, and only texts of a pair move.
    """
    if least < 2 * ANCHOR:
        raise ValueError(f"least must be {2 * ANCHOR} or more")
    long = rows.where(F.col("n") >= least).select("id", "norm", "n")
    asked = written(long.select("id", "n", F.explode(hashing.anchor_hashes(F.col("norm"), ANCHOR, places=PLACES)).alias("anchor")), "asked")
    known = marks(asked.select("anchor").distinct(), "anchor")
    inside = written(long.select(F.col("id").alias("other"), F.col("n").alias("n_large"), F.explode(hashing.anchor_hashes(F.col("norm"), ANCHOR, among=known.holds)).alias("anchor")), "anchors")
    often = inside.groupBy("anchor").agg(F.count(F.lit(1)).alias("many"))
    rare = asked.join(often, "anchor").groupBy("id", "n").agg(F.min(F.struct("many", "anchor")).alias("m")).where("m.many > 1")
    earlier = (F.col("n_large") > F.col("n")) | ((F.col("n_large") == F.col("n")) & (F.col("other") < F.col("id")))
    pairs = written(rare.select("id", "n", F.col("m.anchor").alias("anchor")).join(inside, "anchor").where(earlier).select("id", "other"), "pairs")
    texts = _ends(long, pairs, "id", "other")
    a, b = texts.select("id", F.col("norm").alias("small")), texts.select(F.col("id").alias("other"), F.col("norm").alias("large"))
    found = written(pairs.join(a, "id").join(b, "other").where(F.col("large").contains(F.col("small"))).select("id", "other"), "contained")
    return _smallest_kept(found)


def _smallest_kept(found: DataFrame) -> DataFrame:
    """``id, other`` matches with earlier rows -> ``id, keeper_id``, the smallest match that is itself kept."""
    gone = found.select(F.col("id").alias("other")).distinct()
    return found.join(gone, "other", "left_anti").groupBy("id").agg(F.min("other").alias("keeper_id"))


def sentence_subsets(rows: DataFrame, least: int = 80) -> DataFrame:
    """``id, keeper_id`` of rows whose sentences all stand in one earlier row.

    ``rows`` has ``sentences``; a row is tested from ``least`` characters and two
    distinct sentences on.  The block is its rarest sentence, which any superset has.
    """
    s = rows.select("id", "n", F.transform("sentences", lambda x: F.xxhash64(x)).alias("keys"))
    s = written(s, "sentence-keys")
    each = s.select(F.col("id").alias("other"), F.explode("keys").alias("key"))
    often = each.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    tested = s.where((F.col("n") >= least) & (F.size("keys") >= 2))
    full = tested.select("id", F.size("keys").alias("size"), F.explode("keys").alias("key")).join(often, "key")
    # every sentence of a subset row occurs in two rows at least
    rare = full.groupBy("id", "size").agg(F.min(F.struct("many", "key")).alias("m"), F.count(F.lit(1)).alias("shared")).where("shared = size")
    pairs = rare.select("id", F.col("m.key").alias("key")).join(each, "key").where("id <> other").select("id", "other")
    a, b = s.select("id", F.col("keys").alias("ka"), F.col("n").alias("na")), s.select(F.col("id").alias("other"), F.col("keys").alias("kb"), F.col("n").alias("nb"))
    earlier = (F.col("nb") > F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("other") < F.col("id")))
    found = pairs.join(a, "id").join(b, "other").where(earlier & (F.size(F.array_except("ka", "kb")) == 0)).select("id", "other")
    return _smallest_kept(written(found, "subsets"))


def near_pairs(rows: DataFrame, threshold: float = 0.9, width: int = 5) -> DataFrame:
    """All pairs ``left_id < right_id`` with the Jaccard similarity of their shingles, exhaustively.

    Only shingles of two rows or more can be shared.  In order of rarity, the
    first ``shared - ceil(threshold * n) + 1`` of a row must hold one of any
    partner's; rows with fewer shared shingles than that bound drop out.  Before
    any whole row moves, part of its shingles tells whether it may have a near
    copy (``prefixes``); only rows that may are exploded.  Rows that have such a
    first shingle in common are linked to one of them, not to each other, and
    compared where their component lies: no pair moves but those found.
    """
    return marked_pairs(rows, threshold, width).drop("link")


def marked_pairs(rows: DataFrame, threshold: float = 0.9, width: int = 5) -> DataFrame:
    """:func:`near_pairs`, with ``link`` for some that connect what all of them connect: no more than the rows, or the rows times the tiles that they stand in."""
    able = prefixes.able(rows.select(F.xxhash64("id").alias("key"), "norm"), "key", "norm", hashing.shingle_sets(width), threshold)
    keyed = written(rows.where(marks(able, "key").column(F.xxhash64("id"))).select("id", hashing.shingle_hashes(F.col("norm"), width).alias("keys")).where("size(keys) > 0"), "shingles")
    each = keyed.select("id", F.size("keys").alias("n"), F.explode("keys").alias("key"))
    often = each.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    needed = F.ceil(F.col("n") * F.lit(threshold) - 1e-9)
    shared = each.join(often, "key").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("many", "key"))).alias("shared")).where(F.size("shared") >= needed)
    shared = written(shared.withColumn("keys", F.transform("shared", lambda x: x["key"])).drop("shared"), "shared")
    forget(keyed), forget(able)
    first = F.slice("keys", F.lit(1), (F.size("keys") - needed + 1).cast("int"))
    probes = shared.select("id", F.explode(first).alias("key"))
    edges = probes.join(probes.groupBy("key").agg(F.min("id").alias("other")), "key").where("id <> other")
    found = connected_components(edges, "id", "other").withColumnRenamed("node", "id")
    found = written(found.join(shared.select("id", F.size("keys").cast("long").alias("size")), "id"), "components")
    cuts = found.groupBy("component").agg((F.floor(F.greatest(F.count(F.lit(1)) / TILE, F.sum("size") / ENTRIES)) + 1).cast("int").alias("cuts"))
    placed = written(found.join(cuts, "component").select("id", "component", "size", "cuts", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int").alias("own")), "placed")
    tiles = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    moved = shared.join(placed, "id").select("component", F.explode(tiles).alias("t"), "own", "id", "n", "keys").select("component", "t.i", "t.j", "own", "id", "n", "keys")
    blocks = max(8, -(-(placed.agg(F.sum(F.col("size") * F.col("cuts"))).first()[0] or 0) // ENTRIES))
    moved = moved.withColumn("block", F.pmod(F.xxhash64("component", "i", "j"), F.lit(blocks)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        order = pc.sort_indices(table.select(["component", "i", "j", "id"]), sort_keys=[(c, "ascending") for c in ("component", "i", "j", "id")]).to_numpy()
        ids, column = table["id"].combine_chunks(), table["keys"].combine_chunks()
        begins, flat, sizes = column.offsets.to_numpy(), column.values.to_numpy(), table["n"].to_numpy()
        i, j, own = (table[c].to_numpy()[order] for c in ("i", "j", "own"))
        names = table["component"].combine_chunks().dictionary_encode().indices.to_numpy()[order]
        other = np.flatnonzero((np.diff(names) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1

        def pairs() -> Iterator[tuple[np.ndarray, ...]]:
            for a, b in zip([0, *other.tolist()], [*other.tolist(), len(order)], strict=True):
                sides = np.flatnonzero(own[a:b] == i[a]), np.flatnonzero(own[a:b] == j[a])
                at = order[a:b]
                for x, y, similarity, link in _tile([flat[begins[k] : begins[k + 1]] for k in at.tolist()], sizes[at], *sides, threshold):
                    yield at[np.minimum(x, y)], at[np.maximum(x, y)], similarity, link

        def given(some: list[tuple]) -> pa.RecordBatch:
            left, right, similarity, link = (np.concatenate(c) for c in zip(*some, strict=True))
            return pa.RecordBatch.from_arrays([ids.take(pa.array(left)), ids.take(pa.array(right)), pa.array(similarity), pa.array(link)], names=["left_id", "right_id", "similarity", "link"])

        some, count = [], 0
        for p in pairs():
            some.append(p)
            count += len(p[0])
            if count * 40 > AT_ONCE:
                yield given(some)
                some, count = [], 0
        if some:
            yield given(some)
        release()

    return moved.groupBy("block").applyInArrow(run, "left_id string, right_id string, similarity double, link boolean")


def _tile(sets: list[np.ndarray], sizes: np.ndarray, one: np.ndarray, two: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, ...]]:
    """The near pairs between the rows ``one`` and ``two`` of a tile, which are the same rows or have none in common: for each of ``one`` with any its places, theirs, similarities and what connects them.

    Rows are met through lists of the rows that have a key, so only shared keys are counted, for whole columns at once.
    """
    if len(one) == 0 or len(two) == 0:
        return
    same = len(one) == len(two) and one[0] == two[0]
    entries = np.concatenate([sets[k] for k in two.tolist()])
    order = np.argsort(entries, kind="stable")
    lists = np.repeat(np.arange(len(two)), [len(sets[k]) for k in two.tolist()])[order]
    known, begin, count = np.unique(entries[order], return_index=True, return_counts=True)
    end, label, step = begin + count, np.arange(len(sets)), max(1, AT_ONCE // len(two))
    for x in one.tolist():
        place = np.searchsorted(known, sets[x])
        place = place[known[np.minimum(place, len(known) - 1)] == sets[x]] if not same else place
        if same:
            begin[place] += 1  # rows are visited in the order of the lists: what is left comes after this one
        common = np.zeros(len(two), dtype=np.int64)
        for c in range(0, len(place), step):
            some = place[c : c + step]
            n = end[some] - begin[some]
            before = np.cumsum(n)
            if before[-1]:
                common += np.bincount(lists[np.repeat(begin[some] - before + n, n) + np.arange(before[-1])], minlength=len(two))
        similarity = common / (sizes[x] + sizes[two] - common)
        good = np.flatnonzero(similarity >= threshold)
        if len(good):
            y = two[good]
            link = np.zeros(len(y), dtype=bool)
            theirs, first = np.unique(label[y], return_index=True)
            link[first[theirs != label[x]]] = True
            if link.any():
                label[np.isin(label, theirs)] = label[x]
            yield np.full(len(y), x), y, similarity[good], link


def _scored(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose sets ``id, n, keys`` (``n`` the size with unshared keys) reach the threshold, with their similarity.

    A set moves once to the task of its component of pairs; components of more
    than TILE rows are cut into tiles of pairs, and a set moves to its row of tiles and its column.
    """
    found = written(connected_components(pairs, "left_id", "right_id"), "components")
    cuts = found.groupBy("component").agg((F.floor(F.count(F.lit(1)) / TILE) + 1).cast("int").alias("cuts"))
    placed = written(found.join(cuts, "component").select(F.col("node").alias("id"), "component", "cuts", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int").alias("own")), "placed")
    x, y = placed.select(F.col("id").alias("left_id"), "component", F.col("own").alias("i")), placed.select(F.col("id").alias("right_id"), F.col("own").alias("j"))
    asked = pairs.join(x, "left_id").join(y, "right_id").select("component", "i", "j", F.col("left_id").alias("id"), F.col("right_id").alias("other"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("array<bigint>").alias("keys"))
    each = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda k: F.array(F.struct(F.col("own").alias("i"), k.alias("j")), F.struct(k.alias("i"), F.col("own").alias("j"))))
    moved = sets.join(placed, "id").select("component", F.explode(F.array_distinct(F.flatten(each))).alias("t"), "id", F.col("n").cast("long").alias("n"), "keys")
    moved = moved.select("component", "t.i", "t.j", "id", F.lit(None).cast("string").alias("other"), "n", "keys")
    blocks = max(8, -(-(sets.agg(F.sum(F.size("keys"))).first()[0] or 0) // ENTRIES))
    both = asked.unionByName(moved).withColumn("block", F.pmod(F.xxhash64("component", "i", "j"), F.lit(blocks)).cast("int")).drop("component", "i", "j")

    def run(table: pa.Table) -> pa.Table:
        given = pc.is_null(table["other"])
        rows, wanted = table.filter(given), table.filter(pc.invert(given)).sort_by("id")
        ids, column = rows["id"].to_pylist(), rows["keys"].combine_chunks()
        at, n = {i: k for k, i in enumerate(ids)}, rows["n"].to_numpy()
        begins, flat = column.offsets.to_numpy(), column.values.to_numpy()
        keys = lambda k: flat[begins[k] : begins[k + 1]]
        left, right = ([at[i] for i in wanted[c].to_pylist()] for c in ("id", "other"))
        left, right, similarity = np.array(left, dtype=np.int64), np.array(right, dtype=np.int64), np.zeros(len(left))
        ends = [*np.flatnonzero(np.diff(left, prepend=-1)).tolist(), len(left)]
        for a, b in zip(ends, ends[1:], strict=False):
            own = np.sort(keys(left[a]))
            for c in range(a, b, 256):
                some = right[c : min(b, c + 256)]
                parts = [keys(k) for k in some.tolist()]
                entries = np.concatenate(parts)
                place = np.minimum(np.searchsorted(own, entries), len(own) - 1)
                common = np.bincount(np.repeat(np.arange(len(some)), [len(p) for p in parts])[own[place] == entries], minlength=len(some))
                similarity[c : c + len(some)] = common / (n[left[a]] + n[some] - common)
        good = similarity >= threshold
        out = pa.table({"left_id": wanted["id"].filter(good), "right_id": wanted["other"].filter(good), "similarity": similarity[good]})
        release()
        return out

    return both.groupBy("block").applyInArrow(run, "left_id string, right_id string, similarity double")


def banded_pairs(rows: DataFrame, threshold: float = 0.9, width: int = 5, *, perms: int = 64, bands: int = 8, seed: int = 1729, least: int = 240) -> DataFrame:
    """The pairs ``left_id < right_id, similarity`` of rows that share a band of their MinHash signatures and reach the Jaccard threshold.

    What a search by bands finds and no more: a pair below 1 may share no band.
    ``near_pairs`` finds all.  Rows shorter than ``least`` take no part.  Bands move
    as 64-bit hashes; shingles only of rows that share one.
    """
    if perms % bands:
        raise ValueError("the number of permutations must be a multiple of the number of bands")
    able = rows.where(F.col("n") >= least)
    keyed = written(able.select("id", F.explode(hashing.band_keys(F.col("norm"), width=width, perms=perms, bands=bands, seed=seed)).alias("band")).select("id", F.xxhash64("band").alias("band")), "bands")
    a, b = (keyed.select(F.col("id").alias(f"{s}_id"), "band") for s in ("left", "right"))
    pairs = written(a.join(b, "band").where(F.col("left_id") < F.col("right_id")).select("left_id", "right_id").distinct(), "pairs")
    keys = written(_ends(able, pairs, "left_id", "right_id").select("id", hashing.shingle_hashes(F.col("norm"), width).alias("keys")), "shingles")
    return _scored(pairs, keys.withColumn("n", F.size("keys")), threshold)


def same_facts(pairs: DataFrame, rows: DataFrame, gates: list[str]) -> DataFrame:
    """The pairs whose rows agree in every column of ``gates`` (answer, numbers, task): near copies with other facts are none."""
    pairs = written(pairs, "pairs")
    some = _ends(rows, pairs, "left_id", "right_id")
    a, b = (some.select(F.col("id").alias(f"{s}_id"), F.struct(*gates).alias(f"{s}_facts")) for s in ("left", "right"))
    return pairs.join(a, "left_id").join(b, "right_id").where(F.col("left_facts").eqNullSafe(F.col("right_facts"))).drop("left_facts", "right_facts")


def first_come(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Greedy removal along a relation that is not transitive: ``id, keeper_id, removed``.

    ``nodes`` has ``id, n``; ``edges`` has ``left_id, right_id``.  A row goes if an
    earlier kept row matches it.  Each round keeps the rows without an undecided
    earlier neighbour and removes their later ones; the result equals visiting
    rows one by one, in as many rounds as the longest chain of decisions.
    """
    place = nodes.select("id", "n")
    x, y = place.select(F.col("id").alias("left_id"), F.col("n").alias("nl")), place.select(F.col("id").alias("right_id"), F.col("n").alias("nr"))
    left_first = (F.col("nl") > F.col("nr")) | ((F.col("nl") == F.col("nr")) & (F.col("left_id") < F.col("right_id")))
    arcs = edges.join(x, "left_id").join(y, "right_id").select(F.when(left_first, F.col("left_id")).otherwise(F.col("right_id")).alias("first"), F.when(left_first, F.col("right_id")).otherwise(F.col("left_id")).alias("later"))
    arcs = open_arcs = written(arcs.distinct(), "arcs")
    kept = None
    while not open_arcs.isEmpty():
        heads = open_arcs.select(F.col("first").alias("id")).distinct().join(open_arcs.select(F.col("later").alias("id")), "id", "left_anti")
        heads = written(heads, "heads")
        gone = written(open_arcs.join(heads, F.col("first") == F.col("id")).select(F.col("later").alias("id")).distinct(), "gone")
        kept = heads if kept is None else kept.union(heads)
        out = heads.union(gone)
        following = open_arcs.join(out, F.col("first") == F.col("id"), "left_anti").join(out, F.col("later") == F.col("id"), "left_anti")
        # a row whose earlier neighbours are all removed is kept, though it heads no open arc
        following = written(following, "arcs")
        freed = open_arcs.select(F.col("first").alias("id")).union(open_arcs.select(F.col("later").alias("id"))).distinct().join(out, "id", "left_anti")
        freed = freed.join(following.select(F.col("later").alias("id")), "id", "left_anti").join(following.select(F.col("first").alias("id")), "id", "left_anti")
        kept = kept.union(written(freed, "freed"))
        if open_arcs is not arcs:
            forget(open_arcs)
        open_arcs = following
    if kept is None:
        return place.select("id", F.lit(None).cast("string").alias("keeper_id"), F.lit(False).alias("removed"))
    keepers = arcs.join(kept.distinct(), F.col("first") == F.col("id")).join(kept.select(F.col("id").alias("k")).distinct(), F.col("later") == F.col("k"), "left_anti")
    keepers = keepers.groupBy(F.col("later").alias("id")).agg(F.min("first").alias("keeper_id"))
    return place.join(keepers, "id", "left").select("id", "keeper_id", F.col("keeper_id").isNotNull().alias("removed"))
