"""Jaccard join of documents on word shingles, as a blocked sparse matrix product.

The documents' shingle sets are the rows of a 0/1 matrix; two documents link
when their rows' product is large against their sizes.  The product is taken in
blocks and only where a link is possible:

1. Documents with equal sets are one class.  Part of each set tells which classes
   may link at all (``prefixes``).  Each task sends these classes'
   shingle hashes to blocks of the shingle range, packed, with the class each
   belongs to.  A block counts in how many classes each shingle occurs and sends
   on, by class, only the shingles of two classes or more: others are in no
   product.
2. A class of size n needs ``ceil(t * n)`` shared shingles.  Classes with fewer
   go.  Of the others' shingles, in order of rarity, the first
   ``shared - ceil(t * n) + 1`` must hold one of any partner's: only these
   columns of the matrix say which products are taken.  Copies of frequent
   passages thus never meet through those passages alone.
3. Each such column has a centre, the class with the fewest shingles of its
   own, and each class is multiplied with the centre it meets most: products in
   number of classes, not their square.  A block of the product holds some
   centres and the rows that meet them; overlap counts are accumulated over all
   columns of the block at once and discarded where they lie below the bound
   that the two sizes set.  A centre with very many rows is split over blocks.
   What is left are links, exact ones; components follow from them.  Classes
   that a centre did not reach get another.
4. All remaining pairs of a column that lie in different components are
   multiplied too, if sizes and places allow a link: if the column is the first
   one shared, what follows it in both bounds the overlap.  So no link between
   components is missed, and pairs inside a component, which can change nothing,
   are never made.

A column's rows are dealt over several tasks in proportion to the number of its
classes, so a frequent shingle is in no single task.  Shingles and classes are
64-bit hashes; on their way to a block shingles are cut to 48 bits of their place
in it.  Edge cases: without words or text the set is empty and linked
with nothing; fewer words than a shingle are one shingle; a null id belongs to
its class and is never a component's id (null if no row has one); repeated rows
are one class; ties between centres go to the smaller class; an empty table
gives an empty result; further columns are ignored.  Long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.llm.words import portions, release, shingle_set, words_of
from textquarry.operators import prefixes
from textquarry.operators.components import connected_components
from textquarry.operators.marks import Marks, marks
from textquarry.storage import forget, small_batches, written

#: Characters of text whose shingles a task sends at once, and shingles for each block of the shingle range.
PORTION, BLOCK = 2_000_000, 1_500_000
#: Shingles of rows in one block of the product, and classes of a column in one task, about.
ENTRIES, DEALT = 1_000_000, 512
#: Rounds of multiplying classes with centres before all that is left is multiplied.
ROUNDS = 2
PACKED = "block int, doc_id long, text_key long, n int, class long, classes binary, sizes binary, counts binary, shingles binary"


def _parts(sorted_keys: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(sorted_keys, np.arange(n + 1))


def _sets(words: int):
    """For ``prefixes.able``: classes and shingles of texts."""

    def run(texts: list[str | None], keys: list) -> tuple[np.ndarray, list[np.ndarray]]:
        sets = [shingle_set(w, words) for w in words_of(texts)]
        return np.array([_class_of(s) for s in sets], dtype=np.int64), sets

    return run


def _incidence(docs: DataFrame, words: int, blocks: int, able: Marks) -> DataFrame:
    """Rows of two kinds: a document with its class, and a block's packed part of the matrix, of classes that may link only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in portions(batches, lambda r: len(r[1] or ""), PORTION):
            sets = [shingle_set(w, words) for w in words_of([text for _, text, _ in rows])]
            classes = np.array([_class_of(s) for s in sets], dtype=np.int64)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            out: dict[str, list] = {c.split()[0]: [] for c in PACKED.split(", ")}
            for k, (doc, _, key) in enumerate(rows):
                _put(out, block=k % blocks, doc_id=doc, text_key=key, n=int(sizes[k]), **{"class": int(classes[k]) if sizes[k] else None})
            del rows
            _, first = np.unique(classes, return_index=True)
            first = first[(sizes[first] > 0) & able.holds(classes[first])]
            if len(first):
                flat, of = np.concatenate([sets[k] for k in first]), np.repeat(np.arange(len(first), dtype=np.int32), sizes[first])
                del sets
                block = _block_of(flat, blocks)
                order = np.argsort(block.astype(np.uint16) if blocks <= 65536 else block, kind="stable")
                flat, of, ends = flat[order], of[order], _parts(block[order], blocks)
                del block, order
                for b in range(blocks):
                    part = of[ends[b] : ends[b + 1]]
                    if len(part):
                        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
                        own = first[part[starts]]
                        _put(out, block=b, classes=classes[own].tobytes(), sizes=sizes[own].astype(np.int32).tobytes(), counts=np.diff(np.append(starts, len(part))).astype(np.int32).tobytes(), shingles=_short(flat[ends[b] : ends[b + 1]], b, blocks))
                        if len(out["block"]) > 1024:
                            yield _batch(out)
                            out = {c: [] for c in out}
                del flat, of
            yield _batch(out)
            del out
        release()

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(run, PACKED)


def _block_of(shingles: np.ndarray, blocks: int) -> np.ndarray:
    """Blocks are equal ranges of the hash."""
    return (((shingles >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def _place(block: int, blocks: int) -> tuple[np.uint64, np.uint64]:
    """Where a block's range begins, and how many low bits of a place in it 48 bits leave out."""
    return np.uint64(-(-(block << 32) // blocks) << 32), np.uint64(max(0, 16 - (blocks.bit_length() - 1)))


def _short(shingles: np.ndarray, block: int, blocks: int) -> bytes:
    """Six bytes a shingle: the first 48 bits of its place in the block.

    A block has so many shingles whatever the corpus is, and so the chance of a
    mistaken one, some 1 in 10 ** 8, does not grow with it.
    """
    begin, left_out = _place(block, blocks)
    return np.ascontiguousarray(((shingles - begin) >> left_out).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _long(data: np.ndarray, block: int, blocks: int) -> np.ndarray:
    """The shingles again, but for the bits left out."""
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = data.reshape(-1, 6)
    begin, left_out = _place(block, blocks)
    return (out.view("<u8").ravel() << left_out) + begin


def _class_of(shingles: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _put(out: dict[str, list], **values) -> None:
    for c, column in out.items():
        column.append(values.get(c))


TYPES = {"block": pa.int32(), "doc_id": pa.int64(), "text_key": pa.int64(), "n": pa.int32(), "class": pa.int64(), "classes": pa.binary(), "sizes": pa.binary(), "counts": pa.binary(), "shingles": pa.binary()}


def _batch(out: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, TYPES[c]) for c, v in out.items()], names=list(out))


SHARED = "bucket int, doc_id long, text_key long, n int, class long, classes binary, sizes binary, counts binary, shingles binary, frequencies binary"


def _shared(table: pa.Table, blocks: int) -> pa.Table:
    """One block: documents pass through; shingles of two classes or more go on, by bucket of the class."""
    packed = table.filter(pc.is_valid(table["shingles"]))
    docs = table.filter(pc.is_null(table["shingles"]))
    out = [docs.select(["doc_id", "text_key", "n", "class"])]
    read = lambda c, kind: np.concatenate([np.frombuffer(x.as_buffer(), dtype=kind) for x in packed[c]]) if len(packed) else np.empty(0, kind)
    classes, sizes, counts, shingles = read("classes", np.int64), read("sizes", np.int32), read("counts", np.int32), _long(read("shingles", np.uint8), table["block"][0].as_py(), blocks) if len(packed) else np.empty(0, np.uint64)
    rows = []
    if len(classes):
        # a class sent by many tasks counts once
        of = np.repeat(np.arange(len(classes), dtype=np.int32), counts)
        _, first = np.unique(classes, return_index=True)
        if len(first) < len(classes):
            once = np.zeros(len(classes), dtype=bool)
            once[first] = True
            shingles, of = shingles[once[of]], of[once[of]]
        order = np.argsort(shingles)
        shingles, of = shingles[order], of[order]
        del order
        starts = np.flatnonzero(np.concatenate(([True], shingles[1:] != shingles[:-1])))
        times = np.diff(np.append(starts, len(shingles))).astype(np.int32)
        many = np.repeat(times > 1, times)
        shingles, of, frequency = shingles[many], of[many], np.repeat(times, times)[many]
        del starts, times, many
        order = np.lexsort((of, (classes[of] % blocks)))
        shingles, of, frequency = shingles[order], of[order], frequency[order]
        ends = _parts(classes[of] % blocks, blocks)
        for b in range(blocks):
            part = of[ends[b] : ends[b + 1]]
            if len(part):
                starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
                own = part[starts]
                rows.append({"bucket": b, "classes": classes[own].tobytes(), "sizes": sizes[own].tobytes(), "counts": np.diff(np.append(starts, len(part))).astype(np.int32).tobytes(), "shingles": shingles[ends[b] : ends[b + 1]].tobytes(), "frequencies": frequency[ends[b] : ends[b + 1]].astype(np.int32).tobytes()})
    del classes, sizes, counts, shingles
    release()
    schema = pa.schema([("bucket", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int32()), ("class", pa.int64()), *[(c, pa.binary()) for c in ("classes", "sizes", "counts", "shingles", "frequencies")]])
    fill = lambda t: pa.Table.from_arrays([t[c].combine_chunks().cast(f.type) if c in t.column_names else pa.nulls(len(t), f.type) for c, f in zip(schema.names, schema, strict=True)], schema=schema)
    return pa.concat_tables([fill(out[0]), pa.Table.from_pylist(rows, schema=schema)])


CLASSES = "class long, n int, shared binary, probes int, often binary"
CLASS_SCHEMA = pa.schema([("class", pa.int64()), ("n", pa.int32()), ("shared", pa.binary()), ("probes", pa.int32()), ("often", pa.binary())])


def _needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    return (percent * n + 99) // 100


def _candidates(table: pa.Table, percent: int) -> pa.Table:
    """One bucket: each class that can link at all, its shared shingles from rare to frequent, how many to multiply, and in how many classes these occur."""
    read = lambda c, kind: np.concatenate([np.frombuffer(x.as_buffer(), dtype=kind) for x in table[c]])
    classes, sizes, counts = read("classes", np.int64), read("sizes", np.int32), read("counts", np.int32)
    ids, first = np.unique(classes, return_index=True)
    at = np.repeat(np.searchsorted(ids, classes).astype(np.int32), counts)
    n = sizes[first]
    shared = np.bincount(at, minlength=len(ids))
    able = shared >= _needed(n.astype(np.int64), percent)
    keep = able[at]
    shingles, frequency, at = read("shingles", np.uint64)[keep], read("frequencies", np.int32)[keep], at[keep]
    order = np.lexsort((shingles, frequency, at))
    shingles, frequency, ends = shingles[order], frequency[order], np.searchsorted(at[order], np.arange(len(ids) + 1))
    rows = []
    for k in np.flatnonzero(able).tolist():
        probes = int(shared[k] - _needed(int(n[k]), percent) + 1)
        rows.append({"class": int(ids[k]), "n": int(n[k]), "shared": shingles[ends[k] : ends[k + 1]].tobytes(), "probes": probes, "often": frequency[ends[k] : ends[k] + probes].tobytes()})
    out = pa.Table.from_pylist(rows, schema=CLASS_SCHEMA)
    del shingles, frequency, at, order, keep, rows
    release()
    return out


COLUMNS = "shingle long, class long, n int, s int, at int, shares int"


def _columns(classes: DataFrame) -> DataFrame:
    """The columns to multiply: each class's rarest shared shingles, its size, its number of shared shingles, the place among them, and over how many tasks the column is dealt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 64):
                cls, n, shared, probes, often = (c.to_pylist() for c in whole.slice(k, 64).columns)
                parts = [np.frombuffer(s, dtype=np.int64, count=p) for s, p in zip(shared, probes, strict=True)]
                sizes = [len(p) for p in parts]
                per_class = (np.array(cls, dtype=np.int64), np.array(n, dtype=np.int32), np.array([len(s) // 8 for s in shared], dtype=np.int32))
                at = np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])
                shares = np.concatenate([np.frombuffer(f, dtype=np.int32) for f in often]) // DEALT + 1
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts)), *[pa.array(np.repeat(x, sizes)) for x in per_class], pa.array(at), pa.array(shares)], names=["shingle", "class", "n", "s", "at", "shares"])
        release()

    return classes.select("class", "n", "shared", "probes", "often").mapInArrow(run, COLUMNS)


def _dealt(lists: DataFrame) -> DataFrame:
    """Columns with the share that a row is in; shares of one column lie in different tasks."""
    return lists.withColumn("share", F.pmod(F.xxhash64("class"), F.col("shares")).cast("int"))


def _each_share(columns: DataFrame) -> DataFrame:
    """One row a column -> one for each of its shares."""
    return columns.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))


def _may_link(percent: int) -> Column:
    """Whether x and y can link if this column is the first they share: then no shingle before it is common, so the overlap is at most what follows."""
    left = F.least(F.col("x.s") - F.col("x.at"), F.col("y.s") - F.col("y.at"))
    return left * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent


def _meeting() -> Column:
    return (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.share") == F.col("y.share"))


def _centred(lists: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` of a class and the centre it meets most (``s``: a's shared shingles), and each list's centre.

    The centre of a column is the class with the fewest shingles of its own: what
    edited copies have in common.
    """
    small = F.min(F.struct((F.col("n") - F.col("s")).alias("own"), "n", "class", "s", "at"))
    best = _dealt(lists).groupBy("shingle", "share", "shares").agg(small.alias("c"), F.count(F.lit(1)).alias("many"))
    best = best.groupBy("shingle", "shares").agg(F.min("c").alias("c"), F.sum("many").alias("many")).where("many > 1")
    centres = written(_each_share(best.select("shingle", "shares", *[F.col(f"c.{x}").alias(x) for x in ("class", "n", "s", "at")])), "centres")
    met = _dealt(lists).alias("x").join(centres.alias("y"), _meeting() & (F.col("x.class") != F.col("y.class")) & _may_link(percent))
    met = met.groupBy(F.col("x.class").alias("a"), F.col("y.class").alias("b"), F.col("x.s").alias("s")).agg(F.count(F.lit(1)).alias("overlap"))
    return met.groupBy("a", "s").agg(F.max_by("b", F.struct("overlap", "b")).alias("b")), centres.select("shingle", "share", F.col("class").alias("centre"))


def _product(table: pa.Table, percent: int) -> pa.Table:
    """One block: its rows times its centres; the pairs whose overlap count reaches the bound of their sizes.

    ``table``: ``b, share, a, n, shared``, the centres themselves with ``a`` null.
    """
    table = table.sort_by([("b", "ascending"), ("share", "ascending")])
    b, n, a = table["b"].to_numpy(), table["n"].to_numpy(), table["a"].fill_null(0).to_numpy()  # with nulls in it a column would become doubles
    flat = table["shared"].combine_chunks()
    centre = pc.is_null(table["a"]).to_numpy()
    share = table["share"].to_numpy()
    row_key = np.concatenate(([0], np.cumsum((b[1:] != b[:-1]) | (share[1:] != share[:-1])))) if len(b) else b
    found = []
    for group in range(int(row_key[-1]) + 1 if len(b) else 0):
        low, high = np.searchsorted(row_key, [group, group + 1])
        rows = np.arange(low, high)
        middle, others = rows[centre[rows]], rows[~centre[rows]]
        if not len(middle) or not len(others):
            continue
        column = np.sort(np.frombuffer(flat[int(middle[0])].as_buffer(), dtype=np.int64))
        parts = [np.frombuffer(flat[k].as_buffer(), dtype=np.int64) for k in others.tolist()]
        entries, of = np.concatenate(parts), np.repeat(np.arange(len(others)), [len(p) for p in parts])
        at = np.searchsorted(column, entries)
        at[at == len(column)] = 0
        overlap = np.bincount(of[column[at] == entries], minlength=len(others))
        reaches = (100 + percent) * overlap >= percent * (n[others].astype(np.int64) + int(n[middle[0]]))
        found.append((a[others[reaches]], b[others[reaches]]))
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [np.empty(0, dtype=np.int64)] * 2
    release()
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])


def _links(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of classes that link, by blocks of the product; ``s`` is a's number of shared shingles."""
    total = pairs.agg(F.sum("s")).first()[0] or 0
    if not total:
        return pairs.select("a", "b")
    blocks = max(1, -(-total // ENTRIES))
    weights = pairs.groupBy("b").agg((F.floor(F.sum("s") / ENTRIES) + 1).cast("int").alias("shares"))
    rows = pairs.join(weights, "b").select("b", F.pmod(F.xxhash64("a"), F.col("shares")).cast("int").alias("share"), "a", F.col("a").alias("__class"))
    middle = _each_share(weights).select("b", "share", F.lit(None).cast("long").alias("a"), F.col("b").alias("__class"))
    own = classes.select(F.col("class").alias("__class"), "n", "shared")
    both = rows.union(middle).join(own, "__class").select("b", "share", "a", "n", "shared").withColumn("block", F.pmod(F.xxhash64("b", "share"), F.lit(blocks)))
    product = lambda t: _product(t.drop(["block"]), percent)
    return both.groupBy("block").applyInArrow(product, "a long, b long")


def components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, root`` for every row; rows of one component, and no others, share a root (null: no shingles)."""
    small_batches(docs.sparkSession)
    able = prefixes.able(docs.select(F.lit(0).cast("long").alias("key"), "text"), "key", "text", _sets(words), percent / 100)
    blocks = max(8, -(-(able.agg(F.sum("n")).first()[0] or 0) // BLOCK))
    matrix = _incidence(docs, words, blocks, marks(able, "key")).repartition(blocks, "block")
    held = written(matrix.groupBy("block").applyInArrow(lambda t: _shared(t, blocks), SHARED), "incidence")
    rows = written(held.where("shingles is null").select("doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"), F.col("class")), "classed")
    packed = held.where("shingles is not null").select("bucket", "classes", "sizes", "counts", "shingles", "frequencies")
    classes = written(packed.groupBy("bucket").applyInArrow(lambda t: _candidates(t, percent), CLASSES), "classes")
    forget(held)
    columns = written(_columns(classes), "columns")

    lists, edges = columns, None
    for step in range(ROUNDS):
        pairs, centres = _centred(lists, percent)
        links = written(_links(written(pairs, "pairs"), classes, percent), "links")
        edges = links if edges is None else edges.union(links)
        found = written(connected_components(edges, "a", "b").select(F.col("node").alias("class"), F.col("component").alias("label")), "labels")
        labelled = columns.join(found, "class", "left").withColumn("label", F.coalesce("label", "class"))
        torn = _dealt(labelled).groupBy("shingle", "share", "shares").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        torn = _each_share(torn.groupBy("shingle", "shares").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("shingle", "shares"))
        left = written(_dealt(labelled).join(torn.drop("shares"), ["shingle", "share"]), "left")
        if step + 1 < ROUNDS:
            # what a column's centre did not reach gets a centre of its own
            near = centres.join(found, centres.centre == found["class"], "left").select("shingle", "share", F.coalesce("label", "centre").alias("reached"))
            lists = written(left.join(near, ["shingle", "share"]).where("label <> reached").select(*columns.columns), "unreached")
    # one side of a column goes to all shares of the other
    each = left.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    apart = (F.col("x.label") < F.col("y.label")) & _may_link(percent)
    met = left.alias("x").join(each.alias("y"), _meeting() & apart)
    rest = written(met.select(F.col("x.class").alias("a"), F.col("x.s").alias("s"), F.col("y.class").alias("b"), F.col("x.label").alias("la"), F.col("y.label").alias("lb")).distinct(), "rest")
    # of the links between two components one is enough
    links = _links(rest, classes, percent).join(rest, ["a", "b"]).select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    whole = connected_components(links, "a", "b").select(F.col("node").alias("label"), F.col("component").alias("whole"))
    named = rows.select("class").where("class is not null").distinct().join(found, "class", "left").withColumn("label", F.coalesce("label", "class"))
    found = named.join(whole, "label", "left").select("class", F.coalesce("whole", "label").alias("component"))
    rows = rows.join(written(found, "roots"), "class", "left")
    return rows.select("doc_id", "text_key", "n_shingles", F.col("component").alias("root"))


def join(docs: DataFrame, *, words: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``doc_id, text``.

    Two documents link when 100 times their common shingles are at least
    ``percent`` times their shingles together; a component is what links reach,
    named by its smallest id.
    """
    rows = written(components(docs, words, percent), "rows")
    names = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return rows.join(names, "root", "left").select("doc_id", "n_shingles", component.alias("component_id"))


def keep_first(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without all but one row of each component.

    The row with the smallest id stays, a null id last; under one id the one of
    smallest text hash; of rows equal in id and text any.  Rows without
    shingles stay.
    """
    rows = written(components(docs, words, percent).where("root is not null"), "rows")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"))
    # written, so that adaptive execution can split the join of a large component
    pairs = written(rows.groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("times")), "texts").join(first, "root")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    marked = written(pairs.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), stays.alias("__stays"), "times").where("not __stays or times > 1"), "marked")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
    kept = docs.join(marked, same, "left_anti")
    again = docs.join(marked.where("__stays"), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(again) if not marked.where("__stays").isEmpty() else kept
