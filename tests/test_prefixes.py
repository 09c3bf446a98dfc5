"""What may have a near copy, bitmaps of keys, and anchors of texts."""

import numpy as np
from pyspark.sql import functions as F

from textquarry.functions import hashing
from textquarry.operators import duplicates, prefixes
from textquarry.operators.marks import marks


def _texts():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 100_000, rng.integers(20, 120))) for _ in range(60)]
    copies = [" ".join([*t.split()[:-2], "other", "end"]) for t in texts[:12]]
    return texts + copies


def test_prefixes_meet_whenever_sets_are_near():
    rng = np.random.default_rng(1)
    near = 0
    for _ in range(3000):
        a = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 60)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.integers(0, max(1, len(a) // 4) + 1) :], rng.integers(0, 1 << 62, rng.integers(0, 4)).astype(np.uint64)]))
        for t in (0.5, 0.8, 0.85, 1.0):
            both = len(np.intersect1d(a, b))
            if both and both / (len(a) + len(b) - both) >= t:
                near += 1
                met = len(np.intersect1d(prefixes.prefix(a, t), prefixes.prefix(b, t)))
                assert all(met >= prefixes.extra(prefixes.needed(len(x), t)) for x in (a, b))
    assert near > 1000


def test_only_rows_with_near_copies_are_exploded(spark):
    texts = _texts()
    rows = spark.createDataFrame(list(enumerate(texts)), "key long, norm string")
    found = {r["key"] for r in prefixes.able(rows, "key", "norm", hashing.shingle_sets(5), 0.8).collect()}
    sets = [set(zip(*(t.split()[i:] for i in range(5)), strict=False)) for t in texts]
    near = {i for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j and len(a & b) >= 0.8 * len(a | b)}
    assert near and near <= found and len(found) <= 24  # the sixty texts have nothing in common


def test_tiles_score_the_same_pairs(spark, monkeypatch):
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(_texts())], "id string, norm string")
    whole = {tuple(r) for r in duplicates.near_pairs(rows, 0.6).collect()}
    monkeypatch.setattr(duplicates, "TILE", 1)
    assert {tuple(r) for r in duplicates.near_pairs(rows, 0.6).collect()} == whole and len(whole) >= 10


def test_marks_hold_all_keys(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    held = marks(keys, "key")
    assert spark.range(5000).where(held.column(F.xxhash64("id"))).count() == 5000
    assert spark.range(10_000, 20_000).where(held.column(F.xxhash64("id"))).count() < 1000
    assert spark.createDataFrame([(None,)], "key long").where(held.column(F.col("key"))).count() == 0


def test_an_inner_text_has_its_container_s_anchors():
    rng = np.random.default_rng(2)
    text = "".join(map(chr, rng.integers(0x370, 0x3ff, 900)))
    for begin, size in ((0, 64), (301, 63), (500, 400), (836, 64)):
        assert set(hashing.window_minima(text[begin : begin + size], 32)) <= set(hashing.window_minima(text, 32))
    assert len(hashing.window_minima(text[:62], 32)) == 0 and len(hashing.window_minima(text[:63], 32)) == 1


def test_wide_rows_do_not_move_where_most_are_removed(spark):
    rng = np.random.default_rng(6)
    rows = spark.createDataFrame([(str(i), rng.bytes(1500).hex()) for i in range(2000)], "id string, norm string").repartition(4).cache()
    removed = rows.select("id", (F.col("id").cast("int") % 6 > 0).alias("removed")).cache()
    rows.count(), removed.count()
    moved = lambda: spark._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()  # noqa: E731, SLF001
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as where the ids are too many for a broadcast
    try:
        begin = moved()
        kept = duplicates.survivors(rows, removed)
        assert {r["id"] for r in kept.where("length(norm) = 3000").collect()} == {str(i) for i in range(0, 2000, 6)}
        assert moved() - begin < 500_000  # the removed rows have 5 MB
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        rows.unpersist(), removed.unpersist()


def test_a_large_group_of_near_copies_moves_its_sets_not_its_pairs(spark):
    rng = np.random.default_rng(8)
    words = [f"w{x}" for x in rng.integers(0, 100_000, 60)]
    texts = [" ".join([*words[: 20 + k % 2], f"other{k}", *words[20 + k % 2 :]]) for k in range(600)]
    rows = spark.createDataFrame([(f"{k:04d}", t) for k, t in enumerate(texts)], "id string, norm string")
    sets = [set(zip(*(t.split()[i:] for i in range(5)), strict=False)) for t in texts]
    near = {(f"{i:04d}", f"{j:04d}") for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and len(a & b) >= 0.8 * len(a | b)}
    store = spark._jsc.sc().statusStore()  # noqa: SLF001
    begin = store.executorList(False).apply(0).totalShuffleWrite()
    found = duplicates.marked_pairs(rows, 0.8).collect()
    moved = store.executorList(False).apply(0).totalShuffleWrite() - begin
    assert {(r["left_id"], r["right_id"]) for r in found} == near and len(near) > 100_000 and len(found) == len(near)
    assert moved < 1_000_000, moved
    assert sum(r["link"] for r in found) == len(texts) - 1  # a tree


def test_links_connect_what_the_pairs_connect_across_tiles(spark, monkeypatch):
    from textquarry.operators.components import connected_components

    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(_texts())], "id string, norm string")
    monkeypatch.setattr(duplicates, "TILE", 1)
    monkeypatch.setattr(duplicates, "AT_ONCE", 50)
    found = duplicates.marked_pairs(rows, 0.6).cache()
    groups = lambda t: {tuple(r) for r in connected_components(t, "left_id", "right_id").collect()}
    assert groups(found.where("link")) == groups(found) and found.count() >= 10
    found.unpersist()


def test_a_written_table_leaves_no_shuffle_behind(spark):
    import os

    from textquarry.storage import forget, written

    folder = lambda: sum(os.path.getsize(os.path.join(top, f)) for disk in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString() for top, _, names in os.walk(disk) for f in names)  # noqa: E731, SLF001
    begin = folder()
    out = written(spark.range(200_000).select(F.xxhash64("id").alias("key")).repartition(4, "key"), "keys")
    assert out.count() == 200_000 and folder() - begin < 500_000  # it shuffled 1.6 MB
    forget(out)
