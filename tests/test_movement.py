"""What queries write and move grows with the rows, not with pairs or whole texts."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from textquarry import queries


def test_groups_are_made_of_links_and_leakage_counts_all_pairs(spark, tmp_path):
    words = [f"w{x}" for x in np.random.default_rng(9).integers(0, 100_000, 60)]
    texts = [" ".join([*words[: 20 + k % 2], f"other{chr(97 + k % 26)}{chr(97 + k // 26)}", *words[20 + k % 2 :]]) for k in range(60)] + ["another text"]
    pq.write_table(pa.table({"doc_id": list(range(61)), "text": texts, "lang": ["en"] * 61, "source": ["s"] * 61}), tmp_path / "documents.parquet")
    assigned, links = queries._assigned(spark, str(tmp_path))  # noqa: SLF001
    assert sorted(r["count"] for r in assigned.groupBy("group_id").count().collect()) == [1, 60]
    assert links.count() == 59  # of 1770 pairs
    assert queries._assigned(spark, str(tmp_path), every=True)[1].count() == 1770  # noqa: SLF001


def test_whole_texts_do_not_move_to_prove_a_partition(spark):
    from textquarry.operators import accounting

    rng = np.random.default_rng(10)
    whole = spark.createDataFrame([(i, rng.bytes(1500).hex()) for i in range(1000)] + [(1000, None)], "id long, text string").repartition(4).cache()
    whole.count()
    moved = lambda: spark._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()  # noqa: E731, SLF001
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        begin = moved()
        parts = {"a": whole.where("id < 500"), "b": whole.where("id >= 500")}
        assert accounting.partition_faults(whole, parts, "id", "text").count() == 0
        assert moved() - begin < 500_000  # the texts have 3 MB
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        whole.unpersist()
