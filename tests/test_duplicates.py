import random

from pyspark.sql import functions as F

from textquarry.functions import text as T
from textquarry.operators import duplicates, splits
from textquarry.operators.components import connected_components

SCHEMA = "doc_id string, text string"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_equal_texts_keep_the_smallest_id_as_text(spark):
    rows = duplicates.records(spark.createDataFrame([("10", "Straße  A"), ("9", "STRASSE a"), ("2", "strasse a"), ("3", None), ("4", "")], SCHEMA))
    got = {r["id"]: (r["keeper_id"], r["removed"]) for r in duplicates.exact(rows).collect()}
    assert got == {"10": ("10", False), "9": ("10", True), "2": ("10", True), "3": ("3", False), "4": ("3", True)}


def test_repeated_ids_raise(spark):
    import pytest

    with pytest.raises(ValueError, match="repeated"):
        duplicates.records(spark.createDataFrame([("1", "a"), ("1", "b")], SCHEMA))


def test_contained_texts_match_brute_force(spark):
    rng = random.Random(1)
    base = [words(rng, 200) for _ in range(6)]
    texts = list(base)
    for b in base:
        for _ in range(3):
            i = rng.randrange(0, 300)
            texts.append(b[i : i + rng.choice([200, 239, 240, 241, 400])])
    texts.append(texts[7][10:260])
    rows = duplicates.survivors(r := duplicates.records(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], SCHEMA)), duplicates.exact(r))
    norm = {x["id"]: x["norm"] for x in rows.collect()}
    order = sorted(norm, key=lambda i: (-len(norm[i]), i))
    kept, expected = [], {}
    for i in order:
        hits = [k for k in kept if len(norm[i]) >= 240 and len(norm[k]) >= 240 and norm[i] in norm[k]]
        if hits:
            expected[i] = min(hits)
        else:
            kept.append(i)
    assert {x["id"]: x["keeper_id"] for x in duplicates.contained(rows).collect()} == expected and expected


def test_sentence_subsets(spark):
    data = [("a", "One is here now. Two is here now. Three is here now. Four closes the long text."), ("b", "Two is here now. One is here now. " + "One is here now. " * 3), ("c", "Unique sentence that is short.")]
    rows = duplicates.records(spark.createDataFrame(data, SCHEMA), text=F.col("text")).withColumn("sentences", T.sentences(F.col("text")))
    got = {x["id"]: x["keeper_id"] for x in duplicates.sentence_subsets(rows, least=20).collect()}
    assert got == {}, "the longer text with repeated sentences is not removed by a shorter superset"
    rows = rows.withColumn("n", F.when(F.col("id") == "b", 30).otherwise(F.col("n")).cast("long"))
    assert {x["id"]: x["keeper_id"] for x in duplicates.sentence_subsets(rows, least=20).collect()} == {"b": "a"}


def test_near_pairs_match_brute_force(spark):
    rng = random.Random(24)
    texts = [words(rng, 60, 40) for _ in range(8)]
    for t in texts[:6]:
        parts = t.split()
        parts[rng.randrange(len(parts))] = "changed"
        texts.append(" ".join(parts))
    texts += ["too short", "", texts[0] + " and more at the end"]
    rows = duplicates.records(spark.createDataFrame([(f"{i:02d}", t) for i, t in enumerate(texts)], SCHEMA))
    sets = {f"{i:02d}": {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in enumerate(texts)}
    expected = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7}
    assert {(x["left_id"], x["right_id"]) for x in duplicates.near_pairs(rows, 0.7).collect()} == expected and expected


def test_first_come_equals_sequential_removal(spark):
    rng = random.Random(5)
    for _ in range(3):
        n = {f"{i}": rng.randrange(3) for i in range(14)}
        edges = {tuple(sorted(rng.sample(sorted(n), 2))) for _ in range(16)}
        kept, gone = [], {}
        for i in sorted(n, key=lambda i: (-n[i], i)):
            hits = [k for k in kept if tuple(sorted((i, k))) in edges]
            if hits:
                gone[i] = min(hits)
            else:
                kept.append(i)
        got = duplicates.first_come(spark.createDataFrame(list(n.items()), "id string, n int"), spark.createDataFrame(list(edges), "left_id string, right_id string"))
        assert {x["id"]: x["keeper_id"] for x in got.where("removed").collect()} == gone


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, k) for k in range(101, 120)] + [(7, 7), (None, 3), (200, 201)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 120), 100), 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_caps_drop_whole_groups_and_later_ones_may_fit(spark):
    counts = spark.createDataFrame([("a", "x", 3), ("b", "x", 4), ("b", "y", 1), ("c", "x", 2), ("d", "z", 9), ("e", "y", 1)], "group_id string, domain string, n long")
    got = {r["group_id"]: r["kept"] for r in splits.capped_groups(counts, {"x": 5, "y": 1}).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": True, "e": True}


def test_leakage_measures(spark):
    import pytest

    rows = spark.createDataFrame([("1", "g", "train", "h"), ("2", "g", "test", "h"), ("3", "k", "train", "i")], "id string, group_id string, split string, h string")
    found = splits.leakage(rows, spark.createDataFrame([("1", "2")], "left_id string, right_id string"))
    assert {r["measure"]: r["n"] for r in found.collect()} == {"cross_split_near_pairs": 1, "exact_duplicates": 1, "groups_across_splits": 1}
    with pytest.raises(ValueError, match="leakage"):
        splits.require_no_leakage(found)


def test_signatures_match_plain_arithmetic():
    import numpy as np

    from textquarry.functions import hashing

    rng = random.Random(2)
    x = np.array([rng.randrange(1 << 64) for _ in range(50)] + [0, 1, hashing.PRIME, hashing.PRIME - 1, (1 << 64) - 1], dtype=np.uint64)
    perms = [*hashing.permutations(6, 1729), (hashing.PRIME - 1, hashing.PRIME - 1), (1, 0)]
    assert hashing.signature(x, perms) == [min((a * (v % hashing.PRIME) + b) % hashing.PRIME for v in map(int, x)) for a, b in perms]


def test_bands_find_near_copies_with_the_same_facts(spark):
    rng = random.Random(3)
    base = words(rng, 300)
    other = base.replace(base.split()[150], "changed", 1)
    texts = {"a": base, "b": other, "c": base + " end", "d": words(rng, 300), "e": base + " 17", "f": "short " * 5, "g": ""}
    rows = duplicates.records(spark.createDataFrame(list(texts.items()), SCHEMA)).withColumn("numbers", T.numbers(F.col("norm")))
    pairs = duplicates.banded_pairs(rows, 0.9)
    every = {(r["left_id"], r["right_id"]) for r in duplicates.near_pairs(rows.where("n >= 240"), 0.9).collect()}
    found = {(r["left_id"], r["right_id"]) for r in pairs.collect()}
    assert {("a", "c"), ("a", "e")} <= found <= every
    same = {(r["left_id"], r["right_id"]) for r in duplicates.same_facts(pairs, rows, ["numbers"]).collect()}
    assert same == {("a", "c")}  # digits inside words are numbers too


def test_source_text_takes_the_span(spark):
    import pytest

    make = "SELECT array(named_struct('role','system','content','s'), named_struct('role','user','content','before evidence'), named_struct('role','assistant','content','answer')) AS m, "
    span = "named_struct('message_index', {}, 'start', {}, 'end', {})"
    get = lambda s: spark.sql(make + s + " AS span").select(T.source_text(F.col("m"), F.col("span"))).first()[0]
    assert get(span.format(1, 7, 15)) == "evidence\nanswer" and get(f"CAST(NULL AS {'struct<message_index:int,start:int,end:int>'})") == "before evidence\nanswer"
    with pytest.raises(Exception, match="span"):
        get(span.format(1, 7, 99))
