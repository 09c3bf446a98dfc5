"""The pipeline's stages, each against brute force on its own input, awkward rows included."""

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import drawn_in_turn, words
from textquarry.llm import packing, pii, quality

SF = "/root/testdata/sf0.001"


def key(row):
    return tuple(str(row[c]) for c in ("doc_id", "text", "source", "lang"))


@pytest.fixture(scope="module")
def stages(spark):
    """Name -> input and output rows of each stage."""
    base = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id <= 60")
    some = "a b c d e f g h i j, and quite some more words of a calm and ordinary text."
    odd = [(None, some, "en", "odd", 0), (None, some, "en", "odd", 0), (1000, None, "en", None, 0), (1001, "", "en", "odd", 0), (1002, "Mr Smith wrote to ann.lee@corp.org about the weather of the coast, and Ann replied at length.", "en", None, 7), (1003, "A calm sentence on harbours and coasts, which goes on. " * 2000, "en", "long", 0)]
    docs = base.union(spark.createDataFrame(odd, base.schema)).withColumns({c: F.lit(1) for c in ("root", "block", "n_entities", "size")}).cache()
    out, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF).cache()
        out[name] = (docs, docs.collect(), made.collect())
        assert name == corpus_pipeline.STAGES[-1][0] or made.columns == columns, name
        docs = made
    return out


def test_classifier_keeps_what_its_model_says(spark, stages):
    docs, before, after = stages["quality classifier"]
    model = quality.fit(docs)
    expected = [r for r in before if quality.probability(r["text"], model["w"], model["b"], model["good"]) >= quality.KEEP_FROM]
    assert sorted(map(key, after)) == sorted(map(key, expected)) and all(r["text"] for r in after) and len(after) > 30


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages["n-gram Jaccard join"]
    sets = []
    for r in before:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(r["text"])]
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(before)))
    for _ in before:
        for a in range(len(before)):
            for b in range(a):
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        if all(root[root[a]] == root[a] for a in range(len(before))):
            break
    groups = {}
    for a, r in enumerate(before):
        groups.setdefault(root[a] if sets[a] else ("none", a), []).append((r["doc_id"] is None, r["doc_id"] or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in after) == sorted(min(g) for g in groups.values()) and set(map(key, after)) <= set(map(key, before))


def test_personal_data_is_drawn_in_turn(stages):
    _, before, after = stages["PII surrogates"]
    found = [pii.detect(r["text"]) for r in before]
    kinds = {}
    for f in found:  # a name under titles of two kinds is one entity
        for _, _, kind, value in f:
            at = (kind.split("-")[0], value)
            kinds[at] = min(kinds.get(at, kind), kind)
    cores = drawn_in_turn({(kind, value) for (_, value), kind in kinds.items()}, corpus_pipeline.TRIAL_KEY)
    expected = []
    for r, f in zip(before, found, strict=True):
        text, at = [], 0
        for start, stop, kind, value in f:
            text += [r["text"][at:start], pii.written_like(kind, r["text"][start:stop], cores[kinds[kind.split("-")[0], value], value])]
            at = stop
        expected.append(r.asDict() | {"text": "".join([*text, r["text"][at:]])})
    assert sorted(map(key, after)) == sorted(map(key, expected)) and any(found)
    assert all(r["n_entities"] == 1 for r in after)


def test_sources_reach_their_targets(stages):
    _, before, after = stages["source mix"]
    sizes = Counter()
    for r in before:
        sizes[r["source"]] += len(words(r["text"]))
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight, fixed = {s: 1 + i % 3 for i, s in enumerate(order)}, {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = sum(sizes.values()) - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: 3.0 * sizes[s] for s in free if share[s] >= 3 * sizes[s]}
        if not over:
            break
        fixed |= over
    got = Counter()
    for r in after:
        got[r["source"]] += len(words(r["text"]))
    assert {s: got[s] for s in order} == {s: int(np.floor({**share, **fixed}[s] + 0.5)) for s in order}
    texts = {r["doc_id"]: " ".join(words(r["text"])) for r in before}
    times = Counter()
    for r in after:
        assert texts[r["doc_id"]].startswith(" ".join(words(r["text"])))
        times[r["doc_id"]] += 1
    assert max(times.values()) <= 3


def test_pieces_hold_every_id_once(stages):
    from tokenizers import Tokenizer

    _, before, pieces = stages["packing"]
    t, expected = Tokenizer.from_file(packing.default_tokenizer()), Counter()
    for r in before:
        ids = np.array([*t.encode(r["text"], add_special_tokens=False).ids, 1], dtype="<u4").tobytes()
        for k in range(0, len(ids), 4 * 2048):
            expected[r["doc_id"], k // 4, len(ids[k : k + 8192]) // 4, zlib.crc32(ids[k : k + 8192])] += 1
    assert Counter((p["doc_id"], p["start"], p["length"], p["ids_crc32"]) for p in pieces) == expected
    windows = {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for w in windows.values():
        w.sort()
        assert [o for o, _ in w] == [sum(n for _, n in w[:k]) for k in range(len(w))] and sum(n for _, n in w) <= 2048


def test_stages_accept_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
