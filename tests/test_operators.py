import json
import os

import pytest
from pyspark.sql import functions as F

from textquarry.functions import risk
from textquarry.functions import text as T
from textquarry.operators import accounting, contamination, inventory, sampling
from textquarry.plans import adapters, catalog, scope, validation
from textquarry.sources import files
from textquarry.streaming import incremental


def test_normalisers_differ(spark):
    rows = spark.createDataFrame([("Straße  _Á_ x\r\ny ",)], "text string")
    got = rows.select(T.folded("text").alias("a"), T.word_folded("text").alias("b"), T.trimmed("text").alias("c")).first()
    assert (got["a"], got["b"], got["c"]) == ("strasse _á_ x y", "strasse á x y", "Straße  _Á_ x\ny")


def test_contamination_gates(spark):
    long = "the quick brown fox jumps over the lazy dog while seven old sailors sing about distant harbours and cold northern winds"
    items = [(1, long), (2, "tiny phrase"), (3, "one two three four five")]
    docs = [(1, f"before {long.upper()} after"), (2, "a tiny phrase, here"), (3, "untiny phrases"), (4, long), (5, " ".join(long.split()[:-2]) + " other words"), (6, None), (7, "")]
    found = contamination.hits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc"], r["item"], r["method"].split("_")[0]) for r in found.collect()}
    assert got == {(1, 1, "normalized"), (2, 2, "short"), (4, 1, "exact"), (4, 1, "normalized"), (5, 1, "five")}


def test_risk_codes_and_waivers(spark):
    rows = spark.createDataFrame([("mail a@b.gr password: x [TODO fill]",)], "text string")
    got = rows.select(risk.task_codes(F.col("text")).alias("a"), risk.task_codes(F.col("text"), F.array(F.lit("contact_or_financial_identifier"), F.lit("secret_pattern"))).alias("b")).first()
    assert got["a"] == ["contact_or_financial_identifier", "secret_pattern", "prompt_artifact_or_injection"] and got["b"] == got["a"][1:]


def test_ranges_break_on_status_and_length(spark):
    rows = [("f", i + 1, "ok" if i not in (4, 5) else "bad", "r", f"{i:064x}") for i in range(12)]
    got = inventory.ranges(spark.createDataFrame(rows, "path string, line long, status string, reason string, row_sha256 string"), most=4)
    assert sorted((r["first_record"], r["last_record"], r["status"]) for r in got.collect()) == [(1, 4, "ok"), (5, 6, "bad"), (7, 10, "ok"), (11, 12, "ok")]


def test_schema_variants_limit(spark):
    rows = [("f", 1, '{"a":1}'), ("f", 2, '{"a":"x"}'), ("f", 3, '{"a":2}'), ("f", 4, "[1]"), ("f", 5, None), ("f", 6, "{")]
    got = {r["fields"]: r["n"] for r in inventory.schema_variants(spark.createDataFrame(rows, "path string, line long, raw string"), most=1).collect()}
    assert got == {'{"a":"int"}': 2, None: 1}


def test_partition_faults_and_gate(spark):
    whole = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, h string")
    faults = accounting.partition_faults(whole, {"x": spark.createDataFrame([(1, "a"), (2, "z")], whole.schema), "y": spark.createDataFrame([(1, "a"), (9, "q")], whole.schema)}, "id", "h")
    assert sorted(map(tuple, faults.collect())) == [(1, "multiple"), (2, "changed"), (3, "missing"), (9, "foreign")]
    with pytest.raises(ValueError, match="1 changed"):
        accounting.require_partition(faults)


def test_round_robin_ignores_order_and_partitions(spark):
    rows = [(str(i), f"{i % 7:064x}", "s" if i < 8 else "t") for i in range(10)]
    df = spark.createDataFrame(rows, "id string, candidate_hash string, stratum string")
    one, two = (sorted(map(tuple, sampling.round_robin(d, 5, 3).collect())) for d in (df, df.orderBy(F.desc("id")).repartition(3)))
    assert one == two and len(one) == 5


GREEK = "Αυτή είναι μια πολύ καλή κριτική για το κατάστημα που με εξυπηρέτησε άψογα και γρήγορα."


def lines(spark, rows):
    return spark.createDataFrame([("f.jsonl", i + 1, f"{i:064x}", r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) for i, r in enumerate(rows)], "source_file string, source_line long, source_record_hash string, raw string")


def test_shop_adapter_reasons_and_validation(spark):
    adapter = adapters.BY_FAMILY["skroutz_shop_reviews_sentiment_analysis"]
    rows = [{"text": GREEK, "label": "Positive"}, {"text": GREEK, "label": "Neutral"}, {"text": "", "label": "Positive"}, {"text": 5, "label": "Positive"}, "{", {"text": GREEK + " a@b.gr", "label": "Negative"},
            {"text": "English only text that is long enough to pass every other rule here", "label": "Positive"}, {"text": "Καλό κατάστημα με ωραία", "label": "Positive"}, {"text": GREEK + " positive", "label": "Positive"}, {"text": "Καλο μαγαζι " * 9, "label": "Positive"}, {"text": GREEK * 400, "label": "Positive"}]
    made = adapters.decided(lines(spark, rows), adapter)
    got = [r["reason"] for r in made.orderBy("source_line").collect()]
    assert got == [None, "unsupported_sentiment_label", "missing_or_ambiguous_required_field", "missing_or_ambiguous_required_field", "malformed_json_or_encoding", "contact_or_financial_identifier",
                   "insufficient_greek_text", "insufficient_nontrivial_review_context", "source_annotation_label_leakage", "missing_greek_accents_requires_review", "whole_field_exceeds_limit_no_truncation"]
    first = made.where("status = 'accepted'").first()
    assert first["answer"] == "θετική" and first["prompt"].endswith(GREEK) and first["prompt"][first["span_start"] : first["span_end"]] == GREEK
    checked = validation.issues(validation.candidates(made, adapter), made, adapter)
    assert checked.first()["issues"] == ["license_unverified", "privacy_review_unresolved"]
    tampered = validation.candidates(made, adapter).withColumn("messages", F.transform("messages", lambda m: F.when(m["role"] == "assistant", m.withField("content", F.lit("αρνητική"))).otherwise(m)))
    assert "answer_not_exactly_grounded" in validation.issues(tampered, made, adapter).first()["issues"]


def test_other_adapters(spark):
    recipe = {"name": "Σούπα", "Ingredients": "νερό, ρύζι, λεμόνι, αυγό", "Instructions": "Βράζουμε καλά το ρύζι και προσθέτουμε το αυγό.", "Category": "Κυρίως Γεύμα"}
    news = {"id": "12", "url": "https://www.amna.gr/home/article/12", "title": "Τίτλος είδησης", "text": "Το άρθρο μιλά για την οικονομία της χώρας. " * 5, "category": "Οικονομία"}
    word = {"lemma": "άλφα", "pronunciation": "álfa", "text": "άλφα [álfa] το πρώτο γράμμα του αλφαβήτου [alfa]"}
    resource = {"title": "Μάθημα", "text": "Περιγραφή του μαθήματος για την άλγεβρα και τις ταυτότητες. " * 3, "url": "http://photodentro.edu.gr/aggregator/lo/photodentro-lor-8521-77", "classification": {"thematic_area": ["Μαθηματικά > Άλγεβρα"]}, "audience": {"educational_levels": ["γυμνάσιο"]}}
    for family, good, bad, reason in (
        ("recipes", recipe, recipe | {"Category": "Άλλο"}, "unsupported_recipe_category"), ("AMNA-press", news, news | {"id": "13"}, "article_id_url_mismatch_or_unknown_schema"),
        ("modern-greek-dictionary", word, word | {"lemma": "άλφ"}, "lemma_does_not_match_entry_headword"), ("Photodentro_all_documents", resource, resource | {"audience": {"educational_levels": ["γυμνάσιο", "γυμνάσιο"]}}, "duplicate_annotation_label"),
    ):
        got = adapters.decided(lines(spark, [good, bad]), adapters.BY_FAMILY[family]).orderBy("source_line").collect()
        assert [r["reason"] for r in got] == [None, reason], family
        assert got[0]["answer"]


def test_dispositions_cover_every_file(spark):
    rows = [("recipes/train.jsonl", "recipes", True, 5, "utf-8"), ("recipes/state.jsonl", "recipes", True, 5, "utf-8"), ("x/a.jsonl", "x", True, 1, "utf-8"), ("greek_training/a.jsonl", "recipes", True, 1, "utf-8")]
    table = spark.createDataFrame(rows, "relative_path string, family string, record_boundary_complete boolean, record_count long, encoding string")
    got = {r["relative_path"]: r["status"] for r in catalog.dispositions(table, catalog.plans(spark), roots=("greek_training",)).collect()}
    assert got == {"recipes/train.jsonl": "eligible", "recipes/state.jsonl": "blocked", "x/a.jsonl": "blocked", "greek_training/a.jsonl": "excluded"}


def test_raw_lines_keep_terminators_and_damage(spark, tmp_path):
    import hashlib

    import zstandard

    (tmp_path / "d").mkdir()
    data = b"\xef\xbb\xbf{\"a\":1}\r\n\n{bad\n\xff\n[1]\n" + b'{"b":"' + b"x" * 60 + b'"}\n{"c":2}'
    (tmp_path / "d/a.jsonl").write_bytes(data)
    whole = zstandard.ZstdCompressor(write_checksum=True).compress(b'{"a":1}\n') + zstandard.ZstdCompressor().compress(b'{"b":2}\n')
    (tmp_path / "d/b.jsonl.zst").write_bytes(whole)
    (tmp_path / "d/c.json").write_text("[1,2]")
    got = files.lines(spark, f"file://{tmp_path}", most=50).orderBy("path", "line").collect()
    assert [r["reason"] for r in got if r["path"] == "d/a.jsonl"] == ["license_not_verified_for_sft_redistribution", "blank_physical_row", "invalid_json", "invalid_utf8", "unsupported_non_object_schema", "record_exceeds_safe_parse_limit", "license_not_verified_for_sft_redistribution"]
    assert [r["raw_sha256"] for r in got if r["path"] == "d/a.jsonl"][0] == hashlib.sha256(data[:12]).hexdigest()
    assert [bytes(r["raw"]) for r in got if r["path"] == "d/b.jsonl.zst"] == [b'{"a":1}\n', b'{"b":2}\n']
    assert files.json_documents(spark, f"file://{tmp_path}").first()["json_array_elements"] == 2
    assert files.frame_fault(whole) is None and all(files.frame_fault(whole[:i]) for i in range(0, 17))
    assert files.frame_fault((0x184D2A50).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"abc") is None
    assert files.compression(spark, f"file://{tmp_path}").first()["fault"] is None
    assert files.frame_fault(whole[:4] + bytes([0x20, 5]) + (200_000 << 3 | 1).to_bytes(3, "little") + b"x" * 200_000) == "zstandard_block_exceeds_format_maximum"


def test_incremental_ingestion_reads_each_file_once(spark, tmp_path):
    source, target, journal = (str(tmp_path / x) for x in ("in", "out", "journal"))
    os.mkdir(source)
    open(f"{source}/a.jsonl", "w").write('{"a":1}\n\n[2]\n')
    incremental.ingest(spark, source, target, journal)
    open(f"{source}/b.jsonl", "w").write("{\n")
    incremental.ingest(spark, source, target, journal)
    assert sorted(r["status"] for r in spark.read.parquet(target).collect()) == ["accepted", "malformed", "malformed", "quarantined"]


def test_scope_chain():
    a = scope.Amendment(("x", "x/y"), "first")
    b = scope.Amendment(("z",), "second", a.sha256)
    assert scope.roots_of([a, b]) == ("x", "z")
    with pytest.raises(ValueError, match="broken"):
        scope.roots_of([b])


def test_review_faults(spark):
    rows = spark.sql("SELECT named_struct('decision', 'accept', 'scores', map('a',3,'b',3,'c',3,'d',3,'e',3,'f',3,'g',2), 'issue_codes', array(), 'proposed_revision', CAST(NULL AS STRING), 'short_reason', 'r') AS response")
    assert rows.select(validation.review_faults()).first()[0] == ["inconsistent_acceptance"]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert contamination.hits(empty, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert accounting.failure_rate(empty, F.lit(True)).first()["blocked"] is False


def test_record_faults(spark, tmp_path):
    from pyspark.sql.types import LongType, StructField, StructType

    from textquarry.sources import records

    rows = spark.sql("SELECT 'a' AS id, array(named_struct('role','system','content','s'), named_struct('role','user','content','u'), named_struct('role','assistant','content',' ')) AS messages, named_struct('source_file','f','source_record_hash','h') AS metadata")
    assert records.canonical_faults(rows).first()["fault"] == "empty_message"
    bad = [("a/b", "0" * 64, 1), ("../x", "0" * 64, 1), ("a//b", "0" * 64, 1), ("c", "zz", 1), ("d", "0" * 64, 0), ("e", records.EMPTY_SHA256, 0), ("a/b", "0" * 64, 1)]
    got = sorted((r["relative_path"], r["fault"]) for r in records.manifest_faults(spark.createDataFrame(bad, "relative_path string, sha256 string, size_bytes long")).collect())
    assert got == [("../x", "unsafe_path"), ("a//b", "unsafe_path"), ("a/b", "repeated_path"), ("c", "bad_sha256"), ("d", "bad_empty_file")]
    (tmp_path / "x.jsonl").write_text('{"a":1}\n{oops\n')
    good, wrong = records.audited_json(spark, str(tmp_path / "x.jsonl"), StructType([StructField("a", LongType())]))
    assert (good.count(), wrong.count()) == (1, 1)
    with pytest.raises(Exception, match="(?i)malformed"):
        records.strict_json(spark, str(tmp_path / "x.jsonl"), "a long").collect()
    with pytest.raises(ValueError, match="manifest"):
        records.require_none(records.manifest_faults(spark.createDataFrame(bad, "relative_path string, sha256 string, size_bytes long")), "manifest")


def test_screen_reads_all_depths(spark):
    from textquarry.operators import screen

    rows = [("a", json.dumps({"x": {"y": ["καλημέρα", {"z": "ab"}]}, "email": 5})), ("b", json.dumps({"t": "x" * 4096 + "α" * 100_000 + "x" * 4096})), ("c", "[1]"), ("d", "{"), ("e", None), ("f", '{"n":1}'), ("g", json.dumps({"deep": [["a@b.gr"]]}))]
    got = {r["key"]: r for r in screen.inspected(spark.createDataFrame(rows, "k string, raw string"), F.col("k"), F.col("raw")).collect()}
    assert (got["a"]["greek"], got["a"]["letters"], got["a"]["screen"]) == (8, 10, "positive") and (got["b"]["greek"], got["b"]["screen"]) == (0, "negative")
    assert [got[k]["status"] for k in "cdef"] == ["quarantined", "malformed", "malformed", "license_blocked"] and got["f"]["screen"] == "unknown" and got["c"]["screen"] is None
    assert got["g"]["email"] and not got["a"]["email"] and got["f"]["fields"] == '{"n":"int"}'
    assert screen.inspected(spark.createDataFrame([], "k string, raw string"), F.col("k"), F.col("raw")).count() == 0


def test_gates_and_revisions(spark):
    from textquarry.operators import audit

    bad, none = spark.range(2), spark.range(0)
    got = {r["gate"]: (r["passed"], r["faults"]) for r in audit.release_gates(spark, {"a": none}, {"split_leakage": bad}).collect()}
    assert len(got) == 15 and got["split_leakage"] == (False, 2) and got["counts_reconciled"] == (True, 0) and got["release_auditor"][0] is False
    assert not any(r["passed"] for r in audit.release_gates(spark, {"a": bad}, {}).collect())
    row = spark.range(1).select(F.struct(F.lit("p").alias("split"), F.lit(1).alias("n")).alias("metadata"))
    assert row.select(audit.with_fields("metadata", split=F.lit("train")).alias("m")).first()["m"]["split"] == "train"


def test_large_files_are_streams_and_changed_files_raise(spark, tmp_path):
    import hashlib

    line = b'{"a":"' + b"y" * 999 + b'"}\n'
    (tmp_path / "in put").mkdir()
    (tmp_path / "in put/big.jsonl").write_bytes(line * 12_000 + b"{")
    (tmp_path / "in put/b.bin").write_bytes(b"\x00")
    root = f"file://{tmp_path}"
    got = files.lines(spark, root).groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in got} == {"license_blocked": 12_000, "malformed": 1}
    now = files.hashed(spark, root)
    seen = {r["relative_path"]: (r["size_bytes"], r["sha256"]) for r in now.collect()}
    assert seen["in put/big.jsonl"] == (len(line) * 12_000 + 1, hashlib.sha256(line * 12_000 + b"{").hexdigest()) and seen["in put/b.bin"][0] == 1
    before = spark.createDataFrame([("in put/b.bin", 1, seen["in put/b.bin"][1])], "relative_path string, size_bytes long, sha256 string")
    assert [r["relative_path"] for r in files.new_files(now, before).collect()] == ["in put/big.jsonl"]
    with pytest.raises(ValueError, match="changed"):
        files.new_files(now, before.withColumn("sha256", F.lit("0")))


def test_tables_need_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from textquarry import storage

    class Context:
        master, applicationId = "yarn", "a"

    class Conf:
        get = staticmethod(lambda k, d=None: d)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session)
    path = storage.written(spark.range(3), "some")._written_path
    assert spark.sparkContext.applicationId in path and spark.read.parquet(path).count() == 3


def test_baselines_shards_and_reports(spark, tmp_path):
    import hashlib

    from textquarry.sources import records

    data = "".join(json.dumps({"relative_path": p, "size_bytes": 1, "sha256": "0" * 64}) + "\n" for p in ("b", "a")).encode()
    (tmp_path / "m").mkdir()
    (tmp_path / "m/manifest.jsonl").write_bytes(data)
    rows = records.baseline(spark, f"file://{tmp_path}/m", hashlib.sha256(data).hexdigest())
    assert [r["relative_path"] for r in records.merged_shards([rows.where("relative_path = 'b'"), rows.where("relative_path = 'a'")], "relative_path").collect()] == ["a", "b"]
    with pytest.raises(ValueError, match="checksum"):
        records.baseline(spark, f"file://{tmp_path}/m", "0" * 64)
    with pytest.raises(ValueError, match="repeated"):
        records.merged_shards([rows, rows], "relative_path")
    markdown, text = records.report(spark.sql("SELECT 'a|b' AS x, 1 AS n"), "Counts")
    assert markdown.splitlines()[-1] == "| a\\|b | 1 |" and json.loads(text)["rows"] == [{"x": "a|b", "n": 1}]
    with pytest.raises(ValueError, match="no report"):
        records.report(spark.range(3), "x", most=2)
    ledger = inventory.exclusion_ledger(spark.createDataFrame([("x/y/a", 1), ("x/b", 2), ("z", 4)], "relative_path string, size_bytes long"), ("x", "x/y"))
    assert sorted(map(tuple, ledger.collect())) == [("x", 1, 2), ("x/y", 1, 1)]
