"""The registered queries of the engine's own operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.functions import risk
from textquarry.functions import text as T
from textquarry.operators import accounting, audit, contamination, duplicates, inventory, sampling, screen, splits
from textquarry.plans import adapters, labelled, samples, validation
from textquarry.sources import records
from textquarry.sql import ORACLES
from textquarry.storage import forget, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _records(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.records(table(spark, d, "documents"), lang=F.col("lang"), source=F.col("source"))


def _distinct(spark: SparkSession, d: str) -> DataFrame:
    rows = _records(spark, d)
    return duplicates.survivors(rows, duplicates.exact(rows))


@query
def f_text_profile(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    words = T.tokens(F.lower(t))
    return table(spark, d, "documents").select(
        "doc_id", F.length(t).cast("long").alias("n"), F.size(words).cast("long").alias("n_words"), F.size(T.shingles(words, 5)).cast("long").alias("n_shingles"),
        F.size(T.sentences(t)).cast("long").alias("n_sentences"), F.array_join(T.numbers(t), " ").alias("numbers"), T.slug(t).alias("slug"),
    )


@query
def f_script_counts(spark: SparkSession, d: str) -> DataFrame:
    c = T.greek_counts(F.coalesce("text", F.lit("")))
    return table(spark, d, "documents").select("doc_id", c["alphabetic_characters"].cast("long").alias("letters"), c["greek_characters"].cast("long").alias("greek"), c["greek_ratio"].alias("greek_ratio"), c["accented_characters"].cast("long").alias("accented"))


@query
def r_risk_flags(spark: SparkSession, d: str) -> DataFrame:
    flags = risk.inventory_flags(F.coalesce("text", F.lit("")))
    return table(spark, d, "documents").select("doc_id", *[v.alias(k) for k, v in flags.items()])


@query
def a4_risk_counters(spark: SparkSession, d: str) -> DataFrame:
    return risk.counters(table(spark, d, "documents"), F.coalesce("text", F.lit("")), "source")


@query
def d1_exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.exact(_records(spark, d))


@query
def d2_contained_texts(spark: SparkSession, d: str) -> DataFrame:
    """Documents and benchmark items that stand inside another of them, from 64 characters on."""
    both = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "text").union(table(spark, d, "benchmark").select(F.concat(F.lit("item"), "item_id"), "text"))
    rows = duplicates.records(both, "id")
    return duplicates.contained(duplicates.survivors(rows, duplicates.exact(rows)), least=64)


@query
def d3_near_removal(spark: SparkSession, d: str) -> DataFrame:
    """Greedy removal of near copies with the same facts: the language for task and answer, and the numbers in order."""
    rows = _distinct(spark, d).where("n >= 240").withColumn("numbers", T.numbers(F.col("norm")))
    pairs = duplicates.same_facts(duplicates.near_pairs(rows, 0.8), rows, ["lang", "numbers"])
    return duplicates.first_come(rows, pairs).where("removed").select("id", "keeper_id")


@query
def j11_banded_pairs(spark: SparkSession, d: str) -> DataFrame:
    """What the MinHash bands find of the near pairs from 240 characters on; all pairs of similarity 1 are among them."""
    return duplicates.banded_pairs(_distinct(spark, d), 0.8).withColumn("similarity", F.round("similarity", 6))


@query
def d4_sentence_subsets(spark: SparkSession, d: str) -> DataFrame:
    """Documents, and each again with its sentences in order of code points: the shorter of the two is a subset."""
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    again = rows.select(F.concat("id", F.lit("/sorted")).alias("id"), F.array_join(T.sentences(F.col("text")), "\n").alias("text"))
    rows = duplicates.records(rows.union(again), "id", text=F.col("text")).withColumn("sentences", T.sentences(F.col("text")))
    return duplicates.sentence_subsets(duplicates.survivors(rows, duplicates.exact(rows)))


@query
def j14_near_pairs(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.near_pairs(_distinct(spark, d), 0.8).withColumn("similarity", F.round("similarity", 6))


@query
def j5_contamination_hits(spark: SparkSession, d: str) -> DataFrame:
    found = contamination.hits(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "method", F.round("overlap", 6).alias("overlap"))


@query
def a11_contamination_by_source(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    marked = contamination.partition(docs.select("doc_id", "source"), contamination.hits(docs, table(spark, d, "benchmark")))
    return marked.groupBy("source").agg(F.count_if(F.col("status") == "clean").alias("clean"), F.count_if(F.col("status") == "contaminated").alias("contaminated"), F.sum("n_hits").alias("hits"))


def _assigned(spark: SparkSession, d: str, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows with their groups and splits; and the near pairs that connect the groups, or with ``every`` all near pairs."""
    rows = _records(spark, d)
    found = duplicates.marked_pairs(duplicates.survivors(rows, duplicates.exact(rows)), 0.8).select("left_id", "right_id", "link")
    pairs = written(found if every else found.where("link"), "pairs")
    declared = F.concat_ws("/", "source", F.sha2(F.regexp_replace("norm", "[0-9]+", ""), 256))  # texts that differ in numbers only
    edges = splits.key_edges(rows, F.col("h")).union(splits.key_edges(rows, declared)).union(pairs.where("link").select("left_id", "right_id"))
    grouped = rows.drop("norm").join(splits.groups(rows, edges), "id")
    assigned = written(grouped.withColumn("split", splits.split_of(F.col("group_id"))), "assigned")
    forget(rows)
    return assigned, pairs


@query
def d8_grouped_split(spark: SparkSession, d: str) -> DataFrame:
    return _assigned(spark, d)[0].select("id", "group_id", "split")


@query
def a18_split_counts(spark: SparkSession, d: str) -> DataFrame:
    return _assigned(spark, d)[0].groupBy("split", "lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("characters"))


@query
def d10_leakage(spark: SparkSession, d: str) -> DataFrame:
    assigned, pairs = _assigned(spark, d, every=True)
    return splits.leakage(assigned, pairs)


@query
def d9_capped_groups(spark: SparkSession, d: str) -> DataFrame:
    counts = _assigned(spark, d)[0].groupBy("group_id", F.col("lang").alias("domain")).agg(F.count(F.lit(1)).alias("n"))
    return splits.capped_groups(counts, {"en": 400, "de": 100})


@query
def d13_removal_rates(spark: SparkSession, d: str) -> DataFrame:
    rows = _records(spark, d)
    return splits.removal_rates(rows, duplicates.exact(rows), "lang", protected=("de",)).withColumn("rate", F.round("rate", 6))


@query
def d12_fertility(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    rows = table(spark, d, "documents").select(F.size(T.tokens(t)).cast("long").alias("w"), F.size(F.regexp_extract_all(t, F.lit(r"[\p{L}\p{N}_]{1,4}"), F.lit(0))).cast("long").alias("k"))
    return splits.fertility(rows, "w", "k").withColumn("mean_fertility", F.round("mean_fertility", 6))


@query
def w1_status_ranges(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("user_id").cast("string").alias("path"), F.row_number().over(inventory.by("user_id", "event_id")).cast("long").alias("line"), F.col("event_type").alias("status"), F.lit("-").alias("reason"), F.sha2(F.col("event_id").cast("string"), 256).alias("row_sha256"))
    return inventory.ranges(rows, most=3)


@query
def a2_rollup_by_family(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.col("source").alias("family"), F.lit(1).cast("long").alias("records"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes"))
    return inventory.rollup(rows)


@query
def a3_schema_variants(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("event_type").alias("path"), F.col("event_id").alias("line"), F.col("props").alias("raw"))
    return inventory.schema_variants(rows, most=256)


@query
def a6_hash_chains(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("path"), F.col("turn").alias("line"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("row_sha256"))
    return inventory.hash_chain(rows, "path")


@query
def p1_path_classes(spark: SparkSession, d: str) -> DataFrame:
    path = F.regexp_replace(F.split_part("url", F.lit("://"), F.lit(2)), "[?#].*$", "")
    rows = table(spark, d, "pages").select("page_id", path.alias("path"))
    return rows.select("page_id", inventory.family("path", deep=("blog.ththan.example.net",)).alias("family"), inventory.artifact("path").alias("artifact"), inventory.kind("path", F.lit("other")).alias("kind"), inventory.excluded("path", ("spam-farm.example.org", "www.cheap-pills.example.com")).alias("excluded"))


@query
def c11_exclusion_ledger(spark: SparkSession, d: str) -> DataFrame:
    return inventory.exclusion_ledger(_files(spark, d), ("src0", "src1"))


@query
def u8_distinct_questions(spark: SparkSession, d: str) -> DataFrame:
    return records.distinct_questions(table(spark, d, "benchmark").union(table(spark, d, "documents").select("doc_id", "text")), "text")


@query
def j28_content_groups(spark: SparkSession, d: str) -> DataFrame:
    return inventory.content_groups(_files(spark, d))


@query
def a13_breakdown(spark: SparkSession, d: str) -> DataFrame:
    return inventory.breakdown(_files(spark, d))


def _files(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select(
        F.format_string("%s/%08d.txt", F.col("source"), F.col("doc_id")).alias("relative_path"), F.sha2(t, 256).alias("sha256"), F.octet_length(t).cast("long").alias("size_bytes"),
        F.col("source").alias("family"), F.col("lang").alias("format"), F.when(F.length(t) < 500, "short").otherwise("long").alias("kind"),
    )


@query
def j18_drift(spark: SparkSession, d: str) -> DataFrame:
    """Two states of the documents: the one lacks French, the other Spanish, and German is changed between them."""
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"), F.coalesce("lang", F.lit("")).alias("lang"))
    new = rows.where("lang <> 'es'").withColumn("sha256", F.when(F.col("lang") == "de", F.sha2("sha256", 256)).otherwise(F.col("sha256")))
    return accounting.drift(rows.where("lang <> 'fr'"), new, "path", "sha256")


def _ledger(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All orders; those kept, some of them changed, with one foreign row; those gone, some of them kept as well; medium open ones are in neither."""
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.sha2(F.concat_ws("|", "o_custkey", "o_orderpriority"), 256).alias("h"), "o_orderstatus", "o_orderpriority")
    kept = rows.where("o_orderstatus <> 'F' and not (o_orderstatus = 'O' and o_orderpriority = '3-MEDIUM')").withColumn("h", F.when(F.col("o_orderpriority") == "5-LOW", F.lit("changed")).otherwise(F.col("h"))).drop("o_orderpriority")
    gone = rows.where("o_orderstatus = 'F' or (o_orderstatus = 'P' and o_orderpriority = '1-URGENT')").drop("o_orderpriority")
    return rows.drop("o_orderpriority"), kept.union(spark.range(1).select((-F.col("id") - 1).alias("id"), F.lit("x").alias("h"), F.lit("O").alias("s"))), gone


@query
def u3_partition_proof(spark: SparkSession, d: str) -> DataFrame:
    whole, kept, gone = _ledger(spark, d)
    return accounting.partition_faults(whole, {"kept": kept, "gone": gone}, "id", "h")


@query
def j26_terminal_outcomes(spark: SparkSession, d: str) -> DataFrame:
    _, kept, gone = _ledger(spark, d)
    return accounting.outcomes({"kept": kept, "gone": gone}, "id", "o_orderstatus")


@query
def j22_coverage(spark: SparkSession, d: str) -> DataFrame:
    declared = table(spark, d, "orders").select(F.col("o_orderkey").alias("path"), (F.col("o_orderkey") % 7 + 1).alias("records"))
    return accounting.coverage(declared, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("path")), "path", "records")


@query
def w4_contiguity(spark: SparkSession, d: str) -> DataFrame:
    """Two records a line item; returned ones reach one further, accepted ones end one short."""
    last = 2 * F.col("l_linenumber") + F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", -1).otherwise(0)
    spans = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("path"), (2 * F.col("l_linenumber") - 1).cast("long").alias("first_record"), last.cast("long").alias("last_record"))
    return accounting.range_faults(spans, table(spark, d, "orders").select(F.col("o_orderkey").alias("path"), F.lit(8).cast("long").alias("record_count")))


@query
def j3_paired_evidence(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("value"))
    right = table(spark, d, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") * 1000).cast("long").alias("value"))
    return accounting.paired(left, right, "id", "value").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query
def a22_gates(spark: SparkSession, d: str) -> DataFrame:
    whole, kept, gone = _ledger(spark, d)
    faults = accounting.partition_faults(whole, {"kept": kept, "gone": gone}, "id", "h")
    return accounting.gates(spark, {"partition_is_exact": faults, "no_negative_price": table(spark, d, "orders").where("o_totalprice < 0")})


@query
def a10_failure_gate(spark: SparkSession, d: str) -> DataFrame:
    return accounting.failure_rate(table(spark, d, "labels"), F.col("quality") == 1, most=0.01).withColumn("rate", F.round("rate", 6))


@query
def w6_stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("candidate_hash"), F.concat_ws("|", "source", "lang").alias("stratum"))
    return sampling.round_robin(rows, 60, seed=1729)


@query
def a19_volume_estimate(spark: SparkSession, d: str) -> DataFrame:
    return sampling.volume(table(spark, d, "conversations"), F.coalesce("text", F.lit("")))


@query
def a20_agreement(spark: SparkSession, d: str) -> DataFrame:
    gold = table(spark, d, "labels").where("toxic = 0").select(F.col("doc_id").alias("id"), F.col("quality").cast("string").alias("decision"))
    reviews = table(spark, d, "documents").where("lang <> 'es'").select(F.col("doc_id").alias("id"), F.when(F.length("text") > 100, "1").otherwise("0").alias("decision"))
    return sampling.agreement(gold, reviews, least=0.9).withColumn("agreement", F.round("agreement", 6))


def _annotated(spark: SparkSession, d: str) -> DataFrame:
    """All documents, with their labels where there are any."""
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")


@query
def p10_rule_cascade(spark: SparkSession, d: str) -> DataFrame:
    return labelled.decided(_annotated(spark, d)).select("doc_id", "status", "reason", "prompt_sha256", "answer", "group_id")


@query
def p13_validation_issues(spark: SparkSession, d: str) -> DataFrame:
    return labelled.issues(labelled.decided(_annotated(spark, d))).select("doc_id", F.array_join("issues", ";").alias("issues"))


@query
def a9_issue_histogram(spark: SparkSession, d: str) -> DataFrame:
    made = labelled.issues(labelled.decided(_annotated(spark, d)))
    return made.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@query
def m6_canonical_messages(spark: SparkSession, d: str) -> DataFrame:
    return labelled.canonical_messages(table(spark, d, "conversations"))


def _run(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders as the records of a run: outcomes, the candidates made of them, and the rejections written down."""
    o = table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("source"), F.col("o_orderkey").alias("line"), F.when(F.col("o_orderstatus") == "F", "accepted").when(F.col("o_orderstatus") == "O", "rejected").otherwise("malformed").alias("status"),
        F.col("o_orderpriority").alias("reason"), F.concat(F.lit("c"), "o_orderkey").alias("id"), F.sha2("o_orderpriority", 256).alias("row_hash"),
    )
    candidates = o.where("(status = 'accepted' and reason <> '3-MEDIUM') or (status = 'rejected' and reason = '1-URGENT')").withColumn("row_hash", F.when(F.col("reason") == "2-HIGH", F.lit("other")).otherwise(F.col("row_hash")))
    rejected = o.where("(status <> 'accepted' and reason <> '5-LOW') or (status = 'accepted' and reason = '4-NOT SPECIFIED')").withColumn("reason", F.when(F.col("reason") == "2-HIGH", F.lit("x")).otherwise(F.col("reason")))
    return o, candidates.select("id", "source", "line", "row_hash"), rejected.select("source", "line", "status", "reason", "row_hash")


@query
def j23_record_faults(spark: SparkSession, d: str) -> DataFrame:
    return audit.record_faults(*_run(spark, d))


@query
def j24_decision_faults(spark: SparkSession, d: str) -> DataFrame:
    """Parts as candidates; the decision follows the brand, the stage the size, and the type stands for reasons."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_brand", "p_type", "p_size")
    decisions = p.where("p_brand <> 'Brand#11'").select(
        "id", F.when(F.col("p_size") > 25, "accepted").when(F.col("p_size") > 5, "quarantined").otherwise("lost").alias("status"), F.when(F.col("p_size") > 40, "[]").otherwise(F.col("p_type")).alias("reasons"), F.lit(True).alias("schema_passed"), (F.col("p_brand") != "Brand#12").alias("content_passed")
    )
    members = p.select("id", F.when(F.col("p_size") > 20, "validated").otherwise("quarantine").alias("stage"), F.when(F.col("p_brand") == "Brand#13", "other").otherwise(F.col("p_type")).alias("reason"))
    return audit.decision_faults(p.where("p_size < 50").select("id"), decisions, members)


@query
def j25_missing_keepers(spark: SparkSession, d: str) -> DataFrame:
    removed = table(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.col("l_partkey").alias("keeper_id"))
    return audit.missing_keepers(removed, table(spark, d, "part").where("p_size > 25").select(F.col("p_partkey").alias("id")))


@query
def j29_lineage_faults(spark: SparkSession, d: str) -> DataFrame:
    made = table(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.col("l_orderkey").alias("source"), F.col("l_linenumber").alias("line"), F.lit("h").alias("file_hash"), F.col("l_linestatus").alias("family"))
    return audit.lineage_faults(made, table(spark, d, "orders").select(F.col("o_orderkey").alias("path"), F.lit("h").alias("sha256"), F.lit(4).alias("records"), F.col("o_orderstatus").alias("family")))


@query
def a21_flow_equations(spark: SparkSession, d: str) -> DataFrame:
    n = lambda c, v: F.count_if(F.col(c) == v).alias(v)
    counts = table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("items"), n("l_returnflag", "R"), n("l_returnflag", "A"), n("l_returnflag", "N"), n("l_linestatus", "F"), n("l_linestatus", "O"))
    return audit.flow_faults(counts, {"by_status": ("items", ["F", "O"]), "by_flag": ("items", ["R", "A", "N"]), "returned": ("items", ["R", "A"])})


@query
def a22_release_gates(spark: SparkSession, d: str) -> DataFrame:
    assigned, pairs = _assigned(spark, d, every=True)
    leaks = splits.leakage(assigned, pairs).where("n > 0 and measure <> 'exact_duplicates'")
    copies = duplicates.exact(assigned).where("removed")
    docs = table(spark, d, "documents")
    parts = {str(k): docs.where(c) for k, c in enumerate(("lang = 'en'", "lang <> 'en'"))}
    faults = accounting.partition_faults(docs, parts, "doc_id", "text")
    hit = contamination.hits(docs, table(spark, d, "benchmark")).select("doc").distinct()
    return audit.release_gates(spark, {"partition": faults}, {"exact_deduplication": copies, "split_leakage": leaks, "benchmark_contamination": hit})


@query
def a5_language_screen(spark: SparkSession, d: str) -> DataFrame:
    """Documents as JSON objects: two texts deep, numbers aside."""
    raw = F.to_json(F.struct("doc_id", F.struct("text", F.array("lang", "source").alias("names")).alias("body")))
    docs = table(spark, d, "documents")
    seen = screen.inspected(docs, F.col("source"), raw)
    return screen.counters(seen.withColumnRenamed("key", "source"), "source")


def _adapted(spark: SparkSession, family: str) -> DataFrame:
    lines = samples.lines(spark, family)
    return adapters.decided(lines, adapters.BY_FAMILY[family])


def _adapter_query(name: str, family: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _adapted(spark, family).select("source_line", "status", "reason", "answer", F.sha2("prompt", 256).alias("prompt_sha256"))

    run.__name__, run.__doc__ = name, f"Decisions on the sample records of {family}, one a rule."
    return query(run)


for _name, _family in samples.ADAPTERS.items():
    _adapter_query(_name, _family)


@query
def p13_candidate_issues(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of the sample reviews, as made and with one thing changed in each."""
    adapter = adapters.BY_FAMILY[samples.REVIEWS]
    made = _adapted(spark, samples.REVIEWS)
    one = validation.candidates(made, adapter).limit(1)
    answer = F.transform("messages", lambda m: F.when(m["role"] == "assistant", m.withField("content", F.lit("αρνητική"))).otherwise(m))
    user = F.transform("messages", lambda m: F.when(m["role"] == "user", m.withField("content", F.concat(m["content"], F.lit(" a@b.gr")))).otherwise(m))
    changes = {
        "as made": {}, "answer": {"messages": answer}, "prompt": {"messages": user}, "roles": {"messages": F.slice("messages", 1, 2)}, "id": {"id": F.lit("x")}, "domain": {"metadata": audit.with_fields("metadata", domain=F.lit("news"))},
        "line": {"metadata": audit.with_fields("metadata", source_line=F.lit(0).cast("long"))}, "status": {"metadata": audit.with_fields("metadata", review_status=F.lit("accepted"))},
    }
    out = None
    for name, columns in changes.items():
        t = validation.issues(one.withColumns(columns) if columns else one, made, adapter).select(F.lit(name).alias("change"), F.array_join("issues", ";").alias("issues"), "status")
        out = t if out is None else out.union(t)
    return out


ORACLE_SQL: dict[str, str] = {k: v for k, v in ORACLES.items() if k in QUERIES}
