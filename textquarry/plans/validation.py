"""Checks of canonical candidates against their evidence: a sorted list of issue codes, and what follows from it.

A candidate is ``id, messages array<struct<role, content>>, metadata`` as text
columns of a struct; its evidence is the adapter's decision on the same record,
made again from the source, so a prompt or an answer is compared, not trusted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions import risk
from textquarry.functions import text as T
from textquarry.plans.adapters import LEAST_RATIO, SYSTEM, Adapter

VERSION = "1.1.0"
POLICY_ISSUES = ("license_unverified", "privacy_review_unresolved")


def candidate_id(family: str, task: str) -> Column:
    """SHA-256 of canonical JSON of what identifies an example."""
    parts = F.struct(F.lit(family).alias("family"), F.col("source_file").alias("file"), F.col("source_line").alias("line"), F.col("source_record_hash").alias("record_hash"), F.lit(task).alias("task"), F.lit(VERSION).alias("version"))
    return F.sha2(F.to_json(parts, {"ignoreNullFields": "false"}), 256)


def candidates(decided: DataFrame, adapter: Adapter) -> DataFrame:
    """Accepted decisions (with ``source_file, source_line, source_record_hash``) as canonical examples."""
    messages = F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in (("system", F.lit(SYSTEM)), ("user", F.col("prompt")), ("assistant", F.col("answer")))])
    metadata = F.struct(
        F.lit(adapter.family).alias("source_name"), "source_file", "source_line", "source_record_hash", F.lit(adapter.task).alias("task_type"), F.lit(adapter.domain).alias("domain"),
        F.col("group_sha256").alias("split_group"), "span_start", "span_end", F.lit(VERSION).alias("template_version"), F.lit("pending").alias("review_status"), F.lit("unresolved").alias("privacy_status"),
    )
    return decided.where("status = 'accepted'").select(candidate_id(adapter.family, adapter.task).alias("id"), messages.alias("messages"), metadata.alias("metadata"))


def content_hash(without: tuple[str, ...] = ("review_status", "validation_status", "split", "dedup_group")) -> Column:
    """A candidate's digest without the metadata that later passes may change."""
    return F.sha2(F.to_json(F.struct("id", "messages", F.col("metadata").dropFields(*without).alias("metadata")), {"ignoreNullFields": "false"}), 256)


def issues(made: DataFrame, evidence: DataFrame, adapter: Adapter, *, licensed: Column | None = None, approved: Column | None = None) -> DataFrame:
    """``id, issues, status``: validated without issues, else quarantined; every candidate appears once.

    Malformed messages end the checks.  ``evidence`` is the adapter's decision
    keyed by ``source_file, source_line``.
    """
    keys = [F.col("metadata.source_file").alias("source_file"), F.col("metadata.source_line").alias("source_line")]
    e = evidence.select("source_file", "source_line", F.col("source_record_hash").alias("e_hash"), F.col("reason").alias("e_reason"), F.col("prompt").alias("e_prompt"), F.col("answer").alias("e_answer"), F.col("group_sha256").alias("e_group"), F.col("span_start").alias("e_start"), F.col("span_end").alias("e_end"))
    rows = made.select("*", *keys).withColumn("source_record_hash", F.col("metadata.source_record_hash")).join(e, ["source_file", "source_line"], "left")
    content = lambda i: F.get(F.col("messages"), F.lit(i))["content"]
    roles = F.coalesce(F.array_join(F.transform("messages", lambda m: F.coalesce(m["role"], F.lit("?"))), ",") != "system,user,assistant", F.lit(True))
    empty = F.exists("messages", lambda m: F.coalesce(F.trim(m["content"]) == "", F.lit(True)))
    differs = lambda a, b: ~a.eqNullSafe(b)
    everything = F.array_join(F.transform("messages", lambda m: m["content"]), "\n")
    greek = T.greek_counts(content(1))
    m = F.col("metadata")
    expected = {"source_name": adapter.family, "task_type": adapter.task, "template_version": VERSION, "domain": adapter.domain}
    rebuilt = F.col("e_reason").isNull() & F.col("e_prompt").isNotNull()
    found = [
        F.when(differs(F.col("e_hash"), m["source_record_hash"]), "source_lineage_mismatch"),
        *[F.when(differs(m[k], F.lit(v)), f"metadata_evidence_mismatch:{k}") for k, v in expected.items()],
        F.when(F.coalesce(m["source_line"] <= 0, F.lit(True)), "invalid_source_line"),
        F.when(differs(F.col("id"), candidate_id(adapter.family, adapter.task)), "unstable_or_incorrect_candidate_id"),
        F.when(differs(m["review_status"], F.lit("pending")), "raw_review_status_must_be_pending"),
        F.when(~rebuilt, F.concat(F.lit("source_evidence_invalid:"), F.coalesce("e_reason", F.lit("missing")))),
        F.when(rebuilt & (differs(content(0), F.lit(SYSTEM)) | differs(content(1), F.col("e_prompt"))), "unsupported_or_changed_prompt"),
        F.when(rebuilt & differs(content(2), F.col("e_answer")), "answer_not_exactly_grounded"),
        F.when(rebuilt & differs(m["split_group"], F.col("e_group")), "source_group_mismatch"),
        F.when(rebuilt & (differs(m["span_start"], F.col("e_start")) | differs(m["span_end"], F.col("e_end"))), "grounding_span_mismatch"),
        F.when((greek["greek_ratio"] < LEAST_RATIO) | (greek["accented_characters"] == 0), "greek_script_or_accents_check_failed"),
        F.when(m["source_file"].contains("/datadisk") | m["source_file"].contains("\\home\\"), "private_absolute_path_in_metadata"),
        F.when(~F.coalesce(licensed, F.lit(False)) if licensed is not None else F.lit(True), "license_unverified"),
        F.when((m["privacy_status"] != "approved") | ~F.coalesce(approved if approved is not None else F.lit(False), F.lit(False)), "privacy_review_unresolved"),
    ]
    codes = F.array_union(F.array_compact(F.array(*found)), risk.task_codes(everything))
    listed = F.when(roles, F.array(F.lit("invalid_message_roles_or_order"))).when(empty, F.array(F.lit("empty_or_malformed_message"))).otherwise(F.array_sort(F.array_distinct(codes)))
    out = rows.select("id", listed.alias("issues"))
    return out.withColumn("status", F.when(F.size("issues") == 0, "validated").otherwise("quarantined"))


def counters(checked: DataFrame) -> DataFrame:
    """One row: entering, without issues, without issues other than policy ones."""
    hard = F.size(F.array_except("issues", F.array(*map(F.lit, POLICY_ISSUES))))
    return checked.agg(F.count(F.lit(1)).alias("entering"), F.count_if(F.size("issues") == 0).alias("validated"), F.count_if(hard == 0).alias("deterministic_passed"))


def license_declarations(record: str = "record") -> Column:
    """A map of the licence statements that a VARIANT record carries, blanks and placeholders aside."""
    paths = ("license", "license_url", "rights", "metadata.license", "source_metadata.license")
    entries = F.array(*[F.struct(F.lit(p).alias("key"), F.try_variant_get(record, f"$.{p}", "string").alias("value")) for p in paths])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull() & (F.trim(e["value"]) != "") & ~e["value"].isin("NA", "None")))


def licensed(declared: Column, allowed: Column, training: Column, redistribution: Column, in_scope: Column) -> Column:
    """Whether a policy releases a record: every declaration is allowed, both uses are granted, its hash is in scope."""
    return (F.size(declared) > 0) & F.forall(F.map_values(declared), lambda x: F.array_contains(allowed, x)) & training & redistribution & in_scope


def review_faults(response: str = "response") -> Column:
    """Why a reviewer's answer is inconsistent, as a list; ``response`` is a struct ``decision, scores map, issue_codes, proposed_revision, short_reason``."""
    r = F.col(response)
    scores = F.map_values(r["scores"])
    revised = r["proposed_revision"].isNotNull()
    return F.array_compact(F.array(
        F.when(~F.coalesce(r["decision"].isin("accept", "revise", "reject"), F.lit(False)), "unknown_decision"),
        F.when(F.size(scores) != 7, "wrong_number_of_scores"),
        F.when(F.exists(scores, lambda s: (s < 0) | (s > 4)), "score_out_of_range"),
        F.when(F.length(r["short_reason"]) > 2000, "reason_too_long"),
        F.when((r["decision"] == "accept") & (revised | (F.size(r["issue_codes"]) > 0) | (F.array_min(scores) < 3)), "inconsistent_acceptance"),
        F.when((r["decision"] == "revise") & (F.coalesce(r["proposed_revision"], F.lit("")) == ""), "revision_missing"),
        F.when((r["decision"] == "reject") & revised, "rejection_with_revision"),
    ))
