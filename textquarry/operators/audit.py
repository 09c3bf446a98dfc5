"""Audit joins over a run's artefacts: records, candidates, decisions, keepers, lineage, flows and release gates.

Each check gives a table of faults, empty if all is well.  A comparison with a
null is no fault, a missing row is one; rows may repeat, and each is judged by
itself; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAULTS = "fault string, source string, line long, id string"


def _differs(*pairs: tuple[str, str]) -> Column:
    out = F.lit(False)
    for a, b in pairs:
        out = out | F.coalesce(F.col(a) != F.col(b), F.lit(False))
    return out


def record_faults(generated: DataFrame, candidates: DataFrame, rejected: DataFrame) -> DataFrame:
    """``fault, source, line, id``: accepted records and candidates, and rejected records and rejections, that do not fit each other, both ways.

    ``generated``: ``source, line, status, reason, id, row_hash``; ``candidates``:
    ``id, source, line, row_hash``; ``rejected``: ``source, line, status, reason, row_hash``.
    """
    g = generated.select(*[F.col(c).alias(f"g_{c}") for c in ("source", "line", "status", "reason", "id", "row_hash")])
    c = candidates.select(*[F.col(c).alias(f"c_{c}") for c in ("id", "source", "line", "row_hash")])
    r = rejected.select(*[F.col(c).alias(f"r_{c}") for c in ("source", "line", "status", "reason", "row_hash")])

    def rows(found: DataFrame, fault: str, source: str | None = None, line: str | None = None, id: str | None = None) -> DataFrame:  # noqa: A002
        pick = lambda c, kind: (F.col(c) if c else F.lit(None)).cast(kind)
        return found.select(F.lit(fault).alias("fault"), pick(source, "string").alias("source"), pick(line, "long").alias("line"), pick(id, "string").alias("id"))

    other = _differs(("c_source", "g_source"), ("c_line", "g_line"), ("c_row_hash", "g_row_hash"))
    one = g.where("g_status = 'accepted'").join(c, F.col("g_id") == F.col("c_id"), "left").where(F.col("c_id").isNull() | other)
    two = c.join(g, F.col("g_id") == F.col("c_id"), "left").where(F.col("g_id").isNull() | F.coalesce(F.col("g_status") != "accepted", F.lit(False)) | other)
    place = (F.col("g_source") == F.col("r_source")) & (F.col("g_line") == F.col("r_line"))
    three = g.where("g_status <> 'accepted'").join(r, place, "left").where(F.col("r_source").isNull() | _differs(("g_status", "r_status"), ("g_reason", "r_reason"), ("g_row_hash", "r_row_hash")))
    four = r.join(g, place, "left").where("g_source is null or g_status = 'accepted'")
    return (
        rows(one, "accepted_record_candidate_mismatch", "g_source", "g_line").union(rows(two, "candidate_without_accepted_source_record", id="c_id"))
        .union(rows(three, "rejected_record_artifact_mismatch", "g_source", "g_line")).union(rows(four, "foreign_generation_rejection", "r_source", "r_line"))
    )


def decision_faults(candidates: DataFrame, decisions: DataFrame, members: DataFrame) -> DataFrame:
    """``fault, id``: candidates without a decision, decisions without a candidate, and decisions that the member of their stage does not bear out.

    ``decisions``: ``id, status, reasons, schema_passed, content_passed``; ``members``:
    ``id, stage, reason``.  The stage to look in follows from the status.
    """
    ids, d = candidates.select(F.col("id").alias("c_id")), decisions.select(*[F.col(c).alias(f"d_{c}") for c in ("id", "status", "reasons", "schema_passed", "content_passed")])
    missing = ids.join(d, F.col("c_id") == F.col("d_id"), "left_anti").select(F.lit("candidate_validation_decision_missing").alias("fault"), F.col("c_id").alias("id"))
    foreign = d.join(ids, F.col("c_id") == F.col("d_id"), "left_anti").select(F.lit("foreign_validation_decision").alias("fault"), F.col("d_id").alias("id"))
    stage = F.when(F.col("d_status") == "accepted", "validated").when(F.col("d_status") == "quarantined", "quarantine").otherwise("")
    m = members.select(F.col("id").alias("m_id"), "stage", F.col("reason").alias("m_reason"))
    both = d.join(m, (F.col("d_id") == F.col("m_id")) & (F.col("stage") == stage), "left")
    unborne = (F.col("d_status") == "accepted") & ~(F.coalesce("d_schema_passed", F.lit(False)) & F.coalesce("d_content_passed", F.lit(False)) & F.coalesce(F.col("d_reasons") == "[]", F.lit(True)))
    unlike = (F.col("d_status") == "quarantined") & _differs(("d_reasons", "m_reason"))
    wrong = both.where(F.col("m_id").isNull() | unborne | unlike).select(F.lit("validation_decision_outcome_mismatch").alias("fault"), F.col("d_id").alias("id"))
    return missing.union(foreign).union(wrong)


def missing_keepers(removed: DataFrame, kept: DataFrame) -> DataFrame:
    """``id, keeper_id`` of removed rows whose keeper is not among the kept."""
    return removed.select("id", "keeper_id").join(kept.select(F.col("id").alias("keeper_id")).distinct(), "keeper_id", "left_anti").select("id", "keeper_id")


def lineage_faults(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """``id`` of candidates (``id, source, line, file_hash, family``) whose file (``path, sha256, records, family``) is missing, other, or shorter than their line."""
    f = files.select("path", "sha256", "records", F.col("family").alias("f_family"))
    found = candidates.join(f, F.col("source") == F.col("path"), "left")
    fits = F.col("path").isNotNull() & (F.col("sha256") == F.col("file_hash")) & (F.col("f_family") == F.col("family")) & F.col("line").between(F.lit(1), F.coalesce("records", F.lit(0)))
    return found.where(~F.coalesce(fits, F.lit(False))).select("id")


def flow_faults(counts: DataFrame, equations: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """``equation, whole, parts`` of those equations that a row of counts breaks: a whole must be the sum of its parts."""
    each = [F.struct(F.lit(k).alias("equation"), F.col(whole).cast("long").alias("whole"), sum((F.col(p).cast("long") for p in parts), F.lit(0).cast("long")).alias("parts")) for k, (whole, parts) in equations.items()]
    return counts.select(F.explode(F.array(*each)).alias("e")).select("e.*").where(~F.col("whole").eqNullSafe(F.col("parts")))


# The gates of a release, in the order of its report, and what the open ones wait for.
GATES = (
    "file_coverage", "identified_record_accounting", "complete_semantic_record_coverage", "canonical_schema", "deterministic_validation", "all_api_reviews_accepted", "verified_licenses", "sensitive_data",
    "exact_deduplication", "split_leakage", "benchmark_contamination", "source_hashes_unchanged", "scoped_source_hashes_unchanged", "counts_reconciled", "release_auditor",
)
PENDING = {
    "all_api_reviews_accepted": "API_disabled_no_final_review_set",
    "verified_licenses": "Final_release_license_audit_and_legal_approval_pending",
    "sensitive_data": "Final_privacy_assessment_and_independent_review_pending",
    "release_auditor": "Pre_API_audit_only;required_release_gates_unresolved",
}


def release_gates(spark: SparkSession, accounting: dict[str, DataFrame], own: dict[str, DataFrame]) -> DataFrame:
    """``position, gate, passed, reason, faults`` for every gate.

    Gates that no check here can open are blocked with a reason; all others need
    every table of ``accounting`` empty, and the tables in ``own`` under their name.
    """
    def size(t: DataFrame, gates: list[str]) -> DataFrame:
        each = F.explode(F.array(*map(F.lit, gates)))
        return t.agg(F.count(F.lit(1)).alias("n")).select(each.alias("gate"), "n")

    checked = [g for g in GATES if g not in PENDING]
    parts = [size(t, checked) for t in accounting.values()] + [size(t, [k]) for k, t in own.items()]
    found = spark.createDataFrame([], "gate string, n long")
    for p in parts:
        found = found.union(p)
    names = spark.createDataFrame([(k, g, PENDING.get(g)) for k, g in enumerate(GATES, 1)], "position int, gate string, reason string")
    counted = names.join(found.groupBy("gate").agg(F.sum("n").alias("faults")), "gate", "left").withColumn("faults", F.coalesce("faults", F.lit(0)))
    return counted.select("position", "gate", (F.col("reason").isNull() & (F.col("faults") == 0)).alias("passed"), "reason", "faults")


def with_fields(metadata: str, **fields: Column) -> Column:
    """The metadata struct with some fields set."""
    out = F.col(metadata)
    for name, value in fields.items():
        out = out.withField(name, value)
    return out


def revision_id(parent_hash: Column, child: Column) -> Column:
    """The id of a revised example: a digest of its parent's hash and its own canonical JSON."""
    return F.sha2(F.concat(F.lit('{"parent":"'), parent_hash, F.lit('","revision":'), child, F.lit("}")), 256)
