"""Readers of derived records: strict, audited, and checks of what they must look like.

A strict reader fails on the first bad row; an audited one keeps bad rows apart
and goes on.  Faults are tables, so they can be counted, shown or required to be
empty.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from textquarry.functions import text as T
from textquarry.sources import files
from textquarry.storage import written

SHA256, EMPTY_SHA256 = r"^[0-9a-f]{64}\z", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def strict_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines of a schema; a malformed row fails the read, blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("lineSep", "\n").json(path)


def audited_json(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows as text."""
    whole = StructType(list(schema.fields)).add("_corrupt_record", StringType())
    # written once: Spark does not answer for the corrupt column of a text scan alone
    rows = written(spark.read.schema(whole).option("mode", "PERMISSIVE").option("lineSep", "\n").json(path), "audited")
    return rows.where("_corrupt_record is null").drop("_corrupt_record"), rows.where("_corrupt_record is not null").select("_corrupt_record")


def canonical_faults(rows: DataFrame) -> DataFrame:
    """``id, fault`` for rows that are no canonical example: missing id, wrong roles, empty message, missing lineage."""
    roles = F.array_join(F.transform("messages", lambda m: F.coalesce(m["role"], F.lit("?"))), ",")
    empty = F.exists("messages", lambda m: F.coalesce(F.trim(m["content"]) == "", F.lit(True)))
    lineage = F.coalesce((F.trim("metadata.source_file") == "") | F.col("metadata.source_record_hash").isNull(), F.lit(True))
    fault = (
        F.when(F.coalesce(F.trim("id") == "", F.lit(True)), "missing_id").when(F.coalesce(roles != "system,user,assistant", F.lit(True)), "wrong_roles")
        .when(empty, "empty_message").when(lineage, "missing_lineage")
    )
    return rows.select("id", fault.alias("fault")).where("fault is not null")


def manifest_faults(rows: DataFrame) -> DataFrame:
    """``relative_path, fault`` for manifest rows that cannot be true: unsafe or repeated paths, bad hashes, bad sizes, a wrong hash of an empty file."""
    path = F.col("relative_path")
    unsafe = F.coalesce((path == "") | path.startswith("/") | path.contains("\\") | path.rlike(r"(^|/)(\.{1,2})?(/|\z)"), F.lit(True))
    fault = (
        F.when(unsafe, "unsafe_path").when(~F.coalesce(F.col("sha256").rlike(SHA256), F.lit(False)), "bad_sha256").when(F.coalesce(F.col("size_bytes") < 0, F.lit(True)), "bad_size")
        .when((F.col("size_bytes") == 0) != (F.col("sha256") == EMPTY_SHA256), "bad_empty_file")
    )
    wrong = rows.select("relative_path", fault.alias("fault")).where("fault is not null")
    again = rows.groupBy("relative_path").count().where("count > 1").select("relative_path", F.lit("repeated_path").alias("fault"))
    return wrong.union(again)


def require_none(faults: DataFrame, what: str) -> None:
    """Raise, with an example, if there is a fault."""
    first = faults.limit(1).collect()
    if first:
        raise ValueError(f"{what}: {first[0].asDict()}")


def benchmark_items(rows: DataFrame) -> DataFrame:
    """Rows of ``question, choices`` as evaluation items keyed by a hash of their canonical JSON; others are dropped by the caller's own checks."""
    fine = rows.where("question is not null and choices is not null")
    key = F.sha2(F.to_json(F.struct("choices", "question")), 256)
    return fine.select(key.alias("evaluation_id"), "question", "choices")


def baseline(spark: SparkSession, path: str, sha256: str, schema: StructType | str = "relative_path string, size_bytes long, sha256 string") -> DataFrame:
    """A manifest of an earlier run; raises if the file is not the one of that hash, or a row cannot be true."""
    found = {r["sha256"] for r in files.hashed(spark, path).select("sha256").collect()}  # one file
    if found != {sha256}:
        raise ValueError("the baseline is not the file that its checksum names")
    rows = strict_json(spark, path, schema)
    require_none(manifest_faults(rows), "baseline")
    return rows


def merged_shards(shards: list[DataFrame], key: str) -> DataFrame:
    """Shards of one table as a whole, in order of the key; a key in two rows raises."""
    whole = shards[0]
    for s in shards[1:]:
        whole = whole.unionByName(s)
    whole = written(whole, "shards")
    require_none(whole.groupBy(key).count().where("count > 1"), "repeated key")
    return whole.orderBy(key)


def report(rows: DataFrame, title: str, most: int = 10_000) -> tuple[str, str]:
    """A small table of aggregates as Markdown and as JSON; raises if it is no small one."""
    some = rows.limit(most + 1).collect()
    if len(some) > most:
        raise ValueError(f"more than {most} rows are no report")
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    lines = [f"# {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + "-|" * len(rows.columns), *("| " + " | ".join(map(cell, r)) + " |" for r in some)]
    return "\n".join(lines) + "\n", json.dumps({"title": title, "rows": [r.asDict(recursive=True) for r in some]}, ensure_ascii=False, sort_keys=True, default=str)


def distinct_questions(items: DataFrame, text: str = "question") -> DataFrame:
    """One row: items and different questions among them, in normal form; nulls are no questions."""
    return items.agg(F.count(F.lit(1)).alias("items"), F.count_distinct(T.word_folded(F.col(text))).alias("questions"))
