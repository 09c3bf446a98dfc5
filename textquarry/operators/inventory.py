"""File and record accounting: classes of paths, ranges of equal status, schema variants, rollups, equal contents."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Names that stand for caches, tools, sidecars and documentation.
CACHE_ROOTS = (".hf_cache", ".claude", "00aa_tools", "greek_training", "greek_training_temp")
REPOSITORY_PARTS = (".git", "__pycache__")
SIDECAR_ENDINGS = (".meta", ".idx")
SIDECAR_NAME = "dataset_dict.jsonl"
DOCUMENT_ENDINGS = (".md", ".py", ".pyc", ".sh", ".yaml", ".yml", ".log", ".paths", ".sample")
DEEP_FAMILIES = ("common_corpus", "greek_dialects", "greekllm_additional", "phd-theses-corpus")
DATA_FORMATS = ("jsonl", "json_document", "json", "parquet", "csv", "tsv", "text", "xml")


def by(*columns: str) -> WindowSpec:
    """Rows of the first column's value in order of the others."""
    return Window.partitionBy(columns[0]).orderBy(*columns[1:])


def family(path: str, *, deep: tuple[str, ...] = DEEP_FAMILIES) -> Column:
    """A path's collection: its first part, two parts in ``deep`` collections with more than two, ``_root`` for a bare name."""
    parts = F.split(path, "/")
    two = F.concat_ws("/", parts[0], F.get(parts, F.lit(1)))
    return F.when(F.size(parts) == 1, "_root").when(parts[0].isin(*deep) & (F.size(parts) > 2), two).otherwise(parts[0])


def _ends(name: Column, endings: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for e in endings:
        out = out | name.endswith(e)
    return out


def _classes(path: str) -> dict[str, Column]:
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    return {
        "cache": parts[0].isin(*CACHE_ROOTS),
        "repository": F.arrays_overlap(parts, F.array(*map(F.lit, REPOSITORY_PARTS))),
        "sidecar": _ends(name, SIDECAR_ENDINGS) | (name == SIDECAR_NAME),
        "documentation": _ends(name, DOCUMENT_ENDINGS),
    }


def artifact(path: str) -> Column:
    """Why a file is no source; null if it may be one."""
    c = _classes(path)
    return (
        F.when(c["cache"], "preexisting_pipeline_cache_or_tool_artifact").when(c["repository"], "repository_or_bytecode_artifact")
        .when(c["sidecar"], "source_sidecar_metadata").when(c["documentation"], "documentation_code_or_log_artifact")
    )


def kind(path: str, file_format: Column) -> Column:
    """The kind of a file for the accounting of equal contents."""
    c = _classes(path)
    return (
        F.when(c["cache"], "cache_or_derived_artifact").when(c["repository"], "repository_or_bytecode").when(c["sidecar"], "sidecar_metadata")
        .when(c["documentation"], "documentation_code_or_log").when(file_format.isin(*DATA_FORMATS), "data").otherwise("other_unsupported")
    )


def excluded(path: str, roots: tuple[str, ...]) -> Column:
    """Whether a path is one of the roots or below one; roots are literal text, unsafe ones raise."""
    out = F.lit(False)
    for r in roots:
        if not r or r.startswith("/") or any(p in ("", ".", "..") for p in r.split("/")):
            raise ValueError(f"unsafe root {r!r}")
        out = out | (F.col(path) == r) | F.col(path).startswith(r + "/")
    return out


def exclusion_ledger(files: DataFrame, roots: tuple[str, ...]) -> DataFrame:
    """``root, files, bytes`` of what each root leaves out of ``relative_path, size_bytes``; of nested roots the longest counts."""
    root = None
    for r in sorted(roots, key=len, reverse=True):
        inside = excluded("relative_path", (r,))
        root = F.when(inside, r) if root is None else root.when(inside, r)
    named = files.select((F.lit(None).cast("string") if root is None else root).alias("root"), "size_bytes")
    return named.where("root is not null").groupBy("root").agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("bytes"))


def hash_only(path: str, roots: tuple[str, ...]) -> Column:
    """Whether a file is hashed but not parsed: below an excluded root and not at top level."""
    return excluded(path, roots) & (F.size(F.split(path, "/")) > 1)


def eligible(path: str, adapter: Column, expected: Column, roots: tuple[str, ...] = ()) -> Column:
    """Whether a manifest row's records may be generated from."""
    name = F.element_at(F.split(path, "/"), -1)
    return (
        ~excluded(path, roots) & F.coalesce(adapter == expected, F.lit(False)) & F.coalesce("record_boundary_complete", F.lit(True)) & F.col(path).endswith(".jsonl")
        & F.col("record_count").isNotNull() & F.coalesce(F.col("encoding").isin("utf-8", "utf-8-sig"), F.lit(False))
        & ~(name.startswith("dataset_dict") | name.startswith("dataset_info") | name.startswith("state"))
    )


def file_status(errors: Column, is_artifact: Column, malformed: Column, quarantined: Column) -> Column:
    """A file's status from its counts, worst first."""
    return F.when(errors > 0, "processing_error").when(is_artifact, "unsupported").when(malformed > 0, "malformed").when(quarantined > 0, "quarantined").otherwise("license_blocked")


def ranges(rows: DataFrame, most: int = 10_000) -> DataFrame:
    """Runs of consecutive lines with equal status and reason, of at most ``most`` rows, with a chained hash.

    ``rows``: ``path, line, status, reason, row_sha256`` (hex).  Files spread over
    tasks; the lines of one file are in order in one of them.
    """
    order = Window.partitionBy("path").orderBy("line")
    new = F.when((F.lag("line").over(order) == F.col("line") - 1) & F.lag("status").over(order).eqNullSafe(F.col("status")) & F.lag("reason").over(order).eqNullSafe(F.col("reason")), 0).otherwise(1)
    runs = rows.withColumn("new", new).withColumn("run", F.sum("new").over(order))
    runs = runs.withColumn("piece", F.floor((F.row_number().over(Window.partitionBy("path", "run").orderBy("line")) - 1) / most))
    grouped = runs.groupBy("path", "run", "piece", "status", "reason").agg(F.min("line").alias("first_record"), F.max("line").alias("last_record"), _chain("line").alias("row_hash_chain"))
    return grouped.select("path", "first_record", "last_record", "status", "reason", "row_hash_chain")


def _chain(line: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct(line, "row_sha256")))
    return F.sha2(F.unhex(F.array_join(F.transform(ordered, lambda x: x["row_sha256"]), "")), 256)


def hash_chain(rows: DataFrame, by_col: str) -> DataFrame:
    """SHA-256 over the binary row hashes of each group, in order of ``line``."""
    return rows.groupBy(F.col(by_col)).agg(F.count(F.lit(1)).alias("rows"), _chain("line").alias("row_hash_chain"))


def rollup(rows: DataFrame) -> DataFrame:
    """Records and bytes by family and, under a null family with ``is_total``, in all."""
    out = rows.rollup("family").agg(F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), F.grouping("family").cast("int").alias("is_total"))
    return out.select("family", "is_total", "records", "bytes")


def status_counts(rows: DataFrame, by_col: str) -> DataFrame:
    """Counts of each status and reason by group."""
    return rows.groupBy(by_col, "status", "reason").agg(F.count(F.lit(1)).alias("n"))


#: Python's names of JSON types, which the variants' hashes contain.
_TYPES = {str: "str", int: "int", float: "float", bool: "bool", type(None): "NoneType", list: "list", dict: "dict"}


def variant_of(raw: str | None) -> str | None:
    """Top-level fields with type names as canonical JSON; null for what is no object."""
    try:
        value = json.loads(raw) if raw is not None else None
    except ValueError:
        return None
    if not isinstance(value, dict):
        return None
    return json.dumps({k: _TYPES[type(v)] for k, v in value.items()}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def schema_variants(rows: DataFrame, most: int = 256) -> DataFrame:
    """Variants of ``raw`` JSON objects by ``path``: fields, their hash, counts; variants first seen after the ``most``-th share one row without fields."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(variant_of)

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    seen = rows.select("path", "line", F.pandas_udf(run, "string")("raw").alias("fields")).where("fields is not null")
    counted = seen.groupBy("path", "fields").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("first"))
    rank = F.row_number().over(Window.partitionBy("path").orderBy("first"))
    shown = F.when(rank <= most, F.col("fields"))
    return counted.withColumn("fields", shown).groupBy("path", "fields").agg(F.sum("n").alias("n")).withColumn("schema_sha256", F.sha2("fields", 256))


def content_groups(files: DataFrame) -> DataFrame:
    """Groups of files with equal hash and size: members, smallest path, redundant copies and bytes."""
    out = files.groupBy("sha256", "size_bytes").agg(F.count(F.lit(1)).alias("members"), F.min("relative_path").alias("representative")).where("members > 1")
    return out.withColumns({"redundant_copies": F.col("members") - 1, "redundant_bytes": F.col("size_bytes") * (F.col("members") - 1)})


def breakdown(files: DataFrame, dimensions: tuple[str, ...] = ("family", "format", "kind")) -> DataFrame:
    """By each dimension alone: files, bytes, members of groups of equal files, redundant copies and bytes.

    Within a group all files but the one with the smallest path are redundant.
    """
    groups = content_groups(files).select("sha256", "size_bytes", "representative")
    marked = files.join(groups, ["sha256", "size_bytes"], "left").withColumn("extra", F.coalesce(F.col("representative") != F.col("relative_path"), F.lit(False)))
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions]))
    return marked.select(each.alias("g"), "size_bytes", "representative", "extra").groupBy("g.dimension", "g.value").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("bytes"), F.count("representative").alias("duplicate_members"),
        F.count_if("extra").alias("redundant_copies"), F.coalesce(F.sum(F.when(F.col("extra"), F.col("size_bytes"))), F.lit(0)).alias("redundant_bytes"),
    )
