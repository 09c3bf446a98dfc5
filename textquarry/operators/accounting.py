"""Proofs that every input has exactly one outcome, and comparisons of two states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _all(parts: dict[str, DataFrame], *columns: str) -> DataFrame:
    out = None
    for name, part in parts.items():
        t = part.select(F.lit(name).alias("part"), *columns)
        out = t if out is None else out.unionByName(t)
    return out


def _compared(df: DataFrame, column: str) -> Column:
    """The column, or the digest of its text."""
    return F.unhex(F.sha2(column, 256)) if dict(df.select(F.col(column).alias("x")).dtypes)["x"] == "string" else F.col(column)


def partition_faults(whole: DataFrame, parts: dict[str, DataFrame], key: str, content: str) -> DataFrame:
    """``key, fault`` for every way in which the parts fail to be the whole, each row once and unchanged.

    Faults: missing (in no part), multiple (more than once), foreign (not in the
    whole), changed (other content).  No rows: the partition is exact.  Texts are
    compared by their SHA-256, so they do not move.
    """
    members = _all(parts, key, content)
    members = members.select(F.col(key).alias("__key"), _compared(members, content).alias("__content"))
    n = members.groupBy("__key").agg(F.count(F.lit(1)).alias("n"))
    place = whole.join(n, F.col(key).eqNullSafe(F.col("__key")), "left")
    missing = place.where("n is null").select(F.col(key), F.lit("missing").alias("fault"))
    multiple = place.where("n > 1").select(F.col(key), F.lit("multiple").alias("fault"))
    ids = whole.select(F.col(key).alias("__id"), _compared(whole, content).alias("__whole"))
    foreign = members.join(ids, F.col("__key").eqNullSafe(F.col("__id")), "left_anti").select(F.col("__key").alias(key), F.lit("foreign").alias("fault"))
    both = members.join(ids, F.col("__key").eqNullSafe(F.col("__id")))
    changed = both.where(~F.col("__content").eqNullSafe(F.col("__whole"))).select(F.col("__key").alias(key), F.lit("changed").alias("fault"))
    return missing.union(multiple).union(foreign).union(changed)


def require_partition(faults: DataFrame) -> None:
    """Raise, with counts by fault, unless the partition is exact."""
    bad = faults.groupBy("fault").count().collect()  # four rows at most
    if bad:
        raise ValueError("inexact partition: " + ", ".join(f"{r['count']} {r['fault']}" for r in sorted(bad)))


def outcomes(parts: dict[str, DataFrame], key: str, by: str) -> DataFrame:
    """By group, the rows of each part and how many keys have more than one outcome."""
    members = _all(parts, key, by)
    n = members.withColumn("many", F.count(F.lit(1)).over(Window.partitionBy(key)))
    return n.groupBy(by).agg(*[F.count_if(F.col("part") == p).alias(p) for p in parts], F.count_if(F.col("many") > 1).alias("in_several"))


def drift(old: DataFrame, new: DataFrame, path: str, content: str) -> DataFrame:
    """``path, status``: unchanged, changed, added or removed between two states."""
    a, b = old.select(F.col(path).alias("p"), F.col(content).alias("x")), new.select(F.col(path).alias("q"), F.col(content).alias("y"))
    status = F.when(F.col("q").isNull(), "removed").when(F.col("p").isNull(), "added").when(F.col("x").eqNullSafe(F.col("y")), "unchanged").otherwise("changed")
    return a.join(b, F.col("p") == F.col("q"), "full").select(F.coalesce("p", "q").alias("path"), status.alias("status"))


def paired(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """``key, outcome`` of a join that should be one to one: equal, different, left_only or right_only."""
    a, b = left.select(F.col(key).alias("p"), F.col(value).alias("x")), right.select(F.col(key).alias("q"), F.col(value).alias("y"))
    outcome = F.when(F.col("q").isNull(), "left_only").when(F.col("p").isNull(), "right_only").when(F.col("x").eqNullSafe(F.col("y")), "equal").otherwise("different")
    return a.join(b, F.col("p") == F.col("q"), "full").select(F.coalesce("p", "q").alias(key), outcome.alias("outcome"))


def coverage(declared: DataFrame, rows: DataFrame, path: str, count: str) -> DataFrame:
    """Files whose number of rows differs from the declared one."""
    n = rows.groupBy(path).agg(F.count(F.lit(1)).alias("found"))
    out = declared.select(F.col(path), F.col(count).cast("long").alias("declared")).join(n, path, "left")
    return out.select(path, "declared", F.coalesce("found", F.lit(0)).alias("found")).where("declared <> found")


def range_faults(spans: DataFrame, files: DataFrame) -> DataFrame:
    """``path, fault``: ranges that don't start at 1, leave a gap, overlap, or don't end at the file's count; ranges without a file, files without ranges."""
    order = Window.partitionBy("path").orderBy("first_record", "last_record")
    at = spans.withColumn("before", F.lag("last_record", 1, 0).over(order))
    gap = at.where("first_record <> before + 1").select("path", F.when(F.col("before") == 0, "bad_start").when(F.col("first_record") > F.col("before") + 1, "gap").otherwise("overlap").alias("fault")).distinct()
    ends = spans.groupBy("path").agg(F.max("last_record").alias("last"))
    both = ends.join(files, "path", "full")
    ended = both.where("last is null or record_count is null or last <> record_count")
    ended = ended.select("path", F.when(F.col("record_count").isNull(), "no_file").when(F.col("last").isNull(), "no_ranges").otherwise("bad_end").alias("fault"))
    return gap.union(ended)


def reconciled(declared: DataFrame, found: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Totals that differ, by keys and measure: ``keys..., measure, declared, found``."""
    def long(t: DataFrame, name: str) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("v")) for m in measures]))
        return t.select(*keys, pairs.alias("m")).groupBy(*keys, "m.measure").agg(F.sum("m.v").alias(name))

    out = long(declared, "declared").join(long(found, "found"), [*keys, "measure"], "full")
    return out.where(~F.col("declared").eqNullSafe(F.col("found")))


def failure_rate(rows: DataFrame, passed: Column, most: float = 0.01) -> DataFrame:
    """One row: entered, passed, the share that failed, and whether that is too much; no rows do not fail."""
    out = rows.agg(F.count(F.lit(1)).alias("entered"), F.count_if(passed).alias("passed"))
    rate = F.when(F.col("entered") > 0, (F.col("entered") - F.col("passed")) / F.col("entered")).otherwise(0.0)
    return out.withColumn("rate", rate).withColumn("blocked", F.col("rate") > most)


def gates(spark: SparkSession, checks: dict[str, DataFrame]) -> DataFrame:
    """``gate, passed, faults``: a gate passes when its table of faults is empty."""
    out = None
    for name, faults in checks.items():
        t = faults.agg(F.count(F.lit(1)).alias("faults")).select(F.lit(name).alias("gate"), (F.col("faults") == 0).alias("passed"), "faults")
        out = t if out is None else out.union(t)
    return out if out is not None else spark.createDataFrame([], "gate string, passed boolean, faults long")


def first_errors(errors: DataFrame, order: list[str], most: int = 100) -> tuple[DataFrame, int]:
    """The first errors for a report and the number of all."""
    return errors.orderBy(*order).limit(most), errors.count()


def sets_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, with ``side``; none if the sets are equal."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).union(b.exceptAll(a).withColumn("side", F.lit("right")))
