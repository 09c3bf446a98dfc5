"""Which plan applies to which file, and what happens to each file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.operators import inventory
from textquarry.plans.adapters import ADAPTERS


def plans(spark: SparkSession) -> DataFrame:
    """One row a supported family: ``family, task, domain``."""
    return spark.createDataFrame([(a.family, a.task, a.domain) for a in ADAPTERS], "family string, task string, domain string")


def families(files: DataFrame, catalog: DataFrame) -> DataFrame:
    """All families of files and catalogue, each once."""
    return files.select("family").union(catalog.select("family")).distinct()


def dispositions(files: DataFrame, catalog: DataFrame, *, roots: tuple[str, ...] = (), dispatch: DataFrame | None = None) -> DataFrame:
    """Every manifest row with its plan and one status: excluded, eligible, or blocked with a reason.

    ``dispatch`` maps single files (``relative_path``) to another family's plan;
    a file of a dispatched family without a rule is blocked for review.
    """
    out = files.withColumn("family", F.coalesce("family", F.lit("uncatalogued"))).withColumn("plan_family", F.col("family"))
    if dispatch is not None:
        rules = dispatch.select("relative_path", F.col("family").alias("ruled"))
        routed = dispatch.select(F.col("family").alias("routed")).distinct()
        out = out.join(rules, "relative_path", "left").join(routed, F.col("family") == F.col("routed"), "left")
        out = out.withColumn("plan_family", F.when(F.col("ruled").isNotNull(), F.col("ruled")).when(F.col("routed").isNull(), F.col("family"))).drop("ruled", "routed")
    out = out.join(catalog.select(F.col("family").alias("plan_family"), "task"), "plan_family", "left")
    fits = inventory.eligible("relative_path", F.col("task"), F.col("task"), roots)
    status = F.when(inventory.excluded("relative_path", roots), "excluded").when(F.col("plan_family").isNull(), "blocked").when(F.col("task").isNull(), "blocked").when(fits, "eligible").otherwise("blocked")
    reason = (
        F.when(inventory.excluded("relative_path", roots), "excluded_from_current_source_coverage").when(F.col("plan_family").isNull(), "unmapped_file_requires_schema_review")
        .when(F.col("task").isNull(), "no_adapter_for_family").when(~fits, "file_form_not_eligible")
    )
    return out.withColumns({"status": status, "reason": reason})
