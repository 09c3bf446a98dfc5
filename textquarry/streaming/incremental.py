"""Restartable ingestion: new files since the last run, each line with exactly one outcome.

Structured Streaming's file source remembers the files it has seen and its file
sink commits each micro-batch as a whole, so a run that stops resumes without
repeated or missing rows.  ``availableNow`` ends the query when the folder is
read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def ingest(spark: SparkSession, source: str, target: str, journal: str, *, files_each: int = 256, kind: str = "text", schema: StructType | str | None = None, transform=None) -> int:
    """Append the outcomes of new files below ``source`` to ``target``; returns the number of micro-batches.

    ``kind`` text gives ``value, path``; other kinds need their ``schema``.
    """
    reader = spark.readStream.format(kind).option("maxFilesPerTrigger", files_each)
    if kind == "text":
        reader = reader.option("lineSep", "\n")
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(source).withColumn("path", F.col("_metadata.file_path"))
    rows = transform(rows) if transform else outcomes(rows)
    before = _commits(spark, journal)
    query = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", journal).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return _commits(spark, journal) - before


def _commits(spark: SparkSession, journal: str) -> int:
    """How many micro-batches the journal's log has."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{journal}/commits")  # noqa: SLF001
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    names = [f.getPath().getName() for f in store.listStatus(at)] if store.exists(at) else []
    numbers = [int(n) for n in names if n.isdigit()]
    return max(numbers, default=-1) + 1


def outcomes(rows: DataFrame) -> DataFrame:
    """``path, value, status, reason`` of text lines."""
    record = F.try_parse_json("value")
    kind = F.schema_of_variant(record)
    status = F.when(F.trim("value") == "", "malformed").when(record.isNull(), "malformed").when(~kind.startswith("OBJECT"), "quarantined").otherwise("accepted")
    reason = F.when(F.trim("value") == "", "blank_physical_row").when(record.isNull(), "invalid_json").when(~kind.startswith("OBJECT"), "unsupported_non_object_schema")
    return rows.select("path", "value", status.alias("status"), reason.alias("reason"))
