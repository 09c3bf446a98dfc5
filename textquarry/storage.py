"""Written intermediate tables.

Lineage is cut by writing a table to the folder that the session names in
``spark.checkpoint.dir``; every executor and the driver see that folder, so a
table outlives any executor.  Where the setting is missing and Spark runs in this
process alone (tests, a laptop), a folder of this process stands in; on a cluster
it must be set.  Tables lie in a folder of the application and stay until
:func:`forget` or :func:`clear` deletes them: a plan may read them at any time.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The shared folder's URI, without a trailing slash."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors and the driver share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="textquarry-"))
            atexit.register(shutil.rmtree, _own[0], True)
        named = f"file://{_own[0]}"
    return named.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{_application(spark)}/{label}-{uuid.uuid4().hex}"


def _application(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/textquarry/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Delete all tables and archives that this application has written here; for the end of a job, when no plan reads them any more."""
    remove(spark, _application(spark))


#: Deletes a plan's shuffle files when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the reread table; what it shuffled is deleted at once."""
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path  # noqa: SLF001
    return out


def forget(df: DataFrame) -> None:
    """Delete a table made by :func:`written` that nothing reads any more."""
    path = getattr(df, "_written_path", None)
    if path:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with Spark's own file system client."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)  # noqa: SLF001


#: Settings that bound what a task holds of a table at once, and the most that this engine leaves them at.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20,
    "spark.sql.parquet.columnarReaderBatchSize": 256,
}


def small_batches(spark: SparkSession) -> None:
    """Let batches between Spark and Python, and of Parquet readers, hold few rows and bytes: long texts and packed rows make the defaults very large.

    The settings are read when a plan runs, which may be long after the caller
    has it; so they are lowered for the session, and never raised.
    """
    for name, most in BATCHES.items():
        now = spark.conf.get(name, None)
        number = (now or "").removesuffix("b")
        if not number.isdigit() or not 0 < int(number) <= most:
            spark.conf.set(name, str(most))
