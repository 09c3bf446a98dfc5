"""Session defaults for local work; on a cluster the submitter's settings hold."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "*", **extra: str) -> SparkSession:
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | extra
    spark = SparkSession.builder.master(f"local[{cores}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
