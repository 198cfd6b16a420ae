"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# On a cluster: many small reducers to begin with, merged by size at run time; large ones split when skewed.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles a method of more bytecodes than this; wide projections run in smaller pieces instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the call site of every column doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configured(builder: SparkSession.Builder, settings: dict[str, str] | None = None) -> SparkSession.Builder:
    """The builder with these settings, overridden by ``settings``."""
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder


def local(cpus: int | str, shuffle_partitions: int | str | None = None) -> SparkSession:
    """A session in this process, for tests and measurements."""
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cpus),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    }
    spark = configured(SparkSession.builder.master(f"local[{cpus}]").appName("matchlytics"), settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
