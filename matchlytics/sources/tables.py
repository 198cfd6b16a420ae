"""Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from matchlytics.sources.raw import MissingSource


def read_table(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """A stored table, or only some of its columns."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise MissingSource(f"no table at {path}") from e
        raise
    return df.select(*columns) if columns else df


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        read_table(spark, path)
    except MissingSource:
        return False
    return True


def _write(df: DataFrame, path: str, mode: str, partition_by: Sequence[str], **options) -> int:
    # Counted while writing; a count of its own would run the whole plan again.
    rows = Observation()
    writer = df.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return rows.get["rows"]


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Adds the rows; returns how many."""
    return _write(df, path, "append", partition_by)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Replaces just the partitions that occur in ``df``, so loading a day again does not duplicate it."""
    return _write(df, path, "overwrite", partition_by, partitionOverwriteMode="dynamic")


def clear_partitions(spark: SparkSession, path: str, parts: Sequence[tuple[str, object] | None]) -> int:
    """Removes the partition folders whose leading columns have these values (None: any); returns how many there were.

    For a partition that has no rows any more, which an overwrite of the partitions that occur leaves as it was.
    """
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    folder = "/".join([path, *("*" if p is None else f"{p[0]}={escape(str(p[1]))}" for p in parts)])
    pattern = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(pattern)
    for status in found or []:
        files.delete(status.getPath(), True)
    return len(found or [])


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Replaces a whole table, which ``df`` may itself read.

    The new content is complete beside the old one before that is touched, and stays there should the swap be cut off.
    """
    staged = f"{path}__staged"
    rows = _write(df, staged, "overwrite", ())
    _write(df.sparkSession.read.schema(df.schema).parquet(staged), path, "overwrite", partition_by)
    return rows
