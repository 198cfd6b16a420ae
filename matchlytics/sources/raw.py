"""Raw JSON documents, laid out as ``<root>/<kind>/date=YYYY-MM-DD/<match_id>.json``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from matchlytics.functions import id_from_path
from matchlytics.sources.schemas import RAW


class MissingSource(Exception):
    """The folder of a raw kind does not exist."""


def _scan(spark: SparkSession, folder: str, base: str, schema: str, multi_line: bool) -> DataFrame | None:
    reader = spark.read.schema(schema).option("basePath", base).option("mode", "FAILFAST").option("multiLine", multi_line)
    try:
        return reader.json(folder)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_raw(
    spark: SparkSession, root: str, kind: str, date: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Rows of a raw kind, with ``date`` from the folder and ``match_id`` from the file name where rows lack it.

    With ``date`` only that day's folder is listed; a day without files gives no rows. A missing kind raises
    ``MissingSource`` and a malformed document fails the job.
    """
    base = f"{root}/{kind}"
    schema = f"{RAW[kind]}, date date"
    df = _scan(spark, f"{base}/date={date}" if date else base, base, schema, multi_line)
    if df is None and date:
        # No files that day: only whether the kind exists is left to find out, by its folder alone.
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            df = spark.createDataFrame([], schema)
            if "match_id" not in df.columns:
                df = df.select(F.lit(None).cast("bigint").alias("match_id"), "*")
    if df is None:
        raise MissingSource(f"no raw {kind} under {base}")
    if "match_id" in df.columns:
        return df
    return df.select(id_from_path("_metadata.file_path").alias("match_id"), "*")
