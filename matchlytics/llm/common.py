"""What the operators share: words, batches of bounded size, shared folders, workers' import path."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

import matchlytics

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(matchlytics.__file__)))

#: ASCII white space, as a character class: space and \\x09-\\x0D. ``bytes.split()`` splits at the same characters.
SPACE = r"[\x20\x09-\x0D]"

#: Text handled at a time inside a task, in bytes. Bounds the arrays built from it; results don't depend on it.
BLOCK = 4 << 20


def on_workers(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package also if the driver found it by ``sys.path`` alone."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, paths) if x)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables below ``spark.checkpoint.dir``, which all executors share.

    Only where that is unset and the session runs on one machine, as in tests, a temporary folder is set instead; on a
    cluster it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read back: no lineage, and their size is known to the planner."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(df: DataFrame) -> int:
    """How many tasks a repartition should make: what the session shuffles to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the column's decimal text, modulo. Null: null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    texts = batch.column(batch.schema.get_field_index(column))
    ends = np.cumsum(np.maximum(lengths(texts), 64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of each text, or of each list of numbers; null: 0."""
    found = pc.multiply(pc.list_value_length(texts), 8) if pa.types.is_list(texts.type) else pc.binary_length(texts)
    return pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts' bytes; null: empty."""
    return [x or b"" for x in texts.cast(pa.large_binary()).to_pylist()]


def map_blocks(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[dict] | dict]], schema: T.StructType, column: str = "text", size: int = BLOCK) -> DataFrame:
    """``mapInArrow`` over slices of bounded text size.

    ``make`` runs once in a task and returns the function from a slice to columns (a dict, or several).
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [f.name for f in schema]
    types = list(to_arrow_schema(schema).types)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in blocks(batch, column, size):
                found = step(part)
                for columns in [found] if isinstance(found, dict) else found:
                    arrays = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in ((columns[n], t) for n, t in zip(names, types))]
                    yield pa.RecordBatch.from_arrays([a.cast(t) if a.type != t else a for a, t in zip(arrays, types)], names=names)

    on_workers(df.sparkSession)
    return df.mapInArrow(run, schema)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def fresh(name: str, taken: Iterable[str]) -> str:
    """A column name that the table doesn't have yet."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def with_schema(df: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields)])
