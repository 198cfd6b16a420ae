"""Sums of vectors over all rows: added up in each task, then by Spark for each place of the vector."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchlytics.llm.common import on_workers


def vector_sum(df: DataFrame, size: int, part: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum over all batches of ``part``'s vector of fixed ``size``. What reaches the driver doesn't grow with the rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(batch)
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total[places])], names=["place", "value"])

    on_workers(df.sparkSession)
    found = df.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros(size)
    out[found["place"].to_numpy(np.int64)] = found["value"].to_numpy(float)
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
