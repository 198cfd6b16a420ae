from __future__ import annotations

import pytest
from pyspark.sql import types as T

from matchlytics.llm.common import on_workers

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Builds documents from (doc_id, text) pairs, with an extra column; may be none."""
    on_workers(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()), T.StructField("ids", T.StringType())])

    def build(rows, parts: int = 3):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "s", "extra") for r in rows], schema).repartition(parts)

    return build
