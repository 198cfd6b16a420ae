from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t.orders`` is the orders table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str):
    """Registers a query of ``Tables`` under its function name."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
        ORACLES[build.__name__] = sql
        return build

    return register


def total(c: Column | str) -> Column:
    """Exact sum of an amount with two decimals, as double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def text(c: Column | str) -> Column:
    """A date as text, so that both engines hand it out alike."""
    return F.date_format(c, "yyyy-MM-dd")
