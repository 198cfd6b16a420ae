"""Incremental selection and merging of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def only_date(df: DataFrame, column: str, date: str) -> DataFrame:
    """Rows of one day, as a range on the bare column so that it prunes files and partitions.

    The column holds dates, timestamps or ISO strings.
    """
    c = F.col(column)
    type = df.schema[column].dataType.simpleString()
    day = F.lit(date).cast("date")
    if type in ("date", "string"):
        return df.where(c == (day if type == "date" else F.lit(date)))
    return df.where((c >= day.cast(type)) & (c < F.date_add(day, 1).cast(type)))


def only_configured(df: DataFrame, config: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys occur in the configuration table."""
    return df.join(config.select(*keys), list(keys), "left_semi")


def not_loaded(incoming: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not in the store yet."""
    return incoming.join(loaded.select(*keys), list(keys), "left_anti")


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows and the existing ones they do not replace."""
    return not_loaded(existing, incoming, keys).unionByName(incoming)


def retract(existing: DataFrame, gone: DataFrame, elsewhere: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` without the keys in ``gone`` that ``elsewhere`` does not hold either."""
    keys = list(keys)
    lost = not_loaded(gone.select(*keys).distinct(), elsewhere, keys)
    return not_loaded(existing, lost, keys)


def fill_nulls(existing: DataFrame, values: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``existing`` with ``column`` taken from ``values`` (one row a key) where it is NULL, and nowhere else."""
    keys = list(keys)
    known = values.where(F.col(column).isNotNull()).select(*keys, F.col(column).alias("__value"))
    return existing.join(known, keys, "left").withColumn(column, F.coalesce(column, "__value")).select(*existing.columns)
