"""Constraint checks as queries over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from matchlytics.operators.lookup import join_loss


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def check_fk(df: DataFrame, references: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Per reference the rows and keys without a parent; a NULL key refers to nothing and passes."""
    present = {
        name: (df.dropna(subset=list(keys)), dim, keys) for name, (dim, keys) in references.items()
    }
    losses = [join_loss(rows, {name: (dim, keys)}) for name, (rows, dim, keys) in present.items()]
    return reduce(DataFrame.unionByName, losses).select(
        F.col("lookup").alias("reference"), "rows", "unmatched_rows", "unmatched_keys"
    )


def _unpivot(row: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    others = [c for c in row.columns if c not in names]
    return row.unpivot(others, list(names), label, value)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, rows, nulls`` for each column, in one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _unpivot(counted, columns, "column", "nulls")


def check_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``rule, rows, violations`` in one pass; as in a CHECK, an unknown outcome passes."""
    counted = df.agg(F.count("*").alias("rows"), *[F.count_if(~p).alias(name) for name, p in rules.items()])
    return _unpivot(counted, list(rules), "rule", "violations")


def tag_rejects(df: DataFrame, rules: Mapping[str, Column], out: str = "reject_reason") -> DataFrame:
    """Adds the names of the broken rules, or NULL; here an unknown outcome breaks the rule."""
    broken = [F.when(~F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in rules.items()]
    return df.withColumn(out, F.nullif(F.concat_ws(",", *broken), F.lit("")))


def split_rejects(df: DataFrame, rules: Mapping[str, Column], out: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Accepted rows as they came, and rejected rows with their reason."""
    tagged = tag_rejects(df, rules, out)
    return tagged.where(F.col(out).isNull()).drop(out), tagged.where(F.col(out).isNotNull())
