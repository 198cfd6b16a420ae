"""Aggregations. All combine map-side before their shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from matchlytics.functions.metrics import safe_sum
from matchlytics.functions.nested import as_col


def cond_counts(
    df: DataFrame,
    group: Sequence[str],
    counts: Mapping[str, Column] | None = None,
    sums: Mapping[str, tuple] | None = None,
    **more: Column,
) -> DataFrame:
    """Counts of rows meeting each predicate and exact null-safe sums, in one pass.

    ``sums`` holds ``{output: (column, decimal type)}`` or ``(column, decimal type, limit)``; ``more`` further aggregates.
    """
    aggs = [F.count_if(p).alias(name) for name, p in (counts or {}).items()]
    aggs += [safe_sum(*spec).alias(name) for name, spec in (sums or {}).items()]
    aggs += [c.alias(name) for name, c in more.items()]
    return df.groupBy(*group).agg(*aggs)


def opponent_total(df: DataFrame, match: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Adds ``<c>_match``, the total of the match, and ``<c>_opponent``, the total less the row's own.

    Takes one row per match and team, so a match is a handful of rows.
    """
    w = Window.partitionBy(*match)
    totals = df.withColumns({f"{c}_match": F.sum(c).over(w) for c in cols})
    return totals.withColumns({f"{c}_opponent": F.col(f"{c}_match") - F.col(c) for c in cols})


def distinct_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per non-null key; of several values the smallest stays, whatever the row order."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))


# How partial results of a finer level make up those of a coarser one.
MERGES = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def _levels(df: DataFrame, dims: Sequence[str], measures: Mapping[str, tuple[str, Column | str]], kind: str, level: Column) -> DataFrame:
    """Rows are aggregated once, to the finest level; only its groups are multiplied by the number of levels."""
    parts: dict[str, Column] = {}
    merged: list[Column] = []
    for name, (how, c) in measures.items():
        if how == "avg":
            parts |= {f"__sum_{name}": F.sum(c), f"__count_{name}": F.count(c)}
            merged.append(F.try_divide(F.sum(f"__sum_{name}"), F.sum(f"__count_{name}")).alias(name))
        else:
            parts[f"__{name}"] = getattr(F, how)(c)
            merged.append(MERGES[how](f"__{name}").alias(name))
    finest = df.groupBy(*dims).agg(*[c.alias(n) for n, c in parts.items()])
    return getattr(finest, kind)(*dims).agg(level, *merged)


def rollup_levels(df: DataFrame, dims: Sequence[str], measures: Mapping[str, tuple[str, Column | str]]) -> DataFrame:
    """Measures at every prefix of the hierarchy; ``level`` counts the dimensions that are kept.

    A measure is (how, column), ``how`` being sum, count, min, max or avg.
    """
    kept = len(dims) - sum(F.grouping(d).cast("int") for d in dims)
    return _levels(df, dims, measures, "rollup", kept.alias("level"))


def cube_levels(df: DataFrame, dims: Sequence[str], measures: Mapping[str, tuple[str, Column | str]]) -> DataFrame:
    """Measures, as for ``rollup_levels``, for every subset of the dimensions; ``grouping_id`` has a bit per dropped dimension."""
    return _levels(df, dims, measures, "cube", F.grouping_id().alias("grouping_id"))


def pivot_table(
    df: DataFrame, rows: Sequence[str], column: str, values: Sequence, measure: Column, empty=None
) -> DataFrame:
    """One output column per listed value, without a job to find the values."""
    table = df.groupBy(*rows).pivot(column, list(values)).agg(measure)
    return table if empty is None else table.fillna(empty, [str(v) for v in values])


def correlation(df: DataFrame, x: Column | str, y: Column | str, group: Sequence[str] = (), out: str = "correlation") -> DataFrame:
    return df.groupBy(*group).agg(F.corr(as_col(x), as_col(y)).alias(out))


def histogram(df: DataFrame, value: Column | str, width: float, group: Sequence[str] = ()) -> DataFrame:
    """Rows per bin ``[bin_from, bin_from + width)``; NULL values form a bin of their own."""
    number = F.floor(as_col(value) / width)
    return (
        df.groupBy(*group, number.alias("bin"))
        .agg(F.count("*").alias("rows"))
        .withColumn("bin_from", F.col("bin") * F.lit(float(width)))
    )


def grid(df: DataFrame, x: Column | str, y: Column | str, cell_x: float, cell_y: float, group: Sequence[str] = ()) -> DataFrame:
    """Rows per cell of a regular grid; rows without both coordinates are left out."""
    x, y = as_col(x), as_col(y)
    cells = [F.floor(x / cell_x).alias("cell_x"), F.floor(y / cell_y).alias("cell_y")]
    return df.where(x.isNotNull() & y.isNotNull()).groupBy(*group, *cells).agg(F.count("*").alias("rows"))
