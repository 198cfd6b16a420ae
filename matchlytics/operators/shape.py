"""Projections and row shaping: no shuffle in any of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from matchlytics.functions.clean import to_decimal
from matchlytics.functions.nested import as_col, field


def flatten(df: DataFrame, fields: Mapping[str, Column | str | tuple]) -> DataFrame:
    """Flat columns ``{name: source}``; see ``field`` for the sources."""
    return df.select(*[field(source).alias(name) for name, source in fields.items()])


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns cast to ``{name: type}``; a value that does not fit becomes NULL."""

    def cast(c: str, type: str) -> Column:
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        return to_decimal(c, type) if numeric and type.startswith("decimal(") else F.col(c).try_cast(type)

    return df.withColumns({c: cast(c, t) for c, t in types.items()})


def role_rows(
    df: DataFrame,
    roles: Mapping[str, Mapping[str, Column | str]],
    shared: Sequence[str] = (),
    role: str | None = None,
) -> DataFrame:
    """One row per role of each input row, e.g. home and away side.

    All roles are exploded out of a single pass over the input.
    """
    structs = []
    for name, cols in roles.items():
        parts = [as_col(c).alias(out) for out, c in cols.items()]
        if role:
            parts.insert(0, F.lit(name).alias(role))
        structs.append(F.struct(*parts))
    return df.select(*shared, F.inline(F.array(*structs)))


def standardise(df: DataFrame, column: str, mapping: DataFrame, default: str | None = None) -> DataFrame:
    """Replace the synonyms of ``mapping(synonym, canonical)`` in a column.

    Unmapped values stay; NULL becomes ``default``.
    """
    names = mapping.groupBy(F.col("synonym").alias("__synonym")).agg(F.min("canonical").alias("__canonical"))
    value = F.coalesce("__canonical", column, *([F.lit(default)] if default is not None else []))
    return (
        df.join(names, F.col(column) == F.col("__synonym"), "left")
        .withColumn(column, value)
        .drop("__synonym", "__canonical")
    )
