"""Access to nested columns that never fails on a missing element or field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field(source: Column | str | tuple) -> Column:
    """A column from ``"a.b.c"``, ``("a.b", 0)`` or ``("a.b", 0, "name")``.

    An index outside the array gives NULL.
    """
    if not isinstance(source, tuple):
        return as_col(source)
    array, index, *rest = source
    value = F.get(as_col(array), F.lit(index))
    for name in rest:
        value = value.getField(name)
    return value


def has_field(schema: T.StructType, path: str) -> bool:
    """Whether the dotted path leads through structs to a field of the schema."""
    node: T.DataType = schema
    for name in path.split("."):
        if not isinstance(node, T.StructType) or name not in node.names:
            return False
        node = node[name].dataType
    return True


def optional_col(df: DataFrame, path: str, default=None, type: str = "string") -> Column:
    """The column at ``path`` if the schema has it, else a typed default."""
    value = F.col(path) if has_field(df.schema, path) else F.lit(default)
    return value.cast(type)


def coalesce_leaf(df: DataFrame, leaf: str, type: str = "string") -> Column:
    """First non-null ``<struct>.<leaf>`` over the top-level structs, in schema order."""
    found = [
        F.col(f"`{f.name}`.{leaf}")
        for f in df.schema.fields
        if isinstance(f.dataType, T.StructType) and has_field(f.dataType, leaf)
    ]
    return (F.coalesce(*found) if found else F.lit(None)).cast(type)


def first_point(*arrays: Column | str) -> tuple[Column, Column]:
    """x and y of the first array that has them, each axis on its own."""
    cols = [as_col(a) for a in arrays]
    return tuple(F.coalesce(*[F.get(c, F.lit(axis)) for c in cols]) for axis in (0, 1))


def hash_key(*cols: Column | str) -> Column:
    """Surrogate key that every run and every partition computes alike.

    Each part is written with its length, and NULL as a mark, so that no two rows of parts are written alike.
    """
    texts = [as_col(c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws("~", *parts))


def id_from_path(path: Column | str) -> Column:
    """The number that names a JSON document, NULL if there is none."""
    return F.nullif(F.regexp_extract(as_col(path), r"(\d+)\.json", 1), F.lit("")).try_cast("bigint")
