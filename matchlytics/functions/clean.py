"""Cleaning and classification columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from matchlytics.functions.nested import as_col


def null_outside(c: Column | str, lo, hi) -> Column:
    """The value if it lies in ``[lo, hi]``, else NULL."""
    c = as_col(c)
    return F.when(c.between(lo, hi), c)


def to_decimal(c: Column | str, type: str) -> Column:
    """A number as ``decimal(p,s)``, NULL if it has too many digits before the point.

    The size is tested first: a cast that fails costs an exception, far more than the test, on each row.
    """
    c = as_col(c)
    precision, scale = (int(n) for n in type.removeprefix("decimal(").removesuffix(")").split(","))
    return F.when(F.abs(c) < F.lit(10.0 ** (precision - scale)), c).try_cast(type)


def _ladder(steps: Sequence[tuple[Column, str]], default: str) -> Column:
    first, *rest = steps
    chain = reduce(lambda acc, s: acc.when(s[0], F.lit(s[1])), rest, F.when(first[0], F.lit(first[1])))
    return chain.otherwise(F.lit(default))


def classify_in(c: Column | str, steps: Sequence[tuple[Sequence[str], str]], default: str = "Other") -> Column:
    """Label of the first value list holding the column."""
    c = as_col(c)
    return _ladder([(c.isin(list(values)), label) for values, label in steps], default)


def classify_like(c: Column | str, steps: Sequence[tuple[Sequence[str], str]], default: str = "Unknown") -> Column:
    """Label of the first LIKE pattern list matching the column."""
    c = as_col(c)
    return _ladder([(reduce(Column.__or__, [c.like(p) for p in pats]), label) for pats, label in steps], default)


def clock_seconds(c: Column | str, max_seconds: int = 18000) -> Column:
    """Seconds of ``HH:mm:ss.SSS`` or ``mm:ss.SSS`` as decimal(10,3).

    NULL for anything else and beyond ``max_seconds``.
    """
    c = as_col(c)
    # Two parts lack the hour.
    parts = F.split(F.when(c.like("%:%:%"), c).otherwise(F.concat(F.lit("0:"), c)), ":")

    def part(i: int, type: str) -> Column:
        return F.get(parts, F.lit(i)).try_cast(type)

    seconds = (part(0, "int") * 3600 + part(1, "int") * 60 + part(2, "decimal(10,3)")).try_cast("decimal(10,3)")
    return F.when((F.size(parts) == 3) & (seconds <= max_seconds), seconds)


def date_key(c: Column | str) -> Column:
    """Integer ``yyyyMMdd``."""
    c = as_col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def year_bucket(date_id: Column | str, first: int, last: int) -> Column:
    """Storage range of a ``yyyyMMdd`` key: its year, or ``default`` for NULL and other years."""
    year = F.floor(as_col(date_id) / 10000).cast("int")
    return F.when(year.between(first, last), year.cast("string")).otherwise(F.lit("default"))


def short_name(c: Column | str) -> Column:
    """First and last word of a name of more than two words, else NULL."""
    parts = F.split(F.trim(as_col(c)), r"\s+")
    return F.when(F.size(parts) > 2, F.concat_ws(" ", F.get(parts, F.lit(0)), F.element_at(parts, -1)))
