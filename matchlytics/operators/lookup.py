"""Dimension lookups. Every join keeps an equality, so none becomes a nested loop."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from matchlytics.functions.nested import as_col

def _pairs(keys: Sequence[str] | Mapping[str, str]) -> list[tuple[str, str]]:
    return list(keys.items()) if isinstance(keys, Mapping) else [(k, k) for k in keys]


def _taken(take: Sequence[str] | Mapping[str, str], prefix: str) -> dict[str, str]:
    return dict(take) if isinstance(take, Mapping) else {prefix + c: c for c in take}


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__and__, conditions)


_SLOTS = {
    "year": lambda c: F.year(c),
    "month": lambda c: F.year(c) * 12 + F.month(c),
}


def temporal_lookup(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    at: str,
    take: Sequence[str] | Mapping[str, str],
    prefix: str = "",
    valid: tuple[str, str] = ("effective_from", "effective_to"),
    period: str | None = None,
    horizon: Column | None = None,
) -> DataFrame:
    """Left join with the version of ``dim`` that was valid at ``facts.at``; unmatched facts are kept.

    ``keys`` are shared names or ``{fact column: dim column}``, ``take`` names or ``{output: dim column}``.

    With ``period`` ("year" or "month") each version is laid out over the periods it touches, and the period joins
    the equality keys: a key with many facts and many versions is then split by time, and a fact only meets the
    versions of its own period. Open versions are laid out up to ``horizon``, a day after which none starts, such as
    ``table.agg(max(day)).scalar()``; left out, it is found by a scan of ``dim``.
    """
    pairs, taken = _pairs(keys), _taken(take, prefix)
    start, end = valid
    versions = dim.where(F.col(start) <= F.col(end)).select(
        *[F.col(d).alias(f"__k{i}") for i, (_, d) in enumerate(pairs)],
        F.col(start).alias("__from"),
        F.col(end).alias("__to"),
        *[F.col(d).alias(f"__take_{out}") for out, d in taken.items()],
    )
    on = [F.col(f) == F.col(f"__k{i}") for i, (f, _) in enumerate(pairs)]
    if period:
        slot = _SLOTS[period]
        # No version starts after the horizon, so all later days can share its slot.
        horizon = versions.agg(F.max("__from")).scalar() if horizon is None else horizon
        versions = versions.withColumn(
            "__slot", F.explode(F.sequence(slot(F.col("__from")), slot(F.least("__to", horizon))))
        )
        day = F.to_date(at)
        facts = facts.withColumn("__at_slot", F.when(day.isNotNull(), slot(F.least(day, horizon))))
        on.append(F.col("__at_slot") == F.col("__slot"))
    kept = [c for c in facts.columns if c != "__at_slot"]
    on += [F.col(at) >= F.col("__from"), F.to_date(at) <= F.col("__to")]
    return facts.join(versions, _all(on), "left").select(
        *[F.col(f"`{c}`") for c in kept], *[F.col(f"__take_{out}").alias(out) for out in taken]
    )


def null_safe_lookup(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    take: Sequence[str] | Mapping[str, str],
    prefix: str = "",
) -> DataFrame:
    """Left join in which NULL equals NULL.

    Nothing runs while the plan is built: Spark broadcasts the dimension if it measures it as small when the query runs, and
    otherwise splits the parts of frequent keys.
    """
    pairs, taken = _pairs(keys), _taken(take, prefix)
    rows = dim.select(
        *[F.col(d).alias(f"__k{i}") for i, (_, d) in enumerate(pairs)],
        *[F.col(d).alias(f"__take_{out}") for out, d in taken.items()],
    )
    on = [F.col(f).eqNullSafe(F.col(f"__k{i}")) for i, (f, _) in enumerate(pairs)]
    return facts.join(rows, _all(on), "left").select(
        *[F.col(f"`{c}`") for c in facts.columns], *[F.col(f"__take_{out}").alias(out) for out in taken]
    )


def fallback_lookup(
    df: DataFrame,
    ref: DataFrame,
    attempts: Sequence[Column | str],
    ref_key: str,
    value: str,
    out: str,
    valid: tuple | None = None,
) -> DataFrame:
    """Value of the first attempted key that ``ref`` knows, dropped when outside ``valid``.

    A later key is only tried where the earlier ones were not found. If ``out`` exists, only its NULLs are filled.
    """
    known = ref.where(F.col(ref_key).isNotNull()).groupBy(F.col(ref_key).alias("__key")).agg(F.min(value).alias("__value"))
    current = df
    found = []
    for i, attempt in enumerate(attempts):
        current = current.withColumn(f"__try{i}", as_col(attempt)).join(
            known.select(F.col("__key").alias(f"__key{i}"), F.col("__value").alias(f"__value{i}")),
            F.col(f"__try{i}") == F.col(f"__key{i}"),
            "left",
        )
        found.append((F.col(f"__key{i}").isNotNull(), F.col(f"__value{i}")))
    (first, first_value), *others = found
    chosen = reduce(lambda acc, f: acc.when(*f), others, F.when(first, first_value))
    if valid:
        chosen = F.when(chosen.between(*valid), chosen)
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    filled = F.coalesce(out, chosen) if out in df.columns else chosen
    return current.select(*kept, filled.alias(out))


def join_loss(df: DataFrame, lookups: Mapping[str, tuple[DataFrame, Sequence[str] | Mapping[str, str]]]) -> DataFrame:
    """Per lookup: rows and distinct keys going in, and how many of them find no partner.

    Rows are counted per key first, so a frequent key reaches the join as one row.
    """
    reports = []
    for name, (dim, keys) in lookups.items():
        pairs = _pairs(keys)
        counted = df.groupBy(*[F.col(f).alias(f"__f{i}") for i, (f, _) in enumerate(pairs)]).agg(F.count("*").alias("__n"))
        known = dim.select(*[F.col(d).alias(f"__k{i}") for i, (_, d) in enumerate(pairs)]).distinct()
        lost = F.col("__k0").isNull()
        on = _all([F.col(f"__f{i}") == F.col(f"__k{i}") for i in range(len(pairs))])
        reports.append(
            counted.join(known, on, "left").agg(
                F.lit(name).alias("lookup"),
                F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(lost, F.col("__n"))), F.lit(0)).alias("unmatched_rows"),
                F.count("*").alias("keys"),
                F.count_if(lost).alias("unmatched_keys"),
            )
        )
    return reduce(DataFrame.unionByName, reports)
