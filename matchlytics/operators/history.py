"""Time-versioned rows (slowly changing dimensions)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from matchlytics.operators.ordered import top_k

OPEN_END = "9999-12-31"


def _list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def last_per_day(df: DataFrame, key, day: str, values: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """The last observation per key and day by ``tie``; combined map-side, so at most one row per key, day and task moves."""
    key = _list(key)
    cols = list(dict.fromkeys([*_list(tie), *values]))
    return (
        df.groupBy(*key, F.to_date(day).alias("__day"))
        .agg(F.max(F.struct(*cols)).alias("__last"))
        .select(*key, F.col("__day").alias(day), *[F.col(f"__last.{c}").alias(c) for c in values])
    )


def scd2(
    df: DataFrame,
    key: str | Sequence[str],
    day: str,
    tracked: Sequence[str],
    attrs: Sequence[str] = (),
    tie: str | Sequence[str] = (),
) -> DataFrame:
    """Versions of each key: a new one whenever a tracked value changes, NULL being a value.

    Versions are closed intervals of days and the last one is open until 9999-12-31. ``attrs`` come from the
    version's first observation; of several observations on a day the last by ``tie`` counts. The windows see one
    row per key and day and share one shuffle.
    """
    key, tracked, attrs = _list(key), list(tracked), list(attrs)
    by_day = Window.partitionBy(*key).orderBy("effective_from")
    seen = last_per_day(df, key, day, tracked + attrs, _list(tie)).withColumnRenamed(day, "effective_from")
    differs = reduce(
        Column.__or__, [~F.col(c).eqNullSafe(F.lag(c).over(by_day)) for c in tracked], F.row_number().over(by_day) == 1
    )
    open_end = F.lit(OPEN_END).cast("date")
    return (
        seen.where(F.col("effective_from").isNotNull())
        .withColumn("__new", differs)
        .where("__new")
        .withColumn("effective_to", F.coalesce(F.date_sub(F.lead("effective_from").over(by_day), 1), open_end))
        .select(*key, *tracked, *attrs, "effective_from", "effective_to", (F.col("effective_to") == open_end).alias("is_current"))
    )


def scd2_merge(
    existing: DataFrame,
    history: DataFrame,
    incoming: DataFrame,
    key: str | Sequence[str],
    day: str,
    tracked: Sequence[str],
    attrs: Sequence[str] = (),
    tie: str | Sequence[str] = (),
) -> DataFrame:
    """``existing`` versions after ``incoming`` observations, equal to a rebuild from everything.

    Only keys in ``incoming`` are computed anew, from their ``history`` of observations: the versions alone could not
    tell where a late observation splits one. Observations present in both may repeat.
    """
    key = _list(key)
    touched = incoming.select(*key).distinct()
    cols = list(dict.fromkeys([*key, day, *tracked, *attrs, *_list(tie)]))
    observed = history.join(touched, key, "left_semi").select(*cols).unionByName(incoming.select(*cols))
    rebuilt = scd2(observed, key, day, tracked, attrs, tie)
    return existing.join(touched, key, "left_anti").select(*rebuilt.columns).unionByName(rebuilt)


def scd2_day(
    existing: DataFrame,
    at: str,
    touched: DataFrame,
    observed: DataFrame,
    later: DataFrame,
    key: str | Sequence[str],
    day: str,
    tracked: Sequence[str],
    attrs: Sequence[str] = (),
    tie: str | Sequence[str] = (),
) -> DataFrame:
    """``existing`` versions once the observations of the day ``at`` have become ``observed``, equal to a rebuild.

    ``touched`` holds the keys that the day had before or has now, ``later`` the observations after it. A version tells
    what all observations in it were, so of each touched key only the version before the day, the day itself, the first
    later observation and the versions after it are lined up. Observations before the day are not needed, and for a day
    after all others there is no history to read at all. A key without any observation left has no version.
    """
    key, tracked, attrs, tie = _list(key), list(tracked), list(attrs), _list(tie)
    values, start = [*tracked, *attrs], "effective_from"
    at = F.lit(at).cast("date")
    touched = touched.select(*key).distinct()
    mine = existing.join(touched, key, "left_semi").where(F.col(start) != at).select(*key, *values, start)
    following = mine.where(F.col(start) > at).groupBy(*key).agg(F.min(start).alias("__next"))
    resumed = (
        last_per_day(later.where(F.to_date(day) > at).join(touched, key, "left_semi"), key, day, values, tie)
        .groupBy(*key)
        .agg(F.min(F.struct(F.col(day).alias(start), *values)).alias("__first"))
        .select(*key, "__first.*")
        .join(following, key, "left")
        .where(F.col("__next").isNull() | (F.col(start) < F.col("__next")))
    )
    now = last_per_day(observed.where(F.to_date(day) == at), key, day, values, tie).withColumnRenamed(day, start)
    lined_up = mine.unionByName(now.select(*mine.columns)).unionByName(resumed.select(*mine.columns))
    rebuilt = scd2(lined_up, key, start, tracked, attrs)
    return existing.join(touched, key, "left_anti").select(*rebuilt.columns).unionByName(rebuilt)


def changed_starts(before: DataFrame, after: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Versions present in only one of two version tables: facts inside their intervals may point elsewhere now."""
    on = [*_list(key), "effective_from"]
    cols = [*on, "effective_to"]
    gone = before.select(*cols).join(after.select(*on), on, "left_anti")
    new = after.select(*cols).join(before.select(*on), on, "left_anti")
    return gone.unionByName(new)


def check_intervals(versions: DataFrame, key: str | Sequence[str], valid: tuple[str, str] = ("effective_from", "effective_to")) -> DataFrame:
    """Versions that end before they start or reach into the next version of their key."""
    key, (start, end) = _list(key), valid
    following = F.lead(start).over(Window.partitionBy(*key).orderBy(start, end))
    return (
        versions.withColumn("next_from", following)
        .where((F.col(end) < F.col(start)) | (F.col("next_from") <= F.col(end)))
        .select(*key, start, end, "next_from")
    )


def latest(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key, by aggregation rather than a sorted window."""
    key = _list(key)
    rest = [c for c in df.columns if c not in key and c not in order]
    return (
        df.groupBy(*key)
        .agg(F.max(F.struct(*order, *rest)).alias("__last"))
        .select(*key, *[F.col(f"__last.{c}").alias(c) for c in df.columns if c not in key])
    )


def with_previous(df: DataFrame, key: str | Sequence[str], order: Sequence[str], col: str) -> DataFrame:
    """Current value of ``col`` per key beside the one it replaced.

    The value in force before the last change is the one, other than the current, that occurred last. So it suffices
    to keep the last occurrence of each distinct value.
    """
    key = _list(key)
    last_seen = df.groupBy(*key, col).agg(F.max(F.struct(*order)).alias("__at"))
    return (
        top_k(last_seen, key, [F.col("__at").desc()], 2, "__age")
        .groupBy(*key)
        .agg(
            F.max(F.when(F.col("__age") == 1, F.col(col))).alias(col),
            F.max(F.when(F.col("__age") == 2, F.col(col))).alias(f"previous_{col}"),
        )
    )
