"""Operators over the rows of a group in order.

Spark sorts all rows of a window group in one task. Where a group may grow without bound, pass ``bucket``: a column
that never falls along the order (the day of a timestamp, ``floor(index / 1000)``). Each operator then sorts within
(group, bucket) and learns what it needs of the other buckets from one carried row per bucket, aggregated map-side.
The result is the same as without buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from matchlytics.functions.nested import as_col


def _neighbour(df, partition, order, values, bucket, forward: bool) -> DataFrame:
    partition, order = list(partition), list(order)
    payload = F.struct(*[as_col(c).alias(out) for out, c in values.items()])
    step = F.lead if forward else F.lag
    outputs = [F.col(f"__other.{out}").alias(out) for out in values]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in values]
    rows = df.withColumn("__payload", payload)
    if bucket is None:
        w = Window.partitionBy(*partition).orderBy(*order)
        return rows.withColumn("__other", step("__payload").over(w)).select(*kept, *outputs)

    rows = rows.withColumn("__bucket", bucket).withColumn("__edge", F.lit(0))
    edge = F.min if forward else F.max
    buckets = Window.partitionBy(*partition).orderBy("__bucket")
    shift, position = (F.lag, F.row_number().over(buckets)) if forward else (
        F.lead, F.row_number().over(Window.partitionBy(*partition).orderBy(F.col("__bucket").desc_nulls_last()))
    )
    # The first row of each bucket follows the rows of the bucket before (or the last one precedes those after).
    carried = (
        rows.groupBy(*partition, "__bucket")
        .agg(edge(F.struct(*order, "__payload")).alias("__row"))
        .withColumn("__position", position)
        .withColumn("__bucket", shift("__bucket").over(buckets))
        .where(F.col("__position") > 1)
        .select(*partition, "__bucket", "__row.__payload", F.lit(1 if forward else -1).alias("__edge"))
    )
    w = Window.partitionBy(*partition, "__bucket").orderBy("__edge", *order)
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn("__other", step("__payload").over(w))
        .where(F.col("__edge") == 0)
        .select(*kept, *outputs)
    )


def next_value(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column | str],
    bucket: Column | None = None,
) -> DataFrame:
    """Adds ``{output: column}`` as seen in the next row of the group; NULL at its end."""
    return _neighbour(df, partition, order, values, bucket, forward=True)


def previous_value(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column | str],
    bucket: Column | None = None,
) -> DataFrame:
    """Adds ``{output: column}`` as seen in the row before; NULL at the start of the group."""
    return _neighbour(df, partition, order, values, bucket, forward=False)


def running_total(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    value: Column | str,
    out: str,
    bucket: Column | None = None,
) -> DataFrame:
    """Adds the sum of ``value`` up to and including each row."""
    partition, order = list(partition), list(order)
    rows = df.withColumn("__value", as_col(value))
    upto = (Window.unboundedPreceding, Window.currentRow)
    if bucket is None:
        w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(*upto)
        return rows.withColumn(out, F.sum("__value").over(w)).drop("__value")

    rows = rows.withColumn("__bucket", bucket).withColumn("__edge", F.lit(0))
    total_type = rows.select(F.sum("__value").alias("t")).schema["t"].dataType
    rows = rows.withColumn("__value", F.col("__value").cast(total_type))
    before = Window.partitionBy(*partition).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*partition, "__bucket")
        .agg(F.sum("__value").alias("__sum"))
        .select(
            *partition,
            "__bucket",
            F.sum("__sum").over(before).cast(total_type).alias("__value"),
            F.lit(-1).alias("__edge"),
        )
    )
    w = Window.partitionBy(*partition, "__bucket").orderBy("__edge", *order).rowsBetween(*upto)
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(out, F.sum("__value").over(w))
        .where(F.col("__edge") == 0)
        .drop("__value", "__bucket", "__edge")
    )


def row_index(
    df: DataFrame, partition: Sequence[str], order: Sequence[str], out: str, bucket: Column | None = None
) -> DataFrame:
    """Adds the 1-based position of each row in its group."""
    return running_total(df, partition, order, F.lit(1), out, bucket)


def in_order(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    following: Mapping[str, Column | str] | None = None,
    previous: Mapping[str, Column | str] | None = None,
    totals: Mapping[str, Column | str] | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """``next_value``, ``previous_value`` and ``running_total`` in one sort: several things to know of a group's order at once.

    ``following`` and ``previous`` are {output: column} of the neighbours, ``totals`` {output: value} summed up to each row;
    ``F.lit(1)`` gives the position. With ``bucket`` one aggregation yields all that a bucket must know of the others: the last
    row before it, the first after it and the sums so far. That row stands at both ends of the bucket.
    """
    partition, order = list(partition), list(order)
    following, previous, totals = dict(following or {}), dict(previous or {}), dict(totals or {})

    def payload(values: Mapping[str, Column | str]) -> Column:
        return F.struct(F.lit(True).alias("__there"), *[as_col(c).alias(out) for out, c in values.items()])

    rows = df.select("*", payload(following).alias("__to_before"), payload(previous).alias("__to_after"), *[as_col(c).alias(f"__value_{out}") for out, c in totals.items()])
    upto = (Window.unboundedPreceding, Window.currentRow)
    if bucket is None:
        w, lined_up, mine = Window.partitionBy(*partition).orderBy(*order), rows, F.lit(True)
    else:
        rows = rows.withColumn("__bucket", bucket).withColumn("__edge", F.lit(0))
        types = {out: rows.select(F.sum(f"__value_{out}").alias("t")).schema["t"].dataType for out in totals}
        rows = rows.withColumns({f"__value_{out}": F.col(f"__value_{out}").cast(t) for out, t in types.items()})
        buckets = Window.partitionBy(*partition).orderBy("__bucket")
        ends = rows.groupBy(*partition, "__bucket").agg(
            F.min(F.struct(*order, "__to_before")).alias("__first"),
            F.max(F.struct(*order, "__to_after")).alias("__last"),
            *[F.sum(f"__value_{out}").alias(f"__sum_{out}") for out in totals],
        )
        before = buckets.rowsBetween(Window.unboundedPreceding, -1)
        sums = [F.coalesce(F.sum(f"__sum_{out}").over(before), F.lit(0)).cast(t).alias(f"__value_{out}") for out, t in types.items()]
        known = ends.select(*partition, "__bucket", F.lag("__last.__to_after").over(buckets).alias("__to_after"), F.lead("__first.__to_before").over(buckets).alias("__to_before"), *sums)
        carried = known.select("*", F.explode(F.array(F.lit(-1), F.lit(1))).alias("__edge"))
        lined_up = rows.unionByName(carried, allowMissingColumns=True)
        # The sums so far count at the head of the bucket only.
        lined_up = lined_up.withColumns({f"__value_{out}": F.when(F.col("__edge") <= 0, F.col(f"__value_{out}")) for out in totals})
        w, mine = Window.partitionBy(*partition, "__bucket").orderBy("__edge", *order), F.col("__edge") == 0
    found = lined_up.select(
        "*",
        F.lead("__to_before").over(w).alias("__next"),
        F.lag("__to_after").over(w).alias("__previous"),
        *[F.sum(f"__value_{out}").over(w.rowsBetween(*upto)).alias(f"__total_{out}") for out in totals],
    ).where(mine)
    outputs = {**{o: f"__next.{o}" for o in following}, **{o: f"__previous.{o}" for o in previous}, **{o: f"__total_{o}" for o in totals}}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in outputs]
    return found.select(*kept, *[F.col(c).alias(o) for o, c in outputs.items()])


def recent(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    n: int,
    measures: Mapping[str, Column],
    bucket: Column | None = None,
    block: int = 10_000,
) -> DataFrame:
    """Adds aggregates ``{output: aggregate}`` over the last ``n`` rows including the current one.

    With ``bucket`` the rows are numbered and cut into blocks; the last ``n - 1`` rows of a block also go to the next.
    """
    partition, order = list(partition), list(order)
    if bucket is None:
        w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(-(n - 1), 0)
        return df.withColumns({out: m.over(w) for out, m in measures.items()})

    block = max(block, n)
    place = F.col("__index") - 1
    home = F.floor(place / block)
    also_next = place % block > block - n
    copies = F.when(also_next, F.array(home, home + 1)).otherwise(F.array(home))
    rows = (
        row_index(df, partition, order, "__index", bucket)
        .withColumn("__home", home)
        .withColumn("__block", F.explode(copies))
    )
    w = Window.partitionBy(*partition, "__block").orderBy("__index").rowsBetween(-(n - 1), 0)
    return (
        rows.withColumns({out: m.over(w) for out, m in measures.items()})
        .where(F.col("__block") == F.col("__home"))
        .drop("__index", "__home", "__block")
    )


def league_position(
    df: DataFrame, group: Sequence[str], value: str, bucket: Column | None = None
) -> DataFrame:
    """Adds ``rank`` (1 = highest value) and ``percentile`` (0 = highest, 1 = lowest) within the group.

    Rows are counted per value first, so however many share one, they are a single row in the windows; the rank then joins
    back by (group, value), a key whose rows Spark can split. ``bucket``, which must be the same for equal values, bounds the
    distinct values that are sorted together.
    """
    group = list(group)
    counted = (
        df.groupBy(*group, F.col(value).alias("__value"), (F.lit(0) if bucket is None else bucket).alias("__bucket"))
        .agg(F.count("*").alias("__rows"))
    )
    higher = (Window.unboundedPreceding, -1)
    falling = Window.partitionBy(*group, "__bucket").orderBy(F.col("__value").desc_nulls_last())
    above, total = F.sum("__rows").over(falling.rowsBetween(*higher)), F.sum("__rows").over(Window.partitionBy(*group))
    if bucket is None:
        ranked = counted.withColumn("__above", F.coalesce(above, F.lit(0))).withColumn("__total", total)
    else:
        # One row a bucket carries what lies above it; it stands first among the bucket's values.
        over = Window.partitionBy(*group).orderBy(F.col("__bucket").desc_nulls_last()).rowsBetween(*higher)
        carried = counted.groupBy(*group, "__bucket").agg(F.sum("__rows").alias("__rows")).select(
            *group, "__bucket", F.lit(0).alias("__first"), F.coalesce(F.sum("__rows").over(over), F.lit(0)).alias("__rows"), total.alias("__total")
        )
        lined_up = Window.partitionBy(*group, "__bucket").orderBy("__first", F.col("__value").desc_nulls_last())
        ranked = (
            counted.withColumn("__first", F.lit(1))
            .unionByName(carried, allowMissingColumns=True)
            .withColumn("__above", F.sum("__rows").over(lined_up.rowsBetween(*higher)))
            .withColumn("__total", F.first("__total", ignorenulls=True).over(lined_up))
            .where(F.col("__first") == 1)
        )
    kind = "int" if bucket is None else "bigint"
    ranked = ranked.select(
        *[F.col(c).alias(f"__of_{i}") for i, c in enumerate(group)],
        "__value",
        (F.col("__above") + 1).cast(kind).alias("rank"),
        F.coalesce(F.try_divide(F.col("__above"), F.col("__total") - 1), F.lit(0.0)).alias("percentile"),
    )
    on = [F.col(c).eqNullSafe(F.col(f"__of_{i}")) for i, c in enumerate(group)] + [F.col(value).eqNullSafe(F.col("__value"))]
    kept = [F.col(f"`{c}`") for c in df.columns]
    return df.join(ranked, reduce(Column.__and__, on)).select(*kept, "rank", "percentile")


def top_k(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int, out: str = "position"
) -> DataFrame:
    """The first ``k`` rows of each group, numbered. Spark cuts to ``k`` per group before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)
