"""Monthly totals per entity, kept as one wide row until the very end.

With a fixed list of months, a month is a column: one hash aggregate yields all of them,
joins move one row per entity instead of one per month, and the dense entity x month grid
comes from unpivoting that row. No cross join and no range join is needed.

For spans of any length there are no columns but changes: an interval adds its value in its
first month and takes it away after its last one; a running sum over the months in which
something changes gives the value until the next change.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from estrato.functions.dates import next_month


def spine(spark, months: list[dt.date], name: str = "mes_inicio") -> DataFrame:
    """The month list as a table."""
    first, last = F.lit(months[0]), F.lit(months[-1])
    step = F.expr("interval 1 month")
    return spark.range(1).select(F.explode(F.sequence(first, last, step)).alias(name))


def monthly_sums(
    df: DataFrame, entity: str, day: str, value: Column, months: list[dt.date], prefix: str
) -> DataFrame:
    """Sum per entity and calendar month; NULL where a month has no rows."""
    at = F.col(day)
    window = (at >= F.lit(months[0])) & (at < F.lit(next_month(months[-1])))
    sums = [
        F.sum(F.when((at >= F.lit(m)) & (at < F.lit(next_month(m))), value)).alias(f"{prefix}{i}")
        for i, m in enumerate(months)
    ]
    return df.filter(window).groupBy(entity).agg(*sums)


def overlap_sums(
    df: DataFrame,
    entity: str,
    start: str,
    end: str,
    value: Column,
    months: list[dt.date],
    prefix: str,
) -> DataFrame:
    """Sum per entity over every month that the interval [start, end] touches."""

    def touches(first: dt.date, last: dt.date) -> Column:
        return (F.col(start) < F.lit(next_month(last))) & (F.col(end) >= F.lit(first))

    sums = [
        F.sum(F.when(touches(m, m), value)).alias(f"{prefix}{i}") for i, m in enumerate(months)
    ]
    return df.filter(touches(months[0], months[-1])).groupBy(entity).agg(*sums)


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def _month_start(number: Column) -> Column:
    return F.make_date(F.floor(number / 12).cast("int"), number % 12 + 1, F.lit(1))


def overlap_changes(
    df: DataFrame, entity: str, start: str, end: str, values: dict[str, Column]
) -> DataFrame:
    """Sums over the intervals [start, end] alive in a month, one row per entity and month in
    which they change: `desde` (first month), `hasta` (first month of the next row, NULL for
    the last), `vivos` (intervals alive) and the sums of `values`, exact for integers and
    decimals.

    At most two rows per interval leave the partial aggregation, and at most one per month
    and entity the shuffle, so a busy entity is no wide group. Intervals with a NULL bound, or
    whose last month is before the first, count nowhere; a NULL value counts as nothing.
    """
    first, last = _month_number(F.col(start)), _month_number(F.col(end))
    named = {f"_v{i}": v for i, v in enumerate(values.values())}
    lives = df.select(entity, first.alias("_from"), (last + 1).alias("_to"),
                      *[F.coalesce(v, F.lit(0)).alias(k) for k, v in named.items()])
    ends = [
        F.struct(F.col(at).alias("_month"), F.lit(sign).cast("bigint").alias("_alive"),
                 *[(F.col(k) * sign).alias(k) for k in named])
        for at, sign in (("_from", 1), ("_to", -1))
    ]
    deltas = lives.filter("_from < _to").select(entity, F.explode(F.array(*ends)).alias("_d"))
    changes = deltas.select(entity, "_d.*").groupBy(entity, "_month").agg(
        *[F.sum(c).alias(c) for c in ("_alive", *named)]
    )
    order = Window.partitionBy(entity).orderBy("_month")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    return changes.select(
        entity, _month_start(F.col("_month")).alias("desde"),
        _month_start(F.lead("_month").over(order)).alias("hasta"),
        F.sum("_alive").over(so_far).alias("vivos"),
        *[F.sum(k).over(so_far).alias(name) for k, name in zip(named, values)],
    )


def monthly_grid(
    changes: DataFrame, first: dt.date, last: dt.date, name: str = "mes_inicio"
) -> DataFrame:
    """One row per entity and month from `first` to `last` in which an interval is alive."""
    kept = [c for c in changes.columns if c not in ("desde", "hasta")]
    low = F.greatest(_month_number(F.col("desde")), _month_number(F.lit(first)))
    until = F.coalesce(_month_number(F.col("hasta")) - 1, _month_number(F.col("desde")))
    high = F.least(until, _month_number(F.lit(last)))
    spans = changes.filter("vivos > 0").withColumns({"_low": low, "_high": high})
    months = F.explode(F.sequence("_low", "_high", F.lit(1))).alias("_month")
    return spans.filter("_low <= _high").select(*kept, months).select(
        *kept, _month_start(F.col("_month")).alias(name)
    )


def unpivot_months(
    df: DataFrame,
    keep: list[str],
    months: list[dt.date],
    values: dict[str, str],
    name: str = "mes_inicio",
) -> DataFrame:
    """One row per entity and month; `values` maps output names to column prefixes."""
    cells = [
        F.struct(
            F.lit(m).alias(name),
            F.lit(i).alias("_i"),
            *[F.col(f"{prefix}{i}").alias(out) for out, prefix in values.items()],
        )
        for i, m in enumerate(months)
    ]
    return df.select(*keep, F.explode(F.array(*cells)).alias("_m")).select(*keep, "_m.*")
