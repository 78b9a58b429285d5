"""Statistics of each entity's trailing history.

For a row x the history is every row of the same entity dated at most `days` days earlier
that comes strictly before x in (day, second, id) order.

Rows are cut into ranges of (entity, day, second, id) at splitters drawn from a sample, so
that neither a busy entity, nor its busiest day or second, has to fit into one task. A piece
is what one range holds of one (entity, day). A small stored table has one row per piece:
the totals of the entity's days before it within the window, plus those of the same day's
pieces before it. The row opens its piece, and a running sum does the rest. That takes one
shuffle of the data, by range number, and no join.

The cuts are a constant of the plan, so there are MOST_CUTS ranges at most. Where smaller ones
are asked for, each is cut again by the rank of its rows, inside the task that holds it; the
pieces are then those of the finer cuts. Rows with one key have one rank and stay together.

All parts carry a row count, the sum of the cents and the sum of their squares: exact
integers, so they combine by addition, the result does not depend on where the cuts are, and
a history of equal amounts has a deviation of exactly 0. There is one plan for all sizes
up to MOST_CUTS ranges, and one with ranks beyond.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from estrato.operators.ranges import range_count, range_of, splitters
from estrato.workspace import freeze

EXACT = "decimal(38,0)"
MOST_CUTS = 2048  # ranges cut by a constant array; finer ones are cut by rank

MOMENTS = ["n", "s1", "s2"]


def _moments(cents: Column) -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.sum(cents).cast(EXACT).alias("s1"),
        F.sum((cents * cents).cast(EXACT)).alias("s2"),
    ]


def _sums(window, prefix: str) -> dict[str, Column]:
    """Sums of the three moments over a window, 0 where it is empty."""
    kinds = {"n": "bigint", "s1": EXACT, "s2": EXACT}
    return {
        f"{prefix}{c}": F.coalesce(F.sum(c).over(window), F.lit(0)).cast(kind)
        for c, kind in kinds.items()
    }


def _mean(n: Column, s1: Column) -> Column:
    """Exact mean in money units, DECIMAL(22,6)."""
    count = F.nullif(n, F.lit(0)).cast("decimal(12,0)")
    return (s1.cast("decimal(24,0)") / 100 / count).cast("decimal(22,6)")


def _deviation(n: Column, s1: Column, s2: Column) -> Column:
    """Sample deviation in money units; NULL below two rows.

    With s1 = q * n + r the sum of squares about the mean is s2 - q * s1 - q * r - r^2 / n.
    The integer terms are exact and none exceeds s2, so they fit whenever s2 does.
    """
    count = F.when(n >= 2, n).cast("decimal(12,0)")
    r = F.pmod(s1.cast("decimal(24,0)"), count).cast("decimal(12,0)")
    q = ((s1 - r).cast("decimal(24,0)") / count).cast("decimal(19,0)")
    whole = s2 - (q * s1).cast(EXACT) - (q * r).cast(EXACT)
    rest = r.cast("double") * r.cast("double") / count.cast("double")
    spread = F.greatest(whole.cast("double") - rest, F.lit(0.0))
    return F.sqrt(spread / (count.cast("double") - 1.0)) / 100.0


def history_stats(
    df: DataFrame,
    entity: str,
    day: str,
    second: Column,
    id_col: str,
    amount: str,
    days: int = 30,
    range_rows: int | None = None,
) -> DataFrame:
    """Add count, mean and deviation of the history and the row count of the day.

    Entity, day, second, id and amount must not be NULL; seconds are not negative; the id
    is a unique integer. There are as many ranges as the session has shuffle partitions, or
    one per `range_rows` rows, however many these are. The input is counted and read three
    times, so pass a stored table; the first two reads take the columns of the key and the
    amount only.
    """
    rows = df.withColumns(
        {
            "_day": F.unix_date(F.col(day)),
            "_sec": second,
            "_cents": (F.col(amount).cast("decimal(18,2)") * 100).cast("decimal(19,0)"),
        }
    )
    total, tasks = df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = math.ceil(total / range_rows) if range_rows else range_count(df.sparkSession, total)
    place = [F.col(c) for c in (entity, "_day", "_sec", id_col)]
    coarse = min(ranges, MOST_CUTS)
    cuts = splitters(rows, place, coarse, total)
    ranged = rows.withColumns(
        {"_range": range_of(F.struct(*place), cuts), "_part": F.lit(None).cast("bigint")}
    )
    tasks = min(max(coarse, 1), tasks)
    finer = range_rows if ranges > coarse else None
    openings = freeze(_openings(ranged, entity, days, place, finer, tasks), "history")
    return _running(df.columns, ranged, openings, entity, id_col, place, finer, tasks)


def _parted(df: DataFrame, place: list[Column], range_rows: int | None) -> DataFrame:
    """Rows without a part get it by their rank among those of their range."""
    number = F.lit(0).cast("bigint")
    if range_rows:
        of_range = Window.partitionBy("_range", F.col("_part").isNull()).orderBy(*place)
        number = F.floor((F.rank().over(of_range) - 1) / F.lit(range_rows))
    return df.withColumn("_part", F.coalesce("_part", number))


def _openings(
    ranged: DataFrame, entity: str, days: int, place: list[Column], finer: int | None, tasks: int
) -> DataFrame:
    """A row for each piece that comes first in it and holds what precedes it."""
    moved = ranged.repartitionById(tasks, F.col("_range")) if finer else ranged
    pieces = _parted(moved, place, finer).groupBy("_range", "_part", entity, "_day").agg(
        *_moments(F.col("_cents"))
    )
    of_entity = Window.partitionBy(entity).orderBy("_day")
    of_day = Window.partitionBy(entity, "_day")
    earlier = of_day.orderBy("_range", "_part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        pieces.withColumns(_sums(of_entity.rangeBetween(-days, -1), "past_"))
        .withColumns(_sums(earlier, "prev_"))
        .withColumn("_in_day", F.sum("n").over(of_day))
        .select(
            "_range", "_part", entity, "_day", F.lit(-1).alias("_sec"), "_in_day",
            *[(F.col(f"past_{c}") + F.col(f"prev_{c}")).alias(f"_{c}") for c in MOMENTS],
        )
    )


def _running(
    columns: list[str], ranged: DataFrame, openings: DataFrame, entity: str, id_col: str,
    place: list[Column], finer: int | None, tasks: int,
) -> DataFrame:
    """Running moments before each row, from the opening row of its piece on."""
    both = ranged.unionByName(openings, allowMissingColumns=True)
    own = F.col("_cents").cast(EXACT)
    square = (F.col("_cents") * F.col("_cents")).cast(EXACT)
    before = (
        Window.partitionBy("_range", "_part", entity, "_day")
        .orderBy("_sec", id_col)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    moved = both.repartitionById(tasks, F.col("_range"))
    summed = _parted(moved, place, finer).withColumns(
        {
            "_before_n": F.sum(F.coalesce("_n", F.lit(1).cast("bigint"))).over(before),
            "_before_s1": F.sum(F.coalesce(F.col("_s1").cast(EXACT), own)).over(before),
            "_before_s2": F.sum(F.coalesce(F.col("_s2").cast(EXACT), square)).over(before),
            "_of_day": F.first("_in_day").over(before),
        }
    ).filter(F.col("_in_day").isNull())
    n, s1, s2 = F.col("_before_n"), F.col("_before_s1"), F.col("_before_s2")
    return summed.select(
        *columns,
        n.alias("movimientos_previos"),
        _mean(n, s1).alias("promedio_historico"),
        _deviation(n, s1, s2).alias("desviacion_historica"),
        F.col("_of_day").alias("frecuencia_diaria"),
    )


def fraud_flags(
    df: DataFrame,
    amount: str,
    second: Column,
    risky: Column,
    sigma: int = 3,
    min_history: int = 3,
    night_end: int = 5 * 3600,
    daily_limit: int = 5,
) -> DataFrame:
    """Four 0/1 alerts, their total and the suspicion flag (the amount alert alone)."""
    mean, sd = F.col("promedio_historico").cast("double"), F.col("desviacion_historica")
    unusual = (
        (F.col("movimientos_previos") >= min_history)
        & sd.isNotNull()
        & (F.col(amount).cast("double") > mean + sigma * sd)
    )
    alerts = {
        "alerta_monto": unusual,
        "alerta_horario": (second >= 0) & (second < night_end),
        "alerta_frecuencia": F.col("frecuencia_diaria") >= daily_limit,
        "alerta_canal": risky,
    }
    flagged = df.withColumns({k: F.when(v, 1).otherwise(0) for k, v in alerts.items()})
    total = sum((F.col(k) for k in alerts), F.lit(0))
    return flagged.withColumns(
        {"total_alertas": total, "ind_sospechoso": F.col("alerta_monto")}
    )
