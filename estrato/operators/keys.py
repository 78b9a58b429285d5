"""Dense surrogate keys 1..N in natural-key order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from estrato.operators.ranges import range_count, range_of, splitters
from estrato.workspace import freeze

ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def dense_key(
    df: DataFrame, order: list[str], name: str, keys: DataFrame | None = None
) -> DataFrame:
    """Key without a global sort in one task.

    Range-partition and sort by the natural key, number the rows inside each partition,
    store that, then add to each partition the number of rows before it. The stored copy
    fixes partition and row numbers, so the second pass sees the same ones even after an
    executor is lost. The offsets table has one row per partition.

    Spark draws the cuts of its range partitioning by evaluating the input once more. Where
    that is a join, pass `keys`: a stored table with the first column, or more, of the order
    in about the same shares; the cuts come from there and the input is evaluated once.
    """
    if keys is None:
        placed = df.repartitionByRange(*order)
    else:
        ahead = [F.col(c) for c in keys.columns]
        total = keys.count()
        ranges = range_count(df.sparkSession, total)
        number = range_of(F.struct(*ahead), splitters(keys, ahead, ranges, total))
        placed = df.repartitionById(ranges, number)
    position = F.monotonically_increasing_id()
    ranged = (
        placed.sortWithinPartitions(*order)
        .withColumn("_pos", position)
        .withColumn("_part", F.shiftrightunsigned("_pos", ROW_BITS).cast("int"))
        .withColumn("_row", F.col("_pos").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
        .drop("_pos")
    )
    stored = freeze(ranged, name)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part")
        .agg((F.max("_row") + 1).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    key = (F.col("_before") + F.col("_row") + 1).cast("bigint")
    return stored.join(F.broadcast(offsets), "_part").select(key.alias(name), *df.columns)
