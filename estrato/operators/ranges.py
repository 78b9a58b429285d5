"""Ranges of about equal size, cut at splitters drawn from a sample.

The cuts are a constant array and the range of a row is found by halving, so rows know their
range before they move: one shuffle by range number, and no second evaluation of the input
for a sample of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Keys drawn for each range; the share of a range then varies by some 1 / sqrt(KEYS) of it.
KEYS = 64
# Rows that are worth a range of their own, as long as there are fewer ranges than tasks.
LEAST_ROWS = 4096
HASH_BITS = 40


def range_count(spark: SparkSession, total: int) -> int:
    """As many ranges as the session has shuffle partitions, fewer where rows are few."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // LEAST_ROWS + 1)


def splitters(rows: DataFrame, key: list[Column], ranges: int, total: int) -> Column:
    """The sorted array of keys between ranges of about equal size, as a constant: at most
    one key a range passes through the driver. The sample is drawn by a hash of the key, so a task that runs again draws the
    same; it has about KEYS rows a range, whatever the size of the table.
    """
    lot = F.xxhash64(*key).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    share = min(ranges * KEYS / max(total, 1), 1.0) if ranges > 1 else 0.0
    drawn = rows.filter(lot < F.lit(int(share * (1 << HASH_BITS)))).select(
        F.struct(*[k.alias(f"k{i}") for i, k in enumerate(key)]).alias("key")
    )
    sample = F.array_sort(F.collect_list("key"))
    size = F.size("sample")
    quantiles = F.transform(
        F.sequence(F.lit(1), F.lit(max(ranges - 1, 1))),
        lambda i: F.get("sample", F.floor(i.cast("bigint") * size / F.lit(max(ranges, 2))).cast("int")),
    )
    cuts = drawn.agg(sample.alias("sample")).select(
        F.when(size > 0, F.array_distinct(quantiles)).otherwise(F.col("sample")).alias("cuts")
    )
    return F.from_json(F.lit(cuts.select(F.to_json("cuts")).first()[0]), cuts.schema["cuts"].dataType)


def range_of(key: Column, array: Column) -> Column:
    """Number of keys of the sorted array that are not above the key, by halving."""
    size = F.size(array)
    steps = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.shiftright(low + high, 1)
        above = F.get(array, middle) > key
        return (
            F.when(low >= high, state)
            .when(above, F.struct(low.alias("low"), middle.alias("high")))
            .otherwise(F.struct((middle + 1).alias("low"), high.alias("high")))
        )

    start = F.struct(F.lit(0).alias("low"), size.alias("high"))
    return F.aggregate(steps, start, halve, lambda state: state["low"])
