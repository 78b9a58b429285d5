"""Distinct counts that add up: exact bitmaps over a dense whole-number key.

A partial holds, per group and block of 32,768 keys, one bit per key. Partials of more groups,
or of more days, are joined by OR, so counts at any coarser grain come from one stored table
and never from the fact. A bitmap takes 4 kB before compression: groups should be coarse
enough to hold many keys each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BLOCK, BITS = "bloque", "bits"


def partial(df: DataFrame, key: str, groups: Sequence[str]) -> DataFrame:
    """One row per group and block of keys; rows without a key count for no group."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(*groups, F.bitmap_bucket_number(key).alias(BLOCK))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(BITS))
    )


def merged(partials: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The partial of a coarser grain, or of several partials put together."""
    return partials.groupBy(*groups, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(partials: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    blocks = merged(partials, groups)
    return blocks.groupBy(*groups).agg(F.sum(F.bitmap_count(BITS)).alias(name))


def distinct_rollups(
    partials: DataFrame, grains: Sequence[Sequence[str]], name: str
) -> DataFrame:
    """Counts of several grains in one pass; columns that a grain leaves out are NULL, and
    `nivel` is the place of the grain in the list."""
    every = list(dict.fromkeys(c for grain in grains for c in grain))
    level = F.lit(None).cast("int")
    for i, grain in reversed(list(enumerate(grains))):
        out = sum(1 << (len(every) - 1 - every.index(c)) for c in every if c not in grain)
        level = F.when(F.col("__out") == out, i).otherwise(level)
    # The block takes part in every grain; it is the last bit of the grouping id.
    blocks = partials.groupingSets(
        [[F.col(c) for c in (*grain, BLOCK)] for grain in grains],
        *map(F.col, (*every, BLOCK)),
    ).agg(
        F.bitmap_or_agg(BITS).alias(BITS), F.shiftright(F.grouping_id(), 1).alias("__out"),
    )
    return (
        blocks.groupBy("__out", *every).agg(F.sum(F.bitmap_count(BITS)).alias(name))
        .select(level.alias("nivel"), *every, name)
    )
