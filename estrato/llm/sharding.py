"""Sampled splitters: rows dealt to shards of nearly equal bytes by ranges of a key.

The key is a hash of the text with doc_id behind it, so equal texts are neighbours. A sample
drawn in proportion to size gives quantiles of (key, doc_id); they cut the rows into ranges
of about equal bytes, many to a shard, and since doc_id is part of the boundary a text that
holds a large part of all rows is subdivided too. Running sums inside each range, plus the
exact totals of the ranges before it, place every row; nothing larger than a range is sorted
in one task.

Equal texts stay in one shard unless together they exceed 1/WHOLE_GROUP of a shard; shards
then differ from the mean by that much or by the longest row. Null text counts 0 bytes and
is a text of its own; null doc_ids come first; repeated rows take neighbouring slots. All
columns pass through; those named shard or slot are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from estrato.llm.common import arrow_ready
from estrato.workspace import freeze

ROW_OVERHEAD = 16
RANGES_A_SHARD = 8
RANGE_BYTES = 256 << 20
MOST_RANGES = 50_000
SAMPLES_A_RANGE = 24
WHOLE_GROUP = 20


@dataclass(frozen=True)
class Splitters:
    """Sorted boundaries (key, doc_id); range i ends before boundary i."""

    keys: np.ndarray
    docs: np.ndarray

    def range_of(self, keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
        low = np.searchsorted(self.keys, keys, "left")
        high = np.searchsorted(self.keys, keys, "right")
        for i in np.flatnonzero(low < high):
            low[i] += np.searchsorted(self.docs[low[i] : high[i]], docs[i], "right")
        return low


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_OVERHEAD


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    lowest = F.lit(-(2**63))
    return docs.select(
        F.struct(*docs.columns).alias("row"),
        F.xxhash64(text).alias("key"),
        F.coalesce(F.col(doc_id).cast("long"), lowest).alias("doc"),
        size_of(F.col(text)).alias("size"),
    )


def draw_splitters(keyed: DataFrame, ranges: int, total: int) -> Splitters:
    """Boundaries from a sample whose size depends on the number of ranges only."""
    step = max(total / (ranges * SAMPLES_A_RANGE), 1.0)
    lot = (F.xxhash64("key", "doc", F.lit("lot")).bitwiseAND((1 << 40) - 1)) / float(1 << 40)
    sample = keyed.filter(lot * step < F.col("size")).select(
        "key", "doc", F.greatest(F.col("size"), F.lit(step)).alias("weight")
    ).toPandas()
    sample = sample.sort_values(["key", "doc"])
    reach = sample["weight"].cumsum().to_numpy()
    if not len(reach):
        return Splitters(np.empty(0, np.int64), np.empty(0, np.int64))
    at = np.searchsorted(reach, reach[-1] * np.arange(1, ranges) / ranges)
    bounds = sample.iloc[np.unique(at)].drop_duplicates(["key", "doc"])
    return Splitters(bounds["key"].to_numpy(np.int64), bounds["doc"].to_numpy(np.int64))


def _ranged(keyed: DataFrame, splitters: Splitters) -> DataFrame:
    @F.pandas_udf("int")
    def range_of(key: pd.Series, doc: pd.Series) -> pd.Series:
        return pd.Series(splitters.range_of(key.to_numpy(), doc.to_numpy()))

    return keyed.withColumn("range", range_of("key", "doc"))


def shard(
    docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows with size, shard (0 to shards - 1) and slot (gapless from 0 in each shard)."""
    spark = arrow_ready(docs).sparkSession
    keyed = _keyed(docs, doc_id, text)
    slim = freeze(keyed.select("key", "doc", "size"), "shard-keys")
    total = slim.agg(F.sum("size")).first()[0] or 0
    ranges = min(max(shards * RANGES_A_SHARD, total // RANGE_BYTES), MOST_RANGES)
    splitters = draw_splitters(slim, ranges, total)
    edges = _edges(_ranged(slim, splitters))
    edge_rows = F.broadcast(spark.createDataFrame(edges, EDGE_DDL))

    def placed(rows: DataFrame) -> DataFrame:
        return _placed(_ranged(rows, splitters), edge_rows, total, shards)

    firsts = placed(slim).groupBy("shard").agg(F.min("place").alias("first")).toPandas()
    first = spark.createDataFrame(firsts, "shard int, first long")
    kept = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    return placed(keyed).join(F.broadcast(first), "shard").select(
        *[F.col("row")[c].alias(c) for c in kept],
        "size", "shard", (F.col("place") - F.col("first")).alias("slot"),
    )


EDGE_DDL = (
    "range int, rows_before long, bytes_before long, first_key long, first_start long, "
    "first_bytes long, last_key long, last_start long, last_bytes long"
)


def _edges(ranged: DataFrame) -> pd.DataFrame:
    """One row per range, at most MOST_RANGES: what lies before it, and where the texts at
    its two ends begin and how many bytes they hold in all ranges together."""
    ends = ranged.groupBy("range").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes"),
        F.min("key").alias("first_key"), F.max("key").alias("last_key"),
    )
    shares = ranged.groupBy("range", "key").agg(F.sum("size").alias("part")).join(
        F.broadcast(ends), "range"
    ).groupBy("range", "rows", "bytes", "first_key", "last_key").agg(
        F.max(F.when(F.col("key") == F.col("first_key"), F.col("part"))).alias("first_part"),
        F.max(F.when(F.col("key") == F.col("last_key"), F.col("part"))).alias("last_part"),
    )
    t = shares.toPandas().sort_values("range").reset_index(drop=True)
    t["rows_before"] = t["rows"].cumsum() - t["rows"]
    t["bytes_before"] = t["bytes"].cumsum() - t["bytes"]
    starts: dict[int, int] = {}
    sums: dict[int, int] = {}
    for r in t.itertuples():
        last_start = r.bytes_before + r.bytes - r.last_part
        for key, (part, start) in {
            r.last_key: (r.last_part, last_start), r.first_key: (r.first_part, r.bytes_before),
        }.items():
            starts.setdefault(key, start)
            sums[key] = sums.get(key, 0) + part
    for end in ("first", "last"):
        t[f"{end}_start"] = [starts[k] for k in t[f"{end}_key"]]
        t[f"{end}_bytes"] = [sums[k] for k in t[f"{end}_key"]]
    return t[[f.split()[0] for f in EDGE_DDL.split(", ")]]


def _placed(ranged: DataFrame, edges: DataFrame, total: int, shards: int) -> DataFrame:
    """Adds place (rank among all rows) and shard."""
    ordered = Window.partitionBy("range").orderBy("key", "doc")
    text = Window.partitionBy("range", "key")
    rows = ranged.select(
        "*",
        (F.row_number().over(ordered) - 1).alias("rank"),
        F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("reach"),
    ).select(
        "*", F.min(F.col("reach") - F.col("size")).over(text).alias("own_start"),
        F.sum("size").over(text).alias("own_bytes"),
    ).join(edges, "range")

    def group(name: str) -> Column:
        inner = F.col("own_bytes") if name == "bytes" else F.col("bytes_before") + F.col("own_start")
        return (
            F.when(F.col("key") == F.col("first_key"), F.col(f"first_{name}"))
            .when(F.col("key") == F.col("last_key"), F.col(f"last_{name}")).otherwise(inner)
        )

    whole = group("bytes") * (WHOLE_GROUP * shards) <= total
    twice_middle = F.when(whole, 2 * group("start") + group("bytes")).otherwise(
        2 * (F.col("bytes_before") + F.col("reach")) - F.col("size")
    )
    number = F.floor(twice_middle * shards / F.lit(2 * total)) if total else F.lit(0)
    return rows.select(
        *ranged.columns, (F.col("rows_before") + F.col("rank")).alias("place"),
        F.least(number, F.lit(shards - 1)).cast("int").alias("shard"),
    )
