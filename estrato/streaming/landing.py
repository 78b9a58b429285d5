"""Pick up new landing files and upsert them, each file once.

The source has no streams; this is its incremental load with Spark keeping track of the
files already read. `availableNow` drains the folder and stops.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from estrato.model import Table
from estrato.operators.quality import latest_by
from estrato.operators.upsert import Batch
from estrato.plans.bronze import ingest
from estrato.sources.lake import Lake


def new_rows(spark: SparkSession, folder: str, table: Table) -> DataFrame:
    """Parquet files dropped in the folder, with the time and name of their file."""
    return (
        spark.readStream.schema(table.schema)
        .parquet(folder)
        .withColumn("_archivo", F.struct("_metadata.file_modification_time", "_metadata.file_path"))
    )


def start(
    lake: Lake,
    table: Table,
    folder: str,
    checkpoint: str,
    source: str,
    clock: Callable[[], dt.datetime],
) -> StreamingQuery:
    """Upsert every new file. A replayed micro-batch finds its rows unchanged and publishes
    a snapshot with the same content."""

    def merge(rows: DataFrame, number: int) -> None:
        # Several files may carry the same key; the newest file wins.
        newest = latest_by(rows, [table.key], [F.desc("_archivo")]).drop("_archivo")
        ingest(lake, table, newest, Batch(clock(), f"micro-{number:010d}", source))

    return (
        new_rows(lake.spark, folder, table)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
