"""Lake tables: overwritten snapshots, logs, daily change log."""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from estrato.operators.increment import day_bound, day_parts
from estrato.workspace import small_frame


class Lake:
    """Parquet tables under one root folder, addressed as layer / table."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.buckets = buckets  # of Bronze tables yet to be written, about a gigabyte each
        self.root = root.rstrip("/")
        self._log_lock = threading.Lock()

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def exists(self, layer: str, table: str) -> bool:
        return _exists(self.spark, self.path(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, table))

    def read_or_empty(self, layer: str, table: str, ddl: str) -> DataFrame:
        if self.exists(layer, table):
            return self.spark.read.schema(ddl).parquet(self.path(layer, table))
        return self.spark.createDataFrame([], ddl)

    def overwrite(self, layer: str, table: str, df: DataFrame, sort: list[str] = ()) -> DataFrame:
        """Replace the table and return it as stored. Rebuilding twice gives the same rows.

        `sort` orders rows inside each file, so later filters on those columns skip row
        groups; it adds no shuffle.
        """
        laid_out = df.sortWithinPartitions(*sort) if sort else df
        laid_out.write.mode("overwrite").parquet(self.path(layer, table))
        return self.read(layer, table)

    def append(self, layer: str, table: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(layer, table))

    def append_rows(self, layer: str, table: str, rows: list[tuple], ddl: str) -> None:
        """Append a handful of log rows as one file."""
        self.append(layer, table, small_frame(self.spark, rows, ddl).coalesce(1))

    def log_row(self, table: str, ddl: str, row: tuple) -> int:
        """Append one row to a log under the next id, which is the first column.

        Logs are written by the driver alone, one row at a time.
        """
        with self._log_lock:
            number = self.next_id("logs", table, ddl)
            self.append_rows("logs", table, [(number, *row)], ddl)
        return number

    def next_id(self, layer: str, table: str, ddl: str) -> int:
        column = ddl.split()[0]
        top = self.read_or_empty(layer, table, ddl).agg(F.max(column)).first()[0]
        return (top or 0) + 1


def append_daily(df: DataFrame, ts_col: str, path: str, run_id: str) -> dict:
    """Append rows under anio=/mes=/dia=/ejecucion= and return what was written.

    Row count and new mark are observed while writing. The slice is read twice, once for the
    sample that places the cuts between days, which keeps the number of files small. The run
    id in the path separates runs: a run that is not in the ingestion log is ignored by
    `read_daily`, so a crash before the log row leaves no duplicates.
    """
    seen = Observation()
    # By day, so that a day is in few files; a hash of the row splits the days with many.
    spread = F.xxhash64(*df.columns)
    arranged = day_parts(df, ts_col).repartitionByRange("anio", "mes", "dia", spread)
    watched = arranged.observe(
        seen, F.count("*").alias("rows"), F.max(ts_col).cast("string").alias("mark")
    )
    parts = watched.withColumn("ejecucion", F.lit(run_id))
    parts.write.mode("append").partitionBy("anio", "mes", "dia", "ejecucion").parquet(path)
    got = seen.get
    mark = got["mark"]
    folders, size = _run_files(df.sparkSession, path, run_id)
    return {
        "rows": got["rows"],
        "mark": dt.datetime.fromisoformat(mark) if mark else None,
        "folders": folders,
        "bytes": size,
    }


def read_daily(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    log: DataFrame,
    table: str,
    since: dt.datetime | None = None,
) -> DataFrame:
    """Rows of published runs, optionally only the days that can lie after `since`."""
    full = T.StructType(
        list(schema.fields)
        + [
            T.StructField("anio", T.IntegerType()),
            T.StructField("mes", T.IntegerType()),
            T.StructField("dia", T.IntegerType()),
            T.StructField("ejecucion", T.StringType()),
        ]
    )
    published = log.filter((F.col("tabla") == table) & (F.col("estado") == "OK")).select(
        F.col("id_ejecucion").alias("ejecucion")
    )
    rows = spark.read.schema(full).parquet(path).filter(day_bound(since))
    return rows.join(published, "ejecucion", "left_semi").select(*full.names)


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def _run_files(spark: SparkSession, path: str, run_id: str) -> tuple[list[str], int]:
    """Day folders and bytes written by one run."""
    fs, target = _hadoop(spark, f"{path}/anio=*/mes=*/dia=*/ejecucion={run_id}")
    found = fs.globStatus(target) or []
    size = sum(fs.getContentSummary(s.getPath()).getLength() for s in found)
    return [s.getPath().toString() for s in found], size
