"""Parameterised SQL, on Spark tables or on a database reached through JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def query(spark: SparkSession, sql: str, params: Mapping | None = None, **tables) -> DataFrame:
    """Run `sql` with named parameters (`:name`) over frames named as `{name}`."""
    return spark.sql(sql, args=dict(params or {}), **tables)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    bounds: tuple[int, int],
    partitions: int,
    **options: str,
) -> DataFrame:
    """Read a database table in parallel key ranges instead of through one connection."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    return reader.options(
        partitionColumn=key,
        lowerBound=str(bounds[0]),
        upperBound=str(bounds[1]),
        numPartitions=str(partitions),
    ).load()
