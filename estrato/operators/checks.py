"""Duplicate, orphan and pass/fail checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from estrato.operators.quality import union_all
from estrato.workspace import freeze

PASS, FAIL = "PASS", "FAIL"


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    return repeated.agg(F.count("*").alias("duplicados"))


def key_profile(fact: DataFrame, keys: Sequence[str], flag: Column | None = None) -> DataFrame:
    """Rows per value of each key, and rows and flagged rows of the whole fact.

    One scan: grouping sets over the keys, with `llave` the key that a row is about, NULL on
    the row of the whole. Rows are summed per task before they are shuffled, so a value
    shared by very many rows travels as one row. The result has one row per value of a
    dimension; it is stored, as every check reads it.
    """
    columns = [F.col(k) for k in keys]
    counted = fact.groupingSets([[c] for c in columns] + [[]], *columns).agg(
        F.count("*").alias("n"),
        F.count_if(F.lit(False) if flag is None else flag).alias("marcados"),
        F.grouping_id().alias("__out"),
    )
    whole = (1 << len(keys)) - 1
    about = F.lit(None).cast("string")
    for i, key in enumerate(keys):
        about = F.when(F.col("__out") == whole - (1 << (len(keys) - 1 - i)), key).otherwise(about)
    return freeze(counted.withColumn("llave", about).drop("__out"), "profile")


def orphans_of(profile: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows without a dimension row, per key of a `key_profile`; a NULL key counts.

    The joins are merge joins: Spark takes the share of a narrow key column in a compressed file
    for its size, and would send the keys of a dimension with millions of rows to the driver.
    """
    parts = []
    for key, dim in dims.items():
        values = profile.filter(F.col("llave") == key).select(key, "n")
        missing = values.join(dim.select(key).hint("merge"), key, "left_anti")
        parts.append(
            missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("huerfanos")).select(
                F.lit(key).alias("llave"), "huerfanos"
            )
        )
    return union_all(parts)


def flagged(profile: DataFrame) -> DataFrame:
    return profile.filter(F.col("llave").isNull()).select(F.col("marcados").alias("n"))


def orphans(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows without a dimension row, per key; a NULL key counts.

    `dims` maps the key column to its dimension.
    """
    return orphans_of(key_profile(fact, list(dims)), dims)


@dataclass(frozen=True)
class Check:
    """A named check whose one-row, one-column frame holds the observed count."""

    name: str
    layer: str
    observed: DataFrame
    detail: str
    expected: int = 0


def run_checks(checks: Sequence[Check], run_id: str, ts: dt.datetime, first_id: int = 1):
    """Result rows of one run, numbered in list order.

    They are stored: a log of runs is read several times, and each reader would otherwise plan
    and run every check again.
    """
    parts = []
    for i, c in enumerate(checks):
        seen = c.observed.toDF("x").withColumn("x", F.col("x").cast("bigint"))
        parts.append(
            seen.select(
                F.lit(first_id + i).cast("bigint").alias("id_resultado"),
                F.lit(run_id).alias("id_ejecucion"),
                F.lit(c.name).alias("nombre_prueba"),
                F.lit(c.layer).alias("capa"),
                F.when(F.col("x") == c.expected, PASS).otherwise(FAIL).alias("resultado"),
                F.col("x").alias("valor_observado"),
                F.lit(c.expected).cast("bigint").alias("valor_esperado"),
                F.lit(c.detail).alias("detalle"),
                F.lit(ts).cast("timestamp_ntz").alias("fecha_ejecucion"),
            )
        )
    return freeze(union_all(parts), "results")


def latest_run(results: DataFrame) -> DataFrame:
    """Rows of the run that wrote the highest result id.

    Run ids are random, so the greatest run id is not the latest run.
    """
    last = results.agg(F.max_by("id_ejecucion", "id_resultado").alias("id_ejecucion"))
    return results.join(F.broadcast(last), "id_ejecucion")


def run_totals(results: DataFrame) -> DataFrame:
    return latest_run(results).agg(
        F.count("*").alias("total_pruebas"),
        F.count_if(F.col("resultado") == PASS).alias("pruebas_pass"),
        F.count_if(F.col("resultado") == FAIL).alias("pruebas_fail"),
    )
