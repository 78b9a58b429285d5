"""Null-safe change detection and upsert into a snapshot table."""

from __future__ import annotations

import datetime as dt
import functools
import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

INSERT, UPDATE, SAME, KEEP = "INSERT", "UPDATE", "SAME", "KEEP"
AUDIT = {"fecha_ingesta": "timestamp_ntz", "sistema_fuente": "string", "id_lote": "string"}


@dataclass(frozen=True)
class Batch:
    """Stamp shared by every row that one ingestion run inserts or updates."""

    ts: dt.datetime
    id: str
    source: str

    def columns(self) -> dict[str, Column]:
        return {
            "fecha_ingesta": F.lit(self.ts).cast("timestamp_ntz"),
            "sistema_fuente": F.lit(self.source),
            "id_lote": F.lit(self.id),
        }


class DuplicateKeys(ValueError):
    """Two source rows claim the same target row."""


def with_audit_columns(df: DataFrame) -> DataFrame:
    """Add the audit columns that are missing, as typed NULLs."""
    missing = {c: F.lit(None).cast(t) for c, t in AUDIT.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def same_row(left: str, right: str, columns: list[str]) -> Column:
    """True when all columns agree; two NULLs agree, NULL and a value do not."""
    tests = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return functools.reduce(operator.and_, tests, F.lit(True))


def check_unique(source: DataFrame, key: str) -> None:
    repeated = source.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")
    sample = [row[0] for row in repeated.limit(5).collect()]
    if sample:
        raise DuplicateKeys(f"{key} repeats in the source, for example {sample}")


def upsert_actions(
    target: DataFrame, source: DataFrame, key: str, compared: list[str], batch: Batch
) -> DataFrame:
    """Next snapshot with an extra `accion` column; rows with a NULL key are left out.

    Rows only in the target stay (deletes are not propagated) and unchanged rows keep
    their old stamp. One shuffle per side, on the key.
    """
    marker = F.lit(True)
    t = with_audit_columns(target).filter(F.col(key).isNotNull()).withColumn("_t", marker)
    s = source.select(key, *compared).filter(F.col(key).isNotNull()).withColumn("_s", marker)
    joined = t.alias("t").join(s.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    action = (
        F.when(F.col("_t").isNull(), INSERT)
        .when(F.col("_s").isNull(), KEEP)
        .when(same_row("s", "t", compared), SAME)
        .otherwise(UPDATE)
    )
    joined = joined.withColumn("accion", action)
    fresh = F.col("accion").isin(INSERT, UPDATE)
    stamp = batch.columns()
    return joined.select(
        F.coalesce(F.col(f"s.{key}"), F.col(f"t.{key}")).alias(key),
        *[F.when(fresh, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in compared],
        *[F.when(fresh, stamp[c]).otherwise(F.col(f"t.{c}")).alias(c) for c in AUDIT],
        "accion",
    )


def keyless_rows(
    target: DataFrame, source: DataFrame, key: str, compared: list[str], batch: Batch
) -> DataFrame:
    """Rows without a key: they match nothing, so they are compared as whole rows.

    A rerun with the same source therefore adds nothing.
    """
    old = with_audit_columns(target).filter(F.col(key).isNull())
    new = source.select(key, *compared).filter(F.col(key).isNull()).distinct()
    unseen = new.alias("s").join(old.alias("t"), same_row("s", "t", compared), "left_anti")
    stamped = unseen.withColumns(batch.columns()).withColumn("accion", F.lit(INSERT))
    return old.select(key, *compared, *AUDIT, F.lit(KEEP).alias("accion")).unionByName(stamped)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    compared: list[str],
    batch: Batch,
    verify_source: bool = True,
) -> DataFrame:
    """Insert new rows, update changed ones, keep the rest; see `upsert_actions`."""
    if verify_source:
        check_unique(source, key)
    keyed = upsert_actions(target, source, key, compared, batch)
    return keyed.unionByName(keyless_rows(target, source, key, compared, batch))


def action_counts(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("accion").agg(F.count("*").alias("registros"))
