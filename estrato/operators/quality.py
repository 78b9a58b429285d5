"""Rule-based rejects, quarantine, version pick, null profile and conformity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass(frozen=True)
class Rule:
    """One rejection rule. `when` must be written so that NULL means "not broken".

    Rules are tried in list order for field and reason. The error type is taken from the
    broken rule of lowest `rank`, which lets a type outrank an earlier field.
    """

    when: Column
    kind: str
    field: str
    reason: str
    rank: int = 1


def _first(rules: Sequence[Rule], value: str) -> Column:
    return F.coalesce(*[F.when(r.when, F.lit(getattr(r, value))) for r in rules])


def classify(df: DataFrame, origin: str, key: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per broken record: origin, key as text, type, first bad field, reason."""
    ranked = sorted(rules, key=lambda r: r.rank)  # stable: ties keep list order
    return df.select(
        F.lit(origin).alias("tabla_origen"),
        F.coalesce(F.col(key).cast("string"), F.lit("NULL")).alias("id_registro"),
        _first(ranked, "kind").alias("tipo_error"),
        _first(rules, "field").alias("campo_error"),
        _first(rules, "reason").alias("motivo_rechazo"),
    ).filter(F.col("tipo_error").isNotNull())


def rejects_by_key(rejects: DataFrame, origin: str, df: DataFrame, key: str) -> DataFrame:
    """Rejects of one table with the stored text turned back into the key's own type.

    Joining on the typed key lets the join share a shuffle with other work on that key.
    """
    kind = df.schema[key].dataType
    mine = rejects.filter(F.col("tabla_origen") == origin)
    return mine.withColumn(key, F.col("id_registro").try_cast(kind))


def quarantine(df: DataFrame, rejects: DataFrame, origin: str, key: str) -> DataFrame:
    """Drop every version of a rejected key, and rows that have no key at all.

    The source system logs a NULL key as rejected and still lets it through, because its
    stored text never equals NULL. Here such rows are held back.
    """
    bad = rejects_by_key(rejects, origin, df, key).select(key)
    return df.filter(F.col(key).isNotNull()).join(bad, key, "left_anti").select(*df.columns)


def reject_detail(
    df: DataFrame, rejects: DataFrame, origin: str, key: str, columns: list[str], extra: list[str]
) -> DataFrame:
    """Rejects joined back to the columns of the record they came from."""
    hits = rejects_by_key(rejects, origin, df, key)
    return df.join(hits, key).select(*columns, *extra)


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Row of each key that comes first in `order`.

    A row-number filter of 1 lets Spark keep one row per key and task before the shuffle,
    so a key with very many versions does not pile up in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def existing(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Rows whose key is present in the reference table."""
    return df.join(reference.select(key), key, "left_semi")


def presence(df: DataFrame, reference: DataFrame, key: str, name: str) -> DataFrame:
    """Add a column that is NULL where the key has no match; `reference` is unique by key."""
    known = reference.select(F.col(key).alias("_key"), F.lit(True).alias(name))
    return df.join(known, F.col(key) == F.col("_key"), "left").drop("_key")


def null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, NULLs and NULL percentage of every column; one scan per table."""
    parts = []
    for name, df in tables.items():
        counts = [F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)]
        row = df.agg(F.count("*").alias("total"), *counts)
        cells = F.array(
            *[
                F.struct(F.lit(c).alias("columna"), F.col(f"c{i}").alias("nulos"))
                for i, c in enumerate(df.columns)
            ]
        )
        parts.append(
            row.select("total", F.explode(cells).alias("x")).select(
                F.lit(name).alias("tabla"),
                F.col("x.columna").alias("columna"),
                F.col("total").alias("total_registros"),
                F.col("x.nulos").alias("registros_nulos"),
                share(F.col("x.nulos"), F.col("total")).alias("porcentaje_nulos"),
            )
        )
    return union_all(parts)


def share(part: Column, whole: Column) -> Column:
    """100 * part / whole as DECIMAL(10,2); NULL for an empty whole."""
    ratio = part.cast("decimal(18,0)") * 100 / F.nullif(whole, F.lit(0)).cast("decimal(18,0)")
    return ratio.cast("decimal(10,2)")


def count_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    return union_all(
        [
            df.agg(F.count("*").alias("registros")).select(F.lit(name).alias("objeto"), "registros")
            for name, df in tables.items()
        ]
    )


def conformity(
    received: Mapping[str, DataFrame],
    valid: Mapping[str, DataFrame],
    rejects: DataFrame,
    origins: Mapping[str, str],
) -> DataFrame:
    """Rows in, rows kept, rows rejected and percentage kept, per table.

    `origins` names the tables whose rejects are counted; the others report 0, as the
    source system does, even where a filter dropped rows.
    """
    seen = count_rows(received).withColumnRenamed("registros", "registros_bronze")
    kept = count_rows(valid).withColumnRenamed("registros", "registros_silver")
    lost = rejects.groupBy("tabla_origen").agg(F.count("*").alias("perdidos"))
    chain = F.lit(None).cast("string")
    for table, origin in origins.items():
        chain = F.when(F.col("objeto") == table, F.lit(origin)).otherwise(chain)
    return (
        seen.join(kept, "objeto")
        .withColumn("_origen", chain)
        .join(lost, F.col("_origen") == F.col("tabla_origen"), "left")
        .select(
            F.col("objeto").alias("tabla"),
            "registros_bronze",
            "registros_silver",
            F.coalesce("perdidos", F.lit(0)).cast("bigint").alias("registros_rechazados"),
            share(F.col("registros_silver"), F.col("registros_bronze")).alias(
                "porcentaje_conformidad"
            ),
        )
    )


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
