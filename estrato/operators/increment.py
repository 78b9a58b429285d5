"""High-water marks, incremental slices and checks over the ingestion log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

OK, NO_CHANGES, ERROR = "OK", "SIN_CAMBIOS", "ERROR"

# Spark cannot use Parquet statistics of zone-less timestamps, so stored tables carry the
# ingestion time a second time, as a whole number it can use.
MICROS = "_ingesta_us"
DAY_MICROS = 86_400_000_000


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session time zone."""
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60
    seconds = F.date_part(F.lit("SECOND"), ts).cast("decimal(8,6)")
    rest = clock.cast("bigint") * 1_000_000 + (seconds * 1_000_000).cast("bigint")
    return F.unix_date(ts.cast("date")).cast("bigint") * DAY_MICROS + rest


def mark_micros(mark: dt.datetime) -> int:
    return (mark - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def watermarks(log: DataFrame) -> DataFrame:
    """Last mark of each table, failed runs ignored. One pass over the log."""
    usable = log.filter(F.col("estado").isin(OK, NO_CHANGES) & F.col("watermark_hasta").isNotNull())
    return usable.groupBy("tabla").agg(
        F.max_by("watermark_hasta", "id_log").alias("watermark_hasta")
    )


def slice_since(df: DataFrame, ts_col: str, mark: dt.datetime | None) -> DataFrame:
    """Rows ingested after the mark; everything when there is no mark yet.

    The mark is compared as a literal. Where the table carries the time as a number, that
    is compared too, and the scan skips the row groups before the mark.
    """
    if mark is None:
        return df
    newer = F.col(ts_col) > F.lit(mark).cast("timestamp_ntz")
    if MICROS in df.columns:
        newer = newer & (F.col(MICROS) > mark_micros(mark))
    return df.filter(newer)


def day_bound(mark: dt.datetime | None):
    """Partition test for an `anio/mes/dia` layout: days before the mark cannot match."""
    if mark is None:
        return F.lit(True)
    y, m, d = mark.year, mark.month, mark.day
    anio, mes, dia = F.col("anio"), F.col("mes"), F.col("dia")
    return (anio > y) | ((anio == y) & ((mes > m) | ((mes == m) & (dia >= d))))


def day_parts(df: DataFrame, ts_col: str) -> DataFrame:
    ts = F.col(ts_col)
    return df.withColumns(
        {
            "anio": F.year(ts),
            "mes": F.date_format(ts, "MM"),
            "dia": F.date_format(ts, "dd"),
        }
    )


def volume_flags(log: DataFrame, runs: int = 5, ratio: float = 2.0) -> DataFrame:
    """Mark runs whose row count leaves the band [mean / ratio, mean * ratio].

    The mean is over the previous `runs` runs of the same table. The source describes
    this control without giving a rule; the rule is ours. The log has one row per run
    and table, so a table's window stays small.
    """
    before = Window.partitionBy("tabla").orderBy("id_log").rowsBetween(-runs, -1)
    mean = F.avg(F.col("registros_procesados").cast("double")).over(before)
    rows = F.col("registros_procesados")
    return log.withColumn("media_previa", mean).withColumn(
        "anomalia",
        F.when(
            mean.isNotNull() & ((rows > mean * ratio) | (rows * F.lit(ratio) < mean)), 1
        ).otherwise(0),
    )


def daily_report(ingestion: DataFrame, errors: DataFrame, checks: DataFrame) -> DataFrame:
    """Runs, rows and failures per day, stage and item, from the three logs."""
    ing = ingestion.select(
        F.to_date("fecha_fin").alias("fecha"),
        F.lit("BRONZE").alias("etapa"),
        F.col("tabla").alias("elemento"),
        "estado",
        F.col("registros_procesados").cast("bigint").alias("registros"),
    )
    err = errors.select(
        F.to_date("fecha_error").alias("fecha"),
        "etapa",
        F.col("proceso").alias("elemento"),
        "estado",
        F.lit(0).cast("bigint").alias("registros"),
    )
    chk = checks.select(
        F.to_date("fecha_ejecucion").alias("fecha"),
        F.col("capa").alias("etapa"),
        F.col("nombre_prueba").alias("elemento"),
        F.col("resultado").alias("estado"),
        F.col("valor_observado").cast("bigint").alias("registros"),
    )
    return (
        ing.unionByName(err)
        .unionByName(chk)
        .groupBy("fecha", "etapa", "elemento", "estado")
        .agg(F.count("*").alias("ejecuciones"), F.sum("registros").alias("registros"))
    )
