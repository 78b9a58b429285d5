"""Trailing history and fraud alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from estrato.catalog.data import Data
from estrato.catalog.registry import query
from estrato.functions.dates import micros_of_day, seconds_of_day
from estrato.operators.history import history_stats


def _alert(name: str, *columns: str, view: str = "s_mov") -> None:
    def run(d: Data) -> DataFrame:
        return d.silver("movimientos").select("id_mov", *columns)

    query(name, f"SELECT id_mov, {', '.join(columns)} FROM {view}")(run)


@query(
    "f1_f3_trailing_history",
    "SELECT x.event_id, count(h.event_id) AS n, "
    "round(stddev_samp(cast(h.value as double)), 6) AS sd "
    "FROM events x LEFT JOIN events h ON h.user_id = x.user_id "
    "AND cast(h.ts as date) >= cast(x.ts as date) - 30 "
    "AND (cast(h.ts as date), hour(h.ts) * 3600 + minute(h.ts) * 60 + second(h.ts), h.event_id) "
    "< (cast(x.ts as date), hour(x.ts) * 3600 + minute(x.ts) * 60 + second(x.ts), x.event_id) "
    "GROUP BY x.event_id",
)
def trailing_history(d: Data) -> DataFrame:
    """Straight from the events, over the default window."""
    events = d["events"].withColumn("day", F.col("ts").cast("date"))
    clock = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    scored = history_stats(events, "user_id", "day", clock, "event_id", "value")
    return scored.select(
        "event_id", F.col("movimientos_previos").alias("n"),
        F.round("desviacion_historica", 6).alias("sd"),
    )


@query(
    "f1_f3_week_history_split",
    "SELECT x.event_id, count(h.event_id) AS n, "
    "round(stddev_samp(cast(h.value as double)), 6) AS sd "
    "FROM events x LEFT JOIN events h ON h.user_id = x.user_id "
    "AND cast(h.ts as date) >= cast(x.ts as date) - 7 "
    "AND (cast(h.ts as date), hour(h.ts), h.event_id) "
    "< (cast(x.ts as date), hour(x.ts), x.event_id) GROUP BY x.event_id",
)
def split_history(d: Data) -> DataFrame:
    """The same operator with ranges so small that they split days and hours."""
    events = d["events"].withColumn("day", F.col("ts").cast("date"))
    scored = history_stats(
        events, "user_id", "day", F.hour("ts"), "event_id", "value", days=7, range_rows=50
    )
    return scored.select(
        "event_id", F.col("movimientos_previos").alias("n"),
        F.round("desviacion_historica", 6).alias("sd"),
    )


_HOT = """
WITH e AS (
  SELECT CASE WHEN event_id = low THEN -4000000000000000000 ELSE event_id END AS id, value,
    CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS who, cast(ts as date) AS day,
    CASE WHEN event_id % 3 = 0 THEN 0 ELSE hour(ts) END AS hour
  FROM events, (SELECT min(event_id) AS low FROM events WHERE event_id % 3 = 0)
)"""


@query(
    "f1_f3_hot_client_history",
    _HOT + """
SELECT x.id, count(h.id) AS n, round(stddev_samp(cast(h.value as double)), 6) AS sd
FROM e x LEFT JOIN e h ON h.who = x.who AND h.day BETWEEN x.day - 5 AND x.day
  AND (h.day, h.hour, h.id) < (x.day, x.hour, x.id)
GROUP BY x.id""",
)
def hot_client(d: Data) -> DataFrame:
    """A third of all rows belong to one client, those of a day to one second, and one of
    their ids lies far from the others."""
    events, hot = d["events"], F.col("event_id") % 3 == 0
    lowest = events.filter(hot).agg(F.min("event_id")).scalar()
    rows = events.select(
        F.when(F.col("event_id") == lowest, F.lit(-4_000_000_000_000_000_000))
        .otherwise(F.col("event_id")).alias("id"),
        F.when(hot, -1).otherwise(F.col("user_id")).alias("who"), "value",
        F.col("ts").cast("date").alias("day"),
        F.when(hot, 0).otherwise(F.hour("ts")).alias("hour"),
    )
    scored = history_stats(rows, "who", "day", F.col("hour"), "id", "value", days=5, range_rows=500)
    return scored.select(
        "id", F.col("movimientos_previos").alias("n"),
        F.round("desviacion_historica", 6).alias("sd"),
    )


_alert("f1_prior_count", "movimientos_previos")


@query("f2_prior_mean", "SELECT id_mov, promedio_historico AS promedio FROM s_mov")
def prior_mean(d: Data) -> DataFrame:
    return d.silver("movimientos").select(
        "id_mov", F.col("promedio_historico").alias("promedio")
    )


@query(
    "f3_prior_deviation",
    "SELECT id_mov, round(desviacion_historica, 6) AS desviacion FROM s_mov",
)
def prior_deviation(d: Data) -> DataFrame:
    return d.silver("movimientos").select(
        "id_mov", F.round("desviacion_historica", 6).alias("desviacion")
    )


_alert("f4_daily_frequency", "frecuencia_diaria")
_alert("f5_amount_alert", "alerta_monto")
_alert("f6_night_alert", "alerta_horario")
_alert("f7_frequency_alert", "alerta_frecuencia")
_alert("f8_channel_alert", "alerta_canal")
_alert("f9_alert_total", "total_alertas", "ind_sospechoso")


@query("silver_movimientos", "SELECT * REPLACE (round(desviacion_historica, 6) AS "
       "desviacion_historica) FROM s_mov")
def movements(d: Data) -> DataFrame:
    return d.fresh_silver("movimientos").withColumn(
        "desviacion_historica", F.round("desviacion_historica", 6)
    )


@query(
    "f6_seconds_of_day",
    "SELECT id_mov, cast(epoch(cast(hra_mov as time)) as int) AS segundos FROM b_mov",
)
def clock_seconds(d: Data) -> DataFrame:
    return d.bronze("TB_MOV_FINANCIEROS").select(
        "id_mov", seconds_of_day(F.col("hra_mov")).alias("segundos")
    )


@query(
    "f6_order_by_full_time",
    "WITH e AS (SELECT event_id % 50 AS who, 1000000 - event_id AS id, value, "
    "cast(ts as date) AS day, cast(ts as time) AS at FROM events) "
    "SELECT x.id, count(h.id) AS n, round(stddev_samp(cast(h.value as double)), 6) AS sd "
    "FROM e x LEFT JOIN e h ON h.who = x.who AND h.day BETWEEN x.day - 3 AND x.day "
    "AND (h.day, h.at, h.id) < (x.day, x.at, x.id) GROUP BY x.id",
)
def full_time(d: Data) -> DataFrame:
    """Clocks with fractions of a second as text; ids run against the time."""
    rows = d["events"].select(
        (F.col("event_id") % 50).alias("who"), (1_000_000 - F.col("event_id")).alias("id"),
        F.col("ts").cast("date").alias("day"), "value",
        F.date_format("ts", "HH:mm:ss.SSSSSS").alias("clock"),
    )
    scored = history_stats(
        rows, "who", "day", micros_of_day(F.col("clock")), "id", "value", days=3
    )
    return scored.select(
        "id", F.col("movimientos_previos").alias("n"),
        F.round("desviacion_historica", 6).alias("sd"),
    )
