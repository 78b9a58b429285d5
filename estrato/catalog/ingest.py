"""Upsert, marks, incremental slices and the logs around them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from estrato import model
from estrato.catalog.data import Data
from estrato.catalog.registry import query
from estrato.catalog.roles import RUN_TS
from estrato.operators.increment import (
    daily_report, slice_since, volume_flags, watermarks,
)
from estrato.operators.upsert import Batch, DuplicateKeys, action_counts, same_row, upsert
from estrato.plans import bronze
from estrato.sources.lake import Lake
from estrato.workspace import scratch_path

MARK = dt.datetime(2024, 1, 20, 12, 30, 0, 250000)
COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
NEW = Batch(dt.datetime(2001, 8, 28, 9, 0), "lote-2", "core")

# Old state: a tenth of the orders is not there yet. New state: an eleventh is gone, some
# prices moved, some priorities went to or came from NULL.
OLD_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus,
       cast(o_totalprice as decimal(18,2)) AS o_totalprice,
       case when o_orderkey % 13 = 0 then cast(null as string) else o_orderpriority end
           AS o_orderpriority
FROM {orders} WHERE o_orderkey % 10 <> 0"""
NEW_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus,
       cast(o_totalprice as decimal(18,2)) + case when o_orderkey % 7 = 0 then 1 else 0 end
           AS o_totalprice,
       case when o_orderkey % 26 = 0 then cast(null as string) else o_orderpriority end
           AS o_orderpriority
FROM {orders} WHERE o_orderkey % 11 <> 0"""
_PAIR = (
    f"WITH old AS ({OLD_SQL.format(orders='orders')}), new AS ({NEW_SQL.format(orders='orders')}) "
)
_ACTIONS = _PAIR + """, act AS (
  SELECT coalesce(new.o_orderkey, old.o_orderkey) AS o_orderkey,
         if(old.o_orderkey IS NULL, 'INSERT', if(new.o_orderkey IS NULL, 'KEEP',
            if(row(old.o_custkey, old.o_orderstatus, old.o_totalprice, old.o_orderpriority)
               IS NOT DISTINCT FROM row(new.o_custkey, new.o_orderstatus, new.o_totalprice,
                                        new.o_orderpriority), 'SAME', 'UPDATE'))) AS accion
  FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey)"""


def _states(d: Data) -> tuple[DataFrame, DataFrame]:
    orders = d["orders"]
    old = d.spark.sql(OLD_SQL, orders=orders).withColumns(
        Batch(RUN_TS, "lote-1", "core").columns()
    )
    new = d.spark.sql(NEW_SQL, orders=orders)
    return old, new.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


def _merged(d: Data) -> DataFrame:
    old, new = _states(d)
    return upsert(old, new, "o_orderkey", COLUMNS, NEW)


@query("b1_change_detection", _ACTIONS + "SELECT o_orderkey FROM act WHERE accion = 'UPDATE'")
def change_detection(d: Data) -> DataFrame:
    old, new = _states(d)
    pairs = new.alias("s").join(old.alias("t"), F.col("s.o_orderkey") == F.col("t.o_orderkey"))
    return pairs.filter(~same_row("s", "t", COLUMNS)).select("s.o_orderkey")


@query(
    "b2_upsert",
    _ACTIONS + """
SELECT act.o_orderkey, accion,
       if(accion IN ('INSERT', 'UPDATE'), new.o_custkey, old.o_custkey) AS o_custkey,
       if(accion IN ('INSERT', 'UPDATE'), new.o_orderstatus, old.o_orderstatus) AS o_orderstatus,
       cast(if(accion IN ('INSERT', 'UPDATE'), new.o_totalprice, old.o_totalprice)
            as decimal(18,2)) AS o_totalprice,
       if(accion IN ('INSERT', 'UPDATE'), new.o_orderpriority, old.o_orderpriority)
           AS o_orderpriority,
       if(accion IN ('INSERT', 'UPDATE'), timestamp '2001-08-28 09:00:00',
          timestamp '2001-08-27 10:00:00') AS fecha_ingesta,
       'core' AS sistema_fuente,
       if(accion IN ('INSERT', 'UPDATE'), 'lote-2', 'lote-1') AS id_lote
FROM act LEFT JOIN old ON act.o_orderkey = old.o_orderkey
     LEFT JOIN new ON act.o_orderkey = new.o_orderkey""",
)
def upsert_rows(d: Data) -> DataFrame:
    return _merged(d)


@query(
    "b2_upsert_actions",
    _ACTIONS + "SELECT accion, count(*) AS registros FROM act GROUP BY accion",
)
def upsert_actions(d: Data) -> DataFrame:
    return action_counts(_merged(d))


ORDERS = model.Table(
    "orders", "orders", "o_orderkey",
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(18,2), "
    "o_orderpriority string",
)


def _two_batches(d: Data) -> tuple[Lake, list[DataFrame]]:
    """Both states of the orders through a lake whose tables are kept in buckets."""
    lake = Lake(d.spark, scratch_path(d.spark, "lake"), buckets=32)
    old, new = _states(d)
    first = Batch(RUN_TS, "lote-1", "core")
    return lake, [
        bronze.ingest(lake, ORDERS, state, batch) for state, batch in ((old, first), (new, NEW))
    ]


@query(
    "b2_bucket_upsert",
    _ACTIONS + """
SELECT act.o_orderkey,
       if(accion IN ('INSERT', 'UPDATE'), new.o_custkey, old.o_custkey) AS o_custkey,
       if(accion IN ('INSERT', 'UPDATE'), new.o_orderstatus, old.o_orderstatus) AS o_orderstatus,
       cast(if(accion IN ('INSERT', 'UPDATE'), new.o_totalprice, old.o_totalprice)
            as decimal(18,2)) AS o_totalprice,
       if(accion IN ('INSERT', 'UPDATE'), new.o_orderpriority, old.o_orderpriority)
           AS o_orderpriority,
       if(accion IN ('INSERT', 'UPDATE'), timestamp '2001-08-28 09:00:00',
          timestamp '2001-08-27 10:00:00') AS fecha_ingesta,
       'core' AS sistema_fuente,
       if(accion IN ('INSERT', 'UPDATE'), 'lote-2', 'lote-1') AS id_lote
FROM act LEFT JOIN old ON act.o_orderkey = old.o_orderkey
     LEFT JOIN new ON act.o_orderkey = new.o_orderkey""",
)
def bucket_upsert(d: Data) -> DataFrame:
    lake, _ = _two_batches(d)
    return bronze.current(lake, ORDERS)


@query(
    "b2_bucket_actions",
    _ACTIONS + """SELECT 'lote-1' AS id_lote, 'INSERT' AS accion, count(*) AS registros FROM old
UNION ALL SELECT 'lote-2', accion, count(*) FROM act GROUP BY accion""",
)
def bucket_actions(d: Data) -> DataFrame:
    _, (first, second) = _two_batches(d)
    return first.withColumn("id_lote", F.lit("lote-1")).unionByName(
        second.withColumn("id_lote", F.lit("lote-2"))
    )


@query(
    "b3_batch_stamp",
    _ACTIONS + """SELECT if(accion IN ('INSERT', 'UPDATE'), 'lote-2', 'lote-1') AS id_lote,
       'core' AS sistema_fuente,
       if(accion IN ('INSERT', 'UPDATE'), timestamp '2001-08-28 09:00:00',
          timestamp '2001-08-27 10:00:00') AS fecha_ingesta, count(*) AS registros
FROM act GROUP BY ALL""",
)
def batch_stamp(d: Data) -> DataFrame:
    return (
        _merged(d)
        .groupBy("id_lote", "sistema_fuente", "fecha_ingesta")
        .agg(F.count("*").alias("registros"))
    )


# An ingestion log derived from the events: one run per day and event type. Runs with few
# rows count as failed, and some carry no mark.
LOG_SQL = """SELECT cast(row_number() OVER (ORDER BY cast(ts as date), event_type) as bigint) AS id_log,
       event_type AS tabla, cast(ts as date) AS dia,
       count(*) AS registros_procesados, max(ts) AS watermark_hasta,
       case when min(event_id) % 5 = 0 then 'ERROR'
            when min(event_id) % 5 = 1 then 'SIN_CAMBIOS' else 'OK' end AS estado
FROM {events} GROUP BY cast(ts as date), event_type"""
_LOG = f"WITH log AS ({LOG_SQL.format(events='events')}) "


def _log(d: Data) -> DataFrame:
    return d.spark.sql(LOG_SQL, events=d["events"])


@query(
    "b4_watermarks",
    _LOG + "SELECT DISTINCT ON (tabla) tabla, watermark_hasta FROM log "
    "WHERE estado <> 'ERROR' ORDER BY tabla, id_log DESC",
)
def last_marks(d: Data) -> DataFrame:
    return watermarks(_log(d))


@query(
    "b5_slice_since",
    "SELECT event_id, ts FROM events "
    "WHERE epoch_us(ts) > epoch_us(timestamp '2024-01-20 12:30:00.25')",
)
def incremental_slice(d: Data) -> DataFrame:
    return slice_since(d["events"], "ts", MARK).select("event_id", "ts")


@query("b5_slice_first_run", "SELECT event_id, ts FROM events")
def first_slice(d: Data) -> DataFrame:
    return slice_since(d["events"], "ts", None).select("event_id", "ts")


@query(
    "b6_advance_mark",
    "SELECT max(ts) AS watermark_hasta, count(*) AS registros FROM events "
    "WHERE ts > timestamp '2024-01-20 12:30:00.25'",
)
def advance_mark(d: Data) -> DataFrame:
    new = slice_since(d["events"], "ts", MARK)
    return new.agg(F.max("ts").alias("watermark_hasta"), F.count("*").alias("registros"))


def _sources(d: Data) -> dict[str, DataFrame]:
    return {t.name: d.bronze(t.name) for t in (model.CLIENTS, model.MOVEMENTS)}


@query(
    "b7_ingestion_log",
    """SELECT 'TB_CLIENTES_CORE' AS tabla, count(*) AS registros_procesados,
              cast(NULL as timestamp) AS watermark_desde, max(fecha_ingesta) AS watermark_hasta,
              'OK' AS estado, true AS con_archivo FROM b_cli
       UNION ALL
       SELECT 'TB_MOV_FINANCIEROS', count(*), NULL, max(fecha_ingesta), 'OK', true FROM b_mov""",
)
def ingestion_log(d: Data) -> DataFrame:
    lake = Lake(d.spark, scratch_path(d.spark, "lake"))
    bronze.export_changes(lake, _sources(d))
    log = lake.read(bronze.LOGS, bronze.INGESTION)
    return log.select(
        "tabla", "registros_procesados", "watermark_desde", "watermark_hasta", "estado",
        ((F.col("tamano_archivo_bytes") > 0) & F.col("ruta_archivo").isNotNull()).alias(
            "con_archivo"
        ),
    )


@query(
    "b8_run_outcomes",
    """WITH m AS (SELECT max(fecha_ingesta) AS w, count(*) AS n FROM b_mov)
       SELECT 1 AS corrida, 'TB_MOV_FINANCIEROS' AS tabla, n AS registros, 'OK' AS estado,
              w AS marca FROM m
       UNION ALL SELECT 2, 'TB_MOV_FINANCIEROS', 0, 'SIN_CAMBIOS', w FROM m
       UNION ALL SELECT 1, 'TB_CLIENTES_CORE', 0, 'ERROR', NULL
       UNION ALL SELECT 2, 'TB_CLIENTES_CORE', count(*), 'OK', max(fecha_ingesta) FROM b_cli""",
)
def run_outcomes(d: Data) -> DataFrame:
    """First run: clients lack the time column and fail, movements go on. Second run: the
    failed table starts from its old mark, the other one has nothing new."""
    lake = Lake(d.spark, scratch_path(d.spark, "lake"))
    good = _sources(d)
    broken = {**good, model.CLIENTS.name: good[model.CLIENTS.name].drop("fecha_ingesta")}
    bronze.export_changes(lake, broken)
    bronze.export_changes(lake, good)
    log = lake.read(bronze.LOGS, bronze.INGESTION)  # two rows per run
    return log.select(
        F.when(F.col("id_log") <= 2, 1).otherwise(2).alias("corrida"),
        "tabla",
        F.col("registros_procesados").alias("registros"),
        "estado",
        F.col("watermark_hasta").alias("marca"),
    )


@query(
    "b9_error_log",
    """SELECT id_error, 'BRONZE' AS etapa, 'Pipeline principal' AS proceso,
              if(llaves > 0, 'DuplicateKeys', '') AS tipo_error, 'ERROR' AS estado
       FROM (SELECT count(*) AS llaves FROM (SELECT id_comision FROM b_com GROUP BY 1
                                             HAVING count(*) > 1)),
            (SELECT unnest([cast(1 as bigint), cast(2 as bigint)]) AS id_error)""",
)
def error_log(d: Data) -> DataFrame:
    """Fees come with repeated keys, so their upsert is refused; both attempts are logged."""
    lake = Lake(d.spark, scratch_path(d.spark, "lake"))
    for attempt in ("run-1", "run-2"):
        try:
            bronze.ingest(lake, model.FEES, d.bronze(model.FEES.name), NEW)
        except DuplicateKeys as error:
            bronze.log_error(lake, "BRONZE", "Pipeline principal", error, attempt)
    log = lake.read(bronze.LOGS, bronze.ERRORS)
    return log.select("id_error", "etapa", "proceso", "tipo_error", "estado")


@query(
    "b10_volume_anomaly",
    _LOG + """, num AS (
  SELECT *, row_number() OVER (PARTITION BY tabla ORDER BY id_log) AS k FROM log), near AS (
  SELECT cur.id_log, cur.tabla, cur.registros_procesados,
         avg(cast(old.registros_procesados as double)) AS media
  FROM num cur LEFT JOIN num old
    ON old.tabla = cur.tabla AND old.k BETWEEN cur.k - 5 AND cur.k - 1
  GROUP BY ALL)
SELECT id_log, tabla, registros_procesados, round(media, 6) AS media_previa,
       if(media IS NOT NULL AND (registros_procesados > media * cast(1.25 as double)
          OR registros_procesados * cast(1.25 as double) < media), 1, 0) AS anomalia
FROM near""",
)
def volume_anomaly(d: Data) -> DataFrame:
    flagged = volume_flags(_log(d), runs=5, ratio=1.25)
    return flagged.select(
        "id_log", "tabla", "registros_procesados",
        F.round("media_previa", 6).alias("media_previa"), "anomalia",
    )


@query(
    "b11_daily_report",
    _LOG + """SELECT dia AS fecha, 'BRONZE' AS etapa, tabla AS elemento, estado,
       count(*) AS ejecuciones, cast(sum(registros_procesados) as bigint) AS registros
FROM log GROUP BY ALL
UNION ALL
SELECT cast(ts as date), 'SILVER', 'evento', 'ERROR', count(*), 0 FROM events
WHERE event_type = 'error' GROUP BY ALL
UNION ALL
SELECT cast(o_orderdate as date), 'GOLD', 'prioridad', if(o_totalprice > 0, 'PASS', 'FAIL'),
       count(*), cast(sum(o_orderkey) as bigint) FROM orders GROUP BY ALL""",
)
def run_report(d: Data) -> DataFrame:
    ingestion = _log(d).withColumn("fecha_fin", F.col("dia"))
    errors = d["events"].filter("event_type = 'error'").select(
        F.col("ts").alias("fecha_error"), F.lit("SILVER").alias("etapa"),
        F.lit("evento").alias("proceso"), F.lit("ERROR").alias("estado"),
    )
    checks = d["orders"].select(
        F.col("o_orderdate").alias("fecha_ejecucion"), F.lit("GOLD").alias("capa"),
        F.lit("prioridad").alias("nombre_prueba"),
        F.when(F.col("o_totalprice") > 0, "PASS").otherwise("FAIL").alias("resultado"),
        F.col("o_orderkey").alias("valor_observado"),
    )
    return daily_report(ingestion, errors, checks)
