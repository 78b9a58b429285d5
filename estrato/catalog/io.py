"""Sources and sinks: every query writes what it reads and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from estrato import model
from estrato.catalog.data import Data
from estrato.catalog.registry import query
from estrato.operators.increment import day_parts
from estrato.operators.quality import count_rows
from estrato.operators.upsert import with_audit_columns
from estrato.sources import landing
from estrato.sources.lake import Lake, append_daily, read_daily
from estrato.sources.query import query as run_sql
from estrato.workspace import scratch_path


def _lake(d: Data) -> Lake:
    return Lake(d.spark, scratch_path(d.spark, "lake"))


def _landing(d: Data, table: model.Table) -> DataFrame:
    return d.bronze(table.name).select(*table.columns)


@query(
    "a1_read_csv",
    """SELECT id_cli, nullif(nomb_cli, '') AS nomb_cli, apell_cli, tip_doc, num_doc, fec_nac,
              fec_alta, cod_segmento, score_buro, ciudad_res, depto_res, estado_cli, canal_adquis
       FROM b_cli""",
)
def read_csv(d: Data) -> DataFrame:
    path = scratch_path(d.spark, "csv")
    landing.write_csv(_landing(d, model.CLIENTS), path)
    return landing.read_csv(d.spark, path, model.CLIENTS.schema)


@query(
    "a2_parse_dates",
    "SELECT o_orderkey, cast(o_orderdate as date) AS fecha FROM orders",
)
def parse_dates(d: Data) -> DataFrame:
    text = d["orders"].select("o_orderkey", F.col("o_orderdate").cast("string").alias("fecha"))
    return landing.to_date_columns(text, ["fecha"])


@query(
    "a3_json_records",
    "SELECT cod_prod, desc_prod, tip_prod, tasa_ea, plazo_max_meses, cuota_min, comision_admin, "
    "estado_prod FROM b_prod",
)
def json_records(d: Data) -> DataFrame:
    path = scratch_path(d.spark, "json")
    landing.write_json(_landing(d, model.PRODUCTS), path)
    return landing.read_json(d.spark, path, model.PRODUCTS.schema, lines=True)


@query(
    "a4_write_csv",
    "SELECT cast(count(*) as bigint) AS filas, cast(sum(vr_incentivo) as decimal(18,2)) AS total, "
    "min(fec_incentivo) AS desde, max(fec_incentivo) AS hasta FROM b_inc",
)
def write_csv(d: Data) -> DataFrame:
    path = scratch_path(d.spark, "csv")
    landing.write_csv(_landing(d, model.INCENTIVES), path)
    back = landing.read_csv(d.spark, path, model.INCENTIVES.schema)
    return back.agg(
        F.count("*").alias("filas"),
        F.sum("vr_incentivo").cast("decimal(18,2)").alias("total"),
        F.min("fec_incentivo").alias("desde"),
        F.max("fec_incentivo").alias("hasta"),
    )


@query("a5_replace_landing", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O'")
def replace_landing(d: Data) -> DataFrame:
    """The second load replaces the first whole."""
    lake, orders = _lake(d), d["orders"].select("o_orderkey", "o_custkey", "o_orderstatus")
    lake.overwrite("landing", "orders", orders)
    second = orders.filter("o_orderstatus = 'O'").drop("o_orderstatus")
    return lake.overwrite("landing", "orders", second)


_BRONZE = [("b_cli", model.CLIENTS), ("b_prod", model.PRODUCTS), ("b_suc", model.BRANCHES),
           ("b_obl", model.OBLIGATIONS), ("b_mov", model.MOVEMENTS), ("b_com", model.FEES),
           ("b_inc", model.INCENTIVES)]
COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{t.name}' AS objeto, count(*) AS registros FROM {v}" for v, t in _BRONZE
)


@query("a6_landing_counts", COUNTS_SQL)
def landing_counts(d: Data) -> DataFrame:
    return count_rows({t.name: d.bronze(t.name) for _, t in _BRONZE})


@query(
    "a7_parameterised_query",
    "SELECT o_orderkey, o_totalprice FROM orders "
    "WHERE o_orderstatus = 'F' AND o_orderdate >= timestamp '1998-01-01'",
)
def parameterised(d: Data) -> DataFrame:
    return run_sql(
        d.spark,
        "SELECT o_orderkey, o_totalprice FROM {orders} "
        "WHERE o_orderstatus = :status AND o_orderdate >= cast(:since AS timestamp_ntz)",
        {"status": "F", "since": "1998-01-01"},
        orders=d["orders"],
    )


@query(
    "a8_daily_partitions",
    "SELECT cast(year(ts) as int) AS anio, cast(month(ts) as int) AS mes, "
    "cast(day(ts) as int) AS dia, count(*) AS filas, "
    "cast(sum(cast(value as decimal(18,2))) as decimal(18,2)) AS total FROM events GROUP BY ALL",
)
def daily_partitions(d: Data) -> DataFrame:
    path = scratch_path(d.spark, "daily")
    events = d["events"].withColumn("value", F.col("value").cast("decimal(18,2)"))
    done = append_daily(events, "ts", path, "run-1")
    log = d.spark.createDataFrame([("events", "OK", "run-1", done["rows"])],
                                  "tabla string, estado string, id_ejecucion string, n bigint")
    return (
        read_daily(d.spark, path, events.schema, log, "events")
        .groupBy("anio", "mes", "dia")
        .agg(F.count("*").alias("filas"), F.sum("value").cast("decimal(18,2)").alias("total"))
    )


@query(
    "a8_partition_names",
    "SELECT DISTINCT strftime(ts, 'anio=%Y/mes=%m/dia=%d') AS carpeta FROM events",
)
def partition_names(d: Data) -> DataFrame:
    parts = day_parts(d["events"].select("ts"), "ts").select("anio", "mes", "dia").distinct()
    return parts.select(F.format_string("anio=%d/mes=%s/dia=%s", "anio", "mes", "dia")
                        .alias("carpeta"))


@query("a9_materialise", "SELECT * FROM s_suc")
def materialise(d: Data) -> DataFrame:
    return _lake(d).overwrite("silver", "sucursales", d.fresh_silver("sucursales"))


@query(
    "a10_append_rows",
    "SELECT tabla_origen, tipo_error, count(*) AS filas FROM "
    "(SELECT tabla_origen, tipo_error FROM s_rej_cli UNION ALL "
    "SELECT tabla_origen, tipo_error FROM s_rej_obl) GROUP BY ALL",
)
def append_rows(d: Data) -> DataFrame:
    lake = _lake(d)
    for name in ("rechazos_clientes", "rechazos_obligaciones"):
        lake.append("silver", "registros_rechazados", d.silver(name))
    stored = lake.read("silver", "registros_rechazados")
    return stored.groupBy("tabla_origen", "tipo_error").agg(F.count("*").alias("filas"))


@query("a11_idempotent_rebuild", "SELECT * FROM g_geo")
def idempotent_rebuild(d: Data) -> DataFrame:
    """Built twice into the same place: one set of rows remains."""
    lake = _lake(d)
    lake.overwrite("gold", "dim_geografia", d.fresh_gold("dim_geografia"))
    return lake.overwrite("gold", "dim_geografia", d.fresh_gold("dim_geografia"))


@query(
    "a12_add_audit_columns",
    "SELECT n_nationkey, n_name, n_regionkey, cast(NULL as timestamp) AS fecha_ingesta, "
    "'core' AS sistema_fuente, cast(NULL as varchar) AS id_lote FROM nation",
)
def add_audit_columns(d: Data) -> DataFrame:
    """One audit column is there already and keeps its values; applying twice adds nothing."""
    partial = d["nation"].withColumn("sistema_fuente", F.lit("core"))
    return with_audit_columns(with_audit_columns(partial))


