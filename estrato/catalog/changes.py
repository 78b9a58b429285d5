"""Marts that follow changed rows, and distinct counts from stored partials."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from estrato import model
from estrato.catalog.data import Data
from estrato.catalog.registry import query
from estrato.operators import bitmaps, deltas
from estrato.operators.upsert import Batch
from estrato.plans import bronze, marts
from estrato.sources.lake import Lake
from estrato.workspace import freeze, scratch_path

# Three batches of obligations: most of them; then balances, arrears and products that
# change, with some new and some left out; then a few written off.
_FIRST = "SELECT {c} FROM b_obl WHERE id_oblig % 10 <> 0"
_SECOND_VALUES = {
    "sdo_capital": "cast(sdo_capital + case when id_oblig % 7 = 0 then 1 else 0 end "
                   "as decimal(18,2))",
    "dias_mora_act": "case when id_oblig % 9 = 0 then cast(null as int) else dias_mora_act end",
    "cod_prod": "case when id_oblig % 17 = 0 then '1' else cod_prod end",
}
_THIRD_VALUES = {"sdo_capital": "cast(0 as decimal(18,2))", "dias_mora_act": "5"}


def _columns(values: dict[str, str]) -> str:
    return ", ".join(
        f"{values[c]} AS {c}" if c in values else c for c in model.OBLIGATIONS.columns
    )


_SECOND = f"SELECT {_columns(_SECOND_VALUES)} FROM {{t}} WHERE id_oblig % 11 <> 0"
_THIRD = f"SELECT {_columns(_THIRD_VALUES)} FROM {{t}} WHERE id_oblig % 13 = 0"
_STATE = f"""WITH now AS (
  {_THIRD.format(t='b_obl')}
  UNION ALL SELECT * FROM ({_SECOND.format(t='b_obl')}) WHERE id_oblig % 13 <> 0
  UNION ALL {_FIRST.format(c=_columns({}))} AND id_oblig % 11 = 0 AND id_oblig % 13 <> 0)
"""
BY_PRODUCT = deltas.Mart(
    ("cod_prod",),
    {"cartera_total": "sdo_capital",
     "monto_en_mora": "CASE WHEN dias_mora_act > 0 THEN sdo_capital END",
     "en_mora": "CASE WHEN dias_mora_act > 0 THEN 1 END"},
)
BY_CLIENT = deltas.Mart(
    ("id_cli",), {"saldo_total_capital": "sdo_capital"},
    {"max_dias_mora": "dias_mora_act", "ultimo_vencimiento": "fec_venc"},
)


def _followed(d: Data, name: str, mart: deltas.Mart) -> DataFrame:
    """The mart after each of three batches; the last state of it."""
    lake = Lake(d.spark, scratch_path(d.spark, "lake"))
    rows = d.bronze(model.OBLIGATIONS.name).select(*model.OBLIGATIONS.columns)
    batches = [
        rows.filter("id_oblig % 10 <> 0"), d.spark.sql(_SECOND, t=rows), d.spark.sql(_THIRD, t=rows)
    ]
    for n, source in enumerate(batches, 1):
        stamp = Batch(dt.datetime(2001, 8, 26 + n, 9), f"lote-{n}", "core")
        bronze.ingest(lake, model.OBLIGATIONS, source, stamp)
        kept = marts.refresh(lake, model.OBLIGATIONS, name, mart)
    return kept


@query(
    "m13_product_mart_from_changes",
    _STATE + """SELECT cod_prod, count(*) AS registros,
       cast(coalesce(sum(sdo_capital), 0) as decimal(38,2)) AS cartera_total,
       cast(coalesce(sum(sdo_capital) FILTER (dias_mora_act > 0), 0) as decimal(38,2))
           AS monto_en_mora,
       count(*) FILTER (dias_mora_act > 0) AS en_mora
FROM now GROUP BY cod_prod""",
)
def product_mart(d: Data) -> DataFrame:
    return _followed(d, "por_producto", BY_PRODUCT)


@query(
    "m17_client_mart_from_changes",
    _STATE + """SELECT id_cli, count(*) AS registros,
       cast(coalesce(sum(sdo_capital), 0) as decimal(38,2)) AS saldo_total_capital,
       max(dias_mora_act) AS max_dias_mora, max(fec_venc) AS ultimo_vencimiento
FROM now GROUP BY id_cli""",
)
def client_mart(d: Data) -> DataFrame:
    return _followed(d, "por_cliente", BY_CLIENT)


GRAINS = [("fec_mov",), ("canal_key",), ("segmento",), ("ciudad",), ("segmento", "ciudad"), ()]


def _daily_partials(d: Data) -> DataFrame:
    """Clients with movements per day, channel, segment and city of residence."""
    clients = d.gold("dim_clientes").select(
        "cliente_key", F.col("segmento_legible").alias("segmento"),
        F.col("ciudad_res").alias("ciudad"),
    )
    # Each client once per day and channel before the join.
    seen = d.gold("fact_transacciones").select("fec_mov", "canal_key", "cliente_key").distinct()
    rows = seen.join(clients, "cliente_key")
    groups = ("fec_mov", "canal_key", "segmento", "ciudad")
    return freeze(bitmaps.partial(rows, "cliente_key", groups), "partials")


_CLIENTS = """WITH x AS (
  SELECT fec_mov, canal_key, segmento_legible AS segmento, ciudad_res AS ciudad, cliente_key
  FROM g_tra JOIN g_cli USING (cliente_key))
"""


@query(
    "k2_distinct_clients_by_day",
    _CLIENTS + "SELECT fec_mov, count(DISTINCT cliente_key) AS clientes FROM x GROUP BY fec_mov",
)
def clients_by_day(d: Data) -> DataFrame:
    return bitmaps.distinct_counts(_daily_partials(d), ["fec_mov"], "clientes")


@query(
    "k3_distinct_rollups",
    _CLIENTS + " UNION ALL ".join(
        f"SELECT {i} AS nivel, "
        + ", ".join(
            f"{c} AS {c}" if c in grain else f"cast(NULL as {kind}) AS {c}"
            for c, kind in (("fec_mov", "date"), ("canal_key", "bigint"),
                            ("segmento", "varchar"), ("ciudad", "varchar"))
        )
        + ", count(DISTINCT cliente_key) AS clientes FROM x"
        + (f" GROUP BY {', '.join(grain)}" if grain else "")
        for i, grain in enumerate(GRAINS)
    ),
)
def client_rollups(d: Data) -> DataFrame:
    """Day, channel, segment, city, segment and city, and all, from one stored partial."""
    return bitmaps.distinct_rollups(_daily_partials(d), GRAINS, "clientes")
