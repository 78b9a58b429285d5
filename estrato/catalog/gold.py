"""Dimensions, facts, profitability and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from estrato.catalog.data import Data
from estrato.catalog.registry import query
from estrato.catalog.roles import AS_OF, CUTOFF, FX_RATE
from estrato.functions.dates import month_starts
from estrato.functions.money import convert
from estrato.operators.keys import dense_key
from estrato.operators.months import spine, unpivot_months
from estrato.plans import gold, silver


@query(
    "g1_dense_key",
    "SELECT row_number() OVER (ORDER BY o_custkey, o_orderkey) AS llave, o_orderkey FROM orders",
)
def numbered_orders(d: Data) -> DataFrame:
    orders = d["orders"].select("o_custkey", "o_orderkey")
    return dense_key(orders, ["o_custkey", "o_orderkey"], "llave").select("llave", "o_orderkey")


def _built(name: str, table: str, view: str, select: str = "*") -> None:
    def run(d: Data) -> DataFrame:
        return d.fresh_gold(table)

    query(name, f"SELECT {select} FROM {view}")(run)


_built("g2_client_dimension", "dim_clientes", "g_cli")
_built("g3_product_dimension", "dim_productos", "g_prod")
_built("g4_geography_dimension", "dim_geografia", "g_geo")
_built("g5_channel_dimension", "dim_canal", "g_can")


@query(
    "m1_transaction_fact",
    "SELECT * REPLACE (round(desviacion_historica, 6) AS desviacion_historica) FROM g_tra",
)
def transactions(d: Data) -> DataFrame:
    return d.fresh_gold("fact_transacciones").withColumn(
        "desviacion_historica", F.round("desviacion_historica", 6)
    )


@query(
    "m2_currency",
    "SELECT o_orderkey, cast(((2 * cast(cast(o_totalprice as decimal(18,2)) * 100 as bigint) "
    "+ 4000) // 8000) as decimal(18,0)) * cast(0.01 as decimal(3,2)) AS usd FROM orders",
)
def currency(d: Data) -> DataFrame:
    return d["orders"].select("o_orderkey", convert(F.col("o_totalprice"), FX_RATE).alias("usd"))


_built("m3_portfolio_fact", "fact_cartera", "g_car")


@query(
    "m4_regulatory_class",
    "SELECT o_orderkey, if(x = 0, 'A', if(x < 31, 'B', if(x < 61, 'C', if(x < 91, 'D', 'E')))) "
    "AS clase FROM (SELECT o_orderkey, o_orderkey % 123 - 1 AS x FROM orders)",
)
def regulatory_class(d: Data) -> DataFrame:
    days = (F.col("o_orderkey") % 123 - 1).cast("int")
    return d["orders"].select("o_orderkey", gold.regulatory_class(days).alias("clase"))


@query(
    "m5_provision_rate",
    "SELECT o_orderkey, cast(if(x = 0, 0.01, if(x < 31, 0.05, if(x < 61, 0.20, "
    "if(x < 91, 0.50, 1.00)))) as decimal(5,2)) AS tasa "
    "FROM (SELECT o_orderkey, o_orderkey % 123 - 1 AS x FROM orders)",
)
def provision_rate(d: Data) -> DataFrame:
    days = (F.col("o_orderkey") % 123 - 1).cast("int")
    return d["orders"].select("o_orderkey", gold.provision_rate(days).alias("tasa"))


@query(
    "m6_provision_amount",
    "SELECT id_oblig, clasificacion_regulatoria, provision_estimada FROM g_car",
)
def provision_amount(d: Data) -> DataFrame:
    return d.portfolio_rows().select("id_oblig", "clasificacion_regulatoria", "provision_estimada")


@query(
    "m7_month_spine",
    "SELECT cast(unnest(generate_series(date_trunc('month', w) - interval 11 month, "
    "date_trunc('month', w), interval 1 month)) as date) AS mes_inicio "
    "FROM (SELECT cast(max(o_orderdate) as timestamp) AS w FROM orders)",
)
def month_spine(d: Data) -> DataFrame:
    """Twelve months up to the last order's month; the cut-off comes from the data."""
    last = d["orders"].agg(F.max("o_orderdate").cast("date")).first()[0]
    return spine(d.spark, month_starts(last))


@query(
    "m8_client_month_grid",
    "SELECT c_custkey, mes_inicio FROM customer CROSS JOIN months",
)
def client_months(d: Data) -> DataFrame:
    """Every client with every month, by unpivoting; no cross join."""
    return unpivot_months(d["customer"], ["c_custkey"], month_starts(CUTOFF), {}).drop("_i")


def _long(wide: DataFrame, prefix: str, name: str, kind: str = "decimal(18,2)") -> DataFrame:
    cells = unpivot_months(wide, ["id_cli"], month_starts(CUTOFF), {name: prefix}).drop("_i")
    return cells.filter(F.col(name).isNotNull()).withColumn(name, F.col(name).cast(kind))


@query(
    "m9_monthly_interest",
    "SELECT id_cli, mes_inicio, cast(cast((2 * raw + 1200) // 2400 as decimal(20,0)) "
    "* cast(0.01 as decimal(3,2)) as decimal(18,2)) AS intereses FROM g_int",
)
def monthly_interest(d: Data) -> DataFrame:
    wide = gold.interest_by_month(
        d.silver("obligaciones"), d.silver("productos"), month_starts(CUTOFF)
    )
    return _long(wide, "i", "intereses")


@query(
    "m10_monthly_fees",
    "SELECT id_cli, mes_inicio, cast(paid as decimal(18,2)) AS comisiones FROM g_fee",
)
def monthly_fees(d: Data) -> DataFrame:
    return _long(gold.fees_by_month(d.silver("comisiones"), month_starts(CUTOFF)), "f",
                 "comisiones")


@query(
    "m11_monthly_incentives",
    "SELECT id_cli, mes_inicio, cast(given as decimal(18,2)) AS incentivos FROM g_gift",
)
def monthly_incentives(d: Data) -> DataFrame:
    return _long(gold.incentives_by_month(d.silver("incentivos"), month_starts(CUTOFF)), "g",
                 "incentivos")


_built("m12_profitability", "fact_rentabilidad_cliente", "g_ren")
_built("m13_portfolio_kpi", "kpi_cartera_diaria", "g_kpi")


@query("m14_active_accounts", "SELECT * FROM g_acc")
def active_accounts(d: Data) -> DataFrame:
    return gold.active_accounts(d.gold("fact_cartera"), d.gold("dim_clientes"))


@query("m15_transaction_volume", "SELECT * FROM g_vol")
def transaction_volume(d: Data) -> DataFrame:
    return gold.transaction_volume(
        d.gold("fact_transacciones"), d.gold("dim_clientes"), d.gold("dim_geografia")
    )


_built("m16_regulatory_report", "reporte_regulatorio", "g_reg")


@query("m17_client_portfolio", "SELECT * FROM g_b1")
def client_portfolio(d: Data) -> DataFrame:
    return gold.portfolio_block(d.gold("fact_cartera"))


@query("m18_client_movements", "SELECT * FROM g_b2")
def client_movements(d: Data) -> DataFrame:
    return gold.movement_block(d.gold("fact_transacciones"))


@query("m19_client_profitability", "SELECT * FROM g_b3")
def client_profitability(d: Data) -> DataFrame:
    return gold.profitability_block(d.gold("fact_rentabilidad_cliente"))


_built("m20_customer_360", "vista_cliente_360", "g_360")


@query("m13_portfolio_kpi_from_bronze", "SELECT * FROM g_kpi")
def kpi_from_bronze(d: Data) -> DataFrame:
    return flagship(d)


def flagship(d: Data) -> DataFrame:
    """Portfolio KPI from the raw tables to the mart in one lazy plan but for the two
    numbered dimensions."""
    raw = d.bronze("TB_OBLIGACIONES")
    bad = silver.client_rejects(d.bronze("TB_CLIENTES_CORE"), AS_OF)
    clients = silver.clients(d.bronze("TB_CLIENTES_CORE"), bad, AS_OF)
    products = silver.products(d.bronze("TB_PRODUCTOS_CAT"))
    dim_clients, dim_products = gold.dim_clients(clients), gold.dim_products(products)
    rejects = silver.obligation_rejects(raw, dim_clients, dim_products)
    rows = gold.portfolio_rows(silver.obligations(raw, rejects), dim_clients, dim_products)
    return gold.portfolio_kpi(rows, dim_clients, CUTOFF)
