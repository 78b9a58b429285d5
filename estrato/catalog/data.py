"""Access to the test tables, their Bronze roles and the layers built from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from estrato import model
from estrato.catalog import roles
from estrato.plans import gold, silver
from estrato.workspace import freeze, lasting_tables

_stored: dict[tuple, DataFrame] = {}


class Data:
    """Frames over one data folder.

    Silver and Gold tables are stored the first time a query needs them, as a run would
    store them, and shared by the later queries of the session.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getitem__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def bronze(self, name: str) -> DataFrame:
        sources = {t: self[t] for t in roles.SOURCES if "{" + t + "}" in roles.ROLES[name]}
        return self.spark.sql(roles.ROLES[name].replace("{ts}", "timestamp_ntz"), **sources)

    def stored(self, layer: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        where = (self.spark.sparkContext.applicationId, self.sf_dir, layer, name)
        if where not in _stored:
            with lasting_tables():
                _stored[where] = freeze(make(), f"{layer}-{name}")
        return _stored[where]

    def silver(self, name: str) -> DataFrame:
        return self.stored("silver", name, lambda: self.fresh_silver(name))

    def fresh_silver(self, name: str) -> DataFrame:
        """A Silver table computed from Bronze and the stored tables it refers to."""
        b, s = self.bronze, self.silver
        makers = {
            "rechazos_clientes": lambda: silver.client_rejects(b(model.CLIENTS.name), roles.AS_OF),
            "clientes": lambda: silver.clients(
                b(model.CLIENTS.name), s("rechazos_clientes"), roles.AS_OF
            ),
            "productos": lambda: silver.products(b(model.PRODUCTS.name)),
            "sucursales": lambda: silver.branches(b(model.BRANCHES.name)),
            "rechazos_obligaciones": lambda: silver.obligation_rejects(
                b(model.OBLIGATIONS.name), s("clientes"), s("productos")
            ),
            "registros_rechazados": lambda: s("rechazos_clientes").unionByName(
                s("rechazos_obligaciones")
            ),
            "obligaciones": lambda: silver.obligations(
                b(model.OBLIGATIONS.name), s("rechazos_obligaciones")
            ),
            "obligaciones_rechazadas": lambda: silver.rejected_obligations(
                b(model.OBLIGATIONS.name), s("rechazos_obligaciones")
            ),
            "comisiones": lambda: silver.fees(
                b(model.FEES.name), s("clientes"), s("productos")
            ),
            "incentivos": lambda: silver.incentives(
                b(model.INCENTIVES.name), s("clientes"), s("productos")
            ),
            "movimientos_validos": lambda: silver.valid_movements(
                b(model.MOVEMENTS.name), s("clientes"), s("productos")
            ),
            "movimientos": lambda: silver.movements(s("movimientos_validos")),
        }
        return makers[name]()

    def gold(self, name: str) -> DataFrame:
        return self.stored("gold", name, lambda: self.fresh_gold(name))

    def fresh_gold(self, name: str) -> DataFrame:
        """A Gold table computed from the stored tables it refers to."""
        s, g = self.silver, self.gold
        makers = {
            "dim_clientes": lambda: gold.dim_clients(s("clientes")),
            "dim_productos": lambda: gold.dim_products(s("productos")),
            "dim_geografia": lambda: gold.dim_geography(s("clientes")),
            "dim_canal": lambda: gold.dim_channel(s("movimientos")),
            "fact_transacciones": lambda: gold.transaction_fact(
                self.transaction_rows(), s("movimientos")
            ),
            "fact_cartera": lambda: gold.portfolio_fact(self.portfolio_rows()),
            "fact_rentabilidad_cliente": lambda: gold.profitability(
                g("dim_clientes"), s("obligaciones"), s("productos"), s("comisiones"),
                s("incentivos"), roles.CUTOFF,
            ),
            "kpi_cartera_diaria": lambda: gold.portfolio_kpi(
                g("fact_cartera"), g("dim_clientes"), roles.CUTOFF
            ),
            "reporte_regulatorio": lambda: gold.regulatory_report(
                g("fact_cartera"), g("fact_transacciones"), g("dim_clientes"), g("dim_geografia")
            ),
            "vista_cliente_360": lambda: gold.customer_360(
                g("dim_clientes"), g("fact_cartera"), g("fact_transacciones"),
                g("fact_rentabilidad_cliente"),
            ),
        }
        return makers[name]()

    def transaction_rows(self) -> DataFrame:
        g = self.gold
        return gold.transaction_rows(
            self.silver("movimientos"), g("dim_clientes"), g("dim_productos"), g("dim_canal"),
            g("dim_geografia"), roles.FX_RATE,
        )

    def portfolio_rows(self) -> DataFrame:
        return gold.portfolio_rows(
            self.silver("obligaciones"), self.gold("dim_clientes"), self.gold("dim_productos")
        )
