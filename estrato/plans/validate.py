"""Reconciliation queries and the automatic checks over Silver and Gold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from estrato.functions.money import total
from estrato.operators.checks import (
    Check, duplicates, flagged, key_profile, orphans, orphans_of, run_checks,
)
from estrato.operators.quality import union_all

TOLERANCE = Decimal("0.01")
FACT_KEYS = {
    "cliente_key": "dim_clientes",
    "producto_key": "dim_productos",
    "canal_key": "dim_canal",
    "geografia_key": "dim_geografia",
}


def suspicious(movements: DataFrame) -> DataFrame:
    return movements.filter("ind_sospechoso = 1").select(
        "id_mov", "id_cli", F.col("vr_mov").alias("monto"), "total_alertas", "ind_sospechoso"
    )


def transaction_summary(transactions: DataFrame) -> DataFrame:
    missing = {
        "cliente_key": "clientes_sin_relacion",
        "producto_key": "productos_sin_relacion",
        "canal_key": "canales_sin_relacion",
        "geografia_key": "geografias_sin_relacion",
    }
    return transactions.agg(
        F.count("*").alias("total_transacciones"),
        F.count_if(F.col("ind_sospechoso") == 1).alias("sospechosas"),
        *[F.count_if(F.col(k).isNull()).alias(name) for k, name in missing.items()],
        total("monto_cop").alias("volumen_cop"),
        total("monto_usd").alias("volumen_usd"),
    )


def incomplete_provision() -> Column:
    return (
        F.col("clasificacion_regulatoria").isNull()
        | F.col("porcentaje_provision").isNull()
        | F.col("provision_estimada").isNull()
    )


def portfolio_summary(portfolio: DataFrame) -> DataFrame:
    grade = F.col("clasificacion_regulatoria")
    return portfolio.agg(
        F.count("*").alias("total_cartera"),
        F.count_if(incomplete_provision()).alias("nulos_criticos"),
        *[F.count_if(grade == g).alias(f"clase_{g}") for g in "ABCDE"],
    )


def wrong_value() -> Column:
    """Monthly value off by more than the tolerance from interest plus fees."""
    zero = F.lit(0).cast("decimal(18,2)")
    parts = F.coalesce("ingreso_intereses", zero) + F.coalesce("comisiones_cobradas", zero)
    return F.abs(F.col("cltv_mensual") - parts) > F.lit(TOLERANCE)


def profitability_summary(profit: DataFrame) -> DataFrame:
    return profit.agg(
        F.count("*").alias("total_registros"),
        F.count_distinct("cliente_key").alias("clientes"),
        F.min("mes_inicio").alias("primer_mes"),
        F.max("mes_inicio").alias("ultimo_mes"),
        F.count_if(wrong_value()).alias("cltv_incorrectos"),
    )


def kpi_summary(kpi: DataFrame) -> DataFrame:
    return kpi.agg(
        F.count("*").alias("total_kpis"),
        F.sum("total_obligaciones_activas").alias("obligaciones_consolidadas"),
        F.sum("clientes_en_mora").alias("clientes_en_mora"),
    )


def regulatory_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.sum("total_transacciones").alias("transacciones"),
        total("volumen_transaccional").alias("volumen_total"),
        F.sum("cuentas_activas").alias("cuentas_activas"),
    )


def customer_grain(view: DataFrame) -> DataFrame:
    return view.agg(
        F.count("*").alias("total_clientes"),
        F.count_distinct("cliente_key").alias("clientes_unicos"),
    )


def duplicate_report(gold: Mapping[str, DataFrame]) -> DataFrame:
    keys = {
        "dim_clientes": "cliente_key",
        "dim_productos": "producto_key",
        "fact_transacciones": "transaccion_key",
        "fact_cartera": "cartera_key",
    }
    return union_all(
        [
            duplicates(gold[name], key).select(F.lit(name).alias("objeto"), "duplicados")
            for name, key in keys.items()
        ]
    )


def movement_grain(transactions: DataFrame) -> DataFrame:
    """Movements that appear more than once, the trace of a city in two departments."""
    return duplicates(transactions, "id_mov")


def transaction_orphans(gold: Mapping[str, DataFrame]) -> DataFrame:
    return orphans(
        gold["fact_transacciones"], {key: gold[dim] for key, dim in FACT_KEYS.items()}
    )


def missing_keys(transactions: DataFrame) -> DataFrame:
    """NULL dimension keys, summed over the four keys."""
    total = sum((F.count_if(F.col(k).isNull()) for k in FACT_KEYS), F.lit(0))
    return transactions.agg(total.cast("bigint").alias("faltantes"))


def fraud_difference(movements: DataFrame, profile: DataFrame) -> DataFrame:
    """How far the suspicious counts of Silver and of the fact's profile are apart."""
    parts = union_all(
        [
            movements.filter("ind_sospechoso = 1").agg(F.count("*").alias("n")),
            flagged(profile).select((-F.col("n")).alias("n")),
        ]
    )
    return parts.agg(F.abs(F.sum("n")).alias("diferencia"))


def checks(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> list[Check]:
    """The automatic checks. The transaction fact is read twice: for repeated keys, which
    takes a shuffle of its own, and once for everything else."""
    transactions, profit = gold["fact_transacciones"], gold["fact_rentabilidad_cliente"]
    dims = {key: gold[dim] for key, dim in FACT_KEYS.items()}
    profile = key_profile(transactions, list(dims), F.col("ind_sospechoso") == 1)
    # Names, layers and details of the automatic checks.
    return [
        Check("Duplicados en dim_clientes", "GOLD",
              duplicates(gold["dim_clientes"], "cliente_key"), "No deben existir duplicados."),
        Check("Duplicados en fact_transacciones", "GOLD",
              duplicates(transactions, "transaccion_key"), "No deben existir duplicados."),
        Check("Integridad referencial fact_transacciones", "GOLD",
              orphans_of(profile, dims).agg(F.sum("huerfanos")),
              "No deben existir relaciones faltantes."),
        Check("Nulos criticos fact_cartera", "GOLD",
              gold["fact_cartera"].agg(F.count_if(incomplete_provision())),
              "No deben existir nulos criticos."),
        Check("Consistencia fraude Silver vs Gold", "SILVER-GOLD",
              fraud_difference(silver["movimientos"], profile),
              "Silver y Gold deben coincidir."),
        Check("Consistencia calculo CLTV", "GOLD", profit.agg(F.count_if(wrong_value())),
              "CLTV debe coincidir con intereses y comisiones."),
    ]


def run(
    silver: Mapping[str, DataFrame],
    gold: Mapping[str, DataFrame],
    run_id: str,
    ts: dt.datetime,
    first_id: int = 1,
) -> DataFrame:
    return run_checks(checks(silver, gold), run_id, ts, first_id)
