"""Reconciliation queries, automatic checks and run summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from estrato import model
from estrato.catalog.data import Data
from estrato.catalog.io import COUNTS_SQL
from estrato.catalog.ingest import LOG_SQL
from estrato.catalog.quality import quality_report
from estrato.catalog.registry import query
from estrato.catalog.roles import RUN_TS
from estrato.operators.checks import duplicates, latest_run, orphans, run_totals
from estrato.operators.quality import count_rows
from estrato.plans import summary, validate

_GOLD = {
    "dim_clientes": "g_cli", "dim_productos": "g_prod", "dim_geografia": "g_geo",
    "dim_canal": "g_can", "fact_transacciones": "g_tra", "fact_cartera": "g_car",
    "fact_rentabilidad_cliente": "g_ren", "kpi_cartera_diaria": "g_kpi",
    "reporte_regulatorio": "g_reg", "vista_cliente_360": "g_360",
}


@query("v1_bronze_counts", COUNTS_SQL)
def bronze_counts(d: Data) -> DataFrame:
    return count_rows({t.name: d.bronze(t.name) for t in model.TABLES}).orderBy("objeto")


@query(
    "v2_conformity_listing",
    "SELECT tabla, registros_bronze, registros_silver, registros_rechazados, "
    "cast(round(100.0 * registros_silver / registros_bronze, 2) as decimal(10,2)) "
    "AS porcentaje_conformidad FROM s_quality ORDER BY tabla",
)
def conformity_listing(d: Data) -> DataFrame:
    return quality_report(d).orderBy("tabla")


@query(
    "v3_rejected_listing",
    "SELECT id_oblig, id_cli, tipo_error, motivo_rechazo FROM b_obl JOIN s_rej_obl "
    "ON id_registro = cast(id_oblig as varchar)",
)
def rejected_listing(d: Data) -> DataFrame:
    return d.silver("obligaciones_rechazadas").select(
        "id_oblig", "id_cli", "tipo_error", "motivo_rechazo"
    )


@query(
    "v4_suspicious_listing",
    "SELECT id_mov, id_cli, vr_mov AS monto, total_alertas, ind_sospechoso FROM s_mov "
    "WHERE alerta_monto = 1",
)
def suspicious_listing(d: Data) -> DataFrame:
    return validate.suspicious(d.silver("movimientos"))


@query(
    "v5_gold_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS objeto, count(*) AS registros FROM {v}" for t, v in _GOLD.items()
    ),
)
def gold_counts(d: Data) -> DataFrame:
    return count_rows({t: d.gold(t) for t in _GOLD}).orderBy("objeto")


@query(
    "v6_transaction_summary",
    "SELECT count(*) AS total_transacciones, cast(sum(ind_sospechoso) as bigint) AS sospechosas, "
    "count(*) - count(cliente_key) AS clientes_sin_relacion, "
    "count(*) - count(producto_key) AS productos_sin_relacion, "
    "count(*) - count(canal_key) AS canales_sin_relacion, "
    "count(*) - count(geografia_key) AS geografias_sin_relacion, "
    "cast(sum(monto_cop) as decimal(38,2)) AS volumen_cop, "
    "cast(sum(monto_usd) as decimal(38,2)) AS volumen_usd FROM g_tra",
)
def transaction_summary(d: Data) -> DataFrame:
    return validate.transaction_summary(d.gold("fact_transacciones"))


@query(
    "v7_portfolio_summary",
    "SELECT count(*) AS total_cartera, count(*) - count(clasificacion_regulatoria "
    "|| cast(porcentaje_provision as varchar) || cast(provision_estimada as varchar)) "
    "AS nulos_criticos, "
    + ", ".join(f"count(*) FILTER (clasificacion_regulatoria = '{g}') AS \"clase_{g}\""
                for g in "ABCDE")
    + " FROM g_car",
)
def portfolio_summary(d: Data) -> DataFrame:
    return validate.portfolio_summary(d.gold("fact_cartera"))


@query(
    "v8_profitability_summary",
    "SELECT count(*) AS total_registros, count(DISTINCT cliente_key) AS clientes, "
    "min(mes_inicio) AS primer_mes, max(mes_inicio) AS ultimo_mes, "
    "count(*) FILTER (abs(cltv_mensual - ingreso_intereses - comisiones_cobradas) > 0.01) "
    "AS cltv_incorrectos FROM g_ren",
)
def profitability_summary(d: Data) -> DataFrame:
    return validate.profitability_summary(d.gold("fact_rentabilidad_cliente"))


@query(
    "v9_kpi_rollup",
    "SELECT count(*) AS total_kpis, cast(sum(total_obligaciones_activas) as bigint) "
    "AS obligaciones_consolidadas, cast(sum(clientes_en_mora) as bigint) AS clientes_en_mora "
    "FROM g_kpi",
)
def kpi_rollup(d: Data) -> DataFrame:
    return validate.kpi_summary(d.gold("kpi_cartera_diaria"))


@query(
    "v10_regulatory_rollup",
    "SELECT cast(sum(total_transacciones) as bigint) AS transacciones, "
    "cast(sum(volumen_transaccional) as decimal(38,2)) AS volumen_total, "
    "cast(sum(cuentas_activas) as bigint) AS cuentas_activas FROM g_reg",
)
def regulatory_rollup(d: Data) -> DataFrame:
    return validate.regulatory_summary(d.gold("reporte_regulatorio"))


@query(
    "v11_customer_grain",
    "SELECT count(*) AS total_clientes, count(DISTINCT cliente_key) AS clientes_unicos FROM g_360",
)
def customer_grain(d: Data) -> DataFrame:
    return validate.customer_grain(d.gold("vista_cliente_360"))


@query(
    "v12_gold_duplicates",
    "SELECT unnest(['dim_clientes', 'dim_productos', 'fact_transacciones', 'fact_cartera']) "
    "AS objeto, unnest([(SELECT count(*) - count(DISTINCT cliente_key) FROM g_cli), "
    "(SELECT count(*) - count(DISTINCT producto_key) FROM g_prod), "
    "(SELECT count(*) - count(DISTINCT transaccion_key) FROM g_tra), "
    "(SELECT count(*) - count(DISTINCT cartera_key) FROM g_car)]) AS duplicados",
)
def gold_duplicates(d: Data) -> DataFrame:
    tables = ("dim_clientes", "dim_productos", "fact_transacciones", "fact_cartera")
    return validate.duplicate_report({t: d.gold(t) for t in tables})


@query(
    "v12_duplicate_keys",
    "SELECT count(*) AS duplicados FROM (SELECT id_comision FROM b_com GROUP BY 1 "
    "HAVING count(*) > 1)",
)
def duplicate_keys(d: Data) -> DataFrame:
    """A table that does have repeated keys."""
    return duplicates(d.bronze(model.FEES.name), "id_comision")


@query(
    "v12_movement_grain",
    "SELECT count(*) AS duplicados FROM (SELECT id_mov FROM g_tra GROUP BY 1 HAVING count(*) > 1)",
)
def movement_grain(d: Data) -> DataFrame:
    return validate.movement_grain(d.gold("fact_transacciones"))


_ORPHANS = " UNION ALL ".join(
    f"SELECT '{key}' AS llave, count(*) AS huerfanos FROM g_tra LEFT JOIN {view} x "
    f"ON g_tra.{key} = x.{key} WHERE x.{key} IS NULL"
    for key, view in (("cliente_key", "g_cli"), ("producto_key", "g_prod"),
                      ("canal_key", "g_can"), ("geografia_key", "g_geo"))
)


def _gold(d: Data) -> dict[str, DataFrame]:
    names = ("dim_clientes", "dim_productos", "dim_geografia", "dim_canal",
             "fact_transacciones", "fact_cartera", "fact_rentabilidad_cliente")
    return {t: d.gold(t) for t in names}


@query("v13_orphans", _ORPHANS)
def orphan_counts(d: Data) -> DataFrame:
    return validate.transaction_orphans(_gold(d))


@query(
    "v13_orphans_second_fact",
    "SELECT 'id_cli' AS llave, count(*) AS huerfanos FROM b_mov WHERE id_cli NOT IN "
    "(SELECT id_cli FROM s_cli) UNION ALL SELECT 'cod_prod', count(*) FROM b_mov "
    "WHERE cod_prod NOT IN (SELECT cod_prod FROM s_prod)",
)
def movement_orphans(d: Data) -> DataFrame:
    """The same check over raw movements, which do have orphans."""
    dims = {"id_cli": d.silver("clientes"), "cod_prod": d.silver("productos")}
    return orphans(d.bronze(model.MOVEMENTS.name), dims)


_RESULT_SQL = {
    "v14_check_client_duplicates": (
        "Duplicados en dim_clientes", "SELECT count(*) - count(DISTINCT cliente_key) FROM g_cli"),
    "v15_check_transaction_duplicates": (
        "Duplicados en fact_transacciones",
        "SELECT count(*) - count(DISTINCT transaccion_key) FROM g_tra"),
    "v16_check_referential_integrity": (
        "Integridad referencial fact_transacciones",
        f"SELECT cast(sum(huerfanos) as bigint) FROM ({_ORPHANS})"),
    "v17_check_critical_nulls": (
        "Nulos criticos fact_cartera",
        "SELECT count(*) FROM g_car WHERE provision_estimada IS NULL "
        "OR porcentaje_provision IS NULL OR clasificacion_regulatoria IS NULL"),
    "v18_check_fraud_consistency": (
        "Consistencia fraude Silver vs Gold",
        "SELECT cast(abs((SELECT sum(ind_sospechoso) FROM s_mov) "
        "- (SELECT sum(ind_sospechoso) FROM g_tra)) as bigint)"),
    "v19_check_monthly_value": (
        "Consistencia calculo CLTV",
        "SELECT count(*) FROM g_ren WHERE abs(cltv_mensual - ingreso_intereses "
        "- comisiones_cobradas) > 0.01"),
}


def _check_sql(name: str, observed: str) -> str:
    return (
        f"SELECT '{name}' AS nombre_prueba, x AS valor_observado, "
        f"if(x = 0, 'PASS', 'FAIL') AS resultado FROM (SELECT ({observed}) AS x)"
    )


def _run(d: Data, run_id: str = "run-1", first: int = 1) -> DataFrame:
    silver = {"movimientos": d.silver("movimientos")}
    return validate.run(silver, _gold(d), run_id, RUN_TS, first)


for _key, (_name, _observed) in _RESULT_SQL.items():

    def _one(d: Data, name=_name) -> DataFrame:
        silver = {"movimientos": d.silver("movimientos")}
        check = next(c for c in validate.checks(silver, _gold(d)) if c.name == name)
        results = validate.run_checks([check], "run-1", RUN_TS)
        return results.select("nombre_prueba", "valor_observado", "resultado")

    query(_key, _check_sql(_name, _observed))(_one)

_ALL_CHECKS = " UNION ALL ".join(_check_sql(n, o) for n, o in _RESULT_SQL.values())


@query(
    "v20_check_results",
    f"SELECT *, cast(0 as bigint) AS valor_esperado, if(nombre_prueba LIKE '%Silver%', "
    f"'SILVER-GOLD', 'GOLD') AS capa FROM ({_ALL_CHECKS})",
)
def check_results(d: Data) -> DataFrame:
    return _run(d).select(
        "nombre_prueba", "valor_observado", "resultado", "valor_esperado", "capa"
    )


def _two_runs(d: Data) -> DataFrame:
    """An older run whose id sorts after the newer one."""
    return _run(d, "z-old", 1).unionByName(_run(d, "a-new", 7))


@query(
    "v21_latest_run",
    f"SELECT *, 'a-new' AS id_ejecucion FROM ({_ALL_CHECKS})",
)
def latest_results(d: Data) -> DataFrame:
    return latest_run(_two_runs(d)).select(
        "nombre_prueba", "valor_observado", "resultado", "id_ejecucion"
    )


@query(
    "v21_run_totals",
    f"SELECT count(*) AS total_pruebas, count(*) FILTER (resultado = 'PASS') AS pruebas_pass, "
    f"count(*) FILTER (resultado = 'FAIL') AS pruebas_fail FROM ({_ALL_CHECKS})",
)
def totals(d: Data) -> DataFrame:
    return run_totals(_two_runs(d))


@query(
    "v22_missing_keys",
    "SELECT count(*) * 4 - count(cliente_key) - count(producto_key) - count(canal_key) "
    "- count(geografia_key) AS faltantes FROM g_tra",
)
def missing_keys(d: Data) -> DataFrame:
    return validate.missing_keys(d.gold("fact_transacciones"))


# Run summaries --------------------------------------------------------------------------

_LOG = f"WITH log AS ({LOG_SQL.format(events='events')}) "


def _log(d: Data) -> DataFrame:
    return d.spark.sql(LOG_SQL, events=d["events"])


@query(
    "r1_latest_log_rows",
    _LOG + "SELECT tabla, estado, registros_procesados, watermark_hasta FROM log "
    "WHERE id_log IN (SELECT max(id_log) FROM log GROUP BY tabla)",
)
def latest_log_rows(d: Data) -> DataFrame:
    return summary.bronze_latest(_log(d))


@query(
    "r1_ingestion_totals",
    _LOG + "SELECT count(*) AS tablas, cast(sum(registros_procesados) as bigint) "
    "AS registros_nuevos, count(watermark_hasta) AS tablas_auditadas, "
    "count(*) FILTER (estado = 'ERROR') AS errores FROM log "
    "WHERE id_log IN (SELECT max(id_log) FROM log GROUP BY tabla)",
)
def ingestion_totals(d: Data) -> DataFrame:
    return summary.bronze_totals(_log(d))


@query(
    "r2_silver_quality",
    "SELECT cast(sum(registros_bronze) as bigint) AS recibidos, "
    "cast(sum(registros_silver) as bigint) AS validos, "
    "cast(sum(registros_rechazados) as bigint) AS rechazados, "
    "cast(round(100.0 * sum(registros_silver) / sum(registros_bronze), 2) as decimal(10,2)) "
    "AS calidad_global FROM s_quality",
)
def silver_quality(d: Data) -> DataFrame:
    """An older, emptier report precedes the one that counts."""
    report = quality_report(d)
    old = report.withColumn("registros_silver", F.lit(0).cast("bigint"))
    stamped = [
        r.withColumn("fecha_ejecucion", F.lit(RUN_TS - dt.timedelta(days=back)))
        for r, back in ((old, 1), (report, 0))
    ]
    return summary.silver_totals(stamped[0].unionByName(stamped[1]))


@query(
    "r3_last_reject",
    "SELECT id_oblig, id_cli, tipo_error, motivo_rechazo FROM b_obl JOIN s_rej_obl "
    "ON id_registro = cast(id_oblig as varchar) ORDER BY id_oblig DESC LIMIT 1",
)
def last_reject(d: Data) -> DataFrame:
    rejected = d.silver("obligaciones_rechazadas").withColumn("fecha_rechazo", F.lit(RUN_TS))
    return summary.last_reject(rejected)


@query(
    "r3_last_suspicious_movement",
    "SELECT id_mov, id_cli, vr_mov, total_alertas FROM s_mov WHERE ind_sospechoso = 1 "
    "ORDER BY id_mov DESC LIMIT 1",
)
def last_suspicious(d: Data) -> DataFrame:
    return summary.last_suspicious_movement(d.silver("movimientos"))


@query(
    "r4_last_suspicious_transaction",
    "SELECT id_mov, id_cli, monto_cop, total_alertas, ind_sospechoso FROM g_tra "
    "JOIN g_cli USING (cliente_key) WHERE ind_sospechoso = 1 ORDER BY id_mov DESC LIMIT 1",
)
def last_transaction(d: Data) -> DataFrame:
    return summary.last_suspicious_transaction(d.gold("fact_transacciones"), d.gold("dim_clientes"))


@query(
    "r5_class_counts",
    "SELECT count(*) AS total, "
    + ", ".join(f"count(*) FILTER (clasificacion_regulatoria = '{g}') AS {g.lower()}"
                for g in "ABCDE")
    + ", count(*) - count(provision_estimada) AS provisiones_nulas FROM g_car",
)
def class_counts(d: Data) -> DataFrame:
    return summary.class_counts(d.gold("fact_cartera"))


@query(
    "r6_customer_rows",
    "SELECT count(*) AS total_clientes, count(DISTINCT id_cli) AS clientes_unicos FROM g_360",
)
def customer_rows(d: Data) -> DataFrame:
    return validate.customer_grain(d.gold("vista_cliente_360"))
