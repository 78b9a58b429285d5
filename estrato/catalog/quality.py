"""Data quality, cleansing, masking and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from estrato import model
from estrato.catalog.data import Data
from estrato.catalog.registry import query
from estrato.catalog.roles import AS_OF
from estrato.functions.dates import age_years
from estrato.functions.money import monthly_rate
from estrato.functions.text import (
    blank_to_null, flag, mask_document, mask_name, matches, normalised, or_default, relabel,
)
from estrato.operators.observed import null_profile_of, written
from estrato.operators.quality import (
    conformity, existing, latest_by, null_profile, quarantine, rejects_by_key,
)
from estrato.plans import silver
from estrato.workspace import freeze

_CLI, _OBL, _COM = model.CLIENTS.name, model.OBLIGATIONS.name, model.FEES.name


@query("q1_client_rejects", "SELECT * FROM s_rej_cli")
def client_rejects(d: Data) -> DataFrame:
    return silver.client_rejects(d.bronze(_CLI), AS_OF)


@query("q2_obligation_rejects", "SELECT * FROM s_rej_obl")
def obligation_rejects(d: Data) -> DataFrame:
    return d.fresh_silver("rechazos_obligaciones")


@query(
    "q3_quarantine",
    "SELECT id_oblig FROM b_obl WHERE cast(id_oblig as varchar) NOT IN "
    "(SELECT id_registro FROM s_rej_obl)",
)
def quarantined(d: Data) -> DataFrame:
    kept = quarantine(d.bronze(_OBL), d.silver("rechazos_obligaciones"), _OBL, "id_oblig")
    return kept.select("id_oblig")


@query(
    "q4_referential_filter",
    "SELECT id_comision, id_lote FROM b_com WHERE id_cli IN (SELECT id_cli FROM s_cli) "
    "AND cod_prod IN (SELECT cod_prod FROM s_prod)",
)
def referential_filter(d: Data) -> DataFrame:
    known = existing(d.bronze(_COM), d.silver("clientes"), "id_cli")
    return existing(known, d.silver("productos"), "cod_prod").select("id_comision", "id_lote")


_LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_quantity")


@query(
    "q5_latest_version",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem QUALIFY "
    "row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
    + ", ".join(f"{c} DESC" for c in _LINE_ORDER) + ") = 1",
)
def latest_version(d: Data) -> DataFrame:
    newest = latest_by(
        d["lineitem"], ["l_orderkey", "l_linenumber"], [F.desc(c) for c in _LINE_ORDER]
    )
    return newest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


@query(
    "q6_null_defaults",
    "SELECT id_cli, coalesce(estado_cli, 'NO_INFORMADO') AS estado_cli, "
    "coalesce(canal_adquis, 'NO_INFORMADO') AS canal_adquis, "
    "coalesce(score_buro, 0) AS score_buro FROM b_cli",
)
def null_defaults(d: Data) -> DataFrame:
    return d.bronze(_CLI).select(
        "id_cli",
        or_default(F.col("estado_cli")).alias("estado_cli"),
        or_default(F.col("canal_adquis")).alias("canal_adquis"),
        or_default(F.col("score_buro"), 0).alias("score_buro"),
    )


@query(
    "q7_blank_to_default",
    "SELECT id_cli, if(trim(ifnull(cod_segmento, '')) = '', 'NO_INFORMADO', trim(cod_segmento)) "
    "AS cod_segmento FROM b_cli",
)
def blank_default(d: Data) -> DataFrame:
    return d.bronze(_CLI).select(
        "id_cli", or_default(blank_to_null(F.col("cod_segmento"))).alias("cod_segmento")
    )


@query(
    "q8_normalise_text",
    "SELECT cod_prod, trim(upper(tip_prod)) AS tipo, trim(desc_prod) AS nombre FROM b_prod",
)
def normalise_text(d: Data) -> DataFrame:
    return d.bronze(model.PRODUCTS.name).select(
        "cod_prod", normalised(F.col("tip_prod")).alias("tipo"),
        F.trim("desc_prod").alias("nombre"),
    )


@query(
    "q9_mask_name",
    "SELECT id_cli, ifnull(trim(nomb_cli)[1], '') || '***' AS nombre, "
    "ifnull(trim(apell_cli)[1], '') || '***' AS apellido FROM b_cli",
)
def masked_name(d: Data) -> DataFrame:
    return d.bronze(_CLI).select(
        "id_cli", mask_name(F.col("nomb_cli")).alias("nombre"),
        mask_name(F.col("apell_cli")).alias("apellido"),
    )


@query(
    "q10_mask_document",
    "SELECT id_cli, if(length(num_doc) <= 4, '****', "
    "lpad(right(num_doc, 4), cast(length(num_doc) as int), '*')) AS documento FROM b_cli",
)
def masked_document(d: Data) -> DataFrame:
    return d.bronze(_CLI).select("id_cli", mask_document(F.col("num_doc")).alias("documento"))


@query(
    "q11_age",
    "SELECT id_cli, cast(datesub('year', fec_nac, date '2001-08-27') as int) AS edad "
    "FROM b_cli WHERE fec_nac <= date '2001-08-27'",
)
def age(d: Data) -> DataFrame:
    born = d.bronze(_CLI).filter(F.col("fec_nac") <= F.lit(AS_OF))
    return born.select("id_cli", age_years(F.col("fec_nac"), AS_OF).alias("edad"))


@query("q12_segment_label", "SELECT id_cli, segmento_legible FROM s_cli")
def segment_label(d: Data) -> DataFrame:
    kept = quarantine(d.bronze(_CLI), d.silver("rechazos_clientes"), _CLI, "id_cli")
    label = relabel(F.col("cod_segmento"), model.SEGMENT_LABELS)
    return kept.select("id_cli", label.alias("segmento_legible"))


@query(
    "q13_monthly_rate",
    "SELECT p_partkey, cast(round((pow(1 + cast(p_size as double) / 100, 1 / cast(12 as double)) "
    "- 1) * 100, 4) as decimal(10,4)) AS tasa FROM part",
)
def rate(d: Data) -> DataFrame:
    return d["part"].select("p_partkey", monthly_rate(F.col("p_size")).alias("tasa"))


@query(
    "q13_monthly_rate_short_exponent",
    "SELECT cod_prod, tasa_mensual_equivalente FROM s_prod",
)
def rate_short(d: Data) -> DataFrame:
    return silver.products(d.bronze(model.PRODUCTS.name)).select(
        "cod_prod", "tasa_mensual_equivalente"
    )


@query("q14_product_family", "SELECT cod_prod, familia_producto FROM s_prod")
def family(d: Data) -> DataFrame:
    return silver.products(d.bronze(model.PRODUCTS.name)).select("cod_prod", "familia_producto")


@query("q15_active_label", "SELECT cod_suc, activo, estado_sucursal FROM s_suc")
def active_label(d: Data) -> DataFrame:
    return silver.branches(d.bronze(model.BRANCHES.name)).select(
        "cod_suc", "activo", "estado_sucursal"
    )


@query(
    "q16_arrears_bucket",
    "SELECT id_oblig, if(x = 0, 'AL DIA', if(x < 0, 'DETERIORADO', if(x <= 30, 'RANGO 1', "
    "if(x <= 60, 'RANGO 2', if(x <= 90, 'RANGO 3', 'DETERIORADO'))))) AS bucket "
    "FROM (SELECT id_oblig, ifnull(dias_mora_act, 0) AS x FROM b_obl)",
)
def bucket(d: Data) -> DataFrame:
    days = or_default(F.col("dias_mora_act"), 0)
    return d.bronze(_OBL).select("id_oblig", silver.arrears_bucket(days).alias("bucket"))


@query(
    "q17_status_indicator",
    "SELECT id_comision, id_lote, cast(ifnull(estado_cobro ILIKE 'cobrada', false) as int) AS ind "
    "FROM b_com",
)
def indicator(d: Data) -> DataFrame:
    hit = flag(matches(F.col("estado_cobro"), "COBRADA"))
    return d.bronze(_COM).select("id_comision", "id_lote", hit.alias("ind"))


@query(
    "q18_reject_detail",
    "SELECT id_oblig, id_cli, cod_prod, fec_desembolso, fec_venc, dias_mora_act, calif_riesgo, "
    "tipo_error, motivo_rechazo FROM b_obl JOIN s_rej_obl "
    "ON id_registro = cast(id_oblig as varchar)",
)
def reject_detail(d: Data) -> DataFrame:
    return d.fresh_silver("obligaciones_rechazadas")


_SHORT = ("clientes", "productos", "sucursales", "obligaciones", "movimientos", "comisiones",
          "incentivos")


def quality_report(d: Data) -> DataFrame:
    received = {t.short: d.bronze(t.name) for t in model.TABLES}
    valid = {name: d.silver(name) for name in _SHORT}
    origins = {t.short: t.name for t in (model.CLIENTS, model.OBLIGATIONS)}
    return conformity(received, valid, d.silver("registros_rechazados"), origins)


@query(
    "q19_conformity",
    "SELECT tabla, registros_bronze, registros_silver, registros_rechazados, "
    "cast(round(100.0 * registros_silver / registros_bronze, 2) as decimal(10,2)) "
    "AS porcentaje_conformidad FROM s_quality",
)
def conformity_report(d: Data) -> DataFrame:
    return quality_report(d)


def _null_sql() -> str:
    views = {"orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate "
                       "o_orderpriority".split(),
             "b_cli": [*model.CLIENTS.columns], "b_obl": [*model.OBLIGATIONS.columns]}
    names = {"b_cli": _CLI, "b_obl": _OBL}
    return " UNION ALL ".join(
        f"SELECT '{names.get(v, v)}' AS tabla, '{c}' AS columna, count(*) AS total_registros, "
        f"count(*) - count({c}) AS registros_nulos, "
        f"cast(round(100.0 * (count(*) - count({c})) / count(*), 2) as decimal(10,2)) "
        f"AS porcentaje_nulos FROM {v}"
        for v, columns in views.items() for c in columns
    )


@query("q20_null_profile", _null_sql())
def profile(d: Data) -> DataFrame:
    return null_profile(
        {
            "orders": d["orders"],
            _CLI: d.bronze(_CLI).select(*model.CLIENTS.columns),
            _OBL: d.bronze(_OBL).select(*model.OBLIGATIONS.columns),
        }
    )


_SILVER = (("clientes", "s_cli"), ("productos", "s_prod"), ("sucursales", "s_suc"),
           ("obligaciones", "s_obl"), ("comisiones", "s_com"), ("incentivos", "s_inc"))


@query("q20_silver_null_profile", " UNION ALL ".join(
    f"SELECT '{name}' AS tabla, columna, total_registros, total_registros - n AS registros_nulos, "
    f"cast(round(100.0 * (total_registros - n) / total_registros, 2) as decimal(10,2)) "
    f"AS porcentaje_nulos FROM (UNPIVOT (SELECT count(COLUMNS('(.+)')) AS '\\1' FROM {view}) "
    f"ON COLUMNS(*) INTO NAME columna VALUE n), (SELECT count(*) AS total_registros FROM {view})"
    for name, view in (*_SILVER, ("movimientos", "s_mov"))
))
def silver_profile(d: Data) -> DataFrame:
    """All seven Silver tables, counted while they are written."""
    counts = {
        name: written(d.fresh_silver(name), lambda df, name=name: freeze(df, f"silver-{name}"))[1]
        for name, _ in (*_SILVER, ("movimientos", "s_mov"))
    }
    return null_profile_of(d.spark, counts)


for _name, _view in _SILVER:

    def _table(d: Data, name=_name) -> DataFrame:
        return d.fresh_silver(name)

    query(f"silver_{_name}", f"SELECT * FROM {_view}")(_table)


@query(
    "q3_rejected_keys_by_type",
    "SELECT tipo_error, count(DISTINCT id_registro) AS llaves FROM s_rej_obl GROUP BY ALL",
)
def rejected_by_type(d: Data) -> DataFrame:
    typed = rejects_by_key(d.silver("registros_rechazados"), _OBL, d.bronze(_OBL), "id_oblig")
    return typed.groupBy("tipo_error").agg(F.count_distinct("id_oblig").alias("llaves"))
