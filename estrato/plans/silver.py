"""Silver: rejects, cleaning, masking, derived columns and fraud scoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from estrato import model
from estrato.functions.dates import age_years, micros_of_day, seconds_of_day
from estrato.functions.money import band, monthly_rate
from estrato.functions.text import (
    blank_to_null, contains_any, flag, is_blank, mask_document, mask_name, matches, normalised,
    or_default, relabel,
)
from estrato.operators.history import fraud_flags, history_stats
from estrato.operators.quality import (
    Rule, classify, existing, latest_by, presence, quarantine, reject_detail,
)

NEWEST_FIRST = ("fecha_ingesta", "id_lote")


def newest(df: DataFrame, key: str) -> DataFrame:
    """Latest version of each key by ingestion time, then batch."""
    return latest_by(df, [key], [F.desc(c) for c in NEWEST_FIRST])


def _kept(bronze: DataFrame, rejects: DataFrame, table: model.Table) -> DataFrame:
    """Newest version of every key that has no rejected version.

    Rejection is by key, so picking the newest version first gives the same rows, and old
    versions are dropped before the shuffle that both steps share.
    """
    keyed = bronze.filter(F.col(table.key).isNotNull())
    return quarantine(newest(keyed, table.key), rejects, table.name, table.key)


def client_rules(as_of: dt.date) -> list[Rule]:
    # Error types and messages of the client rules.
    missing, bad_date = "CAMPO_OBLIGATORIO_NULO", "FECHA_INVALIDA"
    born = F.col("fec_nac")
    return [
        Rule(F.col("id_cli").isNull(), missing, "id_cli",
             "El identificador del cliente es obligatorio."),
        Rule(is_blank(F.col("nomb_cli")), missing, "nomb_cli", "El nombre es obligatorio."),
        Rule(is_blank(F.col("apell_cli")), missing, "apell_cli", "El apellido es obligatorio."),
        Rule(is_blank(F.col("num_doc")), missing, "num_doc", "El documento es obligatorio."),
        Rule(born.isNull(), missing, "fec_nac", "La fecha de nacimiento es obligatoria."),
        Rule(born > F.lit(as_of), bad_date, "fec_nac",
             "La fecha de nacimiento no puede ser futura.", rank=0),
    ]


def client_rejects(bronze: DataFrame, as_of: dt.date) -> DataFrame:
    return classify(bronze, model.CLIENTS.name, "id_cli", client_rules(as_of))


def clients(bronze: DataFrame, rejects: DataFrame, as_of: dt.date) -> DataFrame:
    valid = _kept(bronze, rejects, model.CLIENTS)
    first, last = mask_name(F.col("nomb_cli")), mask_name(F.col("apell_cli"))
    document = mask_document(F.col("num_doc"))
    return valid.select(
        "id_cli",
        first.alias("nomb_cli"),
        last.alias("apell_cli"),
        F.concat_ws(" ", first, last).alias("nombre_completo"),
        normalised(F.col("tip_doc")).alias("tip_doc"),
        document.alias("num_doc"),
        document.alias("num_doc_enmascarado"),
        "fec_nac",
        age_years(F.col("fec_nac"), as_of).alias("edad"),
        "fec_alta",
        or_default(blank_to_null(F.col("cod_segmento"))).alias("cod_segmento"),
        relabel(F.col("cod_segmento"), model.SEGMENT_LABELS).alias("segmento_legible"),
        or_default(F.col("score_buro"), 0).alias("score_buro"),
        *_defaults("ciudad_res", "depto_res", "estado_cli", "canal_adquis"),
    )


def products(bronze: DataFrame) -> DataFrame:
    name, kind = F.col("desc_prod"), F.col("tip_prod")
    valid = bronze.filter(F.col("cod_prod").isNotNull() & ~is_blank(name) & ~is_blank(kind))
    return newest(valid, "cod_prod").select(
        "cod_prod",
        F.trim(name).alias("nombre_producto"),
        normalised(kind).alias("tipo_producto"),
        *_zeros("tasa_ea"),
        monthly_rate(or_default(F.col("tasa_ea"), 0), model.MONTH_EXPONENT).alias(
            "tasa_mensual_equivalente"
        ),
        *_zeros("plazo_max_meses", "cuota_min", "comision_admin"),
        *_defaults("estado_prod"),
        product_family(kind).alias("familia_producto"),
    )


def product_family(kind: Column) -> Column:
    # Words that place a product in a family.
    return (
        F.when(contains_any(kind, "CREDITO", "CRÉDITO", "TARJETA"), "CREDITO")
        .when(contains_any(kind, "AHORRO"), "AHORRO")
        .otherwise("TRANSACCIONAL")
    )


def branches(bronze: DataFrame) -> DataFrame:
    valid = bronze.filter(F.col("cod_suc").isNotNull() & ~is_blank(F.col("nom_suc")))
    active = or_default(F.col("activo"), 0)
    return newest(valid, "cod_suc").select(
        "cod_suc",
        F.trim("nom_suc").alias("nombre_sucursal"),
        or_default(F.col("tip_punto")).alias("tipo_punto"),
        or_default(F.col("ciudad")).alias("ciudad"),
        or_default(F.col("depto")).alias("departamento"),
        "latitud",
        "longitud",
        active.alias("activo"),
        F.when(active == 1, "ACTIVA").otherwise("INACTIVA").alias("estado_sucursal"),
    )


def obligation_rules() -> list[Rule]:
    # Error types and messages of the obligation rules.
    required = [
        ("id_oblig", "El identificador es obligatorio."),
        ("id_cli", "El cliente es obligatorio."),
        ("cod_prod", "El producto es obligatorio."),
        ("fec_desembolso", "La fecha de desembolso es obligatoria."),
        ("fec_venc", "La fecha de vencimiento es obligatoria."),
    ]
    return [
        *[Rule(F.col(c).isNull(), "CAMPO_OBLIGATORIO_NULO", c, why) for c, why in required],
        Rule(F.col("_cliente").isNull(), "CLIENTE_INEXISTENTE", "id_cli",
             "El cliente no existe en Silver."),
        Rule(F.col("_producto").isNull(), "PRODUCTO_INEXISTENTE", "cod_prod",
             "El producto no existe en Silver."),
        Rule(F.col("fec_venc") < F.col("fec_desembolso"), "FECHA_VENCIMIENTO_INVALIDA", "fec_venc",
             "La fecha de vencimiento es anterior a la fecha de desembolso."),
    ]


def obligation_rejects(bronze: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    checked = presence(bronze, clients, "id_cli", "_cliente")
    checked = presence(checked, products, "cod_prod", "_producto")
    return classify(checked, model.OBLIGATIONS.name, "id_oblig", obligation_rules())


def arrears_bucket(days: Column) -> Column:
    """Negative arrears fall in the worst bucket here, unlike in the regulatory class."""
    steps = band(days, model.BUCKET_STEPS, model.BUCKET_WORST, zero=model.BUCKET_CURRENT)
    return F.when(days < 0, model.BUCKET_WORST).otherwise(steps)


def obligations(bronze: DataFrame, rejects: DataFrame) -> DataFrame:
    valid = _kept(bronze, rejects, model.OBLIGATIONS)
    return valid.select(
        "id_oblig", "id_cli", "cod_prod",
        *_zeros("vr_aprobado", "vr_desembolsado", "sdo_capital", "vr_cuota"),
        "fec_desembolso", "fec_venc",
        *_zeros("dias_mora_act", "num_cuotas_pend"),
        *_defaults("calif_riesgo"),
        arrears_bucket(or_default(F.col("dias_mora_act"), 0)).alias("bucket_mora"),
        F.lit(0).alias("ind_fecha_inconsistente"),
        F.lit("VALIDO").alias("estado_calidad"),
    )


def rejected_obligations(bronze: DataFrame, rejects: DataFrame) -> DataFrame:
    extra = ["tipo_error", "motivo_rechazo"]
    extra += ["fecha_rechazo"] if "fecha_rechazo" in rejects.columns else []
    return reject_detail(
        bronze, rejects, model.OBLIGATIONS.name, "id_oblig",
        ["id_oblig", "id_cli", "cod_prod", "fec_desembolso", "fec_venc", "dias_mora_act",
         "calif_riesgo"],
        extra,
    )


def _complete(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a value in every mandatory column."""
    return df.dropna(subset=list(columns))


def _referenced(df: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    return existing(existing(df, clients, "id_cli"), products, "cod_prod")


def fees(bronze: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    whole = _complete(bronze, "id_comision", "id_cli", "cod_prod", "fec_cobro", "vr_comision")
    valid = _referenced(whole.filter("vr_comision >= 0"), clients, products)
    return newest(valid, "id_comision").select(
        "id_comision", "id_cli", "cod_prod", "fec_cobro", "vr_comision",
        *_defaults("tip_comision", "estado_cobro"),
        flag(matches(F.col("estado_cobro"), "COBRADA")).alias("ind_comision_cobrada"),
        F.lit(0).alias("ind_valor_inconsistente"),
    )


def incentives(bronze: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    whole = _complete(
        bronze, "id_incentivo", "id_cli", "cod_prod", "fec_incentivo", "vr_incentivo"
    )
    valid = _referenced(whole.filter("vr_incentivo >= 0"), clients, products)
    return newest(valid, "id_incentivo").select(
        "id_incentivo", "id_cli", "cod_prod", "fec_incentivo",
        *_defaults("tip_incentivo"),
        "vr_incentivo",
        *_defaults("estado_incentivo"),
        flag(matches(F.col("estado_incentivo"), "OTORGADO")).alias("ind_incentivo_otorgado"),
        F.lit(0).alias("ind_valor_inconsistente"),
    )


def valid_movements(bronze: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    """Complete, referenced and deduplicated movements, before scoring.

    A clock that cannot be read counts as missing. Scoring reads its input several times, so a full run stores this step first.
    """
    whole = _complete(bronze, "id_mov", "id_cli", "cod_prod", "fec_mov", "hra_mov", "vr_mov")
    whole = whole.filter(seconds_of_day(F.col("hra_mov")).isNotNull())
    return newest(_referenced(whole, clients, products), "id_mov")


def movements(valid: DataFrame, days: int = 30, range_rows: int | None = None) -> DataFrame:
    """Movements with their history and alerts; the order within a day is by the full time,
    fractions of a second included, then by id."""
    time, clock = micros_of_day(F.col("hra_mov")), seconds_of_day(F.col("hra_mov"))
    scored = history_stats(
        valid, "id_cli", "fec_mov", time, "id_mov", "vr_mov", days=days, range_rows=range_rows
    )
    risky = matches(F.col("cod_canal"), *model.RISKY_CHANNELS)
    flagged = fraud_flags(scored, "vr_mov", clock, risky)
    return flagged.select(
        "id_mov", "id_cli", "cod_prod", "num_cuenta", "fec_mov", "hra_mov", "vr_mov",
        *_defaults("tip_mov", "cod_canal", "cod_ciudad", "cod_estado_mov", "id_dispositivo"),
        *model.AUDIT,
        "movimientos_previos", "promedio_historico", "desviacion_historica", "frecuencia_diaria",
        "alerta_monto", "alerta_horario", "alerta_frecuencia", "alerta_canal",
        "total_alertas", "ind_sospechoso",
    )


def _defaults(*columns: str) -> list[Column]:
    return [or_default(F.col(c)).alias(c) for c in columns]


def _zeros(*columns: str) -> list[Column]:
    return [F.coalesce(F.col(c), F.lit(0).cast(_TYPES[c])).alias(c) for c in columns]


_TYPES = {name: kind for t in model.TABLES for name, kind in t.types.items()}
