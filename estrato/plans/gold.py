"""Gold: star schema, provisions, monthly profitability and marts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from estrato import model
from estrato.functions.dates import month_starts
from estrato.functions.money import MONEY, band, convert, money, percent
from estrato.operators.keys import dense_key
from estrato.operators.months import monthly_sums, overlap_sums, unpivot_months


# Dimensions ---------------------------------------------------------------------------


def dim_clients(clients: DataFrame) -> DataFrame:
    kept = clients.drop("nomb_cli", "apell_cli", "num_doc")
    return dense_key(kept, ["id_cli"], "cliente_key")


def dim_products(products: DataFrame) -> DataFrame:
    return dense_key(products, ["cod_prod"], "producto_key")


def dim_geography(clients: DataFrame) -> DataFrame:
    places = clients.select(
        F.col("ciudad_res").alias("ciudad"), F.col("depto_res").alias("departamento")
    )
    return dense_key(places.dropna().distinct(), ["ciudad", "departamento"], "geografia_key")


def dim_channel(movements: DataFrame) -> DataFrame:
    channels = movements.select("cod_canal").dropna().distinct()
    return dense_key(channels, ["cod_canal"], "canal_key")


# Facts --------------------------------------------------------------------------------


def transaction_rows(
    movements: DataFrame,
    clients: DataFrame,
    products: DataFrame,
    channels: DataFrame,
    geography: DataFrame,
    fx_rate: Decimal,
) -> DataFrame:
    """Movements with their dimension keys; a city in two departments gives two rows.

    Only the key columns of a dimension take part. Whether a side is broadcast is left to
    Spark's own size check; skewed clients are split by adaptive execution.
    """
    place = geography.select("geografia_key", F.col("ciudad").alias("cod_ciudad"))
    return (
        movements.join(clients.select("id_cli", "cliente_key"), "id_cli")
        .join(products.select("cod_prod", "producto_key"), "cod_prod")
        .join(channels.select("cod_canal", "canal_key"), "cod_canal", "left")
        .join(place, "cod_ciudad", "left")
        .select(
            "id_mov", "cliente_key", "producto_key", "canal_key", "geografia_key",
            "fec_mov", "hra_mov", "num_cuenta",
            F.col("vr_mov").alias("monto_cop"),
            convert(F.col("vr_mov"), fx_rate).alias("monto_usd"),
            "tip_mov", "cod_estado_mov", "id_dispositivo",
            "movimientos_previos", "promedio_historico", "desviacion_historica",
            "frecuencia_diaria", "alerta_monto", "alerta_horario", "alerta_frecuencia",
            "alerta_canal", "total_alertas", "ind_sospechoso",
        )
    )


def transaction_fact(rows: DataFrame, movements: DataFrame | None = None) -> DataFrame:
    """Rows numbered by movement; the place key settles the order of fanned-out rows. With
    the stored movements the joins that made the rows are evaluated once."""
    keys = None if movements is None else movements.select("id_mov")
    return dense_key(rows, ["id_mov", "geografia_key"], "transaccion_key", keys)


def regulatory_class(days: Column) -> Column:
    return band(days, model.CLASS_STEPS, model.CLASS_WORST, zero=model.CLASS_CURRENT)


def provision_rate(days: Column) -> Column:
    steps = band(days, model.PROVISION_STEPS, model.PROVISION_WORST, zero=model.PROVISION_CURRENT)
    return steps.cast("decimal(5,2)")


def provision_amount(balance: Column, days: Column) -> Column:
    return money(money(balance) * provision_rate(days))


def portfolio_rows(
    obligations: DataFrame, clients: DataFrame, products: DataFrame
) -> DataFrame:
    days = F.col("dias_mora_act")
    return (
        obligations.filter(F.col("estado_calidad") == "VALIDO")
        .join(clients.select("id_cli", "cliente_key"), "id_cli")
        .join(products.select("cod_prod", "producto_key"), "cod_prod")
        .select(
            "id_oblig", "cliente_key", "producto_key", "vr_aprobado", "vr_desembolsado",
            "sdo_capital", "vr_cuota", "fec_desembolso", "fec_venc", "dias_mora_act",
            "num_cuotas_pend", "bucket_mora", "calif_riesgo",
            regulatory_class(days).alias("clasificacion_regulatoria"),
            provision_rate(days).alias("porcentaje_provision"),
            provision_amount(F.col("sdo_capital"), days).alias("provision_estimada"),
        )
    )


def portfolio_fact(rows: DataFrame) -> DataFrame:
    return dense_key(rows, ["id_oblig"], "cartera_key")


# Profitability ------------------------------------------------------------------------


def interest_by_month(
    obligations: DataFrame, products: DataFrame, months: list[dt.date], prefix: str = "i"
) -> DataFrame:
    """Per client, one column per month: today's balance times the monthly share of the
    annual rate, over every obligation alive in that month.

    Products of cents and rates are summed exactly and divided once.
    """
    rate = F.coalesce(F.col("tasa_ea"), F.lit(0).cast("decimal(10,4)"))
    rated = obligations.filter(F.col("estado_calidad") == "VALIDO").join(
        products.select("cod_prod", "tasa_ea"), "cod_prod", "left"
    )
    base = money(F.col("sdo_capital")) * rate
    sums = overlap_sums(rated, "id_cli", "fec_desembolso", "fec_venc", base, months, prefix)
    yearly = F.lit(1200)
    return sums.select(
        "id_cli",
        *[
            (F.col(f"{prefix}{i}").cast("decimal(27,6)") / yearly).alias(f"{prefix}{i}")
            for i in range(len(months))
        ],
    )


def fees_by_month(fees: DataFrame, months: list[dt.date], prefix: str = "f") -> DataFrame:
    paid = fees.filter("ind_comision_cobrada = 1")
    return monthly_sums(paid, "id_cli", "fec_cobro", F.col("vr_comision"), months, prefix)


def incentives_by_month(
    incentives: DataFrame, months: list[dt.date], prefix: str = "g"
) -> DataFrame:
    granted = incentives.filter("ind_incentivo_otorgado = 1")
    return monthly_sums(granted, "id_cli", "fec_incentivo", F.col("vr_incentivo"), months, prefix)


def profitability(
    dim_clients: DataFrame,
    obligations: DataFrame,
    products: DataFrame,
    fees: DataFrame,
    incentives: DataFrame,
    cutoff: dt.date,
) -> DataFrame:
    """Dense client x month grid. Incentives are reported but not part of the value.

    Client keys are dense and every client has the same months, so the row key is
    arithmetic and needs no ranking.
    """
    months = month_starts(cutoff)
    wide = dim_clients.select("cliente_key", "id_cli")
    for part in (
        interest_by_month(obligations, products, months),
        fees_by_month(fees, months),
        incentives_by_month(incentives, months),
    ):
        wide = wide.join(part, "id_cli", "left")
    zero = F.lit(0).cast(MONEY)
    grid = unpivot_months(wide, ["cliente_key"], months, {"_i12": "i", "_f12": "f", "_g12": "g"})
    interest = F.coalesce(F.col("_i12"), zero)
    paid = F.coalesce(F.col("_f12"), zero)
    position = (F.col("cliente_key") - 1) * len(months) + F.col("_i") + 1
    return grid.select(
        position.cast("bigint").alias("rentabilidad_key"),
        "cliente_key",
        "mes_inicio",
        money(interest).alias("ingreso_intereses"),
        money(paid).alias("comisiones_cobradas"),
        money(F.coalesce(F.col("_g12"), zero)).alias("costo_incentivos"),
        money(interest + paid).alias("cltv_mensual"),
    )


# Marts --------------------------------------------------------------------------------


def _with_client(fact: DataFrame, dim_clients: DataFrame, *columns: str) -> DataFrame:
    return fact.join(dim_clients.select("cliente_key", *columns), "cliente_key")


def _by_segment(pairs: DataFrame, dim_clients: DataFrame):
    return _with_client(pairs, dim_clients, "segmento_legible", "ciudad_res").groupBy(
        "producto_key",
        F.col("segmento_legible").alias("segmento"),
        F.col("ciudad_res").alias("ciudad"),
    )


def portfolio_kpi(portfolio: DataFrame, dim_clients: DataFrame, day: dt.date) -> DataFrame:
    """Totals per product, segment and city.

    Obligations are first summed per client and product. That shrinks a client or product
    with very many rows before anything is joined, and since each client has one segment
    and city, the distinct clients are then a plain sum of flags.
    """
    late = F.col("dias_mora_act") > 0
    balance = F.col("sdo_capital")
    zero = F.lit(0).cast(MONEY)
    pairs = portfolio.groupBy("cliente_key", "producto_key").agg(
        F.count("*").alias("n"),
        F.sum(balance).alias("total"),
        F.sum(F.when(late, balance).otherwise(zero)).alias("vencido"),
        F.max(F.when(late, 1).otherwise(0)).alias("en_mora"),
    )
    grouped = _by_segment(pairs, dim_clients).agg(
        F.sum("n").alias("total_obligaciones_activas"),
        money(F.sum("total")).alias("cartera_total"),
        money(F.sum("vencido")).alias("monto_en_mora"),
        F.sum("en_mora").alias("clientes_en_mora"),
    )
    return grouped.select(
        F.lit(day).alias("fecha_kpi"),
        "producto_key", "segmento", "ciudad", "total_obligaciones_activas",
        "cartera_total", "monto_en_mora",
        percent(F.col("monto_en_mora"), F.col("cartera_total"), when_zero=0).alias("tasa_mora_pct"),
        "clientes_en_mora",
    )


def active_accounts(portfolio: DataFrame, dim_clients: DataFrame) -> DataFrame:
    """Distinct clients per product, segment and city, counted over distinct pairs."""
    pairs = portfolio.select("cliente_key", "producto_key").distinct()
    return _by_segment(pairs, dim_clients).agg(F.count("*").alias("cuentas_activas"))


def transaction_volume(
    transactions: DataFrame, dim_clients: DataFrame, geography: DataFrame
) -> DataFrame:
    """Totals per day, product, segment, city of the movement and channel of the client.

    Movements are first summed per client, day, product and place: a client with very many
    rows travels as few. Segment and channel depend on the client alone, so sums of sums
    are the totals.
    """
    place = geography.select("geografia_key", "ciudad")
    summed = transactions.groupBy(
        "cliente_key", "fec_mov", "producto_key", "geografia_key"
    ).agg(F.count("*").alias("n"), F.sum("monto_cop").alias("monto"))
    return (
        _with_client(summed, dim_clients, "segmento_legible", "canal_adquis")
        .join(place, "geografia_key", "left")
        .groupBy(
            F.col("fec_mov").alias("fecha"),
            "producto_key",
            F.col("segmento_legible").alias("segmento"),
            "ciudad",
            F.col("canal_adquis").alias("canal"),
        )
        .agg(
            F.sum("n").alias("total_transacciones"),
            money(F.sum("monto")).alias("volumen_transaccional"),
        )
    )


def regulatory_report(
    portfolio: DataFrame, transactions: DataFrame, dim_clients: DataFrame, geography: DataFrame
) -> DataFrame:
    """Volume rows with the active accounts of their product, segment and city.

    Accounts count residents of the city, transactions the city of the movement; a row
    without a city matches no accounts.
    """
    accounts = active_accounts(portfolio, dim_clients)
    return (
        transaction_volume(transactions, dim_clients, geography)
        .join(accounts, ["producto_key", "segmento", "ciudad"], "left")
        .select(
            "fecha", "producto_key", "segmento", "ciudad", "canal",
            F.coalesce("cuentas_activas", F.lit(0)).alias("cuentas_activas"),
            "total_transacciones", "volumen_transaccional",
        )
    )


def portfolio_block(portfolio: DataFrame) -> DataFrame:
    worst = F.col("max_dias_mora")
    return (
        portfolio.groupBy("cliente_key")
        .agg(
            F.count("*").alias("total_obligaciones"),
            F.count_distinct("producto_key").alias("productos_cartera"),
            money(F.sum("sdo_capital")).alias("saldo_total_capital"),
            F.max("dias_mora_act").alias("max_dias_mora"),
            # As a number, so that Spark can aggregate by hash; classes are single letters.
            F.max(F.ascii("clasificacion_regulatoria")).alias("letra"),
        )
        .withColumns(
            {
                "clasificacion_riesgo": F.chr("letra"),
                "estado_mora": band(
                    worst, model.BUCKET_STEPS, model.BUCKET_WORST, zero=model.BUCKET_CURRENT
                ),
            }
        )
        .drop("letra")
    )


def movement_block(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("cliente_key").agg(
        F.count("*").alias("total_movimientos"),
        F.count_distinct("producto_key").alias("productos_transaccionales"),
        money(F.sum("monto_cop")).alias("volumen_movimientos"),
        F.count_if(F.col("ind_sospechoso") == 1).alias("movimientos_sospechosos"),
    )


def profitability_block(profitability: DataFrame) -> DataFrame:
    return profitability.groupBy("cliente_key").agg(
        money(F.sum("ingreso_intereses")).alias("ingresos_intereses_12m"),
        money(F.sum("comisiones_cobradas")).alias("comisiones_cobradas_12m"),
        money(F.sum("costo_incentivos")).alias("incentivos_12m"),
        money(F.sum("cltv_mensual")).alias("cltv_12m"),
    )


def customer_360(
    dim_clients: DataFrame,
    portfolio: DataFrame,
    transactions: DataFrame,
    profitability: DataFrame,
) -> DataFrame:
    """Every client once. Used products add the two distinct counts, so a product used in
    both blocks counts twice, as in the source system."""
    joined = dim_clients
    for block in (
        portfolio_block(portfolio),
        movement_block(transactions),
        profitability_block(profitability),
    ):
        joined = joined.join(block, "cliente_key", "left")

    def whole(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("bigint"))

    def amount(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast(MONEY)).alias(name)

    return joined.select(
        "cliente_key", "id_cli", "nombre_completo",
        F.col("segmento_legible").alias("segmento"),
        F.col("ciudad_res").alias("ciudad"),
        F.col("depto_res").alias("departamento"),
        "score_buro", "estado_cli",
        whole("total_obligaciones").alias("total_obligaciones"),
        (whole("productos_cartera") + whole("productos_transaccionales")).alias(
            "productos_utilizados"
        ),
        whole("total_movimientos").alias("total_movimientos"),
        amount("saldo_total_capital"),
        F.coalesce("max_dias_mora", F.lit(0)).alias("max_dias_mora"),
        F.coalesce("estado_mora", F.lit(model.BUCKET_CURRENT)).alias("estado_mora"),
        "clasificacion_riesgo",
        amount("volumen_movimientos"),
        whole("movimientos_sospechosos").alias("movimientos_sospechosos"),
        amount("ingresos_intereses_12m"),
        amount("comisiones_cobradas_12m"),
        amount("incentivos_12m"),
        amount("cltv_12m"),
    )
