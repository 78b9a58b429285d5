"""Projections, predicates, joins, aggregates, windows, set operations and scalars, in the
form in which the banking rules use them."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, functions as F

from estrato.catalog.data import Data
from estrato.catalog.registry import query
from estrato.catalog.roles import CUTOFF
from estrato.functions.dates import month_of, month_starts
from estrato.functions.money import dec, money, percent
from estrato.functions.text import contains_any, is_blank, matches
from estrato.operators.history import history_stats
from estrato.operators.increment import day_parts
from estrato.operators.keys import dense_key
from estrato.operators.months import (
    monthly_grid, overlap_changes, overlap_sums, unpivot_months,
)
from estrato.operators.quality import existing, latest_by, union_all
from estrato.operators.upsert import Batch, same_row
from estrato.plans import gold

# Projections, filters, predicates -------------------------------------------------------


@query("c1_project_rename", "SELECT o_orderkey AS id, o_custkey AS cliente FROM orders")
def project(d: Data) -> DataFrame:
    return d["orders"].select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cliente")
    )


@query(
    "c2_mandatory_fields",
    "SELECT id_cli FROM b_cli WHERE trim(nomb_cli) <> '' AND trim(cod_segmento) <> '' "
    "AND score_buro IS NOT NULL",
)
def mandatory(d: Data) -> DataFrame:
    c = d.bronze("TB_CLIENTES_CORE")
    blank = is_blank(F.col("nomb_cli")) | is_blank(F.col("cod_segmento"))
    return c.filter(~blank & F.col("score_buro").isNotNull()).select("id_cli")


@query("c3_non_negative", "SELECT id_comision, id_lote FROM b_com WHERE NOT vr_comision < 0")
def non_negative(d: Data) -> DataFrame:
    return d.bronze("TB_COMISIONES_LOG").filter("vr_comision >= 0").select(
        "id_comision", "id_lote"
    )


@query(
    "c4_range",
    "SELECT id_mov FROM b_mov WHERE hra_mov >= '01:00:00' AND hra_mov < '05:00:00' "
    "AND vr_mov >= 5 AND vr_mov <= 50",
)
def in_range(d: Data) -> DataFrame:
    clock = F.col("hra_mov")
    m = d.bronze("TB_MOV_FINANCIEROS").filter((clock >= "01:00:00") & (clock < "05:00:00"))
    return m.filter(F.col("vr_mov").between(dec("5"), dec("50"))).select("id_mov")


@query(
    "c5_membership",
    "SELECT id_mov FROM b_mov WHERE upper(cod_canal) = 'ATM' OR upper(cod_canal) = 'CORRESPONSAL'",
)
def membership(d: Data) -> DataFrame:
    hit = matches(F.col("cod_canal"), "ATM", "CORRESPONSAL")
    return d.bronze("TB_MOV_FINANCIEROS").filter(hit).select("id_mov")


@query(
    "c6_pattern",
    "SELECT cod_prod FROM b_prod WHERE tip_prod ILIKE '%credito%' OR tip_prod ILIKE '%crédito%'",
)
def pattern(d: Data) -> DataFrame:
    hit = contains_any(F.col("tip_prod"), "CREDITO", "CRÉDITO")
    return d.bronze("TB_PRODUCTOS_CAT").filter(hit).select("cod_prod")


@query("c7_status_filter", "SELECT id_oblig FROM s_obl WHERE estado_calidad = 'VALIDO'")
def status(d: Data) -> DataFrame:
    return d.silver("obligaciones").filter("estado_calidad = 'VALIDO'").select("id_oblig")


@query(
    "c8_searched_case",
    "SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'bajo' "
    "WHEN o_totalprice < 300000 THEN 'medio' ELSE 'alto' END AS nivel FROM orders",
)
def searched_case(d: Data) -> DataFrame:
    price = F.col("o_totalprice")
    level = F.when(price < 100000, "bajo").when(price < 300000, "medio").otherwise("alto")
    return d["orders"].select("o_orderkey", level.alias("nivel"))


@query("c9_if", "SELECT c_custkey, if(c_acctbal >= 0, 'PASS', 'FAIL') AS r FROM customer")
def either(d: Data) -> DataFrame:
    result = F.when(F.col("c_acctbal") >= 0, "PASS").otherwise("FAIL")
    return d["customer"].select("c_custkey", result.alias("r"))


@query("c10_constants", "SELECT p_partkey, 0 AS ind, 'VALIDO' AS estado FROM part")
def constants(d: Data) -> DataFrame:
    return d["part"].select("p_partkey", F.lit(0).alias("ind"), F.lit("VALIDO").alias("estado"))


# Joins ----------------------------------------------------------------------------------


@query(
    "j1_inner",
    "SELECT l_orderkey, l_linenumber, o_custkey, l_partkey FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'",
)
def inner(d: Data) -> DataFrame:
    done = d["orders"].filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    joined = d["lineitem"].join(done, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "o_custkey", "l_partkey")


@query(
    "j2_left_outer",
    "SELECT o_orderkey, n_name, r_name, c_acctbal FROM orders "
    "LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 "
    "LEFT JOIN nation ON c_nationkey = n_nationkey "
    "LEFT JOIN region ON n_regionkey = r_regionkey",
)
def left_outer(d: Data) -> DataFrame:
    known = d["customer"].filter("c_acctbal > 0")
    return (
        d["orders"]
        .join(known, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(d["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(d["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("o_orderkey", "n_name", "r_name", "c_acctbal")
    )


@query(
    "j3_left_three_keys",
    "SELECT v.producto_key, v.segmento, v.ciudad, v.fecha, cuentas_activas FROM g_vol v "
    "LEFT JOIN g_acc a ON v.producto_key = a.producto_key AND v.segmento = a.segmento "
    "AND v.ciudad = a.ciudad",
)
def left_three(d: Data) -> DataFrame:
    clients = d.gold("dim_clientes")
    volume = gold.transaction_volume(d.gold("fact_transacciones"), clients,
                                     d.gold("dim_geografia"))
    accounts = gold.active_accounts(d.gold("fact_cartera"), clients)
    return volume.join(accounts, ["producto_key", "segmento", "ciudad"], "left").select(
        "producto_key", "segmento", "ciudad", "fecha", "cuentas_activas"
    )


@query(
    "j4_left_semi",
    "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders "
    "WHERE o_custkey = c_custkey AND o_orderstatus = 'P')",
)
def left_semi(d: Data) -> DataFrame:
    pending = d["orders"].filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return existing(d["customer"], pending, "c_custkey").select("c_custkey")


@query(
    "j5_left_anti",
    "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders "
    "WHERE o_custkey = c_custkey AND o_orderstatus = 'P')",
)
def left_anti(d: Data) -> DataFrame:
    pending = d["orders"].filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return d["customer"].join(pending, "c_custkey", "left_anti").select("c_custkey")


@query(
    "j6_every_pair_with_months",
    "SELECT s_suppkey, mes_inicio FROM supplier CROSS JOIN months",
)
def pairs(d: Data) -> DataFrame:
    """Pairing with a fixed month list is an explode, not a cross join."""
    return unpivot_months(d["supplier"], ["s_suppkey"], month_starts(CUTOFF), {}).drop("_i")


@query(
    "j7_lateral_aggregate",
    "SELECT c_custkey, x.total FROM customer LEFT JOIN LATERAL (SELECT "
    "cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) AS total FROM orders "
    "WHERE o_custkey = c_custkey AND o_orderstatus = 'O') x ON true",
)
def lateral(d: Data) -> DataFrame:
    totals = (
        d["orders"].filter("o_orderstatus = 'O'")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(money(F.sum(money(F.col("o_totalprice")))).alias("total"))
    )
    return d["customer"].join(totals, "c_custkey", "left").select("c_custkey", "total")


@query(
    "j8_interval_overlap",
    "SELECT id_cli, mes_inicio, cast(sum(sdo_capital) as decimal(18,2)) AS saldo FROM b_obl "
    "JOIN months ON fec_desembolso <= last_day(mes_inicio) AND fec_venc >= mes_inicio "
    "GROUP BY id_cli, mes_inicio",
)
def overlap(d: Data) -> DataFrame:
    months = month_starts(CUTOFF)
    wide = overlap_sums(
        d.bronze("TB_OBLIGACIONES"), "id_cli", "fec_desembolso", "fec_venc",
        F.col("sdo_capital"), months, "s",
    )
    long = unpivot_months(wide, ["id_cli"], months, {"saldo": "s"}).drop("_i")
    return long.filter("saldo IS NOT NULL").withColumn("saldo", money(F.col("saldo")))


@query(
    "j8_overlap_long_span",
    "WITH span AS (SELECT cast(cast(? as date) - to_months(cast(k as int)) as date) AS mes_inicio "
    "FROM range(300) t(k)) "
    "SELECT id_cli, mes_inicio, count(*) AS vivos, cast(sum(sdo_capital) as decimal(18,2)) AS saldo "
    "FROM b_obl JOIN span ON fec_desembolso <= last_day(mes_inicio) AND fec_venc >= mes_inicio "
    "GROUP BY id_cli, mes_inicio".replace("?", f"'{month_starts(CUTOFF, 1)[0]}'"),
)
def long_overlap(d: Data) -> DataFrame:
    """Over 300 months: two changes per obligation, then the months between changes."""
    months = month_starts(CUTOFF, 300)
    changes = overlap_changes(
        d.bronze("TB_OBLIGACIONES"), "id_cli", "fec_desembolso", "fec_venc",
        {"saldo": F.col("sdo_capital")},
    )
    grid = monthly_grid(changes, months[0], months[-1])
    return grid.withColumn("saldo", money(F.col("saldo")))


@query(
    "j9_history_self_join",
    "SELECT x.o_orderkey, count(h.o_orderkey) AS previos FROM orders x LEFT JOIN orders h "
    "ON h.o_custkey = x.o_custkey AND cast(h.o_orderdate as date) >= "
    "cast(x.o_orderdate as date) - 365 "
    "AND (h.o_orderdate, h.o_orderkey) < (x.o_orderdate, x.o_orderkey) GROUP BY x.o_orderkey",
)
def history_join(d: Data) -> DataFrame:
    orders = d["orders"].withColumn("day", F.col("o_orderdate").cast("date"))
    scored = history_stats(
        orders, "o_custkey", "day", F.lit(0), "o_orderkey", "o_totalprice", days=365
    )
    return scored.select("o_orderkey", F.col("movimientos_previos").alias("previos"))


@query(
    "j10_full_outer",
    "SELECT coalesce(s.s_nationkey, c.c_nationkey) AS nacion, s.n AS proveedores, "
    "c.n AS clientes FROM (SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 5000 "
    "GROUP BY 1) s FULL JOIN (SELECT c_nationkey, count(*) AS n FROM customer "
    "WHERE c_acctbal > 9000 GROUP BY 1) c ON s.s_nationkey = c.c_nationkey",
)
def full_outer(d: Data) -> DataFrame:
    s = d["supplier"].filter("s_acctbal > 5000").groupBy("s_nationkey").agg(
        F.count("*").alias("proveedores"))
    c = d["customer"].filter("c_acctbal > 9000").groupBy("c_nationkey").agg(
        F.count("*").alias("clientes"))
    joined = s.join(c, F.col("s_nationkey") == F.col("c_nationkey"), "full_outer")
    return joined.select(
        F.coalesce("s_nationkey", "c_nationkey").alias("nacion"), "proveedores", "clientes"
    )


@query(
    "j11_scalar_subquery",
    "SELECT o_orderkey FROM orders WHERE o_totalprice > 1.5 * (SELECT avg(o_totalprice) FROM orders)",
)
def scalar(d: Data) -> DataFrame:
    return d.spark.sql(
        "SELECT o_orderkey FROM {o} WHERE o_totalprice > 1.5D * (SELECT avg(o_totalprice) FROM {o})",
        o=d["orders"],
    )


@query(
    "j12_join_on_text_key",
    "SELECT id_oblig, tipo_error FROM b_obl JOIN s_rej_obl "
    "ON cast(id_oblig as varchar) = id_registro",
)
def text_key(d: Data) -> DataFrame:
    rejects = d.silver("rechazos_obligaciones")
    rows = d.bronze("TB_OBLIGACIONES")
    joined = rows.join(rejects, F.col("id_oblig").cast("string") == F.col("id_registro"))
    return joined.select("id_oblig", "tipo_error")


# Aggregates -----------------------------------------------------------------------------


@query("k1_count", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def count(d: Data) -> DataFrame:
    return d["orders"].groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "k2_count_distinct",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1",
)
def count_distinct(d: Data) -> DataFrame:
    return d["lineitem"].groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("n"))


@query(
    "k3_conditional_distinct",
    "SELECT l_returnflag, count(DISTINCT l_suppkey) FILTER (l_quantity > 40) AS n "
    "FROM lineitem GROUP BY 1",
)
def conditional_distinct(d: Data) -> DataFrame:
    big = F.when(F.col("l_quantity") > 40, F.col("l_suppkey"))
    return d["lineitem"].groupBy("l_returnflag").agg(F.count_distinct(big).alias("n"))


@query(
    "k4_sum_money",
    "SELECT o_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) AS total "
    "FROM orders GROUP BY 1",
)
def sum_money(d: Data) -> DataFrame:
    total = money(F.sum(money(F.col("o_totalprice")))).alias("total")
    return d["orders"].groupBy("o_custkey").agg(total)


@query(
    "k5_conditional_sum",
    "SELECT o_orderstatus, cast(sum(if(o_orderpriority = '1-URGENT', "
    "cast(o_totalprice as decimal(18,2)), 0)) as decimal(18,2)) AS urgente, "
    "count(*) FILTER (o_orderpriority = '1-URGENT') AS n FROM orders GROUP BY 1",
)
def conditional_sum(d: Data) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    value = F.when(urgent, money(F.col("o_totalprice"))).otherwise(dec("0.00"))
    return d["orders"].groupBy("o_orderstatus").agg(
        money(F.sum(value)).alias("urgente"), F.count_if(urgent).alias("n")
    )


@query(
    "k6_safe_percentage",
    "SELECT l_suppkey, cast(if(sum(cast(l_tax as decimal(5,2))) = 0, 0, "
    "round(100 * ifnull(sum(cast(l_tax as decimal(5,2))) FILTER (l_returnflag = 'A'), 0) "
    "/ sum(cast(l_tax as decimal(5,2))), 2)) as decimal(10,2)) AS pct FROM lineitem GROUP BY 1",
)
def safe_percentage(d: Data) -> DataFrame:
    tax = F.col("l_tax").cast("decimal(5,2)")
    flagged = F.when(F.col("l_returnflag") == "A", tax).otherwise(dec("0.00"))
    sums = d["lineitem"].groupBy("l_suppkey").agg(
        F.sum(flagged).alias("part"), F.sum(tax).alias("whole")
    )
    ratio = percent(F.col("part"), F.col("whole"), when_zero=0)
    return sums.select("l_suppkey", ratio.alias("pct"))


@query(
    "k7_mean_money",
    "SELECT o_custkey, cast(cast((2 * cast(sum(cast(o_totalprice as decimal(18,2))) * 100 as "
    "hugeint) * 10000 + count(*)) // (2 * count(*)) as decimal(28,0)) "
    "* cast(0.000001 as decimal(7,6)) as decimal(22,6)) AS media FROM orders GROUP BY 1",
)
def mean_money(d: Data) -> DataFrame:
    """The mean of money keeps six decimals, rounded half up."""
    return d["orders"].groupBy("o_custkey").agg(
        F.avg(money(F.col("o_totalprice"))).alias("media")
    )


@query(
    "k8_sample_deviation",
    "SELECT o_custkey, round(stddev_samp(o_totalprice), 4) AS sd FROM orders GROUP BY 1",
)
def deviation(d: Data) -> DataFrame:
    return d["orders"].groupBy("o_custkey").agg(
        F.round(F.stddev_samp("o_totalprice"), 4).alias("sd")
    )


@query(
    "k9_min_max",
    "SELECT o_custkey, min(o_orderdate) AS d1, max(o_orderdate) AS d2, min(o_totalprice) AS v1, "
    "max(o_totalprice) AS v2, max(o_orderpriority) AS t2 FROM orders GROUP BY 1",
)
def min_max(d: Data) -> DataFrame:
    return d["orders"].groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("d1"), F.max("o_orderdate").alias("d2"),
        F.min("o_totalprice").alias("v1"), F.max("o_totalprice").alias("v2"),
        F.max("o_orderpriority").alias("t2"),
    )


@query(
    "k10_having",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def having(d: Data) -> DataFrame:
    return d["lineitem"].groupBy("l_orderkey", "l_linenumber").agg(
        F.count("*").alias("n")).filter("n > 1")


@query(
    "k11_global_aggregate",
    "SELECT count(*) AS n, count(DISTINCT o_custkey) AS clientes, "
    "cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) AS total, "
    "count(*) FILTER (o_orderstatus = 'F') AS cerradas FROM orders",
)
def global_aggregate(d: Data) -> DataFrame:
    return d["orders"].agg(
        F.count("*").alias("n"), F.count_distinct("o_custkey").alias("clientes"),
        money(F.sum(money(F.col("o_totalprice")))).alias("total"),
        F.count_if(F.col("o_orderstatus") == "F").alias("cerradas"),
    )


@query(
    "k12_last_row_per_group",
    "SELECT event_type, event_id, ts FROM events WHERE event_id IN "
    "(SELECT max(event_id) FROM events GROUP BY event_type)",
)
def last_per_group(d: Data) -> DataFrame:
    last = F.max_by(F.struct("event_id", "ts"), "event_id").alias("u")
    return d["events"].groupBy("event_type").agg(last).select("event_type", "u.*")


# Windows --------------------------------------------------------------------------------


@query(
    "w1_latest_first",
    "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
)
def latest_first(d: Data) -> DataFrame:
    newest = latest_by(d["orders"], ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return newest.select("o_custkey", "o_orderkey")


@query(
    "w2_global_row_number",
    "SELECT row_number() OVER (ORDER BY ts, event_id) AS llave, event_id FROM events",
)
def global_number(d: Data) -> DataFrame:
    events = d["events"].select("ts", "event_id")
    return dense_key(events, ["ts", "event_id"], "llave").select("llave", "event_id")


@query(
    "w3_latest_report_per_table",
    "SELECT event_type AS tabla, cast(ts as date) AS fecha, count(*) AS n FROM events "
    "GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY event_type "
    "ORDER BY cast(ts as date) DESC) = 1",
)
def latest_report(d: Data) -> DataFrame:
    daily = d["events"].groupBy(
        F.col("event_type").alias("tabla"), F.to_date("ts").alias("fecha")
    ).agg(F.count("*").alias("n"))
    return latest_by(daily, ["tabla"], [F.desc("fecha")])


# Sorts, limits, set operations ----------------------------------------------------------


@query("l1_order_by", "SELECT s_suppkey, s_name FROM supplier ORDER BY s_name, s_suppkey")
def order_by(d: Data) -> DataFrame:
    return d["supplier"].select("s_suppkey", "s_name").orderBy("s_name", "s_suppkey")


@query(
    "l2_top_one",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1",
)
def top_one(d: Data) -> DataFrame:
    ranked = d["orders"].orderBy(F.desc("o_totalprice"), F.desc("o_orderkey"))
    return ranked.limit(1).select("o_orderkey", "o_totalprice")


@query(
    "s1_union_all",
    "SELECT 'cliente' AS tipo, c_nationkey AS nacion FROM customer UNION ALL "
    "SELECT 'proveedor', s_nationkey FROM supplier UNION ALL SELECT 'pais', n_nationkey FROM nation",
)
def unions(d: Data) -> DataFrame:
    parts = [("cliente", "customer", "c_nationkey"), ("proveedor", "supplier", "s_nationkey"),
             ("pais", "nation", "n_nationkey")]
    return union_all(
        [d[t].select(F.lit(kind).alias("tipo"), F.col(c).alias("nacion")) for kind, t, c in parts]
    )


@query(
    "s2_except",
    "SELECT id_cli, estado_cli, canal_adquis FROM b_cli EXCEPT SELECT id_cli, estado_cli, "
    "canal_adquis FROM b_cli WHERE estado_cli IS NOT NULL",
)
def except_rows(d: Data) -> DataFrame:
    """NULLs compare as equal on both sides."""
    c = d.bronze("TB_CLIENTES_CORE").select("id_cli", "estado_cli", "canal_adquis")
    return c.subtract(c.filter("estado_cli IS NOT NULL"))


@query(
    "s2_null_safe_difference",
    "SELECT a.id_cli FROM b_cli a JOIN s_cli b USING (id_cli) "
    "WHERE a.estado_cli IS DISTINCT FROM b.estado_cli OR a.canal_adquis IS DISTINCT FROM "
    "b.canal_adquis",
)
def differing(d: Data) -> DataFrame:
    pair = d.bronze("TB_CLIENTES_CORE").alias("s").join(
        d.silver("clientes").alias("t"), F.col("s.id_cli") == F.col("t.id_cli"))
    return pair.filter(~same_row("s", "t", ["estado_cli", "canal_adquis"])).select("s.id_cli")


@query("s3_distinct", "SELECT DISTINCT n_name, r_name FROM customer JOIN nation "
       "ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def distinct(d: Data) -> DataFrame:
    c = d.bronze("TB_CLIENTES_CORE")
    return c.select(F.col("ciudad_res").alias("n_name"), F.col("depto_res").alias("r_name")).distinct()


# Scalars --------------------------------------------------------------------------------


@query(
    "fn_string",
    "SELECT p_partkey, trim(' ' || p_name || ' ') AS a, left(p_name, 2) AS b, right(p_brand, 3) "
    "AS c, repeat('*', length(p_type)) AS d, concat(p_brand, '/', p_type) AS e, upper(p_name) "
    "AS f, p_name LIKE '%r%' AS g, substring(p_name, 1, 5) AS h FROM part",
)
def strings(d: Data) -> DataFrame:
    name, brand = F.col("p_name"), F.col("p_brand")
    return d["part"].select(
        "p_partkey",
        F.trim(F.concat(F.lit(" "), name, F.lit(" "))).alias("a"),
        F.left(name, F.lit(2)).alias("b"),
        F.right(brand, F.lit(3)).alias("c"),
        F.repeat(F.lit("*"), F.length("p_type")).alias("d"),
        F.concat(brand, F.lit("/"), F.col("p_type")).alias("e"),
        F.upper(name).alias("f"),
        name.like("%r%").alias("g"),
        F.substring(name, 1, 5).alias("h"),
    )


@query(
    "fn_null",
    "SELECT id_cli, coalesce(estado_cli, canal_adquis, '-') AS a, nullif(cod_segmento, ' ') AS b, "
    "ifnull(score_buro, 0) AS c FROM b_cli",
)
def nulls(d: Data) -> DataFrame:
    return d.bronze("TB_CLIENTES_CORE").select(
        "id_cli",
        F.coalesce("estado_cli", "canal_adquis", F.lit("-")).alias("a"),
        F.nullif("cod_segmento", F.lit(" ")).alias("b"),
        F.ifnull("score_buro", F.lit(0)).alias("c"),
    )


@query(
    "fn_date",
    "SELECT o_orderkey, cast(o_orderdate as date) - 30 AS a, "
    "cast(cast(o_orderdate as date) + interval 1 month as date) AS b, "
    "cast(cast(o_orderdate as date) + interval 12 month as date) AS c, "
    "cast(2001 - year(o_orderdate) as int) AS d, cast(date_trunc('month', o_orderdate) as date) "
    "AS e, last_day(cast(o_orderdate as date)) AS f FROM orders",
)
def dates(d: Data) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return d["orders"].select(
        "o_orderkey",
        F.date_sub(day, 30).alias("a"),
        F.add_months(day, 1).alias("b"),
        F.add_months(day, 12).alias("c"),
        (F.lit(2001) - F.year(day)).alias("d"),
        month_of(day).alias("e"),
        F.last_day(day).alias("f"),
    )


@query(
    "fn_date_parts",
    "SELECT event_id, cast(year(ts) as int) AS anio, strftime(ts, '%m') AS mes, "
    "strftime(ts, '%d') AS dia FROM events",
)
def date_parts(d: Data) -> DataFrame:
    return day_parts(d["events"], "ts").select("event_id", "anio", "mes", "dia")


@query(
    "fn_math",
    "SELECT c_custkey, abs(c_acctbal) AS a, round(pow(1 + abs(c_acctbal) / 10000, "
    "cast(0.5 as double)), 9) AS b, cast(cast(c_acctbal as decimal(18,2)) * 3 - 1 "
    "as decimal(18,2)) AS c FROM customer",
)
def math(d: Data) -> DataFrame:
    balance = F.col("c_acctbal")
    return d["customer"].select(
        "c_custkey",
        F.abs(balance).alias("a"),
        F.round(F.pow(1 + F.abs(balance) / 10000, F.lit(0.5)), 9).alias("b"),
        money(money(balance) * 3 - 1).alias("c"),
    )


@query(
    "fn_cast",
    "SELECT l_orderkey, l_linenumber, l_shipdate, cast(l_extendedprice as decimal(18,2)) AS a, "
    "cast(l_quantity as bigint) AS b, cast(l_partkey as varchar) AS c, "
    "cast(l_suppkey as double) AS d, cast(l_shipdate as date) AS e, "
    "try_cast(l_returnflag as int) AS f FROM lineitem",
)
def casts(d: Data) -> DataFrame:
    return d["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("a"),
        F.col("l_quantity").cast("bigint").alias("b"),
        F.col("l_partkey").cast("string").alias("c"),
        F.col("l_suppkey").cast("double").alias("d"),
        F.col("l_shipdate").cast("date").alias("e"),
        F.col("l_returnflag").try_cast("int").alias("f"),
    )


@query(
    "fn_batch_id",
    "SELECT 1 AS lotes, count(*) AS filas FROM orders",
)
def batch_id(d: Data) -> DataFrame:
    """One identifier for all rows of a batch, drawn once on the driver."""
    stamp = Batch(dt.datetime(2001, 8, 27), str(uuid.uuid4()), "core").columns()
    rows = d["orders"].withColumns(stamp)
    return rows.agg(
        F.count_distinct("id_lote").cast("int").alias("lotes"), F.count("*").alias("filas")
    )

