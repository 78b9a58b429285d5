"""The test tables cast in the roles of the seven Bronze tables.

Customers act as clients, parts as products, suppliers as branches, orders as obligations,
events as movements, line items as fees and as incentives. The text is plain SQL that both
engines accept. Some values are blanked, emptied or moved on purpose, so that every
cleaning and rejection rule meets rows that break it.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

AS_OF = dt.date(2001, 8, 27)
CUTOFF = dt.date(2001, 8, 27)
RUN_TS = dt.datetime(2001, 8, 27, 10, 0, 0)
FX_RATE = Decimal("4000.0000")
STAMP = "2001-08-27 10:00:00"

_AUDIT = "{ts} '" + STAMP + "' AS fecha_ingesta, 'core' AS sistema_fuente, 'lote-1' AS id_lote"

_LINE_BATCH = """concat(cast(l_partkey as string), '-', cast(l_suppkey as string), '-',
       cast(cast(l_extendedprice as decimal(18,2)) as string), '-',
       cast(cast(l_quantity as decimal(9,2)) as string), '-',
       cast(cast(l_tax as decimal(5,2)) as string), '-',
       cast(cast(l_discount as decimal(5,2)) as string), '-', l_returnflag, l_linestatus)"""

ROLES = {
    "TB_CLIENTES_CORE": """
SELECT c_custkey AS id_cli,
       case when c_acctbal < 100 then ' ' else c_name end AS nomb_cli,
       concat(n_name, ' ') AS apell_cli,
       concat(' ', lower(substr(c_mktsegment, 1, 2))) AS tip_doc,
       cast(c_custkey * 37 as string) AS num_doc,
       date '1935-01-01' + cast((c_custkey * 7919) % 24800 as int) AS fec_nac,
       date '1995-01-01' + cast(c_custkey % 2000 as int) AS fec_alta,
       case c_mktsegment when 'AUTOMOBILE' then 'premium' when 'BUILDING' then 'Básico'
            when 'FURNITURE' then 'ESTANDAR ' when 'HOUSEHOLD' then ' '
            when 'MACHINERY' then cast(null as string) else c_mktsegment end AS cod_segmento,
       case when c_acctbal < 1000 then cast(null as int)
            else cast(floor(c_acctbal / 10) as int) end AS score_buro,
       n_name AS ciudad_res, r_name AS depto_res,
       case when n_nationkey % 7 = 0 then cast(null as string) else 'ACTIVO' end AS estado_cli,
       case when r_name = 'ASIA' then cast(null as string) else lower(r_name) end AS canal_adquis,
       """ + _AUDIT + """
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
     JOIN {region} ON n_regionkey = r_regionkey""",
    "TB_PRODUCTOS_CAT": """
SELECT cast(p_partkey as string) AS cod_prod,
       concat(' ', p_name) AS desc_prod,
       case p_type when 'STANDARD' then 'credito_libre ' when 'MEDIUM' then 'Tarjeta_digital'
            when 'PROMO' then 'cuenta_ahorros' when 'LARGE' then 'PSE'
            when 'ECONOMY' then 'Crédito_rotativo' else ' ' end AS tip_prod,
       case when p_size = 13 then cast(null as decimal(10,4))
            else cast(p_size as decimal(10,4)) end AS tasa_ea,
       p_size * 12 AS plazo_max_meses,
       cast(p_retailprice as decimal(18,2)) AS cuota_min,
       case when p_brand = 'Brand#1' then cast(null as decimal(18,2))
            else cast(p_size as decimal(18,2)) end AS comision_admin,
       case when p_brand = 'Brand#2' then cast(null as string) else 'ACTIVO' end AS estado_prod,
       """ + _AUDIT + """
FROM {part}""",
    "TB_SUCURSALES_RED": """
SELECT concat('SUC', cast(s_suppkey as string)) AS cod_suc,
       case when s_acctbal < 500 then '' else concat(s_name, ' ') end AS nom_suc,
       case when s_nationkey % 5 = 0 then cast(null as string) else 'OFICINA' end AS tip_punto,
       n_name AS ciudad, r_name AS depto,
       case when s_acctbal > 9000 then cast(null as decimal(10,7))
            else cast(s_acctbal / 1000 as decimal(10,7)) end AS latitud,
       cast(-1 * s_nationkey as decimal(10,7)) AS longitud,
       case s_nationkey % 3 when 0 then cast(null as int) when 1 then 1 else 0 end AS activo,
       """ + _AUDIT + """
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
     JOIN {region} ON n_regionkey = r_regionkey""",
    "TB_OBLIGACIONES": """
SELECT o_orderkey AS id_oblig, o_custkey AS id_cli, prod AS cod_prod,
       cast(o_totalprice as decimal(18,2)) AS vr_aprobado,
       cast(o_totalprice as decimal(18,2)) AS vr_desembolsado,
       cast(o_totalprice as decimal(18,2)) AS sdo_capital,
       case when o_orderstatus = 'P' then cast(null as decimal(18,2))
            else cast(o_totalprice as decimal(18,2)) end AS vr_cuota,
       cast(o_orderdate as date) AS fec_desembolso, due AS fec_venc,
       case when o_orderkey % 123 = 7 then cast(null as int)
            else cast(o_orderkey % 123 - 1 as int) end AS dias_mora_act,
       cast(o_orderkey % 60 as int) AS num_cuotas_pend,
       case when o_orderpriority = '4-NOT SPECIFIED' then cast(null as string)
            else substr(o_orderpriority, 1, 1) end AS calif_riesgo,
       """ + _AUDIT + """
FROM {orders} LEFT JOIN (
       SELECT l_orderkey, max(cast(l_shipdate as date)) AS due,
              cast(min(l_partkey) as string) AS prod
       FROM {lineitem} GROUP BY l_orderkey) x ON o_orderkey = l_orderkey""",
    "TB_MOV_FINANCIEROS": """
SELECT event_id AS id_mov, user_id AS id_cli, regexp_extract(props, '[0-9]+', 0) AS cod_prod,
       concat('CTA', cast(user_id as string)) AS num_cuenta,
       cast(ts as date) AS fec_mov,
       concat(lpad(cast(hour(ts) as string), 2, '0'), ':',
              lpad(cast(minute(ts) as string), 2, '0'), ':',
              lpad(cast(second(ts) as string), 2, '0')) AS hra_mov,
       cast(value as decimal(18,2)) AS vr_mov,
       case event_type when 'view' then cast(null as string) else upper(event_type) end AS tip_mov,
       case event_type when 'error' then 'atm' when 'click' then 'Corresponsal'
            when 'signup' then cast(null as string) else event_type end AS cod_canal,
       concat('NATION_', cast(event_id % 27 as string)) AS cod_ciudad,
       case when event_id % 11 = 0 then cast(null as string) else 'APROBADO' end AS cod_estado_mov,
       case when event_id % 10 = 0 then cast(null as string) else 'DEV' end AS id_dispositivo,
       ts AS fecha_ingesta, 'core' AS sistema_fuente, 'lote-1' AS id_lote
FROM {events}""",
    "TB_COMISIONES_LOG": """
SELECT l_orderkey * 10 + l_linenumber AS id_comision, o_custkey AS id_cli,
       cast(l_partkey as string) AS cod_prod, cast(l_shipdate as date) AS fec_cobro,
       case when l_quantity = 50 then cast(null as decimal(18,2))
            when l_quantity = 49 then cast(-1 as decimal(18,2))
            else cast(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(5,2))
                      as decimal(18,2)) end AS vr_comision,
       case when l_linestatus = 'O' then cast(null as string) else 'MANEJO' end AS tip_comision,
       case l_returnflag when 'A' then 'cobrada' when 'N' then 'PENDIENTE'
            else cast(null as string) end AS estado_cobro,
       l_shipdate AS fecha_ingesta, 'core' AS sistema_fuente,
       """ + _LINE_BATCH + """ AS id_lote
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "TB_INCENTIVOS": """
SELECT l_orderkey * 10 + l_linenumber AS id_incentivo, o_custkey AS id_cli,
       cast(l_partkey as string) AS cod_prod, cast(l_shipdate as date) AS fec_incentivo,
       case l_returnflag when 'R' then cast(null as string) else 'CASHBACK' end AS tip_incentivo,
       cast(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(5,2))
            as decimal(18,2)) AS vr_incentivo,
       case when l_linestatus = 'O' then 'Otorgado' else cast(null as string) end
           AS estado_incentivo,
       l_shipdate AS fecha_ingesta, 'core' AS sistema_fuente,
       """ + _LINE_BATCH + """ AS id_lote
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
}

SOURCES = "region nation customer supplier part orders lineitem events".split()
