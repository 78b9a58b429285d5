"""Comparison views in ANSI SQL, written apart from the Spark code.

`b_*` are the Bronze roles, `s_*` the Silver tables and `g_*` the Gold tables. They follow
the rules of the model literally (self joins, subqueries, global row numbers), whatever
their cost, so that they check the Spark plans rather than repeat them.
"""

from __future__ import annotations

from estrato.catalog.roles import ROLES, SOURCES

_NAMES = {t: t for t in SOURCES}


def _role(name: str) -> str:
    return ROLES[name].format(ts="timestamp", **_NAMES)


VIEWS: dict[str, str] = {
    "b_cli": _role("TB_CLIENTES_CORE"),
    "b_prod": _role("TB_PRODUCTOS_CAT"),
    "b_suc": _role("TB_SUCURSALES_RED"),
    "b_obl": _role("TB_OBLIGACIONES"),
    "b_mov": _role("TB_MOV_FINANCIEROS"),
    "b_com": _role("TB_COMISIONES_LOG"),
    "b_inc": _role("TB_INCENTIVOS"),
    # Client rejects: the first bad field names field and reason, a future birth date
    # names the type whatever else is wrong.
    "s_rej_cli": """
SELECT 'TB_CLIENTES_CORE' AS tabla_origen, cast(id_cli as varchar) AS id_registro,
       if(coalesce(fec_nac > date '2001-08-27', false), 'FECHA_INVALIDA',
          'CAMPO_OBLIGATORIO_NULO') AS tipo_error,
       bad[1].f AS campo_error, bad[1].r AS motivo_rechazo
FROM (SELECT *, list_filter([
        {'b': id_cli IS NULL, 'f': 'id_cli',
         'r': 'El identificador del cliente es obligatorio.'},
        {'b': coalesce(trim(nomb_cli), '') = '', 'f': 'nomb_cli',
         'r': 'El nombre es obligatorio.'},
        {'b': coalesce(trim(apell_cli), '') = '', 'f': 'apell_cli',
         'r': 'El apellido es obligatorio.'},
        {'b': coalesce(trim(num_doc), '') = '', 'f': 'num_doc',
         'r': 'El documento es obligatorio.'},
        {'b': fec_nac IS NULL, 'f': 'fec_nac',
         'r': 'La fecha de nacimiento es obligatoria.'},
        {'b': coalesce(fec_nac > date '2001-08-27', false), 'f': 'fec_nac',
         'r': 'La fecha de nacimiento no puede ser futura.'}], lambda x: x.b) AS bad
      FROM b_cli) WHERE len(bad) > 0""",
    "s_cli": """
SELECT id_cli, concat(trim(nomb_cli)[1], '***') AS nomb_cli,
       concat(trim(apell_cli)[1], '***') AS apell_cli,
       concat(trim(nomb_cli)[1], '*** ', trim(apell_cli)[1], '***') AS nombre_completo,
       upper(trim(tip_doc)) AS tip_doc,
       if(length(num_doc) < 5, '****', lpad(right(num_doc, 4), cast(length(num_doc) as int), '*')) AS num_doc,
       if(length(num_doc) < 5, '****', lpad(right(num_doc, 4), cast(length(num_doc) as int), '*'))
           AS num_doc_enmascarado,
       fec_nac, cast(datesub('year', fec_nac, date '2001-08-27') as int) AS edad, fec_alta,
       coalesce(nullif(trim(cod_segmento), ''), 'NO_INFORMADO') AS cod_segmento,
       coalesce(map {'BASICO': 'Básico', 'BÁSICO': 'Básico', 'ESTANDAR': 'Estándar',
                     'ESTÁNDAR': 'Estándar', 'PREMIUM': 'Premium', 'ELITE': 'Élite',
                     'ÉLITE': 'Élite'}[upper(rtrim(cod_segmento))],
                cod_segmento, 'NO_INFORMADO') AS segmento_legible,
       ifnull(score_buro, 0) AS score_buro, ciudad_res, depto_res,
       ifnull(estado_cli, 'NO_INFORMADO') AS estado_cli,
       ifnull(canal_adquis, 'NO_INFORMADO') AS canal_adquis
FROM b_cli WHERE cast(id_cli as varchar) NOT IN (SELECT id_registro FROM s_rej_cli)""",
    "s_prod": """
SELECT cod_prod, trim(desc_prod) AS nombre_producto, upper(trim(tip_prod)) AS tipo_producto,
       cast(ifnull(tasa_ea, 0) as decimal(10,4)) AS tasa_ea,
       cast(round((pow(1 + cast(ifnull(tasa_ea, 0) as double) / 100, cast(0.083333 as double))
                   - 1) * 100, 4) as decimal(10,4)) AS tasa_mensual_equivalente,
       plazo_max_meses, cuota_min,
       cast(ifnull(comision_admin, 0) as decimal(18,2)) AS comision_admin,
       ifnull(estado_prod, 'NO_INFORMADO') AS estado_prod,
       if(regexp_matches(upper(tip_prod), 'CR[EÉ]DITO|TARJETA'), 'CREDITO',
          if(upper(tip_prod) LIKE '%AHORRO%', 'AHORRO', 'TRANSACCIONAL')) AS familia_producto
FROM b_prod WHERE trim(tip_prod) <> '' AND trim(desc_prod) <> ''""",
    "s_suc": """
SELECT cod_suc, trim(nom_suc) AS nombre_sucursal,
       ifnull(tip_punto, 'NO_INFORMADO') AS tipo_punto, ciudad, depto AS departamento,
       latitud, longitud, ifnull(activo, 0) AS activo,
       if(activo = 1, 'ACTIVA', 'INACTIVA') AS estado_sucursal
FROM b_suc WHERE length(trim(nom_suc)) > 0""",
    "s_rej_obl": """
SELECT 'TB_OBLIGACIONES' AS tabla_origen, cast(id_oblig as varchar) AS id_registro,
       bad[1].k AS tipo_error, bad[1].f AS campo_error, bad[1].r AS motivo_rechazo
FROM (SELECT *, list_filter([
        {'b': id_cli IS NULL, 'k': 'CAMPO_OBLIGATORIO_NULO', 'f': 'id_cli',
         'r': 'El cliente es obligatorio.'},
        {'b': cod_prod IS NULL, 'k': 'CAMPO_OBLIGATORIO_NULO', 'f': 'cod_prod',
         'r': 'El producto es obligatorio.'},
        {'b': fec_desembolso IS NULL, 'k': 'CAMPO_OBLIGATORIO_NULO', 'f': 'fec_desembolso',
         'r': 'La fecha de desembolso es obligatoria.'},
        {'b': fec_venc IS NULL, 'k': 'CAMPO_OBLIGATORIO_NULO', 'f': 'fec_venc',
         'r': 'La fecha de vencimiento es obligatoria.'},
        {'b': id_cli NOT IN (SELECT id_cli FROM s_cli), 'k': 'CLIENTE_INEXISTENTE',
         'f': 'id_cli', 'r': 'El cliente no existe en Silver.'},
        {'b': cod_prod NOT IN (SELECT cod_prod FROM s_prod), 'k': 'PRODUCTO_INEXISTENTE',
         'f': 'cod_prod', 'r': 'El producto no existe en Silver.'},
        {'b': fec_venc < fec_desembolso, 'k': 'FECHA_VENCIMIENTO_INVALIDA', 'f': 'fec_venc',
         'r': 'La fecha de vencimiento es anterior a la fecha de desembolso.'}],
        lambda x: ifnull(x.b, false)) AS bad
      FROM b_obl) WHERE len(bad) > 0""",
    "s_obl": """
SELECT id_oblig, id_cli, cod_prod, vr_aprobado, vr_desembolsado, sdo_capital,
       cast(ifnull(vr_cuota, 0) as decimal(18,2)) AS vr_cuota, fec_desembolso, fec_venc,
       d AS dias_mora_act, num_cuotas_pend, ifnull(calif_riesgo, 'NO_INFORMADO') AS calif_riesgo,
       if(d = 0, 'AL DIA', if(d < 0 OR d > 90, 'DETERIORADO',
          'RANGO ' || cast((d - 1) // 30 + 1 as varchar))) AS bucket_mora,
       0 AS ind_fecha_inconsistente, 'VALIDO' AS estado_calidad
FROM (SELECT *, ifnull(dias_mora_act, 0) AS d FROM b_obl)
WHERE cast(id_oblig as varchar) NOT IN (SELECT id_registro FROM s_rej_obl)""",
    "s_com": """
SELECT DISTINCT ON (id_comision) id_comision, id_cli, cod_prod, fec_cobro, vr_comision,
       ifnull(tip_comision, 'NO_INFORMADO') AS tip_comision,
       ifnull(estado_cobro, 'NO_INFORMADO') AS estado_cobro,
       if(upper(estado_cobro) = 'COBRADA', 1, 0) AS ind_comision_cobrada,
       0 AS ind_valor_inconsistente
FROM b_com SEMI JOIN s_cli USING (id_cli) SEMI JOIN s_prod USING (cod_prod)
WHERE vr_comision >= 0 ORDER BY id_comision, fecha_ingesta DESC, id_lote DESC""",
    "s_inc": """
SELECT DISTINCT ON (id_incentivo) id_incentivo, id_cli, cod_prod, fec_incentivo,
       ifnull(tip_incentivo, 'NO_INFORMADO') AS tip_incentivo, vr_incentivo,
       ifnull(estado_incentivo, 'NO_INFORMADO') AS estado_incentivo,
       if(upper(estado_incentivo) = 'OTORGADO', 1, 0) AS ind_incentivo_otorgado,
       0 AS ind_valor_inconsistente
FROM b_inc SEMI JOIN s_cli USING (id_cli) SEMI JOIN s_prod USING (cod_prod)
WHERE vr_incentivo >= 0 ORDER BY id_incentivo, fecha_ingesta DESC, id_lote DESC""",
    "s_val": """
SELECT * FROM b_mov SEMI JOIN s_cli USING (id_cli) SEMI JOIN s_prod USING (cod_prod)""",
    # History by the literal self join.
    "s_hist": """
SELECT x.id_mov, count(h.id_mov) AS n, sum(h.vr_mov) AS total,
       stddev_samp(cast(h.vr_mov as double)) AS sd
FROM s_val x LEFT JOIN s_val h
  ON h.id_cli = x.id_cli AND h.fec_mov >= x.fec_mov - 30
 AND (h.fec_mov, h.hra_mov, h.id_mov) < (x.fec_mov, x.hra_mov, x.id_mov)
GROUP BY x.id_mov""",
    "s_day": """
SELECT id_cli, fec_mov, count(*) AS per_day FROM s_val GROUP BY id_cli, fec_mov""",
    "s_mov": """
SELECT id_mov, id_cli, cod_prod, num_cuenta, fec_mov, hra_mov, vr_mov,
       ifnull(tip_mov, 'NO_INFORMADO') AS tip_mov, ifnull(cod_canal, 'NO_INFORMADO') AS cod_canal,
       cod_ciudad, ifnull(cod_estado_mov, 'NO_INFORMADO') AS cod_estado_mov,
       ifnull(id_dispositivo, 'NO_INFORMADO') AS id_dispositivo,
       fecha_ingesta, sistema_fuente, id_lote,
       n AS movimientos_previos, mean AS promedio_historico, sd AS desviacion_historica,
       per_day AS frecuencia_diaria, a1 AS alerta_monto, a2 AS alerta_horario,
       a3 AS alerta_frecuencia, a4 AS alerta_canal, a1 + a2 + a3 + a4 AS total_alertas,
       a1 AS ind_sospechoso
FROM (SELECT v.*, n, sd, per_day,
             cast(cast(((2 * cast(total * 100 as hugeint) * 10000 + n) // (2 * n))
                       as decimal(28,0)) * cast(0.000001 as decimal(7,6)) as decimal(22,6)) AS mean,
             if(n >= 3 AND sd IS NOT NULL
                AND cast(vr_mov as double) > cast(total as double) / n + 3 * sd, 1, 0) AS a1,
             if(hra_mov < '05:00:00', 1, 0) AS a2, if(per_day >= 5, 1, 0) AS a3,
             if(upper(cod_canal) IN ('ATM', 'CORRESPONSAL'), 1, 0) AS a4
      FROM s_val v JOIN s_hist USING (id_mov) JOIN s_day USING (id_cli, fec_mov))""",
    "s_quality": """
SELECT * FROM (VALUES
  ('clientes', (SELECT count(*) FROM b_cli), (SELECT count(*) FROM s_cli),
   (SELECT count(*) FROM s_rej_cli)),
  ('productos', (SELECT count(*) FROM b_prod), (SELECT count(*) FROM s_prod), 0),
  ('sucursales', (SELECT count(*) FROM b_suc), (SELECT count(*) FROM s_suc), 0),
  ('obligaciones', (SELECT count(*) FROM b_obl), (SELECT count(*) FROM s_obl),
   (SELECT count(*) FROM s_rej_obl)),
  ('movimientos', (SELECT count(*) FROM b_mov), (SELECT count(*) FROM s_mov), 0),
  ('comisiones', (SELECT count(*) FROM b_com), (SELECT count(*) FROM s_com), 0),
  ('incentivos', (SELECT count(*) FROM b_inc), (SELECT count(*) FROM s_inc), 0)
) t(tabla, registros_bronze, registros_silver, registros_rechazados)""",
    "g_cli": """
SELECT row_number() OVER (ORDER BY id_cli) AS cliente_key,
       * EXCLUDE (nomb_cli, apell_cli, num_doc) FROM s_cli""",
    "g_prod": "SELECT row_number() OVER (ORDER BY cod_prod) AS producto_key, * FROM s_prod",
    "g_geo": """
SELECT row_number() OVER (ORDER BY ciudad, departamento) AS geografia_key, *
FROM (SELECT DISTINCT ciudad_res AS ciudad, depto_res AS departamento FROM s_cli)""",
    "g_can": """
SELECT row_number() OVER (ORDER BY cod_canal) AS canal_key, *
FROM (SELECT DISTINCT cod_canal FROM s_mov)""",
    "g_tra": """
SELECT row_number() OVER (ORDER BY id_mov, geografia_key) AS transaccion_key, id_mov,
       cliente_key, producto_key, canal_key, geografia_key, fec_mov, hra_mov, num_cuenta,
       vr_mov AS monto_cop,
       cast(((2 * cast(vr_mov * 100 as bigint) + 4000) // 8000) as decimal(18,0))
         * cast(0.01 as decimal(3,2)) AS monto_usd,
       tip_mov, cod_estado_mov, id_dispositivo, movimientos_previos, promedio_historico,
       desviacion_historica, frecuencia_diaria, alerta_monto, alerta_horario,
       alerta_frecuencia, alerta_canal, total_alertas, ind_sospechoso
FROM s_mov JOIN g_cli USING (id_cli) JOIN g_prod USING (cod_prod)
     LEFT JOIN g_can USING (cod_canal) LEFT JOIN g_geo ON cod_ciudad = g_geo.ciudad""",
    "g_car": """
SELECT row_number() OVER (ORDER BY id_oblig) AS cartera_key, id_oblig, cliente_key,
       producto_key, vr_aprobado, vr_desembolsado, sdo_capital, vr_cuota, fec_desembolso,
       fec_venc, dias_mora_act, num_cuotas_pend, bucket_mora, calif_riesgo,
       c.clase AS clasificacion_regulatoria, c.tasa AS porcentaje_provision,
       cast(sdo_capital * c.tasa as decimal(18,2)) AS provision_estimada
FROM s_obl JOIN g_cli USING (id_cli) JOIN g_prod USING (cod_prod)
     JOIN (VALUES (0, 0, 'A', cast(0.01 as decimal(5,2))), (-99999, -1, 'B', 0.05),
                  (1, 30, 'B', 0.05), (31, 60, 'C', 0.20), (61, 90, 'D', 0.50),
                  (91, 99999, 'E', 1.00)) c(lo, hi, clase, tasa)
       ON dias_mora_act BETWEEN c.lo AND c.hi""",
    "months": """
SELECT cast(m as date) AS mes_inicio
FROM (SELECT unnest(generate_series(timestamp '2000-09-01', timestamp '2001-08-01',
                                    interval 1 month)) AS m)""",
    # Interest in whole cents, rounded half up: balance cents * percent / 1200.
    "g_int": """
SELECT id_cli, mes_inicio, sum(cast(sdo_capital * 100 as hugeint)
                               * cast(coalesce(tasa_ea, 0) as int)) AS raw
FROM s_obl LEFT JOIN s_prod USING (cod_prod)
     JOIN months ON fec_desembolso <= last_day(mes_inicio) AND fec_venc >= mes_inicio
GROUP BY id_cli, mes_inicio""",
    "g_fee": """
SELECT id_cli, mes_inicio, sum(vr_comision) AS paid
FROM s_com JOIN months ON date_trunc('month', fec_cobro) = mes_inicio
WHERE ind_comision_cobrada = 1 GROUP BY id_cli, mes_inicio""",
    "g_gift": """
SELECT id_cli, mes_inicio, sum(vr_incentivo) AS given
FROM s_inc JOIN months ON date_trunc('month', fec_incentivo) = mes_inicio
WHERE ind_incentivo_otorgado = 1 GROUP BY id_cli, mes_inicio""",
    "g_ren": """
SELECT row_number() OVER (ORDER BY cliente_key, mes_inicio) AS rentabilidad_key, cliente_key,
       mes_inicio, cast(i as decimal(18,2)) AS ingreso_intereses,
       cast(f as decimal(18,2)) AS comisiones_cobradas,
       cast(g as decimal(18,2)) AS costo_incentivos, cast(i + f as decimal(18,2)) AS cltv_mensual
FROM (SELECT cliente_key, mes_inicio,
             cast((2 * ifnull(raw, 0) + 1200) // 2400 as decimal(20,0))
               * cast(0.01 as decimal(3,2)) AS i,
             ifnull(paid, 0) AS f, ifnull(given, 0) AS g
      FROM g_cli CROSS JOIN months LEFT JOIN g_int USING (id_cli, mes_inicio)
           LEFT JOIN g_fee USING (id_cli, mes_inicio)
           LEFT JOIN g_gift USING (id_cli, mes_inicio))""",
    "g_kpi": """
SELECT date '2001-08-27' AS fecha_kpi, producto_key, segmento_legible AS segmento,
       ciudad_res AS ciudad, count(*) AS total_obligaciones_activas,
       cast(sum(sdo_capital) as decimal(18,2)) AS cartera_total,
       cast(coalesce(sum(sdo_capital) FILTER (dias_mora_act > 0), 0) as decimal(18,2))
           AS monto_en_mora,
       cast(round(100 * coalesce(sum(sdo_capital) FILTER (dias_mora_act > 0), 0)
                  / sum(sdo_capital), 2) as decimal(10,2)) AS tasa_mora_pct,
       count(DISTINCT cliente_key) FILTER (dias_mora_act > 0) AS clientes_en_mora
FROM g_car JOIN g_cli USING (cliente_key) GROUP BY ALL""",
    "g_acc": """
SELECT producto_key, segmento_legible AS segmento, ciudad_res AS ciudad,
       count(DISTINCT cliente_key) AS cuentas_activas
FROM g_car JOIN g_cli USING (cliente_key) GROUP BY ALL""",
    "g_vol": """
SELECT fec_mov AS fecha, producto_key, segmento_legible AS segmento, g_geo.ciudad AS ciudad,
       canal_adquis AS canal, count(*) AS total_transacciones,
       cast(sum(monto_cop) as decimal(18,2)) AS volumen_transaccional
FROM g_tra JOIN g_cli USING (cliente_key) LEFT JOIN g_geo USING (geografia_key) GROUP BY ALL""",
    "g_reg": """
SELECT fecha, producto_key, segmento, ciudad, canal, ifnull(cuentas_activas, 0) AS cuentas_activas,
       total_transacciones, volumen_transaccional
FROM g_vol LEFT JOIN g_acc USING (producto_key, segmento, ciudad)""",
    "g_b1": """
SELECT cliente_key, count(*) AS total_obligaciones,
       count(DISTINCT producto_key) AS productos_cartera,
       cast(sum(sdo_capital) as decimal(18,2)) AS saldo_total_capital,
       max(dias_mora_act) AS max_dias_mora, max(clasificacion_regulatoria) AS clasificacion_riesgo,
       if(max(dias_mora_act) = 0, 'AL DIA', if(max(dias_mora_act) > 90, 'DETERIORADO',
          'RANGO ' || cast(greatest((max(dias_mora_act) - 1) // 30, 0) + 1 as varchar)))
           AS estado_mora
FROM g_car GROUP BY cliente_key""",
    "g_b2": """
SELECT cliente_key, count(*) AS total_movimientos,
       count(DISTINCT producto_key) AS productos_transaccionales,
       cast(sum(monto_cop) as decimal(18,2)) AS volumen_movimientos,
       cast(sum(ind_sospechoso) as bigint) AS movimientos_sospechosos
FROM g_tra GROUP BY cliente_key""",
    "g_b3": """
SELECT cliente_key, cast(sum(ingreso_intereses) as decimal(18,2)) AS ingresos_intereses_12m,
       cast(sum(comisiones_cobradas) as decimal(18,2)) AS comisiones_cobradas_12m,
       cast(sum(costo_incentivos) as decimal(18,2)) AS incentivos_12m,
       cast(sum(cltv_mensual) as decimal(18,2)) AS cltv_12m
FROM g_ren GROUP BY cliente_key""",
    "g_360": """
SELECT cliente_key, id_cli, nombre_completo, segmento_legible AS segmento, ciudad_res AS ciudad,
       depto_res AS departamento, score_buro, estado_cli,
       ifnull(total_obligaciones, 0) AS total_obligaciones,
       ifnull(productos_cartera, 0) + ifnull(productos_transaccionales, 0)
           AS productos_utilizados,
       ifnull(total_movimientos, 0) AS total_movimientos,
       cast(ifnull(saldo_total_capital, 0) as decimal(18,2)) AS saldo_total_capital,
       ifnull(max_dias_mora, 0) AS max_dias_mora, ifnull(estado_mora, 'AL DIA') AS estado_mora,
       clasificacion_riesgo,
       cast(ifnull(volumen_movimientos, 0) as decimal(18,2)) AS volumen_movimientos,
       ifnull(movimientos_sospechosos, 0) AS movimientos_sospechosos,
       ingresos_intereses_12m, comisiones_cobradas_12m, incentivos_12m, cltv_12m
FROM g_cli LEFT JOIN g_b1 USING (cliente_key) LEFT JOIN g_b2 USING (cliente_key)
     LEFT JOIN g_b3 USING (cliente_key)""",
}
