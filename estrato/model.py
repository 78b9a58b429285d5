"""Tables, keys and fixed values of the banking model."""

from __future__ import annotations

import re
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import types as T

AUDIT = ("fecha_ingesta", "sistema_fuente", "id_lote")
AUDIT_FIELDS = [
    T.StructField("fecha_ingesta", T.TimestampNTZType()),
    T.StructField("sistema_fuente", T.StringType()),
    T.StructField("id_lote", T.StringType()),
]


@dataclass(frozen=True)
class Table:
    name: str  # landing and Bronze name
    short: str  # Silver name
    key: str
    ddl: str  # landing columns with their final types

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def types(self) -> dict[str, str]:
        return dict(re.findall(r"(\w+) (\w+(?:\([^)]*\))?)", self.ddl))

    @property
    def columns(self) -> list[str]:
        return list(self.types)

    @property
    def compared(self) -> list[str]:
        return [c for c in self.columns if c != self.key]


CLIENTS = Table(
    "TB_CLIENTES_CORE", "clientes", "id_cli",
    "id_cli bigint, nomb_cli string, apell_cli string, tip_doc string, num_doc string, "
    "fec_nac date, fec_alta date, cod_segmento string, score_buro int, ciudad_res string, "
    "depto_res string, estado_cli string, canal_adquis string",
)
PRODUCTS = Table(
    "TB_PRODUCTOS_CAT", "productos", "cod_prod",
    "cod_prod string, desc_prod string, tip_prod string, tasa_ea decimal(10,4), "
    "plazo_max_meses int, cuota_min decimal(18,2), comision_admin decimal(18,2), "
    "estado_prod string",
)
BRANCHES = Table(
    "TB_SUCURSALES_RED", "sucursales", "cod_suc",
    "cod_suc string, nom_suc string, tip_punto string, ciudad string, depto string, "
    "latitud decimal(10,7), longitud decimal(10,7), activo int",
)
OBLIGATIONS = Table(
    "TB_OBLIGACIONES", "obligaciones", "id_oblig",
    "id_oblig bigint, id_cli bigint, cod_prod string, vr_aprobado decimal(18,2), "
    "vr_desembolsado decimal(18,2), sdo_capital decimal(18,2), vr_cuota decimal(18,2), "
    "fec_desembolso date, fec_venc date, dias_mora_act int, num_cuotas_pend int, "
    "calif_riesgo string",
)
MOVEMENTS = Table(
    "TB_MOV_FINANCIEROS", "movimientos", "id_mov",
    "id_mov bigint, id_cli bigint, cod_prod string, num_cuenta string, fec_mov date, "
    "hra_mov string, vr_mov decimal(18,2), tip_mov string, cod_canal string, "
    "cod_ciudad string, cod_estado_mov string, id_dispositivo string",
)
FEES = Table(
    "TB_COMISIONES_LOG", "comisiones", "id_comision",
    "id_comision bigint, id_cli bigint, cod_prod string, fec_cobro date, "
    "vr_comision decimal(18,2), tip_comision string, estado_cobro string",
)
INCENTIVES = Table(
    "TB_INCENTIVOS", "incentivos", "id_incentivo",
    "id_incentivo bigint, id_cli bigint, cod_prod string, fec_incentivo date, "
    "tip_incentivo string, vr_incentivo decimal(18,2), estado_incentivo string",
)

TABLES = (CLIENTS, PRODUCTS, BRANCHES, OBLIGATIONS, MOVEMENTS, FEES, INCENTIVES)

# Log tables.
INGESTION_LOG = (
    "id_log bigint, id_ejecucion string, tabla string, fecha_inicio timestamp_ntz, "
    "fecha_fin timestamp_ntz, duracion_segundos decimal(18,3), registros_procesados bigint, "
    "tamano_archivo_bytes bigint, ruta_archivo string, watermark_desde timestamp_ntz, "
    "watermark_hasta timestamp_ntz, estado string, mensaje_error string"
)
ERROR_LOG = (
    "id_error bigint, id_ejecucion string, etapa string, proceso string, tipo_error string, "
    "mensaje_error string, fecha_error timestamp_ntz, estado string"
)
CHECK_LOG = (
    "id_resultado bigint, id_ejecucion string, nombre_prueba string, capa string, "
    "resultado string, valor_observado bigint, valor_esperado bigint, detalle string, "
    "fecha_ejecucion timestamp_ntz"
)
MART_LOG = "id_log bigint, mart string, tabla string, manifiesto string, ruta string"
SNAPSHOT_LOG = "id_log bigint, tabla string, id_lote string, fecha timestamp_ntz, ruta string"

# Readable segment names.
SEGMENT_LABELS = {
    "BASICO": "Básico",
    "BÁSICO": "Básico",
    "ESTANDAR": "Estándar",
    "ESTÁNDAR": "Estándar",
    "PREMIUM": "Premium",
    "ELITE": "Élite",
    "ÉLITE": "Élite",
}

# Arrears buckets and regulatory classes by days overdue.
BUCKET_STEPS = [(30, "RANGO 1"), (60, "RANGO 2"), (90, "RANGO 3")]
BUCKET_CURRENT, BUCKET_WORST = "AL DIA", "DETERIORADO"
CLASS_STEPS = [(30, "B"), (60, "C"), (90, "D")]
CLASS_CURRENT, CLASS_WORST = "A", "E"
PROVISION_STEPS = [(30, Decimal("0.05")), (60, Decimal("0.20")), (90, Decimal("0.50"))]
PROVISION_CURRENT, PROVISION_WORST = Decimal("0.01"), Decimal("1.00")

# Channels that raise a fraud alert.
RISKY_CHANNELS = ("ATM", "CORRESPONSAL")

# Fixed value: one twelfth as the source system keeps it, cut to six decimals.
MONTH_EXPONENT = 0.083333
