"""Column lists, keys and table schemas of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: landing loan columns, in file order -----------------------------
LOAN_COLUMNS = [
    "periodo", "tipoCredito", "tipoEntidad", "entidad", "sectorEconomico", "region",
    "provincia", "moneda", "tipoCartera", "actividad", "sector", "persona", "facilidad",
    "residencia", "administracionYPropiedad", "genero", "tipoCliente",
    "clasificacionEntidad", "cantidadPlasticos", "cantidadCredito", "deuda",
    "tasaPorDeuda", "deudaCapital", "deudaVencida", "deudaVencidaDe31A90Dias",
    "valorDesembolso", "valorGarantia", "valorProvisionCapitalYRendimiento",
]
REQUESTED_PERIOD = "__periodo"
EXPECTED_COLUMNS = [*LOAN_COLUMNS, REQUESTED_PERIOD]

LOAN_TEXT = LOAN_COLUMNS[:18]
LOAN_INTEGERS = ["cantidadPlasticos", "cantidadCredito"]
LOAN_DOUBLES = [
    "deuda", "tasaPorDeuda", "deudaCapital", "deudaVencida", "deudaVencidaDe31A90Dias",
    "valorDesembolso", "valorGarantia", "valorProvisionCapitalYRendimiento",
]

# --- fixed values: silver -----------------------------------------------------------
SILVER_TEXT = [
    "periodo", "tipoCliente", "actividad", "entidad", "sector", "moneda", "provincia",
    "residencia", "genero", "persona",
]
SILVER_AMOUNTS = [
    "deudaCapital", "deudaVencida", "deudaVencidaDe31A90Dias", "valorDesembolso",
    "valorGarantia", "valorProvisionCapitalYRendimiento", "deuda",
]
SILVER_KEY = ["entidad", "periodo", "tipoCliente", "provincia", "genero", "persona"]
SILVER_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in SILVER_TEXT]
    + [
        T.StructField("deudaCapital", T.DoubleType()),
        T.StructField("deudaVencida", T.DoubleType()),
        T.StructField("deudaVencidaDe31A90Dias", T.DoubleType()),
        T.StructField("cantidadCredito", T.LongType()),
        T.StructField("valorDesembolso", T.DoubleType()),
        T.StructField("valorGarantia", T.DoubleType()),
        T.StructField("valorProvisionCapitalYRendimiento", T.DoubleType()),
        T.StructField("deuda", T.DoubleType()),
        T.StructField("periodo_date", T.DateType()),
        T.StructField("anio", T.LongType()),
        T.StructField("mes", T.LongType()),
        T.StructField("periodo_ym", T.LongType()),
        T.StructField("flg_periodo_invalido", T.LongType()),
        T.StructField("flg_importe_negativo", T.LongType()),
        T.StructField("dt_captura", T.DateType()),
    ]
)
SILVER_COLUMNS = SILVER_SCHEMA.fieldNames()

# --- fixed values: gold -------------------------------------------------------------
# (silver column, gold column) of the summed measures and of the distinct counts
FACT_SUMS = [
    ("deudaCapital", "DEUDACAPITAL"),
    ("deudaVencida", "DEUDAVENCIDA"),
    ("deudaVencidaDe31A90Dias", "DEUDAVENCIDADE31A90DIAS"),
    ("cantidadCredito", "CANTIDADCREDITO"),
    ("valorDesembolso", "VALORDESEMBOLSO"),
    ("valorGarantia", "VALORGARANTIA"),
    ("valorProvisionCapitalYRendimiento", "VALORPROVISIONCAPITALYRENDIMIENTO"),
    ("deuda", "DEUDA"),
]
FACT_DIMENSIONS = ["genero", "persona", "moneda", "sector", "entidad", "residencia"]
GOLD_KEY = ["periodo_date", "PROVINCIA"]
GOLD_SCHEMA = T.StructType(
    [
        T.StructField("periodo_date", T.DateType()),
        T.StructField("ANIO", T.LongType()),
        T.StructField("MES", T.LongType()),
        T.StructField("PROVINCIA", T.StringType()),
    ]
    + [
        T.StructField(g, T.LongType() if g == "CANTIDADCREDITO" else T.DoubleType())
        for _, g in FACT_SUMS
    ]
    + [T.StructField(c.upper(), T.DoubleType()) for c in FACT_DIMENSIONS]
    + [
        T.StructField("TASA_MORA", T.DoubleType()),
        T.StructField("COBERTURA_GARANTIA", T.DoubleType()),
        T.StructField("PROPORCION_PROVISIONADA", T.DoubleType()),
        T.StructField("PD_AGREGADA", T.LongType()),
        T.StructField("INFLACION", T.DoubleType()),
        T.StructField("TC_VENTA", T.DoubleType()),
        T.StructField("TC_COMPRA", T.DoubleType()),
    ]
)
GOLD_COLUMNS = GOLD_SCHEMA.fieldNames()
# First month ever loaded when the target is empty, and the default capture watermark.
FIRST_PERIOD = "2012-01-01"
FIRST_CAPTURE = "1900-01-01"
LOOKBACK_MONTHS = 2

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("provincia", T.StringType()),
        T.StructField("anio", T.LongType()),
        T.StructField("mes", T.LongType()),
        T.StructField("tasa_mora_promedio", T.DoubleType()),
        T.StructField("tendencia_mora", T.StringType()),
        T.StructField("nivel_alerta", T.StringType()),
        T.StructField("entidades_afectadas", T.LongType()),
        T.StructField("fecha_calculo", T.DateType()),
    ]
)
DASHBOARD_SCHEMA = T.StructType(
    [
        T.StructField("PROVINCIA", T.StringType()),
        T.StructField("ANIO", T.LongType()),
        T.StructField("MES", T.LongType()),
        T.StructField("periodo_date", T.DateType()),
        T.StructField("tasa_mora", T.DoubleType()),
        T.StructField("variacion_mensual", T.DoubleType()),
        T.StructField("percentil_nacional", T.DoubleType()),
        T.StructField("clasificacion_riesgo", T.StringType()),
    ]
)
LOG_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.StringType()),
        T.StructField("process_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("start_time", T.TimestampType(), False),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# --- fixed values: macro series in their canonical bronze shape, all text ------------
MACRO_COLUMNS = {
    "desempleo_imf": ["fecha", "pais", "tasa_desempleo", "fuente"],
    "inflacion_12m": ["fecha", "pais", "inflacion_anual", "indice_base"],
    "tipo_cambio": ["fecha", "moneda_origen", "moneda_destino", "tasa_cambio", "tipo_cambio"],
}
