"""Queries through files: landing CSV, bronze, silver and gold tables, file stream.

Each writes whole tables below the shared folder of the session, reads them back with the
library's scans, and must give what the SQL says about the original tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.functions.scalars import stable_sum
from sparklake.operators.dedup import spread
from sparklake.plans import bronze, gold, silver
from sparklake.plans.layout import Lake
from sparklake.queries import views
from sparklake.queries.registry import query
from sparklake.queries.silver import _latest_sql
from sparklake.schemas import ALERT_SCHEMA, DASHBOARD_SCHEMA, GOLD_COLUMNS, GOLD_SCHEMA, LOAN_COLUMNS, REQUESTED_PERIOD, SILVER_COLUMNS, SILVER_KEY, SILVER_SCHEMA
from sparklake.session import shared_dir
from sparklake.sinks.clustering import write_clustered
from sparklake.sinks.csv import COMPRESSED, export_by_period, export_capture
from sparklake.sinks.tables import read_table, write_partitions
from sparklake.sources import files
from sparklake.sources.landing import path_date, read_captures, read_partitioned, rows_per_file
from sparklake.streaming.landing import start_silver_stream

_CAPTURE = dt.date(2002, 1, 1)
# landing columns made from the tables; the remaining ones stay empty
_LANDED = [c for c in SILVER_COLUMNS if c in LOAN_COLUMNS]


def _lake(spark) -> Lake:
    return Lake(shared_dir(spark, "lake"))


def _landed_text(rows: DataFrame, *keep: str) -> DataFrame:
    """Loans as a landing file holds them: 28 text columns."""
    text = [
        F.col(c).cast("string").alias(c) if c in _LANDED else F.lit(None).cast("string").alias(c)
        for c in LOAN_COLUMNS
    ]
    return rows.select(*text, *keep)


def _landing_rows(spark, sf_dir: str) -> DataFrame:
    return _landed_text(views.loans(spark, sf_dir, *_LANDED, "dt_captura"), "dt_captura")


def _loans_by_year(spark, sf_dir: str) -> DataFrame:
    """Loans with their capture ``dt``, the first of January after the year of shipment."""
    rows = views.loans(spark, sf_dir, *_LANDED, "dt_captura")
    return rows.withColumn("dt", F.make_date(F.year("dt_captura") + 1, F.lit(1), F.lit(1)))


def _land_by_year(spark, sf_dir: str, lake: Lake, harvest: bool = False, gathered: bool = False) -> None:
    """One capture per year of shipment, dated the first of January after it.

    With ``harvest`` the files also have the requested month, in two orders or not at all. A stream that
    takes some files at a time gets them ``gathered``: a capture's rows, still typed and narrow, are
    dealt to a few tasks, where otherwise each task of the join leaves a file for every capture.
    """
    rows = _loans_by_year(spark, sf_dir)
    orders = [LOAN_COLUMNS]
    if harvest:
        orders = [[*LOAN_COLUMNS, REQUESTED_PERIOD], [REQUESTED_PERIOD, *reversed(LOAN_COLUMNS)], LOAN_COLUMNS]
    for kind, columns in enumerate(orders):
        part = rows.where(F.year("dt_captura") % 3 == kind) if harvest else rows
        if gathered:
            tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
            part = part.repartition(tasks, "dt", spread(part, _LANDED))
        part = _landed_text(part, "dt").withColumn(REQUESTED_PERIOD, F.col("periodo"))
        landed = part.select(*columns, "dt").write.partitionBy("dt").mode("append").option("header", True)
        landed.options(**COMPRESSED).csv(lake.loans_landing)


_CAPTURED_SQL = f"""{views.LOANS_SQL}, yearly AS (
  SELECT * REPLACE (make_date(year(dt_captura) + 1, 1, 1) AS dt_captura) FROM loans
)"""
_LATEST_SQL = f"{_CAPTURED_SQL}, latest AS ({_latest_sql('yearly', SILVER_COLUMNS, SILVER_KEY, 'dt_captura')})"
_SILVER_LIST = ", ".join(SILVER_COLUMNS)


@query("csv_roundtrip", f"WITH {_CAPTURED_SQL} SELECT {', '.join(_LANDED)}, dt_captura FROM yearly")
def csv_roundtrip(spark, sf_dir):
    """Written as partitioned CSV, read back as text with the capture date from the path."""
    lake = _lake(spark)
    _land_by_year(spark, sf_dir, lake)
    raw = read_captures(spark, lake.loans_landing, files.capture_dates(spark, lake.loans_landing))
    types = {f.name: f.dataType for f in SILVER_SCHEMA}
    return raw.select(*[F.col(c).cast(types[c]).alias(c) for c in _LANDED], "dt_captura")


@query(
    "bronze_write_read",
    f"""WITH {views.LOANS_SQL} SELECT CAST(anio AS INTEGER) AS anio, CAST(mes AS INTEGER) AS mes, count(*) AS filas,
      round(sum(deudaCapital), 2) AS deuda_capital, CAST(sum(cantidadCredito) AS BIGINT) AS creditos,
      DATE '{_CAPTURE}' AS dt_captura FROM loans GROUP BY 1, 2""",
)
def bronze_write_read(spark, sf_dir):
    """The bronze job on one capture, read back through its month folders."""
    lake = _lake(spark)
    export_capture(_landing_rows(spark, sf_dir).drop("dt_captura"), lake.loans_landing, _CAPTURE, compressed=True)
    bronze.load_loans(spark, lake)
    stored = read_partitioned(spark, lake.loans_bronze)
    return stored.groupBy("anio", "mes").agg(
        F.count(F.lit(1)).alias("filas"),
        stable_sum(F.col("deudaCapital"), 2).alias("deuda_capital"),
        F.sum("cantidadCredito").alias("creditos"),
        F.max("dt_captura").alias("dt_captura"),
    )


@query("silver_from_bronze", f"""WITH {views.LOANS_SQL}, captured AS (
    SELECT * REPLACE (DATE '{_CAPTURE}' AS dt_captura) FROM loans)
    {_latest_sql('captured', SILVER_COLUMNS, SILVER_KEY, 'dt_captura')}""")
def silver_from_bronze(spark, sf_dir):
    """Landing to bronze to silver; a second run finds nothing new."""
    lake = _lake(spark)
    export_capture(_landing_rows(spark, sf_dir).drop("dt_captura"), lake.loans_landing, _CAPTURE, compressed=True)
    bronze.load_loans(spark, lake)
    silver.load_from_bronze(spark, lake)
    silver.load_from_bronze(spark, lake)
    return read_table(spark, lake.silver, SILVER_SCHEMA)


@query("silver_from_landing", f"WITH {_LATEST_SQL} SELECT {_SILVER_LIST} FROM latest")
def silver_from_landing(spark, sf_dir):
    """The incremental route straight from CSV; a second run finds no new capture."""
    lake = _lake(spark)
    _land_by_year(spark, sf_dir, lake)
    silver.load_from_landing(spark, lake)
    silver.load_from_landing(spark, lake)
    return read_table(spark, lake.silver, SILVER_SCHEMA)


@query("stream_landing", f"WITH {_LATEST_SQL} SELECT {_SILVER_LIST} FROM latest")
def stream_landing(spark, sf_dir):
    """The same captures as a file stream, several micro-batches, upserted by key.

    Files carry the harvest's 29 columns; one capture in three has them in another order,
    and one in three lacks the requested month.
    """
    lake = _lake(spark)
    _land_by_year(spark, sf_dir, lake, harvest=True, gathered=True)
    checkpoint = shared_dir(spark, "stream")
    start_silver_stream(spark, lake.loans_landing, lake.silver, checkpoint, files_per_batch=8).awaitTermination()
    return read_table(spark, lake.silver, SILVER_SCHEMA)


# the job started in 1990 reads the whole macro series
_ALL_GOLD_SQL = views.GOLD_SQL.replace(f"DATE '{views.MACRO_SINCE}'", "DATE '1989-12-01'")


def _gold_lake(spark, sf_dir: str) -> Lake:
    """Silver written as a table, and the macro series as bronze tables."""
    lake = _macro_lake(spark, sf_dir)
    write_partitions(views.silver(spark, sf_dir), lake.silver, [silver.PARTITION], silver.CLUSTER)
    return lake


def _macro_lake(spark, sf_dir: str) -> Lake:
    """The macro series as bronze tables."""
    lake = _lake(spark)
    series = views.macro_standin(spark, sf_dir)
    day = F.date_format("fecha", "yyyy-MM-dd").alias("fecha")
    captured = F.lit(_CAPTURE).alias("dt_captura")
    kind = F.when(F.col("tipo_cambio") == "F", "VENTA").when(F.col("tipo_cambio") == "O", "COMPRA")
    inflation = series.select(day, F.col("inflacion_anual").cast("string"), captured)
    exchange = series.select(day, F.col("tasa_cambio").cast("string"), kind.alias("tipo_cambio"), captured)
    write_partitions(inflation, lake.macro_bronze("inflacion_12m"), ["dt_captura"])
    write_partitions(exchange, lake.macro_bronze("tipo_cambio"), ["dt_captura"])
    return lake


def _load_twice(spark, lake: Lake) -> None:
    """All months into empty gold, then the two-month look-back over what that wrote."""
    exact = {"scales": views.MEASURE_SCALES, "macro_scale": 2}
    gold.load_gold(spark, lake, start=dt.date(1990, 1, 1), **exact)
    gold.load_gold(spark, lake, **exact)


@query("gold_table", f"WITH {_ALL_GOLD_SQL} SELECT {', '.join(GOLD_COLUMNS)} FROM gold")
def gold_table(spark, sf_dir):
    """The gold job, run for everything and then again for the last months."""
    lake = _gold_lake(spark, sf_dir)
    _load_twice(spark, lake)
    return read_table(spark, lake.gold, GOLD_SCHEMA).select(*GOLD_COLUMNS)


@query(
    "alerts_table",
    f"""WITH {_ALL_GOLD_SQL}, a AS (
      SELECT PROVINCIA AS provincia, ANIO AS anio, MES AS mes, TASA_MORA AS t,
        lag(TASA_MORA) OVER (PARTITION BY PROVINCIA ORDER BY ANIO, MES) AS p FROM gold)
    SELECT provincia, anio, mes, t AS tasa_mora_promedio,
      CASE WHEN t > p THEN 'SUBIENDO' WHEN t < p THEN 'BAJANDO' ELSE 'ESTABLE' END AS tendencia_mora,
      CASE WHEN t > 0.15 THEN 'ALTO' WHEN t > 0.08 THEN 'MEDIO' ELSE 'BAJO' END AS nivel_alerta,
      CAST(1 AS BIGINT) AS entidades_afectadas FROM a""",
)
def alerts_table(spark, sf_dir):
    """The alert table after a full run and a second run over the last months."""
    lake = _gold_lake(spark, sf_dir)
    _load_twice(spark, lake)
    return read_table(spark, lake.alerts, ALERT_SCHEMA).drop("fecha_calculo", gold.ALERT_PARTITION)


@query(
    "dashboard_table",
    f"""WITH {_ALL_GOLD_SQL} SELECT PROVINCIA, ANIO, MES, periodo_date, TASA_MORA AS tasa_mora,
      TASA_MORA - lag(TASA_MORA) OVER (PARTITION BY PROVINCIA ORDER BY periodo_date) AS variacion_mensual,
      percent_rank() OVER (PARTITION BY periodo_date ORDER BY TASA_MORA) AS percentil_nacional,
      CASE WHEN TASA_MORA > 0.15 THEN 'ALTO' WHEN TASA_MORA > 0.08 THEN 'MEDIO' ELSE 'BAJO' END AS clasificacion_riesgo
    FROM gold""",
)
def dashboard_table(spark, sf_dir):
    """The dashboard's alert table after a full run and a second run over the last months."""
    lake = _gold_lake(spark, sf_dir)
    _load_twice(spark, lake)
    return read_table(spark, lake.dashboard, DASHBOARD_SCHEMA)


@query("gold_incremental_state", f"WITH {_ALL_GOLD_SQL} SELECT {', '.join(GOLD_COLUMNS)} FROM gold")
def gold_incremental_state(spark, sf_dir):
    """Gold of two appends to silver; after the second one only its own files are counted."""
    lake = _macro_lake(spark, sf_dir)
    rows, late = views.silver(spark, sf_dir), F.col("dt_captura") >= F.lit(dt.date(1996, 1, 1))
    for part in (rows.where(~late), rows.where(late)):
        silver.store(spark, part, lake.silver)
        exact = {"scales": views.MEASURE_SCALES, "macro_scale": 2}
        gold.load_gold(spark, lake, start=dt.date(1990, 1, 1), from_state=True, **exact)
    return read_table(spark, lake.gold, GOLD_SCHEMA).select(*GOLD_COLUMNS)


@query(
    "encoding_fallback",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN concat('Crédito año ', c_name) ELSE concat('Peña ñandú ', c_name) END AS entidad,
      c_mktsegment AS "Sección" FROM customer""",
)
def encoding_fallback(spark, sf_dir):
    """UTF-8 files beside ISO-8859-1 files of one capture, headers with accents included."""
    path = shared_dir(spark, "encoding")
    accented = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("Crédito año "), "c_name")).otherwise(
        F.concat(F.lit("Peña ñandú "), "c_name")
    )
    rows = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        accented.alias("entidad"),
        F.col("c_mktsegment").alias("Sección"),
        (F.col("c_acctbal") >= 0).alias("_utf8"),
    )
    day = f"{path}/dt={_CAPTURE.isoformat()}"
    for encoding, part in (("UTF-8", rows.where("_utf8")), ("ISO-8859-1", rows.where("NOT _utf8"))):
        part.drop("_utf8").write.mode("append").option("header", True).option("encoding", encoding).csv(day)
    read = read_captures(spark, path, [_CAPTURE])
    return read.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "entidad", "Sección")


@query(
    "monthly_csv_export",
    """SELECT strftime(o_orderdate, '%Y-%m') AS periodo, count(*) AS filas, round(sum(o_totalprice), 2) AS deuda
    FROM orders GROUP BY 1""",
)
def monthly_csv_export(spark, sf_dir):
    """One CSV folder per month, read back with the month from the folder name."""
    path = shared_dir(spark, "monthly")
    rows = views.table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("periodo"), F.col("o_totalprice").alias("deuda")
    )
    export_by_period(rows, path)
    read = spark.read.option("header", True).schema("deuda double, periodo string").csv(path)
    return read.groupBy("periodo").agg(F.count(F.lit(1)).alias("filas"), F.round(F.sum("deuda"), 2).alias("deuda"))


@query(
    "year_label_partitions",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS "Año", o_orderstatus, count(*) AS filas FROM orders GROUP BY 1, 2""",
)
def year_label_partitions(spark, sf_dir):
    """Parquet partitioned by a column whose name is not ASCII."""
    path = shared_dir(spark, "year")
    rows = views.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("Año"), "o_orderstatus")
    write_partitions(rows, path, ["Año"])
    return read_partitioned(spark, path).groupBy("Año", "o_orderstatus").agg(F.count(F.lit(1)).alias("filas"))


@query(
    "lineage_columns",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS dt_captura, count(*) AS filas FROM orders GROUP BY 1""",
)
def lineage_columns(spark, sf_dir):
    """Rows per source file, then per the capture date in the file's path."""
    base = shared_dir(spark, "lineage")
    orders = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.to_date(F.trunc("o_orderdate", "MM")).alias("dt")
    )
    orders.write.partitionBy("dt").option("header", True).csv(base)
    raw = read_captures(spark, base, files.capture_dates(spark, base))
    per_file = rows_per_file(raw)
    return per_file.groupBy(path_date(F.col("archivo_origen")).alias("dt_captura")).agg(
        F.sum("filas").alias("filas")
    )


@query(
    "clustered_filters",
    """
    SELECT 'day' AS filtered, COUNT(*) AS n, CAST(SUM(l_linenumber) AS BIGINT) AS lines FROM lineitem
    WHERE l_shipdate >= DATE '1995-03-01' AND l_shipdate < DATE '1995-04-01'
    UNION ALL
    SELECT 'part', COUNT(*), CAST(SUM(l_linenumber) AS BIGINT) FROM lineitem WHERE l_partkey BETWEEN 20 AND 40
    """,
)
def clustered_filters(spark, sf_dir: str) -> DataFrame:
    """A table clustered by two columns, read by a filter on either."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_shipdate", "l_partkey", "l_linenumber")
    path = shared_dir(spark, "clustered")
    write_clustered(rows, path, ["l_shipdate", "l_partkey"], 16)
    table = spark.read.schema(rows.schema).parquet(path)
    day = table.where("l_shipdate >= DATE '1995-03-01' AND l_shipdate < DATE '1995-04-01'")
    part = table.where("l_partkey BETWEEN 20 AND 40")
    told = [F.count("*").alias("n"), F.sum("l_linenumber").cast("bigint").alias("lines")]
    one, two = (x.agg(*told).select(F.lit(name).alias("filtered"), "n", "lines") for name, x in (("day", day), ("part", part)))
    return one.union(two)
