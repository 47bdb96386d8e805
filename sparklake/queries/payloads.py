"""Queries over landed API responses, built page by page from the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklake.functions.scalars import frequency_label
from sparklake.operators.normalize import MORTGAGES
from sparklake.plans.harvest import harvest
from sparklake.plans.layout import Lake
from sparklake.queries import views
from sparklake.queries.registry import query
from sparklake.session import shared_dir
from sparklake.sources.countries import COUNTRY_NAMES, country_dimension
from sparklake.sources.landing import file_listing, latest_loaded_period, read_captures
from sparklake.sources.payloads import (
    inflation_series,
    loan_fields,
    loan_rows,
    loan_variants,
    series_detected,
    series_fixed,
    statistics_rows,
    unemployment_series,
    variant_columns,
)

_PAGE = 100  # rows per response; keeps every document small


def _pages(df: DataFrame, key: str, row: Column) -> DataFrame:
    """Responses of at most a page of rows each, as the services send them."""
    page = F.floor(F.col(key) / _PAGE).alias("page")
    return df.groupBy(page).agg(F.collect_list(row).alias("rows"))


def _series_document(pages: DataFrame) -> DataFrame:
    """The nesting of the BI service around a list of rows."""
    block = F.concat(F.lit('{"DM0":'), F.to_json("rows"), F.lit("}"))
    body = F.concat(
        F.lit('{"results":[{"result":{"data":{"dsr":{"DS":[{"PH":['), block, F.lit("]}]}}}}]}")
    )
    return pages.select(body.alias("body"))


def _ms() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp")).cast("double")


def _plain_time(df: DataFrame) -> DataFrame:
    """The time without a zone, as the tables hold it."""
    return df.withColumn("fecha", F.col("fecha").cast("timestamp_ntz"))


_MS_SQL = "CAST(date_trunc('milliseconds', ts) AS TIMESTAMP)"


@query("json_series_fixed", f"SELECT {_MS_SQL} AS fecha, value AS valor FROM events")
def json_series_fixed(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    row = F.struct(F.array(_ms(), F.col("value")).alias("C"))
    return _plain_time(series_fixed(_series_document(_pages(events, "event_id", row))))


@query(
    "json_series_detect",
    f"SELECT {_MS_SQL} AS fecha, value AS valor FROM events WHERE event_type NOT IN ('error', 'signup')",
)
def json_series_detect(spark, sf_dir):
    """Views come value first; errors hold one element and signups no timestamp."""
    events = views.table(spark, sf_dir, "events")
    items = (
        F.when(F.col("event_type") == "view", F.array("value", _ms()))
        .when(F.col("event_type") == "error", F.array("value"))
        .when(F.col("event_type") == "signup", F.array("value", "value"))
        .otherwise(F.array(_ms(), "value"))
    )
    return _plain_time(series_detected(_series_document(_pages(events, "event_id", F.struct(items.alias("C"))))))


@query(
    "json_inflation_shape",
    "SELECT strftime(ts, '%Y-%m') AS fecha, value AS inflacion, 'Dominican Republic' AS pais FROM events",
)
def json_inflation_shape(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    row = F.struct(F.array(_ms(), F.col("value")).alias("C"))
    return inflation_series(_series_document(_pages(events, "event_id", row)), COUNTRY_NAMES["DOM"])


_LOAN_FIELDS = ["periodo", "entidad", "moneda", "deuda", "provincia"]


@query(
    "json_rows",
    """SELECT strftime(o_orderdate, '%Y-%m') AS periodo, CAST(o_orderkey AS VARCHAR) AS entidad, o_orderstatus AS moneda,
      CAST(o_totalprice AS VARCHAR) AS deuda, CAST(NULL AS VARCHAR) AS provincia,
      CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS nota,
      CASE WHEN (o_orderkey // 100) % 2 = 0 THEN 'lista' ELSE 'objeto' END AS __periodo FROM orders""",
)
def json_rows(spark, sf_dir):
    """Even pages are JSON lists, odd ones objects with the list as ``Data``."""
    orders = views.table(spark, sf_dir, "orders")
    row = F.struct(
        F.date_format("o_orderdate", "yyyy-MM").alias("periodo"),
        F.col("o_orderkey").alias("entidad"),
        F.col("o_orderstatus").alias("moneda"),
        F.col("o_totalprice").alias("deuda"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("nota"),  # in some rows only
    )
    pages = _pages(orders, "o_orderkey", row)
    listed = F.col("page") % 2 == 0
    body = F.when(listed, F.to_json("rows")).otherwise(
        F.concat(F.lit('{"Data":'), F.to_json("rows"), F.lit("}"))
    )
    landed = pages.select(
        body.alias("body"), F.when(listed, "lista").otherwise("objeto").alias("periodo_solicitado")
    )
    return loan_rows(landed, fields=loan_fields(landed, preferred=_LOAN_FIELDS))


@query(
    "harvest_to_landing",
    """SELECT strftime(o_orderdate, '%Y-%m') AS periodo, CAST(o_orderkey AS VARCHAR) AS entidad,
      CAST(o_totalprice AS VARCHAR) AS deuda, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS nota,
      DATE '2002-01-01' AS dt_captura, '2002-01' AS ultimo_periodo
    FROM orders WHERE o_orderstatus <> 'P'""",
)
def harvest_to_landing(spark, sf_dir):
    """Responses to a consolidated capture, filtered by category, read back with its lineage."""
    orders = views.table(spark, sf_dir, "orders")
    row = F.struct(
        F.date_format("o_orderdate", "yyyy-MM").alias("periodo"),
        F.col("o_orderkey").alias("entidad"),
        F.when(F.col("o_orderstatus") == "P", "Otra").otherwise("CRÉDITOS hipotecarios").alias("tipoCartera"),
        F.col("o_totalprice").alias("deuda"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("nota"),
    )
    pages = _pages(orders, "o_orderkey", row)
    responses = pages.select(F.to_json("rows").alias("body"), F.lit("2001-12").alias("periodo_solicitado"))
    lake = Lake(shared_dir(spark, "harvest"))
    day = dt.date(2002, 1, 1)
    harvest(spark, responses, lake, day, MORTGAGES)
    read = read_captures(spark, lake.loans_landing, [day])
    newest = latest_loaded_period(file_listing(spark, lake.loans_landing)).scalar()
    return read.select("periodo", "entidad", "deuda", "nota", "dt_captura", newest.alias("ultimo_periodo"))


_CODES = {"view": ("DOM", "A"), "click": ("USA", "M"), "purchase": ("MEX", "Q"), "signup": ("XXX", "M"), "error": ("ESP", "W")}


def _case(position: int) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v[position]}'" for k, v in _CODES.items())
    return f"CASE event_type {whens} END"


def _statistics(spark, sf_dir) -> DataFrame:
    """Statistics responses: errors carry a value that is not a number."""
    events = views.table(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    row = F.struct(
        value.alias("OBS_VALUE"),
        F.date_format("ts", "yyyy-MM").alias("TIME_PERIOD"),
        F.expr(_case(1)).alias("FREQ"),
        F.expr(_case(0)).alias("REF_AREA"),
        F.col("event_id").alias("extra"),
    )
    pages = _pages(events, "event_id", row)
    return pages.select(F.concat(F.lit('{"value":'), F.to_json("rows"), F.lit("}")).alias("body"))


_STATISTICS_SQL = f"""SELECT CASE WHEN event_type <> 'error' THEN value END AS OBS_VALUE, strftime(ts, '%Y-%m') AS TIME_PERIOD,
  {_case(1)} AS FREQ, {_case(0)} AS REF_AREA FROM events"""


@query("json_statistics", _STATISTICS_SQL)
def json_statistics(spark, sf_dir):
    return statistics_rows(_statistics(spark, sf_dir))


@query(
    "broadcast_dimension",
    f"""SELECT OBS_VALUE AS tasa_desempleo, TIME_PERIOD AS anio,
      CASE FREQ WHEN 'A' THEN 'Anual' WHEN 'M' THEN 'Mensual' WHEN 'Q' THEN 'Trimestral' ELSE 'Desconocido' END AS periodicidad,
      REF_AREA AS pais_id, CASE REF_AREA WHEN 'DOM' THEN 'Dominican Republic' WHEN 'USA' THEN 'United States'
        WHEN 'MEX' THEN 'Mexico' WHEN 'ESP' THEN 'Spain' END AS pais FROM ({_STATISTICS_SQL}) s""",
)
def broadcast_dimension(spark, sf_dir):
    """Country names for the codes of a response; an unknown code stays without a name."""
    return unemployment_series(statistics_rows(_statistics(spark, sf_dir)), country_dimension(spark))


@query(
    "dimension_labels",
    f"""SELECT n_name, n_nationkey, CASE n_regionkey WHEN 0 THEN 'Anual' WHEN 1 THEN 'Mensual' WHEN 2 THEN 'Trimestral'
      ELSE 'Desconocido' END AS periodicidad, count(*) AS clientes
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3""",
)
def dimension_labels(spark, sf_dir):
    """Customers joined with a dimension table whose size Spark checks itself."""
    joined = views.table(spark, sf_dir, "customer").join(
        views.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    code = F.try_element_at(F.array(F.lit("A"), F.lit("M"), F.lit("Q")), F.col("n_regionkey") + 1)
    return joined.groupBy("n_name", "n_nationkey", frequency_label(code).alias("periodicidad")).agg(
        F.count(F.lit(1)).alias("clientes")
    )


@query(
    "json_variant_rows",
    """SELECT CAST(o_orderkey AS BIGINT) AS entidad, o_totalprice AS deuda,
      CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS prioridad,
      CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS BIGINT) END AS cliente,
      CASE WHEN (o_orderkey // 100) % 2 = 0 THEN 'lista' ELSE 'objeto' END AS __periodo FROM orders""",
)
def json_variant_rows(spark, sf_dir):
    """Fields that some rows nest, from one parse and one scan; other responses are malformed."""
    orders = views.table(spark, sf_dir, "orders")
    nested = F.struct(F.col("o_orderpriority").alias("prioridad"), F.struct(F.col("o_custkey").alias("id")).alias("cliente"))
    row = F.struct(
        F.col("o_orderkey").alias("entidad"),
        F.col("o_totalprice").alias("deuda"),
        F.when(F.col("o_orderkey") % 3 == 0, nested).alias("detalle"),
    )
    pages = _pages(orders, "o_orderkey", row)
    listed = F.col("page") % 2 == 0
    whole = F.when(listed, F.to_json("rows")).otherwise(F.concat(F.lit('{"Data":'), F.to_json("rows"), F.lit("}")))
    kind = F.when(listed, "lista").otherwise("objeto").alias("periodo_solicitado")
    cut = F.concat(F.lit('[{"entidad": 1, "deuda"'), F.col("page").cast("string"))
    landed = pages.select(F.explode(F.array(whole, cut, F.lit("[7]"))).alias("body"), kind)
    fields = {
        "entidad": ("$.entidad", "bigint"),
        "deuda": ("$.deuda", "double"),
        "prioridad": ("$.detalle.prioridad", "string"),
        "cliente": ("$.detalle.cliente.id", "bigint"),
    }
    return variant_columns(loan_variants(landed), fields).drop("fila")
