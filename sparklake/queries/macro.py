"""Macro queries: monthly means, rates by kind, shape adapters, derived columns."""

from __future__ import annotations


from pyspark.sql import functions as F

from sparklake.functions.periods import epoch_ms_text
from sparklake.functions.scalars import frequency_label
from sparklake.operators import macro
from sparklake.operators.risk import moving_statistics
from sparklake.queries import views
from sparklake.queries.registry import query
from sparklake.sources.payloads import derived_rates


@query(
    "monthly_avg",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo_date,
      round(sum(o_totalprice), 2) / count(o_totalprice) AS inflacion FROM orders GROUP BY 1""",
)
def monthly_avg(spark, sf_dir):
    return macro.monthly_mean(views.macro_standin(spark, sf_dir), scale=2)


@query(
    "macro_lookback",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo_date,
      round(sum(o_totalprice), 2) / count(o_totalprice) AS inflacion FROM orders
    WHERE o_orderdate >= make_date(1999, 6, 1) - INTERVAL 1 MONTH GROUP BY 1""",
)
def macro_lookback(spark, sf_dir):
    """Mean per month from one month before the first month that is processed."""
    start = F.add_months(F.make_date(F.lit(1999), F.lit(6), F.lit(1)), -1)
    return macro.monthly_mean(views.macro_standin(spark, sf_dir), since=start, scale=2)


@query(
    "fx_conditional_avg",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo_date,
      round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2)
        / nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS tc_venta,
      round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2)
        / nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS tc_compra
    FROM orders GROUP BY 1""",
)
def fx_conditional_avg(spark, sf_dir):
    return macro.monthly_rates(views.macro_standin(spark, sf_dir), scale=2, names=views.MACRO_KINDS)


@query(
    "fx_daily_kinds",
    """SELECT CAST(ts AS DATE) AS fecha,
      round(sum(value) FILTER (event_type = 'purchase'), 2)
        / nullif(count(*) FILTER (event_type = 'purchase'), 0) AS venta,
      round(sum(value) FILTER (event_type = 'view'), 2)
        / nullif(count(*) FILTER (event_type = 'view'), 0) AS compra
    FROM events GROUP BY 1""",
)
def fx_daily_kinds(spark, sf_dir):
    """The same conditional means per day, as a pivot over the two kinds."""
    events = views.table(spark, sf_dir, "events")
    pivoted = (
        events.where(F.col("event_type").isin("purchase", "view"))
        .groupBy(F.to_date("ts").alias("fecha"))
        .pivot("event_type", ["purchase", "view"])
        .agg((F.round(F.sum("value"), 2) / F.count("value")).alias("m"))
    )
    days = events.select(F.to_date("ts").alias("fecha")).distinct()
    means = pivoted.select("fecha", F.col("purchase").alias("venta"), F.col("view").alias("compra"))
    return days.join(means, "fecha", "left")


@query(
    "fx_wide_to_long",
    """WITH wide AS (
      SELECT strftime(o_orderdate, '%Y-%m-%d') AS fecha, o_orderkey,
             CAST(o_totalprice AS VARCHAR) AS tc_venta, CAST(o_custkey AS VARCHAR) AS tc_compra FROM orders)
    SELECT fecha, o_orderkey, tc_venta AS tasa_cambio, 'VENTA' AS tipo_cambio FROM wide
    UNION ALL SELECT fecha, o_orderkey, tc_compra, 'COMPRA' FROM wide""",
)
def fx_wide_to_long(spark, sf_dir):
    wide = views.table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"),
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("tc_venta"),
        F.col("o_custkey").cast("string").alias("tc_compra"),
    )
    return macro.wide_to_long(wide, "fecha", ("o_orderkey",))


@query(
    "macro_canonical",
    """SELECT strftime(o_orderdate, '%Y-%m') AS fecha, o_orderstatus AS pais,
      CAST(o_totalprice AS VARCHAR) AS inflacion_anual, CAST(NULL AS VARCHAR) AS indice_base FROM orders""",
)
def macro_canonical(spark, sf_dir):
    """Extracted column names to the canonical ones; what is missing becomes NULL."""
    extracted = views.table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("Fecha"),
        F.col("o_totalprice").cast("string").alias("inflacion"),
        F.col("o_orderstatus").alias("pais"),
    )
    return macro.canonical_macro(extracted, "inflacion_12m")


@query(
    "derived_rate_year",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS anio, o_totalprice AS tc_venta,
      o_totalprice * 0.995 AS tc_compra, CAST(1 AS BIGINT) AS pd_agregada FROM orders""",
)
def derived_rate_year(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").cast("bigint").alias("anio"),
        F.col("o_totalprice").alias("tc_venta"),
        F.lit(1).cast("bigint").alias("pd_agregada"),
    )
    return derived_rates(rows)


@query(
    "epoch_to_month_text",
    """SELECT event_id, strftime(ts, '%Y-%m') AS mes, strftime(ts, '%Y-%m-%d') AS dia FROM events
    WHERE event_type <> 'error'""",
)
def epoch_to_month_text(spark, sf_dir):
    """Milliseconds as text to a month and a day; text that is no number is dropped."""
    events = views.table(spark, sf_dir, "events")
    ms = F.when(F.col("event_type") == "error", F.lit("sin dato")).otherwise(
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    )
    texts = events.select("event_id", ms.alias("ms")).select(
        "event_id",
        epoch_ms_text(F.col("ms"), "yyyy-MM").alias("mes"),
        epoch_ms_text(F.col("ms"), "yyyy-MM-dd").alias("dia"),
    )
    return texts.na.drop()


@query(
    "label_map",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'Anual' WHEN 'O' THEN 'Mensual' ELSE 'Desconocido' END AS periodicidad,
      o_orderpriority, count(*) AS filas FROM orders GROUP BY 1, 2""",
)
def label_map(spark, sf_dir):
    """Frequency codes to names; a code without a name becomes unknown."""
    code = F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "M").otherwise(
        F.col("o_orderstatus")
    )
    rows = views.table(spark, sf_dir, "orders").select(frequency_label(code).alias("periodicidad"), "o_orderpriority")
    return rows.groupBy("periodicidad", "o_orderpriority").agg(F.count(F.lit(1)).alias("filas"))


@query(
    "fx_volatility",
    f"""WITH m AS (
      SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo_date,
        round(sum(o_totalprice), 2) / count(*) AS inflacion FROM orders GROUP BY 1)
    SELECT a.periodo_date, any_value(a.inflacion) AS inflacion, round(avg(b.inflacion), 2) AS media_movil,
      round(stddev_samp(b.inflacion), 2) AS volatilidad, count(*) AS meses
    FROM m a JOIN m b ON b.periodo_date BETWEEN a.periodo_date - INTERVAL 11 MONTH AND a.periodo_date
    GROUP BY 1""",
)
def fx_volatility(spark, sf_dir):
    monthly = macro.monthly_mean(views.macro_standin(spark, sf_dir), scale=2)
    stats = moving_statistics(monthly, "inflacion")
    return stats.withColumns(
        {"media_movil": F.round("media_movil", 2), "volatilidad": F.round("volatilidad", 2)}
    )
