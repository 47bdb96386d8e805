"""Gold queries: facts, ratios, macro enrichment, upsert, alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.operators import alerts, facts, macro, merge
from sparklake.plans import procedures
from sparklake.queries import views
from sparklake.queries.registry import query
from sparklake.schemas import GOLD_COLUMNS, GOLD_KEY

_KPI_COLUMNS = [c for c in GOLD_COLUMNS if c not in {"INFLACION", "TC_VENTA", "TC_COMPRA"}]
_ALERT_FROM = dt.date(1998, 1, 1)
_UPSERT_FROM = dt.date(2000, 1, 1)
_CALCULATED = dt.date(2024, 1, 31)


def _kpi(spark, sf_dir: str, since=None) -> DataFrame:
    rows = facts.usable_rows(views.silver(spark, sf_dir), since)
    return facts.with_ratios(facts.monthly_facts(rows, views.MEASURE_SCALES))


def _rates(spark, sf_dir: str) -> DataFrame:
    """Arrears rate per month and province: only the columns an alert needs."""
    rows = views.loans(spark, sf_dir, "periodo_date", "provincia", "entidad", "deudaCapital", "deudaVencida")
    return rows.groupBy("periodo_date", F.col("provincia").alias("PROVINCIA")).agg(
        F.year("periodo_date").cast("bigint").alias("ANIO"),
        F.month("periodo_date").cast("bigint").alias("MES"),
        F.count_distinct("entidad").cast("double").alias("ENTIDAD"),
        (F.round(F.sum("deudaVencida"), 2) / F.round(F.sum("deudaCapital"), 2)).alias("TASA_MORA"),
    )


@query(
    "kpi_by_province_month",
    f"WITH {views.LOANS_SQL}, {views.FACTS_SQL} SELECT {', '.join(_KPI_COLUMNS)} FROM kpi",
)
def kpi_by_province_month(spark, sf_dir):
    return _kpi(spark, sf_dir).select(*_KPI_COLUMNS)


@query("gold_with_macro", f"WITH {views.GOLD_SQL} SELECT {', '.join(GOLD_COLUMNS)} FROM gold")
def gold_with_macro(spark, sf_dir):
    series = views.macro_standin(spark, sf_dir)
    inflation = macro.monthly_mean(series, since=views.MACRO_SINCE, scale=2)
    exchange = macro.monthly_rates(series, since=views.MACRO_SINCE, scale=2, names=views.MACRO_KINDS)
    return facts.gold_rows(views.silver(spark, sf_dir), inflation, exchange, scales=views.MEASURE_SCALES)


@query(
    "lookback_gold",
    f"""WITH {views.LOANS_SQL}, {views.FACTS_SQL}
    SELECT {', '.join(_KPI_COLUMNS)} FROM kpi WHERE periodo_date >= (
      SELECT CAST(max(date_trunc('month', o_orderdate)) - INTERVAL 2 MONTH AS DATE) FROM orders)""",
)
def lookback_gold(spark, sf_dir):
    """The months gold would recompute: two before its newest one, as a scalar subquery."""
    loaded = views.table(spark, sf_dir, "orders").select(
        F.to_date(F.trunc("o_orderdate", "MM")).alias("periodo_date")
    )
    return _kpi(spark, sf_dir, facts.lookback_start(loaded, 2, "2012-01-01")).select(*_KPI_COLUMNS)


@query(
    "gold_upsert",
    f"""WITH {views.LOANS_SQL}, {views.FACTS_SQL}
    SELECT periodo_date, PROVINCIA,
      CASE WHEN periodo_date >= DATE '{_UPSERT_FROM}' THEN DEUDACAPITAL ELSE -1 END AS DEUDACAPITAL,
      TASA_MORA, periodo_date >= DATE '{_UPSERT_FROM}' AS actualizado
    FROM kpi""",
)
def gold_upsert(spark, sf_dir):
    """Months from 2000 on come from the source, older ones stay as the target has them."""
    rows = _rates_with_capital(spark, sf_dir).select(*GOLD_KEY, "DEUDACAPITAL", "TASA_MORA")
    target = rows.withColumns({"DEUDACAPITAL": F.lit(-1.0), "actualizado": F.lit(False)})
    source = rows.where(F.col("periodo_date") >= F.lit(_UPSERT_FROM)).withColumn("actualizado", F.lit(True))
    return merge.upserted(target, source, GOLD_KEY)


_ALERTS_SQL = """alerts AS (
  SELECT PROVINCIA AS provincia, ANIO AS anio, MES AS mes, avg(TASA_MORA) AS tasa_mora_promedio,
    lag(avg(TASA_MORA)) OVER (PARTITION BY PROVINCIA ORDER BY ANIO, MES) AS previa,
    count(DISTINCT ENTIDAD) AS entidades_afectadas, CAST(max(ENTIDAD) AS BIGINT) AS entidades_total
  FROM kpi {where} GROUP BY 1, 2, 3
), judged AS (
  SELECT provincia, anio, mes, tasa_mora_promedio,
    CASE WHEN tasa_mora_promedio > previa THEN 'SUBIENDO'
         WHEN tasa_mora_promedio < previa THEN 'BAJANDO' ELSE 'ESTABLE' END AS tendencia_mora,
    CASE WHEN tasa_mora_promedio > 0.15 THEN 'ALTO'
         WHEN tasa_mora_promedio > 0.08 THEN 'MEDIO' ELSE 'BAJO' END AS nivel_alerta,
    entidades_afectadas, DATE '2024-01-31' AS fecha_calculo, entidades_total
  FROM alerts
)"""


def _alerts_sql(where: str, then: str = "") -> str:
    return f"WITH {views.LOANS_SQL}, {views.FACTS_SQL}, {_ALERTS_SQL.format(where=where)} SELECT * FROM judged {then}"


@query("alert_trend", _alerts_sql(""))
def alert_trend(spark, sf_dir):
    return alerts.alert_rows(_rates(spark, sf_dir), calculated_on=F.lit(_CALCULATED))


@query(
    "alert_levels",
    f"""WITH {views.LOANS_SQL}, {views.FACTS_SQL}, {_ALERTS_SQL.format(where='')}
    SELECT nivel_alerta, tendencia_mora, count(*) AS meses FROM judged GROUP BY 1, 2""",
)
def alert_levels(spark, sf_dir):
    rows = alerts.alert_rows(_rates(spark, sf_dir), calculated_on=F.lit(_CALCULATED))
    return rows.groupBy("nivel_alerta", "tendencia_mora").agg(F.count(F.lit(1)).alias("meses"))


@query("alert_range_parity", _alerts_sql(f"WHERE periodo_date >= DATE '{_ALERT_FROM}'"))
def alert_range_parity(spark, sf_dir):
    """Alerts of a range whose first month has no month to compare with."""
    return alerts.alert_rows(_rates(spark, sf_dir), _ALERT_FROM, False, F.lit(_CALCULATED))


@query("alert_range_warm", _alerts_sql("", f"WHERE make_date(anio, mes, 1) >= DATE '{_ALERT_FROM}'"))
def alert_range_warm(spark, sf_dir):
    """The same range; the month before it is read for the first trend."""
    return alerts.alert_rows(_rates(spark, sf_dir), _ALERT_FROM, True, F.lit(_CALCULATED))


@query(
    "alerts_since_sql",
    f"""WITH {views.LOANS_SQL}, {views.FACTS_SQL}, {_ALERTS_SQL.format(where='')}
    SELECT r_name AS region, anio, nivel_alerta, count(*) AS alertas FROM judged
    JOIN nation ON n_name = provincia JOIN region ON r_regionkey = n_regionkey
    WHERE make_date(anio, mes, 1) >= DATE '{_ALERT_FROM}' GROUP BY 1, 2, 3""",
)
def alerts_since_sql(spark, sf_dir):
    """Alerts as a procedure that a statement joins with other tables."""
    procedures.define_alerts(spark, _rates(spark, sf_dir))
    return spark.sql(
        f"""SELECT r_name AS region, anio, nivel_alerta, count(*) AS alertas FROM alerts_since(DATE '{_ALERT_FROM}')
        JOIN parquet.`{sf_dir}/nation.parquet` ON n_name = provincia
        JOIN parquet.`{sf_dir}/region.parquet` ON r_regionkey = n_regionkey GROUP BY ALL"""
    )


@query(
    "alert_replace_range",
    f"""WITH {views.LOANS_SQL}, {views.FACTS_SQL}, {_ALERTS_SQL.format(where='')}
    SELECT provincia, anio, mes, nivel_alerta, 'anterior' AS origen FROM judged
    WHERE make_date(anio, mes, 1) < DATE '{_ALERT_FROM}'
    UNION ALL
    SELECT provincia, anio, mes, nivel_alerta, 'nuevo' AS origen FROM judged
    WHERE make_date(anio, mes, 1) >= DATE '{_ALERT_FROM}'""",
)
def alert_replace_range(spark, sf_dir):
    columns = ["provincia", "anio", "mes", "nivel_alerta"]
    rates = _rates(spark, sf_dir)
    old = alerts.alert_rows(rates).select(*columns, F.lit("anterior").alias("origen"))
    new = alerts.alert_rows(rates, _ALERT_FROM).select(*columns, F.lit("nuevo").alias("origen"))
    row_month = F.make_date(F.col("anio").cast("int"), F.col("mes").cast("int"), F.lit(1))
    return merge.range_replaced(old, new, row_month, _ALERT_FROM)


@query(
    "adhoc_entity_sum",
    f"""WITH {views.LOANS_SQL}
    SELECT entidad, provincia, round(sum(deudaCapital), 2) AS deuda_capital FROM loans
    WHERE entidad = 'Supplier#000000007' GROUP BY 1, 2""",
)
def adhoc_entity_sum(spark, sf_dir):
    rows = views.loans(spark, sf_dir, "entidad", "provincia", "deudaCapital")
    return (
        rows.where(F.col("entidad") == "Supplier#000000007")
        .groupBy("entidad", "provincia")
        .agg(F.round(F.sum("deudaCapital"), 2).alias("deuda_capital"))
    )


@query(
    "adhoc_range_in",
    f"""WITH {views.LOANS_SQL}, {views.FACTS_SQL}
    SELECT PROVINCIA, round(sum(DEUDACAPITAL), 2) AS deuda_capital,
           round(avg(TASA_MORA), 6) AS tasa_mora
    FROM kpi WHERE periodo_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
      AND PROVINCIA IN ('NATION_3', 'NATION_11') GROUP BY 1""",
)
def adhoc_range_in(spark, sf_dir):
    months = _rates_with_capital(spark, sf_dir).where(
        F.col("periodo_date").between("1997-01-01", "1997-12-31")
        & F.col("PROVINCIA").isin("NATION_3", "NATION_11")
    )
    return months.groupBy("PROVINCIA").agg(
        F.round(F.sum("DEUDACAPITAL"), 2).alias("deuda_capital"),
        F.round(F.avg("TASA_MORA"), 6).alias("tasa_mora"),
    )


def _rates_with_capital(spark, sf_dir: str) -> DataFrame:
    rows = views.loans(spark, sf_dir, "periodo_date", "provincia", "deudaCapital", "deudaVencida")
    sums = rows.groupBy("periodo_date", F.col("provincia").alias("PROVINCIA")).agg(
        F.round(F.sum("deudaCapital"), 2).alias("DEUDACAPITAL"),
        F.round(F.sum("deudaVencida"), 2).alias("_overdue"),
    )
    return sums.withColumn("TASA_MORA", F.when(F.col("DEUDACAPITAL") > 0, F.col("_overdue") / F.col("DEUDACAPITAL")).otherwise(0.0))
