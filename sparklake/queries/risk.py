"""Queries over the metrics that the gold layer announces without a formula."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparklake.operators import facts, macro, risk
from sparklake.queries import views
from sparklake.queries.gold import _kpi, _rates, _rates_with_capital
from sparklake.queries.registry import query
from sparklake.schemas import GOLD_COLUMNS

_KPI = f"WITH {views.LOANS_SQL}, {views.FACTS_SQL}"


@query(
    "mora_by_entity",
    f"""WITH {views.LOANS_SQL}, s AS (
      SELECT entidad, periodo_date, round(sum(COALESCE(deudaCapital, 0)), 2) AS deuda_capital,
        round(sum(COALESCE(deudaVencida, 0)), 2) AS deuda_vencida FROM loans GROUP BY 1, 2)
    SELECT *, CASE WHEN deuda_capital > 0 THEN deuda_vencida / deuda_capital ELSE 0 END AS tasa_mora FROM s""",
)
def mora_by_entity(spark, sf_dir):
    rows = views.loans(spark, sf_dir, "entidad", "periodo_date", "deudaCapital", "deudaVencida")
    return risk.arrears_by(rows, ["entidad", "periodo_date"], 2)


@query(
    "concentration_hhi",
    f"""WITH {views.LOANS_SQL}, e AS (
      SELECT periodo_date, entidad, round(sum(deudaCapital), 2) AS c FROM loans GROUP BY 1, 2)
    SELECT periodo_date, round(sum(c), 2) AS deuda_capital, count(*) AS entidades,
      max(c) / round(sum(c), 2) AS mayor_participacion,
      round(sum(c * c) / (round(sum(c), 2) * round(sum(c), 2)), 8) AS hhi FROM e GROUP BY 1""",
)
def concentration_hhi(spark, sf_dir):
    rows = views.loans(spark, sf_dir, "entidad", "periodo_date", "deudaCapital", "deudaVencida")
    return risk.concentration(rows, 2).withColumn("hhi", F.round("hhi", 8))


@query(
    "rollup_periods",
    f"""WITH {views.LOANS_SQL} SELECT CAST(year(periodo_date) AS BIGINT) AS anio, CAST(quarter(periodo_date) AS BIGINT) AS trimestre,
      CAST(month(periodo_date) AS BIGINT) AS mes, round(sum(deudaCapital), 2) AS deuda_capital,
      round(sum(deudaVencida), 2) AS deuda_vencida FROM loans GROUP BY ROLLUP (1, 2, 3)""",
)
def rollup_periods(spark, sf_dir):
    return risk.period_rollup(views.loans(spark, sf_dir, "periodo_date", "deudaCapital", "deudaVencida"), 2)


@query(
    "evolution_yoy",
    f"""{_KPI}, k AS (SELECT periodo_date, PROVINCIA, DEUDACAPITAL, year(periodo_date) * 12 + month(periodo_date) AS n FROM kpi)
    SELECT a.periodo_date, a.PROVINCIA, a.DEUDACAPITAL, m.DEUDACAPITAL AS mes_anterior, y.DEUDACAPITAL AS anio_anterior,
      CASE WHEN m.DEUDACAPITAL > 0 THEN a.DEUDACAPITAL / m.DEUDACAPITAL - 1 END AS variacion_mensual,
      CASE WHEN y.DEUDACAPITAL > 0 THEN a.DEUDACAPITAL / y.DEUDACAPITAL - 1 END AS variacion_anual
    FROM k a LEFT JOIN k m ON a.PROVINCIA = m.PROVINCIA AND m.n = a.n - 1
    LEFT JOIN k y ON a.PROVINCIA = y.PROVINCIA AND y.n = a.n - 12""",
)
def evolution_yoy(spark, sf_dir):
    monthly = _rates_with_capital(spark, sf_dir).select("periodo_date", "PROVINCIA", "DEUDACAPITAL")
    return risk.evolution(monthly, "DEUDACAPITAL", ["PROVINCIA"])


@query(
    "macro_corr",
    f"""WITH {views.GOLD_SQL} SELECT PROVINCIA, count(*) AS meses, round(corr(TASA_MORA, INFLACION), 6) AS corr_inflacion,
      round(corr(TASA_MORA, TC_VENTA), 6) AS corr_tc_venta FROM gold WHERE periodo_date >= DATE '{views.MACRO_SINCE}' GROUP BY 1""",
)
def macro_corr(spark, sf_dir):
    series = views.macro_standin(spark, sf_dir)
    inflation = macro.monthly_mean(series, since=views.MACRO_SINCE, scale=2)
    exchange = macro.monthly_rates(series, since=views.MACRO_SINCE, scale=2, names=views.MACRO_KINDS)
    rates = _rates(spark, sf_dir).where(F.col("periodo_date") >= F.lit(views.MACRO_SINCE).cast("date"))
    joined = facts.attach_macro(rates, inflation, exchange)
    out = risk.macro_correlation(joined, "TASA_MORA", ["INFLACION", "TC_VENTA"], "PROVINCIA")
    return out.withColumns({c: F.round(c, 6) for c in ("corr_inflacion", "corr_tc_venta")})


@query(
    "risk_percentile",
    f"""{_KPI} SELECT PROVINCIA, ANIO, MES, periodo_date, TASA_MORA AS tasa_mora,
      TASA_MORA - lag(TASA_MORA) OVER (PARTITION BY PROVINCIA ORDER BY periodo_date) AS variacion_mensual,
      percent_rank() OVER (PARTITION BY periodo_date ORDER BY TASA_MORA) AS percentil_nacional,
      CASE WHEN TASA_MORA > 0.15 THEN 'ALTO' WHEN TASA_MORA > 0.08 THEN 'MEDIO' ELSE 'BAJO' END AS clasificacion_riesgo
    FROM kpi""",
)
def risk_percentile(spark, sf_dir):
    return risk.dashboard_alerts(_rates(spark, sf_dir))


_KPI_COLUMNS = [c for c in GOLD_COLUMNS if c not in {"INFLACION", "TC_VENTA", "TC_COMPRA"}]


@query(
    "gold_for_range",
    f"""{_KPI} SELECT {', '.join(_KPI_COLUMNS)} FROM kpi
    WHERE periodo_date BETWEEN DATE '1997-03-01' AND DATE '1997-08-01'""",
)
def gold_for_range(spark, sf_dir):
    """Gold rows of an explicit range of months; the range reaches the scan of orders."""
    rows = _kpi(spark, sf_dir, "1997-03-01").where(F.col("periodo_date") <= F.lit("1997-08-01").cast("date"))
    return rows.select(*_KPI_COLUMNS)
