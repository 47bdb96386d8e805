"""Arrears alerts per province and month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# fixed values: thresholds and labels of the alert level and the trend
HIGH_ABOVE, MEDIUM_ABOVE = 0.15, 0.08
HIGH, MEDIUM, LOW = "ALTO", "MEDIO", "BAJO"
RISING, FALLING, STABLE = "SUBIENDO", "BAJANDO", "ESTABLE"


def alert_level(rate: Column) -> Column:
    return F.when(rate > HIGH_ABOVE, HIGH).when(rate > MEDIUM_ABOVE, MEDIUM).otherwise(LOW)


def trend(rate: Column, previous: Column) -> Column:
    """Stable also where there is no previous month to compare with."""
    return F.when(rate > previous, RISING).when(rate < previous, FALLING).otherwise(STABLE)


def with_trend(df: DataFrame, rate: str, province: str, order: list[str]) -> DataFrame:
    """Compare with the province's previous month.

    The frame holds one row per province and month, so a window partition is as long as
    the calendar, whatever the size of the portfolio.
    """
    window = W.partitionBy(province).orderBy(*order)
    return df.withColumn("tendencia_mora", trend(F.col(rate), F.lag(rate).over(window)))


def alert_rows(
    gold: DataFrame,
    min_date: dt.date | Column | None = None,
    warm_up: bool = True,
    calculated_on: Column | None = None,
) -> DataFrame:
    """Alerts of the months from ``min_date`` on.

    With ``warm_up`` earlier months are read too, so that the first month of the range has
    a trend even where the month before it is missing; gold holds one row per province and
    month, which keeps that cheap. Without it the first month of every range is stable.
    """
    start = None if min_date is None else F.lit(min_date).cast("date")
    rows = gold if start is None or warm_up else gold.where(F.col("periodo_date") >= start)
    # one shuffle by province serves the grouping, the distinct count and the window; a
    # province has as many rows here as the calendar has months
    monthly = rows.repartition("PROVINCIA").groupBy(
        F.col("PROVINCIA").alias("provincia"), F.col("ANIO").alias("anio"), F.col("MES").alias("mes")
    ).agg(
        F.avg("TASA_MORA").alias("tasa_mora_promedio"),
        F.count_distinct("ENTIDAD").alias("entidades_afectadas"),
        F.max("ENTIDAD").cast("bigint").alias("entidades_total"),
    )
    judged = with_trend(monthly, "tasa_mora_promedio", "provincia", ["anio", "mes"])
    if start is not None:
        judged = judged.where(F.make_date(F.col("anio").cast("int"), F.col("mes").cast("int"), F.lit(1)) >= start)
    return judged.select(
        "provincia",
        "anio",
        "mes",
        "tasa_mora_promedio",
        "tendencia_mora",
        alert_level(F.col("tasa_mora_promedio")).alias("nivel_alerta"),
        "entidades_afectadas",
        (F.current_date() if calculated_on is None else calculated_on).alias("fecha_calculo"),
        "entidades_total",
    )
