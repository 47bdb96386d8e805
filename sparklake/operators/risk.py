"""Metrics that the gold layer announces without a formula; the definitions are ours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparklake.functions.scalars import ratio_or_zero, stable_sum
from sparklake.operators.alerts import alert_level


def arrears_by(silver: DataFrame, keys: list[str], scale: int | None = None) -> DataFrame:
    """Capital, overdue capital and arrears rate per ``keys``."""
    sums = silver.groupBy(*keys).agg(
        stable_sum(F.coalesce("deudaCapital", F.lit(0)), scale).alias("deuda_capital"),
        stable_sum(F.coalesce("deudaVencida", F.lit(0)), scale).alias("deuda_vencida"),
    )
    return sums.withColumn("tasa_mora", ratio_or_zero(F.col("deuda_vencida"), F.col("deuda_capital")))


def concentration(silver: DataFrame, scale: int | None = None) -> DataFrame:
    """Per month: total capital, largest share, and the Herfindahl index over entities.

    Both follow from plain sums, so no month has to fit into one window partition.
    """
    by_entity = arrears_by(silver, ["periodo_date", "entidad"], scale)
    total = stable_sum(F.col("deuda_capital"), scale)
    squares = F.sum(F.col("deuda_capital") * F.col("deuda_capital"))
    return by_entity.groupBy("periodo_date").agg(
        total.alias("deuda_capital"),
        F.count(F.lit(1)).alias("entidades"),
        ratio_or_zero(F.max("deuda_capital"), total).alias("mayor_participacion"),
        ratio_or_zero(squares, total * total).alias("hhi"),
    )


def period_rollup(silver: DataFrame, scale: int | None = None) -> DataFrame:
    """Month, quarter, year and overall totals.

    Rows are reduced to months first; the rollup then expands months, not loans.
    """
    monthly = arrears_by(silver, ["periodo_date"], scale)
    parts = monthly.select(
        F.year("periodo_date").cast("bigint").alias("anio"),
        F.quarter("periodo_date").cast("bigint").alias("trimestre"),
        F.month("periodo_date").cast("bigint").alias("mes"),
        "deuda_capital",
        "deuda_vencida",
    )
    return parts.rollup("anio", "trimestre", "mes").agg(
        stable_sum(F.col("deuda_capital"), scale).alias("deuda_capital"),
        stable_sum(F.col("deuda_vencida"), scale).alias("deuda_vencida"),
    )


def _months_before(value: str, group: list[str], months: int) -> Column:
    """The value exactly ``months`` earlier in the calendar, NULL if that month is missing."""
    number = F.year("periodo_date") * 12 + F.month("periodo_date")
    window = W.partitionBy(*group).orderBy(number).rangeBetween(-months, -months)
    return F.max(value).over(window)


def evolution(facts: DataFrame, value: str, group: list[str]) -> DataFrame:
    """Change against one and twelve months before; one row per ``group`` and month in."""
    out = facts.withColumns(
        {
            "mes_anterior": _months_before(value, group, 1),
            "anio_anterior": _months_before(value, group, 12),
        }
    )
    change = {
        name: F.when(F.col(base) > 0, F.col(value) / F.col(base) - 1)
        for name, base in [("variacion_mensual", "mes_anterior"), ("variacion_anual", "anio_anterior")]
    }
    return out.withColumns(change)


def moving_statistics(monthly: DataFrame, value: str, months: int = 12) -> DataFrame:
    """Mean and sample deviation over the last ``months`` calendar months.

    Every month is sent to the ``months`` months it counts for and those are grouped; a
    window without a partition key would put the whole series into one task.
    """
    reach = F.sequence("periodo_date", F.add_months("periodo_date", months - 1), F.expr("interval 1 month"))
    spread = monthly.select(F.explode(reach).alias("periodo_date"), F.col(value).alias("_v"),
                            (F.col("periodo_date")).alias("_origin"))
    stats = spread.groupBy("periodo_date").agg(
        F.avg("_v").alias("media_movil"),
        F.stddev_samp("_v").alias("volatilidad"),
        F.count("_v").alias("meses"),
        F.max(F.when(F.col("_origin") == F.col("periodo_date"), F.col("_v"))).alias(value),
        F.max(F.col("_origin") == F.col("periodo_date")).alias("_observed"),
    )
    return stats.where("_observed").drop("_observed")


def macro_correlation(facts: DataFrame, rate: str, macro: list[str], group: str) -> DataFrame:
    """Pearson correlation of ``rate`` with every macro column, per ``group``."""
    return facts.groupBy(group).agg(
        F.count(F.lit(1)).alias("meses"), *[F.corr(rate, m).alias(f"corr_{m.lower()}") for m in macro]
    )


def dashboard_alerts(gold: DataFrame) -> DataFrame:
    """Rate, monthly change, rank among the provinces of the month, and risk class.

    Windows run over gold: months of a province, provinces of a month.
    """
    by_province = W.partitionBy("PROVINCIA").orderBy("periodo_date")
    by_month = W.partitionBy("periodo_date").orderBy("TASA_MORA")
    return gold.select(
        "PROVINCIA",
        "ANIO",
        "MES",
        "periodo_date",
        F.col("TASA_MORA").alias("tasa_mora"),
        (F.col("TASA_MORA") - F.lag("TASA_MORA").over(by_province)).alias("variacion_mensual"),
        F.percent_rank().over(by_month).alias("percentil_nacional"),
        alert_level(F.col("TASA_MORA")).alias("clasificacion_riesgo"),
    )
