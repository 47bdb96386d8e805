"""Monthly facts and ratios of the portfolio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklake.functions.scalars import ratio_or_zero, stable_sum
from sparklake.schemas import FACT_DIMENSIONS, FACT_SUMS, GOLD_COLUMNS


def usable_rows(silver: DataFrame, since: Column | str | None = None) -> DataFrame:
    """Rows that may enter gold; ``since`` limits them to months from that date on."""
    rows = silver.where(
        (F.col("flg_periodo_invalido") == 0)
        & F.col("provincia").isNotNull()
        & F.col("periodo_date").isNotNull()
    )
    if since is None:
        return rows
    start = F.lit(since).cast("date") if isinstance(since, str) else since
    return rows.where(F.col("periodo_date") >= start)


def summed_measures(scales: dict[str, int] | None = None) -> list[Column]:
    scales = scales or {}
    return [
        stable_sum(F.coalesce(F.col(s), F.lit(0)), scales.get(s)).alias(g) for s, g in FACT_SUMS
    ]


def distinct_counts() -> list[Column]:
    return [F.count_distinct(c).cast("double").alias(c.upper()) for c in FACT_DIMENSIONS]


def monthly_facts(silver: DataFrame, scales: dict[str, int] | None = None) -> DataFrame:
    """Eight sums and six distinct counts per month and province.

    Distinct counts go through Spark's expand-and-aggregate plan: every dimension value is
    deduplicated before the shuffle, so neither a hot group nor a dimension with many
    values has to fit into one task, as it would with a set per group.
    """
    grouped = silver.groupBy("periodo_date", F.col("provincia").alias("PROVINCIA")).agg(
        *summed_measures(scales), *distinct_counts()
    )
    return grouped.withColumns(
        {
            "ANIO": F.year("periodo_date").cast("bigint"),
            "MES": F.month("periodo_date").cast("bigint"),
            "PD_AGREGADA": F.lit(1).cast("bigint"),
        }
    )


def with_ratios(facts: DataFrame) -> DataFrame:
    """Arrears, collateral and provision over outstanding capital; 0 without capital."""
    capital = F.col("DEUDACAPITAL")
    return facts.withColumns(
        {
            "TASA_MORA": ratio_or_zero(F.col("DEUDAVENCIDA"), capital),
            "COBERTURA_GARANTIA": ratio_or_zero(F.col("VALORGARANTIA"), capital),
            "PROPORCION_PROVISIONADA": ratio_or_zero(
                F.col("VALORPROVISIONCAPITALYRENDIMIENTO"), capital
            ),
        }
    )


def gold_rows(
    silver: DataFrame,
    inflation: DataFrame,
    exchange: DataFrame,
    since: Column | str | None = None,
    scales: dict[str, int] | None = None,
) -> DataFrame:
    """The 25 gold columns: facts, ratios and the month's macro values (0 where missing)."""
    return enriched(silver.transform(usable_rows, since).transform(monthly_facts, scales), inflation, exchange)


def enriched(facts: DataFrame, inflation: DataFrame, exchange: DataFrame) -> DataFrame:
    """Gold's columns, from monthly facts however they were counted."""
    return attach_macro(facts.transform(with_ratios), inflation, exchange).select(*GOLD_COLUMNS)


def attach_macro(facts: DataFrame, inflation: DataFrame, exchange: DataFrame) -> DataFrame:
    """Left joins on the month. The join strategy follows measured sizes (AQE)."""
    joined = facts.join(inflation, "periodo_date", "left").join(exchange, "periodo_date", "left")
    return joined.withColumns(
        {
            "INFLACION": F.coalesce("inflacion", F.lit(0.0)),
            "TC_VENTA": F.coalesce("tc_venta", F.lit(0.0)),
            "TC_COMPRA": F.coalesce("tc_compra", F.lit(0.0)),
        }
    )


def lookback_start(gold: DataFrame, months: int, default: str) -> Column:
    """Scalar subquery: ``months`` before gold's newest month, or ``default``."""
    newest = gold.agg(
        F.coalesce(F.add_months(F.max("periodo_date"), -months), F.lit(default).cast("date")).alias("_s")
    )
    return newest.scalar()
