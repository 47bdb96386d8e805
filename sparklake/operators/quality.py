"""Data-quality checks over silver and gold, each in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: tolerance, first month with macro data, and the message texts
DRIFT_TOLERANCE = 100
MACRO_SINCE = "2020-01-01"
ALERT_WORD = "ALERTA"
MESSAGES = {
    "periodos_invalidos": "ALERTA: {} registros con períodos inválidos en Silver. ",
    "importes_negativos": "ALERTA: {} registros con importes negativos en Silver. ",
    "diferencia_claves": "ALERTA: Diferencia significativa entre Silver y Gold: {} combinaciones. ",
    "sin_inflacion": "ALERTA: {} registros sin datos de inflación recientes. ",
}
ALL_PASSED = "Todas las validaciones de calidad pasaron exitosamente."


def composite_key(province: str, month: str) -> Column:
    """NULL where one part is NULL, so such a row is not counted."""
    return F.concat(F.col(province), F.lit("_"), F.date_format(month, "yyyy-MM"))


def _both(province: str, month: str) -> Column:
    return F.col(province).isNotNull() & F.col(month).isNotNull()


def silver_checks(silver: DataFrame) -> DataFrame:
    """Invalid periods, negative amounts and the number of province-month pairs."""
    # group first: the pairs are few, and the counts ride along
    grouped = silver.groupBy("provincia", F.trunc("periodo_date", "MM").alias("_month")).agg(
        F.count_if(F.col("flg_periodo_invalido") == 1).alias("_bad"),
        F.count_if(F.col("flg_importe_negativo") == 1).alias("_negative"),
    )
    return grouped.agg(
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("periodos_invalidos"),
        F.coalesce(F.sum("_negative"), F.lit(0)).alias("importes_negativos"),
        F.count_if(_both("provincia", "_month")).alias("claves_silver"),
    )


def gold_checks(gold: DataFrame, macro_since: str = MACRO_SINCE) -> DataFrame:
    """Number of province-month pairs, and rows without inflation since ``macro_since``."""
    recent = F.col("periodo_date") >= F.lit(macro_since).cast("date")
    missing = (F.col("INFLACION") == 0) | F.col("INFLACION").isNull()
    grouped = gold.groupBy("PROVINCIA", F.trunc("periodo_date", "MM").alias("_month")).agg(
        F.count_if(recent & missing).alias("_missing")
    )
    return grouped.agg(
        F.count_if(_both("PROVINCIA", "_month")).alias("claves_gold"),
        F.coalesce(F.sum("_missing"), F.lit(0)).alias("sin_inflacion"),
    )


def check_counts(silver: DataFrame, gold: DataFrame, macro_since: str = MACRO_SINCE) -> DataFrame:
    """All counts in one row; gold's are a scalar subquery beside silver's."""
    gold_counts = gold_checks(gold, macro_since)
    names = gold_counts.columns
    one_value = gold_counts.select(F.struct(*names).alias("_g")).scalar()
    both = silver_checks(silver).withColumn("_g", one_value).select("*", *[f"_g.{n}" for n in names]).drop("_g")
    return both.withColumn("diferencia_claves", F.abs(F.col("claves_gold") - F.col("claves_silver")))


def verdict(counts: DataFrame) -> DataFrame:
    """Message and status of a row of counts."""
    parts = []
    for name, text in MESSAGES.items():
        limit = DRIFT_TOLERANCE if name == "diferencia_claves" else 0
        head, tail = text.split("{}")
        message = F.concat(F.lit(head), F.col(name).cast("string"), F.lit(tail))
        parts.append(F.when(F.col(name) > limit, message).otherwise(F.lit("")))
    joined = F.concat(*parts)
    worded = counts.withColumn("message", F.when(F.length(joined) == 0, F.lit(ALL_PASSED)).otherwise(joined))
    return worded.withColumn(
        "status", F.when(F.col("message").rlike(ALERT_WORD), "WARNING").otherwise("SUCCESS")
    )


def span_profile(df: DataFrame, date_col: str, keys: list[str] | None = None) -> DataFrame:
    """Row count with the first and last date, overall or per key."""
    return df.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("filas"),
        F.min(date_col).alias("desde"),
        F.max(date_col).alias("hasta"),
    )


def null_profile(df: DataFrame, columns: list[str], flags: list[str]) -> DataFrame:
    """Row count, NULLs per column, and the share of rows with one of ``flags`` set."""
    flagged = F.greatest(*[F.col(f) for f in flags]) if len(flags) > 1 else F.col(flags[0])
    counts = [F.count_if(F.col(c).isNull()).alias(f"nulos_{c}") for c in columns]
    return df.agg(
        F.count(F.lit(1)).alias("filas"),
        *counts,
        F.sum(flagged).alias("filas_marcadas"),
        (F.sum(flagged) / F.count(F.lit(1))).alias("tasa_error"),
    )


def duplicate_profile(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, and the rows beyond the first of each."""
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("claves"),
        F.count_if(F.col("_n") > 1).alias("claves_repetidas"),
        F.sum(F.col("_n") - 1).alias("filas_sobrantes"),
    )


def range_violations(df: DataFrame, rules: dict[str, tuple[float, float]]) -> DataFrame:
    """Per column: values below and above its permitted range, in one pass."""
    aggs = []
    for name, (low, high) in rules.items():
        aggs += [
            F.count_if(F.col(name) < low).alias(f"{name}_bajo"),
            F.count_if(F.col(name) > high).alias(f"{name}_alto"),
        ]
    return df.agg(F.count(F.lit(1)).alias("filas"), *aggs)
