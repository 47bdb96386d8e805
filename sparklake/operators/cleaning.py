"""Raw or bronze loan rows to typed, flagged silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklake.functions import periods
from sparklake.functions.scalars import clean_text, strip_lenient, strip_strict, to_double, to_int_truncated, to_long
from sparklake.schemas import (
    LOAN_DOUBLES,
    LOAN_INTEGERS,
    LOAN_TEXT,
    REQUESTED_PERIOD,
    SILVER_AMOUNTS,
    SILVER_COLUMNS,
    SILVER_TEXT,
)

MONEY = {"cast": None, "strict": strip_strict, "lenient": strip_lenient}


def bronze_columns(df: DataFrame) -> DataFrame:
    """Landing text to the bronze types, with calendar columns; lineage stays.

    One ``select``: trimmed text, tolerant numbers, and the month of ``periodo``.
    """
    month = periods.parse_period(clean_text(F.col("periodo")))
    cols = [clean_text(F.col(c)).alias(c) for c in LOAN_TEXT]
    cols += [to_int_truncated(F.col(c)).alias(c) for c in LOAN_INTEGERS]
    cols += [to_double(F.col(c)).alias(c) for c in LOAN_DOUBLES]
    known = {*LOAN_TEXT, *LOAN_INTEGERS, *LOAN_DOUBLES, REQUESTED_PERIOD}
    lineage = [c for c in df.columns if c not in known]
    return df.select(
        *cols,
        REQUESTED_PERIOD,
        month.alias("periodo_date"),
        F.year(month).alias("anio"),
        F.month(month).alias("mes"),
        *lineage,
    )


def with_quality_flags(df: DataFrame) -> DataFrame:
    """1 for a row without a usable month, and 1 for a row with a negative amount."""
    no_month = F.col("periodo_date").isNull() | F.col("periodo").isNull() | (F.col("periodo") == "")
    negative = (F.col("deudaCapital") < 0) | (F.col("deudaVencida") < 0) | (F.col("deuda") < 0)
    return df.withColumns(
        {
            "flg_periodo_invalido": F.when(no_month, 1).otherwise(0).cast("bigint"),
            "flg_importe_negativo": F.when(negative, 1).otherwise(0).cast("bigint"),
        }
    )


def silver_rows(
    df: DataFrame,
    money: str = "cast",
    formats: tuple[str, ...] = periods.ONE_FORMAT,
) -> DataFrame:
    """The 25 silver columns from loan rows that carry ``dt_captura``.

    ``money``: ``cast`` for clean numbers, ``strict`` to drop ``,`` and ``$`` (NULL stays
    NULL), ``lenient`` to drop everything but digits, dot and minus (NULL becomes 0).
    """
    is_text = {f.name: isinstance(f.dataType, T.StringType) for f in df.schema}
    strip = MONEY[money]
    # stripped in a step of its own, so that the shape test and the cast share the result
    dirty = [c for c in SILVER_AMOUNTS if is_text[c]] if strip else []
    stripped = df.withColumns({c: strip(F.col(c)) for c in dirty}) if dirty else df
    text = [clean_text(F.col(c)).alias(c) for c in SILVER_TEXT]
    amounts = [
        (to_double(F.col(c)) if is_text[c] else F.col(c).cast("double")).alias(c) for c in SILVER_AMOUNTS
    ]
    count = F.col("cantidadCredito")
    typed = stripped.select(
        *text,
        *amounts,
        (to_long(count) if is_text["cantidadCredito"] else count.cast("bigint")).alias("cantidadCredito"),
        F.col("dt_captura").cast("date").alias("dt_captura"),
    )
    dated = typed.withColumn("periodo_date", periods.parse_period(F.col("periodo"), formats))
    flagged = dated.transform(periods.with_calendar).transform(with_quality_flags)
    return flagged.select(*SILVER_COLUMNS)
