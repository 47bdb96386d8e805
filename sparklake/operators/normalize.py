"""Bring frames of varying shape to an expected column list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.schemas import LOAN_COLUMNS, REQUESTED_PERIOD

MORTGAGES = "créditos hipotecarios"  # fixed value: portfolio name, lower case


def align_columns(df: DataFrame, expected: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly ``expected``, in that order: missing ones become NULL, extras go.

    Columns in ``keep`` (lineage) stay at the end.
    """
    present = set(df.columns)
    cols = [F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in expected]
    return df.select(*cols, *keep)


def preferred_order(df: DataFrame, preferred: list[str] = LOAN_COLUMNS) -> DataFrame:
    """``preferred`` columns first, then every other column in its old order."""
    first = [c for c in preferred if c in df.columns]
    rest = [c for c in df.columns if c not in set(preferred)]
    return df.select(*first, *rest)


def fallback_period(df: DataFrame) -> DataFrame:
    """``periodo`` as text, or the month that was asked for where there is no such column."""
    source = "periodo" if "periodo" in df.columns else REQUESTED_PERIOD
    return df.withColumn("periodo", F.col(source).cast("string"))


def only_category(df: DataFrame, column: str = "tipoCartera", value: str = MORTGAGES) -> DataFrame:
    """Case-insensitive equality filter; a frame without the column passes unchanged."""
    if column not in df.columns:
        return df
    return df.where(F.lower(F.col(column)) == value.lower())


def require_fields(df: DataFrame, fields: list[str] | tuple[str, ...]) -> DataFrame:
    """Drop rows with a NULL in one of ``fields``; an empty text is not NULL."""
    return df.na.drop(subset=list(fields)) if fields else df
