"""Macro series: one canonical shape per dataset, then monthly means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklake.functions.periods import MACRO_FORMATS, parse_period
from sparklake.functions.scalars import clean_text, stable_mean, to_double
from sparklake.operators.normalize import align_columns
from sparklake.schemas import MACRO_COLUMNS

# fixed values: rate kinds, and the wide column that holds each
RATE_KINDS = {"tc_venta": "VENTA", "tc_compra": "COMPRA"}
# columns of the extracted files -> columns of the canonical shape
RENAMES = {
    "inflacion_12m": {"Fecha": "fecha", "inflacion": "inflacion_anual"},
    "desempleo_imf": {"anio": "fecha"},
    "tipo_cambio": {},
}


def wide_to_long(df: DataFrame, date_col: str = "fecha", keep: tuple[str, ...] = ()) -> DataFrame:
    """``fecha, tc_venta, tc_compra`` to one row per date and kind of rate."""
    long = df.unpivot([date_col, *keep], list(RATE_KINDS), "_kind", "tasa_cambio")
    kinds = F.create_map(*[F.lit(x) for pair in RATE_KINDS.items() for x in pair])
    return long.select(date_col, "tasa_cambio", kinds[F.col("_kind")].alias("tipo_cambio"), *keep)


def canonical_macro(df: DataFrame, dataset: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Accept the extracted shape or the canonical one, by column name; all text."""
    if dataset == "tipo_cambio" and set(RATE_KINDS) <= set(df.columns):
        df = wide_to_long(df, "fecha", keep)
    for old, new in RENAMES[dataset].items():
        if old in df.columns and (new not in df.columns or old.lower() == new.lower()):
            df = df.withColumnRenamed(old, new)
    return align_columns(df, MACRO_COLUMNS[dataset], keep)


def _numeric(df: DataFrame, name: str) -> Column:
    return to_double(F.col(name)) if dict(df.dtypes)[name] == "string" else F.col(name)


def _dated(df: DataFrame, since: Column | str | None) -> DataFrame:
    """Add ``_date`` from ``fecha`` (a day or a month) and cut before ``since``."""
    if dict(df.dtypes)["fecha"] == "string":
        day = parse_period(clean_text(F.col("fecha")), MACRO_FORMATS)
    else:
        day = F.col("fecha").cast("date")
    dated = df.withColumn("_date", day).where(F.col("_date").isNotNull())
    if since is None:
        return dated
    start = F.lit(since).cast("date") if isinstance(since, str) else since
    return dated.where(F.col("_date") >= start)


def monthly_mean(
    df: DataFrame,
    value: str = "inflacion_anual",
    out: str = "inflacion",
    since: Column | str | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Mean per month; values that are not numbers do not count."""
    rows = _dated(df, since).select(F.trunc("_date", "MM").alias("periodo_date"), _numeric(df, value).alias("_v"))
    return rows.groupBy("periodo_date").agg(stable_mean(F.col("_v"), scale).alias(out))


def monthly_rates(
    df: DataFrame,
    value: str = "tasa_cambio",
    kind: str = "tipo_cambio",
    since: Column | str | None = None,
    scale: int | None = None,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Mean rate per month, one column per kind of rate."""
    rows = _dated(df, since).select(
        F.trunc("_date", "MM").alias("periodo_date"), kind, _numeric(df, value).alias("_v")
    )
    means = [
        stable_mean(F.when(F.col(kind) == label, F.col("_v")), scale).alias(out)
        for out, label in (names or RATE_KINDS).items()
    ]
    return rows.groupBy("periodo_date").agg(*means)
