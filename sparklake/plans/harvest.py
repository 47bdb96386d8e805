"""Landed API responses to landing CSV: the loan harvest and the macro series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklake.operators.normalize import fallback_period, only_category, preferred_order
from sparklake.plans.layout import Lake
from sparklake.sinks.csv import export_by_period, export_capture
from sparklake.sources.countries import country_dimension
from sparklake.sources.payloads import exchange_series, inflation_series, loan_rows, statistics_rows, unemployment_series


def harvest_rows(responses: DataFrame, category: str | None = None) -> DataFrame:
    """Loan rows of the responses: all fields, the preferred ones first, the month filled in.

    ``category`` keeps one kind of portfolio, whatever its case.
    """
    rows = loan_rows(responses).transform(fallback_period)
    if category:
        rows = only_category(rows, value=category)
    return preferred_order(rows)


def harvest(spark: SparkSession, responses: DataFrame, lake: Lake, run_date: dt.date, category: str | None = None) -> str:
    """Monthly files and the consolidated capture of ``run_date``; returns the capture's folder."""
    rows = harvest_rows(responses, category)
    export_by_period(rows, lake.loans_monthly)
    return export_capture(rows, lake.loans_landing, run_date)


def extract_macro(
    spark: SparkSession, bodies: dict[str, DataFrame], lake: Lake, run_date: dt.date, country: str = "DO"
) -> dict[str, str]:
    """The three series from their responses (a ``body`` column each) to landing captures."""
    series = {
        "inflacion_12m": lambda df: inflation_series(df, country),
        "tipo_cambio": exchange_series,
        "desempleo_imf": lambda df: unemployment_series(statistics_rows(df), country_dimension(spark)),
    }
    made = {}
    for name, df in bodies.items():
        rows = series[name](df)
        text = rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns])
        made[name] = export_capture(text, lake.macro_landing(name), run_date)
    return made
