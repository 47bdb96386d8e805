"""Silver and macro series to the gold tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklake.operators.alerts import alert_rows
from sparklake.operators.facts import enriched, gold_rows
from sparklake.operators.macro import monthly_mean, monthly_rates
from sparklake.operators.partials import facts_of_state
from sparklake.operators.risk import dashboard_alerts
from sparklake.plans.fact_state import refresh_state, state_table
from sparklake.plans.layout import Lake
from sparklake.schemas import (
    ALERT_SCHEMA,
    DASHBOARD_SCHEMA,
    FIRST_PERIOD,
    GOLD_KEY,
    GOLD_SCHEMA,
    LOOKBACK_MONTHS,
    MACRO_COLUMNS,
    SILVER_SCHEMA,
)
from sparklake.sinks import audit
from sparklake.sinks.tables import partition_values, read_table, replace_from, upsert
from sparklake.sources import files
from sparklake.sources.landing import CAPTURE_DATE, read_partitioned

PARTITION = "periodo_date"
ALERT_PARTITION = "periodo_ym"


def months_back(day: dt.date, months: int) -> dt.date:
    number = day.year * 12 + day.month - 1 - months
    return dt.date(number // 12, number % 12 + 1, 1)


def first_month(spark: SparkSession, path: str) -> dt.date:
    """Two months before gold's newest month: read from the folder names."""
    months = [v for v in partition_values(spark, path, PARTITION) if v[:1].isdigit()]
    if not months:
        return dt.date.fromisoformat(FIRST_PERIOD)
    return months_back(dt.date.fromisoformat(max(months)), LOOKBACK_MONTHS)


def macro_table(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """The newest capture of a bronze series; empty while there is none.

    Every capture holds the whole series, so averaging over several would mix revised
    values with old ones. The folder names say which is newest, and only that one is read.
    """
    path = lake.macro_bronze(dataset)
    captures = files.capture_dates(spark, path, CAPTURE_DATE)
    if captures:
        return read_partitioned(spark, path).where(F.col(CAPTURE_DATE) == F.lit(captures[-1]))
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in MACRO_COLUMNS[dataset]))


def gold_frame(
    spark: SparkSession,
    lake: Lake,
    start: dt.date,
    end: dt.date | None = None,
    scales: dict[str, int] | None = None,
    macro_scale: int | None = None,
    from_state: bool = False,
) -> DataFrame:
    """Gold rows of the months from ``start`` (to ``end``), pruned to silver's folders.

    ``from_state`` merges the state of the facts instead of reading those months of silver.
    ``scales`` and ``macro_scale`` name the decimals of the inputs, see ``stable_sum``.
    """
    source = state_table(spark, lake) if from_state else read_table(spark, lake.silver, SILVER_SCHEMA)
    source = source.where(F.col("periodo_ym") >= start.year * 100 + start.month)
    if end is not None:
        source = source.where(F.col("periodo_ym") <= end.year * 100 + end.month)
    macro_since = months_back(start, 1).isoformat()
    inflation = monthly_mean(macro_table(spark, lake, "inflacion_12m"), since=macro_since, scale=macro_scale)
    exchange = monthly_rates(macro_table(spark, lake, "tipo_cambio"), since=macro_since, scale=macro_scale)
    if from_state:
        recent = source.where(F.col("periodo_date") >= F.lit(start))
        return enriched(facts_of_state(recent, scales), inflation, exchange)
    return gold_rows(source, inflation, exchange, start.isoformat(), scales)


def refresh_alerts(spark: SparkSession, lake: Lake, start: dt.date, warm_up: bool = True) -> int:
    """Recompute the alerts of all months from ``start`` on and drop vanished months."""
    gold = read_table(spark, lake.gold, GOLD_SCHEMA)
    rows = alert_rows(gold, start, warm_up).select(*ALERT_SCHEMA.fieldNames())
    keyed = rows.withColumn(ALERT_PARTITION, F.col("anio") * 100 + F.col("mes"))
    first = f"{start.year * 100 + start.month:06d}"
    return replace_from(spark, keyed, lake.alerts, ALERT_PARTITION, first, ["provincia"])


def refresh_dashboard(spark: SparkSession, lake: Lake, start: dt.date) -> int:
    """Recompute the dashboard rows of all months from ``start`` on and drop vanished months."""
    rows = dashboard_alerts(read_table(spark, lake.gold, GOLD_SCHEMA)).where(F.col("periodo_date") >= F.lit(start))
    rows = rows.select(*DASHBOARD_SCHEMA.fieldNames())
    return replace_from(spark, rows, lake.dashboard, PARTITION, start.isoformat(), ["PROVINCIA"])


@audit.job
def load_gold(
    spark: SparkSession,
    lake: Lake,
    start: dt.date | None = None,
    end: dt.date | None = None,
    delete_missing: bool = False,
    scales: dict[str, int] | None = None,
    macro_scale: int | None = None,
    from_state: bool = False,
) -> int:
    """Upsert the recent months into gold, then refresh their alerts and dashboard rows.

    ``start`` and ``end`` override the look-back. A province that vanished from silver
    stays in gold unless ``delete_missing`` replaces the months as a whole. ``from_state``
    counts silver's new loads alone and merges them with what was counted before.
    """
    name, began = "silver_to_gold", audit.utc_now()
    audit.log_event(spark, lake.log, name, audit.STARTED, "inicio", began)
    try:
        since = start or first_month(spark, lake.gold)
        if from_state:
            refresh_state(spark, lake)
        rows = gold_frame(spark, lake, since, end, scales, macro_scale, from_state)
        if delete_missing:
            last = end.isoformat() if end else None
            count = replace_from(spark, rows, lake.gold, PARTITION, since.isoformat(), ["PROVINCIA"], last)
        else:
            count = upsert(
                spark, rows, lake.gold, GOLD_SCHEMA, GOLD_KEY, PARTITION, since.isoformat(), ["PROVINCIA"]
            )
        refresh_alerts(spark, lake, since)
        refresh_dashboard(spark, lake, since)
    except Exception as error:
        audit.log_event(
            spark, lake.log, name, audit.ERROR, f"fallo: {error}", began, audit.utc_now()
        )
        raise
    message = f"{count} filas desde {since.isoformat()}"
    audit.log_event(spark, lake.log, name, audit.SUCCESS, message, began, audit.utc_now(), count)
    return count
