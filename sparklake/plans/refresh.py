"""Full refresh: silver, gold, quality verdict."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import SparkSession

from sparklake.operators.quality import check_counts, verdict
from sparklake.plans import gold, silver
from sparklake.plans.layout import Lake
from sparklake.schemas import GOLD_SCHEMA, SILVER_SCHEMA
from sparklake.sinks import audit
from sparklake.sinks.tables import read_table


@audit.job
def check_quality(spark: SparkSession, lake: Lake) -> tuple[str, str]:
    """Status and message of the checks, also written to the run log."""
    start = audit.utc_now()
    counts = check_counts(
        read_table(spark, lake.silver, SILVER_SCHEMA), read_table(spark, lake.gold, GOLD_SCHEMA)
    )
    result = verdict(counts).select("status", "message").first()
    audit.log_event(spark, lake.log, "data_quality_checks", result.status, result.message, start)
    return result.status, result.message


@audit.job
def run_refresh(
    spark: SparkSession, lake: Lake, route: str = "bronze", mode: str = "append", start: dt.date | None = None
) -> str:
    """Run all steps; returns the quality status. ``start`` is gold's first month, see ``load_gold``.

    ``route`` is where silver is fed from: ``bronze`` or ``landing``.
    """
    first = start
    name, start = f"full_refresh_{uuid.uuid4()}", audit.utc_now()
    load = {"bronze": silver.load_from_bronze, "landing": silver.load_from_landing}[route]
    steps = [
        (f"paso 1: {route.capitalize()} → Silver", lambda: load(spark, lake, mode)),
        ("paso 2: Silver → Gold", lambda: gold.load_gold(spark, lake, first)),
        ("paso 3: calidad", lambda: check_quality(spark, lake)),
    ]
    audit.log_event(spark, lake.log, name, audit.STARTED, "inicio", start)
    result = None
    try:
        for title, step in steps:
            audit.log_event(spark, lake.log, name, audit.RUNNING, title, audit.utc_now())
            result = step()
    except Exception as error:
        audit.log_event(spark, lake.log, name, audit.ERROR, f"fallo: {error}", start, audit.utc_now())
        raise RuntimeError(f"Pipeline failed: {error}") from error
    end = audit.utc_now()
    seconds = int((end - start).total_seconds())
    message = f"terminado en {seconds} segundos"
    audit.log_event(spark, lake.log, name, audit.SUCCESS, message, start, end)
    return result[0]
