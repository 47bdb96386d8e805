"""Procedures that analysts call from SQL, as table functions of the session.

``SELECT * FROM alerts_since(DATE '2024-01-01')`` and ``SELECT * FROM quality_checks()`` are plain
relations: they can be joined, filtered and called for each row with LATERAL, and are planned
together with the statement around them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklake.operators.alerts import alert_rows
from sparklake.operators.quality import DRIFT_TOLERANCE, MACRO_SINCE, MESSAGES, check_counts
from sparklake.plans.layout import Lake
from sparklake.schemas import ALERT_SCHEMA, GOLD_SCHEMA, SILVER_SCHEMA
from sparklake.sinks.tables import read_table

_ALERTS, _CHECKS = "sparklake_alert_rows", "sparklake_check_rows"


def _define(spark: SparkSession, signature: str, columns: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS TABLE ({columns}) RETURN {body}")


def define_alerts(spark: SparkSession, gold: DataFrame) -> None:
    """``alerts_since(since)``: alerts of the months from ``since`` on; the trend knows earlier months."""
    alert_rows(gold).createOrReplaceTempView(_ALERTS)
    names = ALERT_SCHEMA.fieldNames()
    typed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ALERT_SCHEMA)
    month = "make_date(CAST(anio AS INT), CAST(mes AS INT), 1)"
    _define(spark, "alerts_since(since DATE)", typed, f"SELECT {', '.join(names)} FROM {_ALERTS} WHERE {month} >= since")


def define_checks(spark: SparkSession, silver: DataFrame, gold: DataFrame, macro_since: str = MACRO_SINCE) -> None:
    """``quality_checks()``: one row for each check, with its count, its limit and whether it holds."""
    limits = {name: DRIFT_TOLERANCE if name == "diferencia_claves" else 0 for name in MESSAGES}
    checks = F.array(
        *[
            F.struct(F.lit(name).alias("control"), F.col(name).cast("bigint").alias("valor"), F.lit(limit).cast("bigint").alias("limite"))
            for name, limit in limits.items()
        ]
    )
    check_counts(silver, gold, macro_since).select(F.inline(checks)).createOrReplaceTempView(_CHECKS)
    columns = "control string, valor bigint, limite bigint, correcto boolean"
    _define(spark, "quality_checks()", columns, f"SELECT control, valor, limite, valor <= limite FROM {_CHECKS}")


def define(spark: SparkSession, lake: Lake) -> None:
    """All procedures over the tables of a lake, as they are when the session defines them."""
    silver, gold = read_table(spark, lake.silver, SILVER_SCHEMA), read_table(spark, lake.gold, GOLD_SCHEMA)
    define_alerts(spark, gold)
    define_checks(spark, silver, gold)
