"""Landing CSV to bronze Parquet."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklake.operators.cleaning import bronze_columns
from sparklake.operators.macro import canonical_macro
from sparklake.operators.normalize import align_columns
from sparklake.plans.layout import Lake
from sparklake.schemas import EXPECTED_COLUMNS, MACRO_COLUMNS
from sparklake.sinks import audit, ledger
from sparklake.sinks.tables import write_one, write_told
from sparklake.sources import files
from sparklake.sources.landing import CAPTURE_DATE, SOURCE_FILE, read_captures


def loans_frame(spark: SparkSession, landing: str, capture: dt.date) -> DataFrame:
    """Typed bronze rows of one capture, with lineage columns."""
    raw = read_captures(spark, landing, [capture])
    lineage = (CAPTURE_DATE, SOURCE_FILE)
    return align_columns(raw, EXPECTED_COLUMNS, lineage).transform(bronze_columns)


@audit.job
def load_loans(spark: SparkSession, lake: Lake) -> int:
    """Newest loan capture to bronze: one scan, one write, months replaced as a whole.

    Rows without a readable month go to the NULL partition instead of being lost. A load that lost
    its driver is named in the ledger, so silver looks for its rows in the table itself.
    """
    audit.log_odd_folders(spark, lake.log, "landing_to_bronze", files.odd_folders(spark, lake.loans_landing))
    capture = files.latest_capture(spark, lake.loans_landing)
    ledger.seed(spark, lake.loans_bronze, "anio")
    ledger.recover(spark, lake.loans_bronze)
    load = ledger.begin(spark, lake.loans_bronze, ledger.OVERWRITE, capture)
    rows = loans_frame(spark, lake.loans_landing, capture)
    told = write_told(rows, lake.loans_bronze, ["anio", "mes"], None, "overwrite")
    ledger.commit(spark, load, capture, told["rows"], told["values"])
    return told["rows"]


def macro_frame(spark: SparkSession, landing: str, dataset: str, capture: dt.date) -> DataFrame:
    """Canonical text columns of one macro capture, plus processing date and lineage."""
    raw = read_captures(spark, landing, [capture])
    rows = canonical_macro(raw, dataset, (CAPTURE_DATE, SOURCE_FILE))
    return rows.withColumn("fecha_proceso", F.current_date())


def load_macro(spark: SparkSession, lake: Lake, dataset: str) -> int | None:
    """Newest capture of one series; ``None`` when there is nothing to load."""
    landing = lake.macro_landing(dataset)
    captures = files.capture_dates(spark, landing)
    if not captures:
        return None
    rows = macro_frame(spark, landing, dataset, captures[-1])
    if rows.isEmpty():
        return None
    return write_one(rows, lake.macro_bronze(dataset), CAPTURE_DATE, captures[-1])


@audit.job
def load_all_macro(spark: SparkSession, lake: Lake) -> dict[str, int | str | None]:
    """Every series on its own: a missing or unreadable one does not stop the others."""
    results: dict[str, int | str | None] = {}
    for dataset in MACRO_COLUMNS:
        try:
            results[dataset] = load_macro(spark, lake, dataset)
        except Exception as error:  # reported per dataset, in the result and in the run log
            results[dataset] = f"error: {error}"
            now = audit.utc_now()
            audit.log_event(spark, lake.log, f"macro_{dataset}", audit.ERROR, f"fallo: {error}", now, now)
    return results


def stored_rows(spark: SparkSession, path: str) -> int:
    """Read-back check: rows of a written table, counted from the file footers."""
    return spark.read.parquet(path).count()
