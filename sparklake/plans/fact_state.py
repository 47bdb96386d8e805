"""Keeps the state of gold's facts beside silver, see ``operators.partials``.

The ledger of the state names the loads of silver that it has counted. A run reads only the files
of appends that came since, which carry the load's identifier in their names. After an upsert or
a rebuild of silver, rows that were counted may be gone, and the state is made anew.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sparklake.operators.partials import PART, STATE_SCHEMA, fact_state
from sparklake.plans.layout import Lake
from sparklake.plans.silver import PARTITION, watermark
from sparklake.schemas import SILVER_SCHEMA
from sparklake.sinks import audit, ledger, snapshots
from sparklake.sinks.tables import drop_partitions, partition_values, read_table, write_told
from sparklake.sources import files


def _commits(spark: SparkSession, table: str) -> list:
    """The commits of a table, oldest first: as many as it had loads."""
    done = ledger.records(spark, table).where(F.col("estado") == ledger.COMMIT)
    return done.orderBy("cargado", "carga").select("carga", "modo", "partes").collect()


def _counted(spark: SparkSession, table: str) -> set[str]:
    """The loads of silver that are in the state."""
    counted: set[str] = set()
    for row in _commits(spark, table):
        counted = set(row.partes) | (set() if row.modo == ledger.REBUILD else counted)
    return counted


def _files_of(spark: SparkSession, table: str, loads: list[str]) -> list[str]:
    """Patterns for the files of the loads, one for each folder that has some."""
    prefixes = {ledger.Load(table, load, ledger.APPEND).prefix for load in loads}
    held: snapshots.Parts = {}
    for value, name in files.partition_files(spark, table, PARTITION):
        load = name[: len(snapshots.new_prefix())]
        if load in prefixes and load not in held.setdefault(value, []):
            held[value].append(load)
    return snapshots.globs(table, PARTITION, held)


@audit.job
def refresh_state(spark: SparkSession, lake: Lake) -> str:
    """Count what silver has got since the last run; returns ``append``, ``rebuild`` or ``none``.

    A run that lost its driver is repeated: files of an append without a commit are taken back.
    """
    name, began, path = "fact_state", audit.utc_now(), lake.fact_state
    watermark(spark, lake.silver)  # starts the ledger of an older table, takes back lost appends
    redo = ledger.REBUILD in ledger.recover(spark, path)
    loads, counted = _commits(spark, lake.silver), _counted(spark, path)
    fresh = [row for row in loads if row.carga not in counted]
    if not fresh and not redo:
        audit.log_event(spark, lake.log, name, audit.NO_NEW_DATA, "sin cargas nuevas", began, audit.utc_now())
        return "none"
    if redo or any(row.modo != ledger.APPEND for row in fresh):
        mode, load = "rebuild", ledger.begin(spark, path, ledger.REBUILD)
        old = set(partition_values(spark, path, PART))
        written = write_told(fact_state(read_table(spark, lake.silver, SILVER_SCHEMA)), path, [PART], ["provincia"], "overwrite")
        drop_partitions(spark, path, PART, old - set(written["values"]))
        ledger.commit(spark, load, None, written["rows"], [row.carga for row in loads])
        ledger.close_rebuilds(spark, path)
    else:
        mode, load = "append", ledger.begin(spark, path, ledger.APPEND)
        found = _files_of(spark, lake.silver, [row.carga for row in fresh])
        written = {"rows": 0}
        if found:
            rows = spark.read.schema(SILVER_SCHEMA).option("basePath", lake.silver).parquet(*found)
            written = write_told(fact_state(rows), path, [PART], ["provincia"], "append", load.prefix)
        ledger.commit(spark, load, None, written["rows"], [row.carga for row in fresh])
    message = f"{mode}: {len(fresh)} cargas"
    audit.log_event(spark, lake.log, name, audit.SUCCESS, message, began, audit.utc_now(), written["rows"])
    return mode


def state_table(spark: SparkSession, lake: Lake):
    return read_table(spark, lake.fact_state, STATE_SCHEMA)
