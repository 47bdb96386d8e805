"""Loads that lose their driver: each step fails once, the next run gives the rows of a run that did not."""

import datetime as dt
from pathlib import Path

import pytest
from helpers import land, landing_line, loan, silver_frame
from pyspark.sql import functions as F

from sparklake.plans import bronze, refresh, silver
from sparklake.plans.layout import Lake
from sparklake.schemas import SILVER_SCHEMA
from sparklake.sinks import audit, ledger
from sparklake.sinks.tables import read_table, write_partitions
from sparklake.sources import files

D = dt.date


def rows_of(spark, lake):
    return sorted((tuple(r) for r in read_table(spark, lake.silver, SILVER_SCHEMA).collect()), key=str)


def lose(monkeypatch, where, name, before=None):
    """The function fails once, after ``before`` was done in its place."""
    real, lost = getattr(where, name), []

    def once(*args, **named):
        if lost:
            return real(*args, **named)
        lost.append(True)
        if before:
            before(real, *args, **named)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(where, name, once)


def half_written(real, df, path, *rest, **named):
    """The job's commit is cut short: every other file is in the table."""
    real(df, path, *rest, **named)
    for k, file in enumerate(sorted(Path(path).rglob("carga-*.parquet"))):
        if k % 2:
            file.unlink()


def captures(lake, base):
    for month in (1, 2):
        lines = [landing_line(periodo=f"2024-0{m}", entidad=f"E{e}", deuda=str(month)) for m in range(1, 6) for e in range(3)]
        land(base, f"2024-0{month}-10", lines)


STEPS = {
    "intent": lambda mp: lose(mp, ledger, "begin"),
    "write": lambda mp: lose(mp, silver, "write_partitions"),
    "half": lambda mp: lose(mp, silver, "write_partitions", half_written),
    "commit": lambda mp: lose(mp, ledger, "commit"),
}


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_landing_loads_can_be_repeated(spark, tmp_path, monkeypatch, step, mode):
    if mode == "upsert" and step in ("write", "half"):
        step = "commit"
    whole, cut = Lake(str(tmp_path / "whole")), Lake(str(tmp_path / "cut"))
    for lake in (whole, cut):
        captures(lake, lake.loans_landing)
    silver.load_from_landing(spark, whole, mode)
    STEPS[step](monkeypatch)
    with pytest.raises(RuntimeError, match="driver lost"):
        silver.load_from_landing(spark, cut, mode)
    assert silver.load_from_landing(spark, cut, mode) == 15
    assert silver.load_from_landing(spark, cut, mode) is None
    assert rows_of(spark, cut) == rows_of(spark, whole)
    assert ledger.pending(spark, cut.silver) == []


def test_earlier_files_stay_when_a_load_is_taken_back(spark, lake, monkeypatch):
    land(lake.loans_landing, "2024-01-10", [landing_line(deuda="1")])
    silver.load_from_landing(spark, lake)
    first = rows_of(spark, lake)
    land(lake.loans_landing, "2024-02-10", [landing_line(deuda="2")])
    lose(monkeypatch, ledger, "commit")
    with pytest.raises(RuntimeError):
        silver.load_from_landing(spark, lake)
    assert len(rows_of(spark, lake)) == 2
    assert silver.watermark(spark, lake.silver) == D(2024, 1, 10)  # takes the lost load back
    assert rows_of(spark, lake) == first
    assert silver.load_from_landing(spark, lake) == 1 and len(rows_of(spark, lake)) == 2


@pytest.mark.parametrize("step", ["write", "commit"])
def test_a_lost_bronze_load_reaches_silver(spark, lake, monkeypatch, step):
    """Its years are not in the ledger, and a newer capture is loaded on top."""
    land(lake.loans_landing, "2024-01-10", [landing_line(periodo="2022-03")])
    bronze.load_loans(spark, lake)
    assert silver.load_from_bronze(spark, lake) == 1
    land(lake.loans_landing, "2024-02-10", [landing_line(periodo="2021-03"), landing_line(periodo="2021-04")])
    if step == "write":
        lose(monkeypatch, bronze, "write_told", lambda real, *a, **n: real(*a, **n))
    else:
        lose(monkeypatch, ledger, "commit")
    with pytest.raises(RuntimeError):
        bronze.load_loans(spark, lake)
    land(lake.loans_landing, "2024-03-10", [landing_line(periodo="2024-01")])
    bronze.load_loans(spark, lake)
    assert silver.load_from_bronze(spark, lake) == 3
    assert silver.load_from_bronze(spark, lake) == 0
    assert sorted(r.periodo for r in read_table(spark, lake.silver, SILVER_SCHEMA).collect()) == ["2021-03", "2021-04", "2022-03", "2024-01"]


def test_bronze_that_is_older_than_its_ledger(spark, lake):
    land(lake.loans_landing, "2024-01-10", [landing_line(periodo="2020-03")])
    bronze.load_loans(spark, lake)
    files.delete(spark, ledger.path_of(lake.loans_bronze))
    land(lake.loans_landing, "2024-02-10", [landing_line(periodo="2024-01")])
    bronze.load_loans(spark, lake)
    assert ledger.parts_after(spark, lake.loans_bronze, None) == ["2020", "2024"]
    assert silver.load_from_bronze(spark, lake) == 2


def test_a_lost_rebuild_is_done_again(spark, lake, monkeypatch):
    write_partitions(silver_frame(spark, [loan(periodo="2019-01")]), lake.silver, ["periodo_ym"])
    land(lake.loans_landing, "2024-01-10", [landing_line(), landing_line(periodo="2024-02")])
    bronze.load_loans(spark, lake)
    lose(monkeypatch, silver, "write_partitions", lambda real, *a, **n: real(*a, **n))  # the vanished month is still there
    with pytest.raises(RuntimeError):
        silver.load_from_bronze(spark, lake, rebuild=True)
    assert len(rows_of(spark, lake)) == 3
    assert silver.load_from_bronze(spark, lake) == 2
    assert sorted(r.periodo for r in read_table(spark, lake.silver, SILVER_SCHEMA).collect()) == ["2024-01", "2024-02"]
    assert silver.load_from_bronze(spark, lake) == 0 and ledger.pending(spark, lake.silver) == []


def test_a_run_writes_its_log_once(spark, lake):
    land(lake.loans_landing, "2024-01-10", [landing_line()])
    bronze.load_loans(spark, lake)
    refresh.run_refresh(spark, lake)
    written = list(Path(lake.log).rglob("*.parquet"))
    assert len(written) == 1
    log = audit.read_log(spark, lake.log)
    assert log.where("process_name like 'full_refresh_%'").count() == 5 and log.where("status = 'STARTED'").count() >= 2
    refresh.run_refresh(spark, lake)
    assert len(list(Path(lake.log).rglob("*.parquet"))) == 2
    before = sorted(map(str, audit.read_log(spark, lake.log).collect()))
    for day in {r[0] for r in spark.read.parquet(lake.log).select("created_date").collect()}:
        audit.compact(spark, lake.log, day)
    assert len(list(Path(lake.log).rglob("*.parquet"))) == 1
    assert sorted(map(str, audit.read_log(spark, lake.log).collect())) == before


def test_a_failed_run_is_logged(spark, lake):
    with pytest.raises(FileNotFoundError):
        bronze.load_loans(spark, lake)
    with pytest.raises(Exception):
        silver.load_from_bronze(spark, lake)
    errors = audit.read_log(spark, lake.log).where(F.col("status") == "ERROR").collect()
    assert [r.process_name for r in errors] == ["bronze_to_silver"]
