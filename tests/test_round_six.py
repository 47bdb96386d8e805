"""Loads at size: rows move once, shuffle files go with their job."""

from __future__ import annotations

import datetime as dt
import time
from pathlib import Path

import pytest
from helpers import DAY, land, landing_line

from sparklake.operators.dedup import SPREAD, latest_per_key
from sparklake.plans import bronze, refresh, silver
from sparklake.plans.layout import Lake
from sparklake.queries import jobs, storage
from sparklake.schemas import SILVER_COLUMNS, SILVER_SCHEMA
from sparklake.sinks import audit, tables
from sparklake.sinks.tables import read_table
from sparklake.sources import files
from sparklake.sources.landing import read_captures, read_partitioned
from sparklake.streaming.dedup import each_once


def _odd_captures(lake):
    """Months of several spellings, or none, and keys that come again in either capture."""
    months = ["2024-01", "2024/1", "01/2024", "202402", "no", ""]
    for k, day in enumerate(("2024-03-01", "2024-04-01")):
        lines = [landing_line(periodo=m, entidad=f"E{i % 7}", deuda=str(i + k)) for i in range(60) for m in months]
        land(lake.loans_landing, day, lines)
    return [DAY(2024, 3, 1), DAY(2024, 4, 1)]


def test_a_load_moves_its_rows_once(spark, lake, monkeypatch):
    dates = _odd_captures(lake)
    plan = silver.from_landing(read_captures(spark, lake.loans_landing, dates))._jdf.queryExecution().executedPlan().toString()
    assert [line for line in plan.splitlines() if "Exchange" in line and "hashpartitioning(periodo_ym" not in line] == []
    assert plan.count("Exchange ") == 1
    told, write = [], tables.write_told
    monkeypatch.setattr(tables, "write_told", lambda *a, **n: told.append(a[-1]) or write(*a, **n))
    silver.load_from_landing(spark, lake)
    assert told[0] is True  # written as they come


def test_a_load_keeps_the_rows_that_the_plain_dedup_keeps(spark, lake):
    raw = read_captures(spark, lake.loans_landing, _odd_captures(lake))
    plain = silver.silver_rows(silver.align_columns(raw, silver.LOAN_COLUMNS, ("dt_captura",)), "lenient", silver.FOUR_FORMATS)
    wanted = latest_per_key(plain).select(*SILVER_COLUMNS).collect()
    silver.load_from_landing(spark, lake)
    stored = read_table(spark, lake.silver, SILVER_SCHEMA).select(*SILVER_COLUMNS).collect()
    assert sorted(map(str, stored)) == sorted(map(str, wanted)) and len(stored) == 42
    per_month = [v for v, _ in files.partition_files(spark, lake.silver, "periodo_ym")]
    assert max(per_month.count(v) for v in per_month) <= SPREAD
    for file in Path(lake.silver).rglob("*.parquet"):  # sorted as the table's files are
        names = [r.entidad for r in spark.read.parquet(str(file)).collect()]
        assert names == sorted(names)


def test_another_key_is_deduplicated_as_before(spark, lake):
    _odd_captures(lake)
    silver.load_from_landing(spark, lake, key=["entidad"])
    stored = read_table(spark, lake.silver, SILVER_SCHEMA).collect()
    assert sorted(r.entidad for r in stored) == [f"E{i}" for i in range(7)]
    assert {r.dt_captura for r in stored} == {dt.date(2024, 4, 1)}


def test_shuffle_files_go_with_their_job(spark, lake):
    _odd_captures(lake)
    held = lambda: {f.getName() for f in _shuffle_files(spark)}
    before = held()
    silver.load_from_landing(spark, lake)
    for _ in range(50):  # they go in the background
        left = held() - before
        if not left:
            break
        time.sleep(0.2)
    assert left == set()


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return [f for i in range(found.size()) if (f := found.apply(i)).getName().startswith("shuffle_")]


def _landed(spark, tmp_path, name, **how):
    """What a query lands, by capture: the rows, and the number of files."""
    lake = Lake(str(tmp_path / name))
    storage._land_by_year(spark, "/root/testdata/sf0.001", lake, **how)
    dates = files.capture_dates(spark, lake.loans_landing)
    rows = read_captures(spark, lake.loans_landing, dates).drop("archivo_origen").collect()
    held = [len(files.data_files(spark, f"{lake.loans_landing}/dt={d}")) for d in dates]
    return sorted(str(sorted(r.asDict().items(), key=str)) for r in rows), held


def test_a_stream_finds_few_files_a_capture(spark, tmp_path):
    """Each task of the join left a file for every capture; a stream takes some files at a time."""
    changed = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        rows, held = _landed(spark, tmp_path, "join", harvest=True)
        gathered, few = _landed(spark, tmp_path, "few", harvest=True, gathered=True)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert gathered == rows and len(rows) > 5000
    assert max(few) <= SPREAD < min(held) and sum(few) > 8  # still several micro-batches of eight


class _Landed(Exception):
    pass


def _no_stream(*args, **named):
    raise _Landed


def test_the_append_stream_finds_few_files_and_keeps_its_state_off_the_heap(spark, monkeypatch):
    held = []

    def landed(spark, landing, *args, **named):
        held.extend(len(files.data_files(spark, f"{landing}/dt={d}")) for d in files.capture_dates(spark, landing))
        raise _Landed

    monkeypatch.setattr(jobs, "start_append_stream", landed)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        with pytest.raises(_Landed):
            jobs.stream_dedup_state(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(held) == 7 and 1 < max(held) <= SPREAD  # one write of a single task left one file a capture before
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    digest = each_once(spark.createDataFrame([("a", dt.datetime(2024, 1, 1))], "v string, t timestamp"), "t", "1 day")
    assert "unhex(sha2" in digest._jdf.queryExecution().logical().toString()


def test_a_capture_is_dealt_before_it_becomes_text(spark, monkeypatch):
    plans, text = [], storage._landed_text
    monkeypatch.setattr(jobs, "_landed_text", lambda rows, *keep: plans.append(rows) or text(rows, *keep), raising=False)
    monkeypatch.setattr(jobs, "start_silver_stream", _no_stream)
    with pytest.raises(_Landed):
        jobs.stream_log_rows(spark, "/root/testdata/sf0.001")
    assert "RepartitionByExpression" in plans[0]._jdf.queryExecution().optimizedPlan().toString()
    assert dict(plans[0].dtypes)["deuda"] == "double"


def test_silver_from_bronze_moves_its_rows_once(spark, lake):
    land(lake.loans_landing, "2024-03-01", [landing_line(periodo=m, entidad=f"E{i % 9}", deuda=str(i)) for i in range(90) for m in ("2024-01", "2024-02")])
    bronze.load_loans(spark, lake)
    plan = silver.from_bronze(read_partitioned(spark, lake.loans_bronze), None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "hashpartitioning(periodo_ym" in plan
    assert silver.load_from_bronze(spark, lake) == 18
    assert {r.deuda for r in read_table(spark, lake.silver, SILVER_SCHEMA).collect()} == {float(i) for i in range(9)}
    assert silver.load_from_bronze(spark, lake) == 0


def test_a_refresh_leaves_no_shuffle_files(spark, lake):
    land(lake.loans_landing, "2024-03-01", [landing_line(entidad=f"E{i}", deuda=str(i)) for i in range(50)])
    bronze.load_loans(spark, lake)
    before = {f.getName() for f in _shuffle_files(spark)}
    refresh.run_refresh(spark, lake, start=dt.date(2024, 1, 1))
    for _ in range(50):
        left = {f.getName() for f in _shuffle_files(spark)} - before
        if not left:
            break
        time.sleep(0.2)
    assert left == set()


def test_a_load_without_news_leaves_its_log_and_no_shuffle_files(spark, lake):
    _odd_captures(lake)
    before = {f.getName() for f in _shuffle_files(spark)}
    assert silver.load_from_landing(spark, lake) == 42 and silver.load_from_landing(spark, lake) is None
    log = sorted((r.status, r.rows_processed) for r in audit.read_log(spark, lake.log).collect() if r.status in ("SUCCESS", "NO_NEW_DATA"))
    assert log == [("NO_NEW_DATA", None), ("SUCCESS", 42)]
    for _ in range(50):
        left = {f.getName() for f in _shuffle_files(spark)} - before
        if not left:
            break
        time.sleep(0.2)
    assert left == set()
