"""Landing headers, kept fields, ledgers, recoverable upserts and prunable predicates."""

import datetime as dt

import pytest
from helpers import land, landing_line, loan, silver_frame
from pyspark.sql import functions as F

from sparklake.functions import periods
from sparklake.functions.scalars import to_int_truncated
from sparklake.plans import bronze, gold, silver
from sparklake.schemas import GOLD_SCHEMA, LOAN_COLUMNS, REQUESTED_PERIOD, SILVER_SCHEMA
from sparklake.session import shared_dir
from sparklake.sinks import audit, ledger, snapshots, tables
from sparklake.sinks.tables import read_table, write_partitions
from sparklake.sources import files, landing, payloads
from sparklake.streaming.landing import start_silver_stream

D = dt.date


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_integers_lose_their_fraction(spark):
    rows = [("12", 12), ("12.0", 12), (" 12.7 ", 12), ("-3.9", -3), ("+4.", 4), ("1e3", None), ("x", None), (None, None), ("99999999999", None)]
    df = spark.createDataFrame(rows, "t string, want int")
    assert all(r[0] == r[1] for r in df.select(to_int_truncated(F.col("t")), "want").collect())


def test_impossible_and_odd_folders_are_named(spark, lake):
    land(lake.loans_landing, "2024-01-10", [landing_line()])
    for name in ("2024-02-30", "latest"):
        land(lake.loans_landing, name, [landing_line()])
    assert files.capture_dates(spark, lake.loans_landing) == [D(2024, 1, 10)]
    assert files.odd_folders(spark, lake.loans_landing) == ["2024-02-30", "latest"]
    assert silver.load_from_landing(spark, lake) == 1
    warned = audit.read_log(spark, lake.log).where("status = 'WARNING'").collect()
    assert [r.message for r in warned] == ["carpetas omitidas: 2024-02-30, latest"]


def test_fields_outside_the_list_are_kept(spark):
    bodies = [('[{"entidad": "A", "nota": "x"}]', "p"), ('{"Data": [{"entidad": "B", "otro": 5}]}', "q"), ("no json", "r"), (None, "s")]
    got = payloads.loan_rows(spark.createDataFrame(bodies, "body string, periodo_solicitado string"))
    assert got.columns == [*LOAN_COLUMNS, "nota", "otro", REQUESTED_PERIOD]
    assert {(r.entidad, r.nota, r.otro, r[REQUESTED_PERIOD]) for r in got.collect()} == {("A", "x", None, "p"), ("B", None, "5", "q")}


def test_one_capture_with_two_encodings(spark, tmp_path):
    folder = tmp_path / "dt=2024-01-01"
    folder.mkdir()
    (folder / "a.csv").write_bytes("entidad,Sección\nPeña,1\n".encode())
    (folder / "b.csv").write_bytes("Sección,entidad\n2,Ñandú\n".encode("latin-1"))
    (folder / "empty.csv").write_bytes(b"")
    rows = landing.read_captures(spark, str(tmp_path), [D(2024, 1, 1)])
    assert {(r.entidad, r["Sección"]) for r in rows.collect()} == {("Peña", "1"), ("Ñandú", "2")}


def test_stream_takes_files_by_their_own_headers(spark, lake):
    harvest = [*LOAN_COLUMNS, REQUESTED_PERIOD]
    line = lambda **x: landing_line(**x) | {REQUESTED_PERIOD: "2024-01"}
    land(lake.loans_landing, "2024-01-10", [line(entidad="E1", deuda="1")], columns=harvest)
    land(lake.loans_landing, "2024-02-10", [line(entidad="E2", deuda="2")], columns=harvest[::-1])
    land(lake.loans_landing, "2024-03-10", [landing_line(entidad="E3", deuda="3")], columns=LOAN_COLUMNS)
    run = lambda: start_silver_stream(spark, lake.loans_landing, lake.silver, f"{lake.root}/stream", files_per_batch=2).awaitTermination()
    run()
    land(lake.loans_landing, "2023-12-10", [line(entidad="E0", deuda="4")], columns=harvest)  # late
    run()
    rows = read_table(spark, lake.silver, SILVER_SCHEMA).collect()
    assert {(r.entidad, r.deuda) for r in rows} == {("E1", 1.0), ("E2", 2.0), ("E3", 3.0), ("E0", 4.0)}
    assert silver.watermark(spark, lake.silver) == D(2024, 3, 10)


def test_ledger_stands_in_for_scans(spark, lake):
    land(lake.loans_landing, "2024-01-10", [landing_line()])
    bronze.load_loans(spark, lake)
    assert silver.load_from_bronze(spark, lake) == 1
    assert ledger.newest(spark, lake.silver) == D(2024, 1, 10)
    assert ledger.parts_after(spark, lake.loans_bronze, None) == ["2024"]
    assert ledger.parts_after(spark, lake.loans_bronze, D(2024, 1, 10)) == []
    assert silver.load_from_bronze(spark, lake) == 0
    last = audit.read_log(spark, lake.log).where("process_name = 'bronze_to_silver'").orderBy(F.col("created_at").desc()).first()
    assert last.status == "NO_NEW_DATA"
    files.delete(spark, ledger.path_of(lake.silver))  # rebuilt from the table
    assert silver.watermark(spark, lake.silver) == D(2024, 1, 10) == ledger.newest(spark, lake.silver)
    land(lake.loans_landing, "2024-02-10", [landing_line(periodo="2023-05")])
    bronze.load_loans(spark, lake)
    pending = silver._pending_bronze(spark, lake, D(2024, 1, 10))
    assert "anio#" in plan_of(pending).split("PartitionFilters")[1].split("]")[0]
    assert silver.load_from_bronze(spark, lake) == 1


@pytest.mark.parametrize("lost", ["before", "between"])
def test_upsert_survives_a_lost_driver(spark, tmp_path, monkeypatch, lost):
    path = str(tmp_path / "silver")
    silver.store(spark, silver_frame(spark, [loan(deuda=1.0), loan(entidad="E2", deuda=5.0)]), path, "upsert")
    later = silver_frame(spark, [loan(deuda=2.0, dt_captura=D(2024, 5, 1))])
    before = read_table(spark, path, SILVER_SCHEMA).collect()
    real_write, real_publish = tables.write_told, snapshots.publish

    def lost_before(df, target, *rest, **named):
        if target != path:
            return real_write(df, target, *rest, **named)
        raise RuntimeError("driver lost")

    def lost_between(session, table, parts):  # the files are there, no version names them
        if any(len(files.data_files(session, f"{path}/periodo_ym={v}")) > 1 for v in parts):
            raise RuntimeError("driver lost")
        return real_publish(session, table, parts)

    if lost == "before":
        monkeypatch.setattr(tables, "write_told", lost_before)
    else:
        monkeypatch.setattr(snapshots, "publish", lost_between)
    with pytest.raises(RuntimeError):
        silver.store(spark, later, path, "upsert")
    monkeypatch.undo()
    assert sorted(read_table(spark, path, SILVER_SCHEMA).collect()) == sorted(before)
    silver.store(spark, later, path, "upsert")
    rows = read_table(spark, path, SILVER_SCHEMA).collect()
    assert {(r.entidad, r.deuda) for r in rows} == {("E1", 2.0), ("E2", 5.0)}


def test_gold_range_drops_what_vanished(spark, lake):
    months = [f"2024-{m:02d}" for m in range(1, 5)]
    write_partitions(silver_frame(spark, [loan(periodo=m, provincia=p) for m in months for p in ("P1", "P2")]), lake.silver, ["periodo_ym"])
    gold.load_gold(spark, lake)
    write_partitions(silver_frame(spark, [loan(periodo=m, provincia="P1") for m in months]), lake.silver, ["periodo_ym"])
    gold.load_gold(spark, lake, D(2024, 2, 1), D(2024, 3, 1), delete_missing=True)
    rows = read_table(spark, lake.gold, GOLD_SCHEMA).collect()
    assert {(r.MES, r.PROVINCIA) for r in rows} == {(1, "P1"), (1, "P2"), (2, "P1"), (3, "P1"), (4, "P1"), (4, "P2")}


def test_selections_reach_the_scan(spark, tmp_path):
    path = shared_dir(spark, "rows")
    rows = spark.range(400).select(F.date_add(F.lit(D(2023, 1, 1)), F.col("id").cast("int")).alias("periodo_date"), "id")
    rows.write.parquet(path)
    df = spark.read.parquet(path)
    forced = periods.select_periods(df, None, ["2023-03", "2023-12"])
    assert forced.count() == 62 and "GreaterThanOrEqual(periodo_date" in plan_of(forced)
    months = periods.lookback_months(spark.range(1).select(F.lit(D(2023, 6, 9)).alias("last")), 2)
    assert periods.select_periods(df, months).count() == 61
    log = f"{tmp_path}/log"
    now = audit.utc_now()
    audit.log_event(spark, log, "p", audit.SUCCESS, "m", now, now, 1)
    health = audit.health(audit.read_log(spark, log), "2024-01-01")
    assert health.count() == 1 and "created_date" in plan_of(health).split("PartitionFilters")[1].split("]")[0]
