import datetime as dt

import pytest
from helpers import land, landing_line, loan, silver_frame
from pyspark.sql import functions as F

from sparklake.operators.quality import ALERT_WORD
from sparklake.plans import bronze, gold, refresh, silver
from sparklake.schemas import ALERT_SCHEMA, GOLD_SCHEMA, SILVER_SCHEMA
from sparklake.sinks import audit
from sparklake.sinks.csv import export_by_period, export_capture
from sparklake.sinks.tables import read_table, replace_from, write_partitions
from sparklake.streaming.landing import start_silver_stream

D = dt.date


def table(spark, path, schema):
    names = schema.fieldNames()
    return sorted((tuple(r) for r in read_table(spark, path, schema).select(*names).collect()), key=str)


def statuses(spark, lake, process):
    rows = audit.read_log(spark, lake.log).where(F.col("process_name") == process).orderBy("created_at")
    return [r.status for r in rows.collect()]


def test_bronze_takes_newest_capture_and_keeps_unreadable_months(spark, lake):
    land(lake.loans_landing, "2024-01-10", [landing_line(deuda="1")])
    land(lake.loans_landing, "2024-02-10", [landing_line(deuda="$2"), landing_line(periodo="??", deuda="3")])
    assert bronze.load_loans(spark, lake) == 2
    rows = spark.read.parquet(lake.loans_bronze)
    assert {(r.anio, r.mes, r.deuda, r.dt_captura) for r in rows.collect()} == {
        (2024, 1, None, D(2024, 2, 10)), (None, None, 3.0, D(2024, 2, 10)),
    }
    assert bronze.load_loans(spark, lake) == 2 and bronze.stored_rows(spark, lake.loans_bronze) == 2


def test_macro_datasets_are_independent(spark, lake):
    land(lake.macro_landing("inflacion_12m"), "2024-01-01", [{"Fecha": "2024-01", "inflacion": "3.5", "pais": "DO"}], columns=["Fecha", "inflacion", "pais"])
    land(lake.macro_landing("tipo_cambio"), "2024-01-01", [], columns=["fecha", "tc_venta", "tc_compra"])
    assert bronze.load_all_macro(spark, lake) == {"desempleo_imf": None, "inflacion_12m": 1, "tipo_cambio": None}
    land(lake.macro_landing("inflacion_12m"), "2024-02-01", [{"Fecha": "2024-02", "inflacion": "4", "pais": "DO"}], columns=["Fecha", "inflacion", "pais"])
    bronze.load_all_macro(spark, lake)
    stored = spark.read.parquet(lake.macro_bronze("inflacion_12m"))
    assert {r.inflacion_anual for r in stored.collect()} == {"3.5", "4"}  # the earlier capture stays


def test_landing_to_silver_append_and_upsert(spark, lake, tmp_path):
    land(lake.loans_landing, "2024-01-10", [landing_line(deuda="1"), landing_line(entidad="E2", deuda="5"), landing_line(periodo="01/2023")])
    assert silver.load_from_landing(spark, lake) == 3
    first = table(spark, lake.silver, SILVER_SCHEMA)
    assert silver.load_from_landing(spark, lake) is None
    assert table(spark, lake.silver, SILVER_SCHEMA) == first
    land(lake.loans_landing, "2024-02-10", [landing_line(deuda="2")])
    assert silver.load_from_landing(spark, lake, "upsert") == 1
    rows = read_table(spark, lake.silver, SILVER_SCHEMA).where("periodo = '2024-01'").collect()
    assert {(r.entidad, r.deuda) for r in rows} == {("E1", 2.0), ("E2", 5.0)}
    land(lake.loans_landing, "2024-03-10", [landing_line(deuda="3")])
    silver.load_from_landing(spark, lake)
    assert read_table(spark, lake.silver, SILVER_SCHEMA).where("periodo = '2024-01' and entidad = 'E1'").count() == 2
    done = audit.read_log(spark, lake.log).where("status = 'SUCCESS'").orderBy("created_at").first()
    assert done.rows_processed == 3 and done.message.startswith("3 filas leídas, 3 filas nuevas, 0 sin período válido")
    assert "2023-01-01 a 2024-01-01, capturas: 2024-01-10" in done.message
    assert statuses(spark, lake, "landing_to_silver")[:5] == ["STARTED", "PROCESSING", "SUCCESS", "STARTED", "NO_NEW_DATA"]


def test_landing_requires_fields_and_bronze_does_not(spark, lake):
    land(lake.loans_landing, "2024-01-10", [landing_line(), landing_line(provincia="")])
    bronze.load_loans(spark, lake)
    assert silver.load_from_bronze(spark, lake) == 2
    assert silver.load_from_bronze(spark, lake) == 0


def test_silver_rebuild_drops_old_months(spark, lake):
    write_partitions(silver_frame(spark, [loan(periodo="2019-01")]), lake.silver, ["periodo_ym"])
    land(lake.loans_landing, "2024-01-10", [landing_line()])
    bronze.load_loans(spark, lake)
    assert silver.load_from_bronze(spark, lake, rebuild=True) == 1
    assert [r.periodo for r in read_table(spark, lake.silver, SILVER_SCHEMA).collect()] == ["2024-01"]


def test_upsert_handles_unreadable_months(spark, tmp_path):
    path = str(tmp_path / "silver")
    bad = {"periodo": "??", "periodo_date": None, "flg_periodo_invalido": 1}
    silver.store(spark, silver_frame(spark, [loan(**bad, deuda=1.0), loan()]), path, "upsert")
    silver.store(spark, silver_frame(spark, [loan(**bad, deuda=2.0, dt_captura=D(2024, 5, 1))]), path, "upsert")
    assert sorted(r.deuda for r in read_table(spark, path, SILVER_SCHEMA).collect()) == [2.0, 110.0]


def put_silver(spark, lake, rows):
    write_partitions(silver_frame(spark, rows), lake.silver, ["periodo_ym"])


def test_gold_upsert_is_idempotent_and_keeps_vanished_rows(spark, lake):
    months = [f"2024-{m:02d}" for m in range(1, 6)]
    put_silver(spark, lake, [loan(periodo=m, provincia=p) for m in months for p in ("P1", "P2")])
    assert gold.load_gold(spark, lake) == 10
    first, first_alerts = table(spark, lake.gold, GOLD_SCHEMA), table(spark, lake.alerts, ALERT_SCHEMA)
    assert gold.first_month(spark, lake.gold) == D(2024, 3, 1)
    assert gold.load_gold(spark, lake) == 6  # two months back from the newest: three months
    assert table(spark, lake.gold, GOLD_SCHEMA) == first
    assert table(spark, lake.alerts, ALERT_SCHEMA) == first_alerts
    put_silver(spark, lake, [loan(periodo="2024-05", provincia="P1", deuda=7.0)])
    gold.load_gold(spark, lake)
    rows = {(r.periodo_date.month, r.PROVINCIA): r.DEUDA for r in read_table(spark, lake.gold, GOLD_SCHEMA).collect()}
    assert rows[5, "P1"] == 7.0 and (5, "P2") in rows and len(rows) == 10
    gold.load_gold(spark, lake, start=D(2024, 5, 1), delete_missing=True)
    assert read_table(spark, lake.gold, GOLD_SCHEMA).where("MES = 5").count() == 1
    assert read_table(spark, lake.gold, GOLD_SCHEMA).count() == 9


def test_gold_range(spark, lake):
    put_silver(spark, lake, [loan(periodo=f"2024-{m:02d}") for m in range(1, 6)])
    assert gold.load_gold(spark, lake, D(2024, 2, 1), D(2024, 3, 1)) == 2


def test_replace_from_removes_vanished_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, "v string, m string")
    write_partitions(frame([("old", "1"), ("old", "2"), ("old", "3")]), path, ["m"])
    for _ in range(2):
        assert replace_from(spark, frame([("new", "2")]), path, "m", "2") == 1
        assert {(r.v, str(r.m)) for r in spark.read.parquet(path).collect()} == {("old", "1"), ("new", "2")}
    assert replace_from(spark, frame([]), path, "m", "2") == 0
    assert spark.read.parquet(path).count() == 1


def test_refresh_runs_all_steps_and_reports_quality(spark, lake):
    land(lake.loans_landing, "2024-01-10", [landing_line(), landing_line(periodo="x", entidad="E9")])
    bronze.load_loans(spark, lake)
    assert refresh.run_refresh(spark, lake) == "WARNING"
    log = audit.read_log(spark, lake.log)
    checks = log.where("process_name = 'data_quality_checks'").first()
    assert ALERT_WORD in checks.message and "períodos inválidos" in checks.message
    full = audit.health(log, "2000-01-01", "full_refresh_%", 20).collect()
    assert full[0].status == "SUCCESS" and full[-1].status == "STARTED"


def test_refresh_from_landing_with_the_newest_macro_capture(spark, lake):
    land(lake.loans_landing, "2024-02-10", [landing_line(), landing_line(periodo="2024-02")])
    columns = ["fecha", "tc_venta", "tc_compra"]
    for capture, rate in (("2024-02-01", "50"), ("2024-03-01", "60")):
        land(lake.macro_landing("tipo_cambio"), capture, [{"fecha": f"2024-0{m}-05", "tc_venta": rate, "tc_compra": "40"} for m in (1, 2)], columns=columns)
        land(lake.macro_landing("inflacion_12m"), capture, [{"Fecha": f"2024-0{m}", "inflacion": "3.5"} for m in (1, 2)], columns=["Fecha", "inflacion"])
        bronze.load_all_macro(spark, lake)
    assert refresh.run_refresh(spark, lake, "landing", "upsert") == "SUCCESS"
    rows = read_table(spark, lake.gold, GOLD_SCHEMA).collect()
    assert {(r.MES, r.INFLACION, r.TC_VENTA, r.TC_COMPRA) for r in rows} == {(1, 3.5, 60.0, 40.0), (2, 3.5, 60.0, 40.0)}
    assert refresh.run_refresh(spark, lake, "landing", "upsert") == "SUCCESS"  # nothing new: same result
    assert read_table(spark, lake.gold, GOLD_SCHEMA).count() == 2


def test_refresh_logs_errors_and_raises(spark, lake):
    with pytest.raises(RuntimeError, match="Pipeline failed"):
        refresh.run_refresh(spark, lake)  # there is no bronze table
    assert "ERROR" in statuses(spark, lake, "bronze_to_silver")


def test_stream_takes_late_captures_and_keeps_the_latest(spark, lake, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        start_silver_stream(spark, lake.loans_landing, lake.silver, checkpoint, files_per_batch=1).awaitTermination()
        return {(r.entidad, r.deuda) for r in read_table(spark, lake.silver, SILVER_SCHEMA).collect()}

    land(lake.loans_landing, "2024-02-01", [landing_line(deuda="2"), landing_line(entidad="Peña", deuda="9")], "iso-8859-1")
    assert run() == {("E1", 2.0), ("Peña", 9.0)}
    land(lake.loans_landing, "2024-01-15", [landing_line(deuda="1"), landing_line(entidad="E2", deuda="5")])
    assert run() == {("E1", 2.0), ("Peña", 9.0), ("E2", 5.0)}
    assert silver.load_from_landing(spark, lake) is None  # the watermark job skips a late capture
    assert run() == {("E1", 2.0), ("Peña", 9.0), ("E2", 5.0)}


def test_csv_exports(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "periodo string, v int")
    export_by_period(rows, str(tmp_path / "m"))
    assert (tmp_path / "m" / "periodo=2024-01").is_dir()
    for day in (D(2024, 1, 1), D(2024, 2, 1)):
        export_capture(rows, str(tmp_path / "c"), day)
    assert sorted(p.name for p in (tmp_path / "c").iterdir()) == ["dt=2024-01-01", "dt=2024-02-01"]


def test_hot_month_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 200000, 1, 8).select((F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50)).alias("m"), F.sha1(F.col("id").cast("string")).alias("v"))
        assert write_partitions(rows, str(tmp_path / "t"), ["m"]) == 200000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "m=1").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200000
