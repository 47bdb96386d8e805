"""Headers read by executors, names written by tasks, mergeable facts, procedures, VARIANT payloads."""

import datetime as dt
import gzip
import json

import pytest
from helpers import land, landing_line, loan, silver_frame

from sparklake.operators import facts, partials
from sparklake.plans import fact_state, gold, procedures, silver
from sparklake.queries import QUERIES
from sparklake.schemas import DASHBOARD_SCHEMA, GOLD_SCHEMA
from sparklake.sinks import ledger
from sparklake.sinks.csv import export_capture
from sparklake.sinks.tables import read_table
from sparklake.sources import files, headers, landing, payloads

D = dt.date
SF = "/root/testdata/sf0.001"


def test_headers_are_read_by_tasks(spark, tmp_path, monkeypatch):
    texts = {
        "a b.csv": b"x,y\n1,2\n", "b.csv": b"x,y\r\n3,4\r\n", "c.csv": b"y,x\n5,6\n", "d%20.csv": b"x,y",
        "e.csv": "﻿x,y\n".encode(), "long.csv": b"x," + b"z" * 9000 + b"\n1,2\n",
    }
    for name, raw in texts.items():
        (tmp_path / name).write_bytes(raw)
    (tmp_path / "f.csv.gz").write_bytes(gzip.compress(b"x,y\n7,8\n"))
    paths = files.data_files(spark, str(tmp_path))
    monkeypatch.setattr(files, "first_line", lambda *_: pytest.fail("the driver opened a file"))
    groups = headers.by_header(spark, paths)
    names = sorted(sorted(p.rsplit("/", 1)[1] for p in g) for g in groups)
    assert names == [["a b.csv", "b.csv", "d%20.csv", "f.csv.gz"], ["c.csv"], ["e.csv"], ["long.csv"]]


def test_headers_of_systems_that_tasks_cannot_open(spark, tmp_path, monkeypatch):
    land(str(tmp_path), "2024-01-01", [landing_line()])
    (path,) = files.data_files(spark, f"{tmp_path}/dt=2024-01-01")
    assert headers._digest("nosuch://host/x.csv") is None and headers._digest(f"{path}.missing") is None
    inside = headers._digest(path)
    line = files.first_line(spark, path)
    assert headers.line_digest(line.encode("latin-1")) == inside
    with pytest.raises(Exception, match="missing"):
        headers.by_header(spark, [f"{path}.missing"])


def test_capture_names_are_written_by_tasks(spark, tmp_path):
    rows = spark.range(100).selectExpr("cast(id AS string) a").repartition(3)
    target = export_capture(rows, str(tmp_path), D(2024, 2, 3))
    names = [p.rsplit("/", 1)[1] for p in files.data_files(spark, target)]
    assert len(names) == 3 and all(n.startswith("consolidado_20240203-") and n.endswith(".csv") for n in names)
    found = landing.latest_loaded_period(landing.file_listing(spark, str(tmp_path))).first()[0]
    assert found == "2024-02"
    export_capture(rows.limit(5), str(tmp_path), D(2024, 2, 3))
    assert spark.read.option("header", True).csv(target).count() == 5


def loans(n, capture, months=("2024-01", "2024-02", "2024-03")):
    return [
        loan(
            periodo=months[i % len(months)], provincia=f"P{i % 2}" if i % 7 else None, entidad=f"E{i % 5}" if i % 3 else None,
            genero="FM"[i % 2], deudaCapital=float(i), deudaVencida=None if i % 4 == 0 else 1.5, dt_captura=capture,
            flg_periodo_invalido=int(i % 11 == 0),
        )
        for i in range(n)
    ]


def facts_of(df):
    key = lambda r: (r["periodo_date"], r["PROVINCIA"])
    return sorted((r.asDict() for r in df.collect()), key=key)


def test_states_merge(spark):
    parts = [loans(40, D(2024, 4, 1)), loans(25, D(2024, 5, 1)), [], loans(40, D(2024, 4, 1))]
    state = partials.fact_state(silver_frame(spark, parts[0]))
    for part in parts[1:]:
        state = state.unionByName(partials.fact_state(silver_frame(spark, part)))
    assert state.schema.simpleString() == partials.STATE_SCHEMA.simpleString()
    whole = facts.monthly_facts(facts.usable_rows(silver_frame(spark, sum(parts, []))))
    assert facts_of(partials.facts_of_state(state)) == facts_of(whole)
    assert partials.facts_of_state(partials.fact_state(silver_frame(spark, []))).collect() == []


def full_gold(spark, lake):
    return facts_of(gold.gold_frame(spark, lake, D(2024, 1, 1)))


def state_gold(spark, lake):
    return facts_of(gold.gold_frame(spark, lake, D(2024, 1, 1), from_state=True))


def test_state_counts_new_loads_alone(spark, lake, monkeypatch):
    silver.store(spark, silver_frame(spark, loans(30, D(2024, 4, 1))), lake.silver)
    assert fact_state.refresh_state(spark, lake) == "append"
    assert fact_state.refresh_state(spark, lake) == "none"
    silver.store(spark, silver_frame(spark, loans(20, D(2024, 5, 1), ("2024-03", "2024-04"))), lake.silver)
    seen = []
    whole = fact_state.fact_state
    monkeypatch.setattr(fact_state, "fact_state", lambda df: whole(seen.append(df.count()) or df))
    assert fact_state.refresh_state(spark, lake) == "append"
    assert seen == [20]  # the first load's 30 rows are not read again
    assert state_gold(spark, lake) == full_gold(spark, lake)
    assert gold.load_gold(spark, lake, D(2024, 1, 1), from_state=True) == len(full_gold(spark, lake))
    # an upsert takes rows away, so all is counted anew
    silver.store(spark, silver_frame(spark, loans(10, D(2024, 6, 1))), lake.silver, "upsert", ["periodo", "provincia"])
    assert fact_state.refresh_state(spark, lake) == "rebuild"
    assert state_gold(spark, lake) == full_gold(spark, lake)
    silver.store(spark, silver_frame(spark, loans(5, D(2024, 7, 1))), lake.silver)
    assert fact_state.refresh_state(spark, lake) == "append"
    assert state_gold(spark, lake) == full_gold(spark, lake)


class LostDriver(Exception):
    pass


@pytest.mark.parametrize("mode", ["append", "rebuild"])
def test_state_after_a_lost_driver(spark, lake, monkeypatch, mode):
    silver.store(spark, silver_frame(spark, loans(30, D(2024, 4, 1))), lake.silver)
    fact_state.refresh_state(spark, lake)
    how = ("append", None) if mode == "append" else ("upsert", ["periodo", "provincia"])
    silver.store(spark, silver_frame(spark, loans(20, D(2024, 5, 1))), lake.silver, *how)

    def lost(*_):
        raise LostDriver

    with monkeypatch.context() as m:
        m.setattr(fact_state.ledger, "commit", lost)
        with pytest.raises(LostDriver):
            fact_state.refresh_state(spark, lake)
    assert fact_state.refresh_state(spark, lake) == mode
    assert state_gold(spark, lake) == full_gold(spark, lake)
    assert ledger.pending(spark, lake.fact_state) == []


def test_dashboard_table(spark, lake):
    silver.store(spark, silver_frame(spark, loans(30, D(2024, 4, 1))), lake.silver)
    gold.load_gold(spark, lake, D(2024, 1, 1))
    rows = read_table(spark, lake.dashboard, DASHBOARD_SCHEMA).collect()
    assert len(rows) == read_table(spark, lake.gold, GOLD_SCHEMA).count() == 6
    gold.refresh_dashboard(spark, lake, D(2024, 3, 1))  # the change of the first month still has one before it
    again = {(r.PROVINCIA, r.MES): r.variacion_mensual for r in read_table(spark, lake.dashboard, DASHBOARD_SCHEMA).collect()}
    assert again == {(r.PROVINCIA, r.MES): r.variacion_mensual for r in rows}
    assert all((v is None) == (k[1] == 1) for k, v in again.items())


def test_procedures_from_sql(spark, lake):
    silver.store(spark, silver_frame(spark, loans(30, D(2024, 4, 1))), lake.silver)
    gold.load_gold(spark, lake, D(2024, 1, 1))
    procedures.define(spark, lake)
    each = spark.sql("SELECT d.since, count(*) FROM VALUES (DATE'2024-01-01'), (DATE'2024-03-01') d(since), LATERAL alerts_since(d.since) GROUP BY ALL")
    assert {r[0]: r[1] for r in each.collect()} == {D(2024, 1, 1): 6, D(2024, 3, 1): 2}
    checks = {r.control: r for r in spark.sql("SELECT * FROM quality_checks()").collect()}
    assert checks["periodos_invalidos"].valor == 3 and not checks["periodos_invalidos"].correcto
    assert checks["diferencia_claves"].limite == 100 and checks["diferencia_claves"].correcto


def test_variant_rows(spark):
    bodies = [
        '[{"a": 1, "n": {"k": [1, {"z": "é"}]}}, {"a": "x"}, null, 7]', '{"Data": [{"b": true}]}', '{"Data": 5}', "[]", "", None,
        '[{"a": 1', json.dumps([{"a": 10**30, "a.b": 2}]),
    ]
    df = spark.createDataFrame([(b, str(i)) for i, b in enumerate(bodies)], "body string, periodo_solicitado string")
    rows = payloads.variant_columns(
        payloads.loan_variants(df), {"a": ("$.a", "bigint"), "z": ("$.n.k[1].z", "string"), "b": ("$.b", "boolean"), "ab": ("$['a.b']", "int")}
    )
    got = [(r["__periodo"], r["a"], r["z"], r["b"], r["ab"]) for r in rows.drop("fila").collect()]
    assert sorted(got, key=str) == sorted([("0", 1, "é", None, None), ("0", None, None, None, None), ("1", None, None, True, None), ("7", None, None, None, 2)], key=str)


def test_variant_query_parses_once(spark):
    plan = QUERIES["json_variant_rows"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
