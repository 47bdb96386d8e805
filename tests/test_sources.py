import datetime as dt
import json

import pytest
from helpers import land, landing_line

from sparklake.schemas import LOAN_COLUMNS
from sparklake.sources import files, landing, payloads
from sparklake.sources.countries import COUNTRY_NAMES, country_dimension

D = dt.date


def test_capture_folders(spark, tmp_path):
    base = str(tmp_path)
    for name in ("dt=2024-02-01", "dt=2024-01-15", "dt=bad", "other"):
        (tmp_path / name).mkdir()
    assert files.capture_dates(spark, base) == [D(2024, 1, 15), D(2024, 2, 1)]
    assert files.latest_capture(spark, base) == D(2024, 2, 1)
    assert files.new_captures(spark, base, D(2024, 1, 15)) == [D(2024, 2, 1)]
    assert len(files.new_captures(spark, base, None)) == 2
    with pytest.raises(FileNotFoundError):
        files.latest_capture(spark, str(tmp_path / "other"))


def test_path_date(spark):
    df = spark.createDataFrame([("a/dt=2024-09-14/x.csv",), ("a/x.csv",)], "p string")
    got = [r[0] for r in df.select(landing.path_date(df.p)).collect()]
    assert got == [D(2024, 9, 14), None]


def test_jagged_rows_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,c\n1\n"x,y",2,3\n')
    rows = landing.read_text_csv(spark, str(tmp_path)).collect()
    assert [(r.a, r.b, r.c) for r in rows] == [("1", None, None), ("x,y", "2", "3")]
    assert rows[0].archivo_origen.endswith("a.csv")


def test_typed_scan_with_another_separator(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("País;v\nPerú;1.5\nx;bad\n".encode("latin-1"))
    rows = landing.read_text_csv(spark, str(tmp_path), "ISO-8859-1", ";", "`País` string, v double").collect()
    assert [(r["País"], r.v) for r in rows] == [("Perú", 1.5), ("x", None)]
    auto = landing.read_text_csv(spark, str(tmp_path), sep=";").collect()
    assert [(r["País"], r.v) for r in auto] == [("Perú", "1.5"), ("x", "bad")]


def test_other_header_raises_instead_of_shifting(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        landing.read_text_csv(spark, str(tmp_path)).collect()


def test_both_encodings_in_one_capture(spark, tmp_path):
    base = str(tmp_path)
    land(base, "2024-01-01", [landing_line(entidad="Créditos ñ")], "utf-8", "a.csv")
    land(base, "2024-01-01", [landing_line(entidad="Créditos ñ")], "iso-8859-1", "b.csv")
    rows = landing.read_captures(spark, base, [D(2024, 1, 1)]).collect()
    assert [r.entidad for r in rows] == ["Créditos ñ"] * 2
    assert {r.dt_captura for r in rows} == {D(2024, 1, 1)}
    per_file = landing.rows_per_file(landing.read_captures(spark, base, [D(2024, 1, 1)])).collect()
    assert sorted(r.filas for r in per_file) == [1, 1]


def test_captures_with_different_headers_are_stacked_by_name(spark, tmp_path):
    base = str(tmp_path)
    land(base, "2024-01-01", [{"entidad": "A", "deuda": "1"}], columns=["entidad", "deuda"])
    land(base, "2024-02-01", [{"deuda": "2", "entidad": "B", "__periodo": "2024-01"}], columns=["deuda", "entidad", "__periodo"])
    (tmp_path / "dt=2024-03-01").mkdir()
    rows = landing.read_captures(spark, base, files.capture_dates(spark, base)).collect()
    assert {(r.entidad, r.deuda, r["__periodo"], r.dt_captura.month) for r in rows} == {
        ("A", "1", None, 1), ("B", "2", "2024-01", 2),
    }
    with pytest.raises(FileNotFoundError):
        landing.read_captures(spark, base, [D(2024, 3, 1)])


def test_latest_loaded_period_reads_only_names(spark, tmp_path):
    for day, name in (("2024-01-05", "consolidado_x.csv"), ("2024-03-05", "incremental_x.csv"), ("2024-02-05", "consolidado_y.csv")):
        folder = tmp_path / f"dt={day}"
        folder.mkdir()
        (folder / name).write_text("a\n1\n")
    listing = landing.file_listing(spark, str(tmp_path))
    assert landing.latest_loaded_period(listing).first()[0] == "2024-02"
    assert landing.latest_loaded_period(listing.where("false")).first()[0] is None


def test_rows_after(spark):
    rows = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 2, 1),)], "d date")
    target = spark.createDataFrame([(D(2024, 1, 1),)], "t date")
    assert [r.d for r in landing.rows_after(rows, "d", target, "t", "1900-01-01").collect()] == [D(2024, 2, 1)]
    assert landing.rows_after(rows, "d", target.where("false"), "t", "1900-01-01").count() == 2


def test_loan_payload_shapes(spark):
    bodies = [
        (json.dumps([{"entidad": "E", "deuda": 1.5}]), "2024-01"),
        (json.dumps({"Data": [{"entidad": "F", "deuda": "2"}, {"entidad": "G"}]}), "2024-02"),
        ("", "2024-03"), ("[]", "2024-04"), ('{"Data": null}', "2024-05"), ("not json", "2024-06"), (None, "2024-07"),
    ]
    out = payloads.loan_rows(spark.createDataFrame(bodies, "body string, periodo_solicitado string"))
    assert out.columns == [*LOAN_COLUMNS, "__periodo"]
    got = sorted((r.entidad, r.deuda, r["__periodo"]) for r in out.select("entidad", "deuda", "__periodo").fillna("-").collect())
    assert got == [("E", "1.5", "2024-01"), ("F", "2", "2024-02"), ("G", "-", "2024-02")]


def series(rows, key="DM0"):
    return json.dumps({"results": [{"result": {"data": {"dsr": {"DS": [{"PH": [{"X": 1, key: [{"C": r} for r in rows]}]}]}}}}]})


def test_series_payloads(spark):
    ms = 1704067200000
    body = series([[ms, 58.2], [58.2, ms], [1, 2], [5], [ms, "x"]], "DM3")
    df = spark.createDataFrame([(body,)], "body string")
    day = dt.datetime(2024, 1, 1)
    assert [(r.fecha, r.valor) for r in payloads.series_detected(df).collect()] == [(day, 58.2), (day, 58.2)]
    fixed = spark.createDataFrame([(series([[ms, 3.5]]),)], "body string")
    assert payloads.series_fixed(fixed).first().valor == 3.5
    assert payloads.inflation_series(fixed, "X").first().fecha == "2024-01"
    rate = payloads.exchange_series(df).first()
    assert (rate.fecha, rate.tc_compra) == ("2024-01-01", 58.2 * 0.995)


def test_statistics_payload(spark):
    items = [
        {"OBS_VALUE": "5.1", "TIME_PERIOD": "2023", "FREQ": "A", "REF_AREA": "DOM"},
        {"OBS_VALUE": "n/a", "TIME_PERIOD": "2023", "FREQ": "Z", "REF_AREA": "XXX", "other": 1},
    ]
    stats = payloads.statistics_rows(spark.createDataFrame([(json.dumps({"value": items}),)], "body string"))
    rows = payloads.unemployment_series(stats, country_dimension(spark)).orderBy("pais_id").collect()
    assert [(r.tasa_desempleo, r.periodicidad, r.pais) for r in rows] == [(5.1, "Anual", "Dominican Republic"), (None, "Desconocido", None)]


def test_country_dimension(spark):
    rows = country_dimension(spark).collect()
    assert dict(tuple(r) for r in rows) == COUNTRY_NAMES
