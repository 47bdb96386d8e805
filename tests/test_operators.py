import datetime as dt
import random

import pytest
from helpers import loan, silver_frame
from pyspark.sql import functions as F

from sparklake.operators import alerts, dedup, facts, macro, merge, normalize, quality, risk
from sparklake.operators.cleaning import bronze_columns, silver_rows, with_quality_flags
from sparklake.schemas import EXPECTED_COLUMNS, GOLD_SCHEMA, LOAN_COLUMNS, SILVER_KEY

D = dt.date


def test_flags(spark):
    rows = [(-1.0, 0.0, 0.0), (None, -1.0, 0.0), (None, None, None), (0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "deudaCapital double, deudaVencida double, deuda double").withColumns(
        {"periodo": F.lit("2024-01"), "periodo_date": F.lit(D(2024, 1, 1))}
    )
    assert [r.flg_importe_negativo for r in with_quality_flags(df).collect()] == [1, 1, 0, 0]
    months = spark.createDataFrame(
        [(None, "x"), (D(2024, 1, 1), ""), (D(2024, 1, 1), "2024-01"), (D(2024, 1, 1), None)],
        "periodo_date date, periodo string",
    ).withColumns({c: F.lit(0.0) for c in ("deudaCapital", "deudaVencida", "deuda")})
    assert [r.flg_periodo_invalido for r in with_quality_flags(months).collect()] == [1, 1, 0, 1]


def test_silver_rows_from_typed_and_text_columns(spark):
    text = spark.createDataFrame([tuple("$1,5" if c == "deuda" else None for c in LOAN_COLUMNS)], ", ".join(f"{c} string" for c in LOAN_COLUMNS))
    text = text.withColumns({"periodo": F.lit("2024/03"), "dt_captura": F.lit("2024-04-01")})
    row = silver_rows(text, "strict", ("%Y-%m", "%Y/%m")).first()
    assert (row.deuda, row.deudaCapital, row.periodo_ym, row.dt_captura) == (15.0, None, 202403, D(2024, 4, 1))
    assert silver_rows(text, "lenient").first().deudaCapital == 0.0
    typed = silver_frame(spark, [loan()])
    again = silver_rows(typed).first()
    assert again.deudaCapital == 100.0 and again.cantidadCredito == 2


def test_bronze_columns(spark):
    raw = spark.createDataFrame([(" 2024-02 ", "7", "1.0", "x")], "periodo string, cantidadCredito string, cantidadPlasticos string, deuda string")
    row = bronze_columns(normalize.align_columns(raw, EXPECTED_COLUMNS)).first()
    assert (row.periodo, row.anio, row.mes, row.cantidadCredito, row.cantidadPlasticos, row.deuda) == (
        "2024-02", 2024, 2, 7, 1, None,  # a fraction is cut off, as the described cast does
    )


def test_latest_per_key_prefers_newer_and_groups_nulls(spark):
    df = silver_frame(
        spark,
        [
            loan(deuda=1.0, dt_captura=D(2024, 1, 1)),
            loan(deuda=2.0, dt_captura=D(2024, 2, 1)),
            loan(entidad=None, deuda=3.0),
            loan(entidad=None, deuda=4.0),
        ],
    )
    got = {(r.entidad, r.deuda) for r in dedup.latest_per_key(df).collect()}
    assert got == {("E1", 2.0), (None, 3.0)}


def test_latest_per_key_does_not_depend_on_order_and_survives_a_hot_key(spark):
    rng = random.Random(7)
    rows = [loan(entidad="hot" if i % 3 == 0 else f"E{i % 50}", deuda=float(rng.randrange(1000)),
                 sector=str(rng.randrange(9)), dt_captura=D(2024, 1, 1 + rng.randrange(3))) for i in range(900)]
    first = {tuple(r) for r in dedup.latest_per_key(silver_frame(spark, rows)).collect()}
    rng.shuffle(rows)
    assert {tuple(r) for r in dedup.latest_per_key(silver_frame(spark, rows).repartition(7)).collect()} == first
    assert len(first) == len({tuple(r[k] for k in SILVER_KEY) for r in rows})


def test_latest_per_key_limits_ranks_before_the_shuffle(spark):
    plan = dedup.latest_per_key(silver_frame(spark, [loan()]))._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_monthly_facts_and_ratios(spark):
    df = silver_frame(
        spark,
        [
            loan(), loan(entidad="E2", genero=None, deudaCapital=None), loan(flg_periodo_invalido=1, deuda=9e9),
            loan(provincia=None), loan(periodo="2024-02", deudaCapital=0.0, genero=None),
        ],
    )
    rows = {r.periodo_date: r for r in facts.with_ratios(facts.monthly_facts(facts.usable_rows(df))).collect()}
    jan, feb = rows[D(2024, 1, 1)], rows[D(2024, 2, 1)]
    assert (jan.DEUDACAPITAL, jan.DEUDA, jan.ENTIDAD, jan.GENERO, jan.CANTIDADCREDITO) == (100.0, 220.0, 2.0, 1.0, 4)
    assert jan.TASA_MORA == 0.2
    assert (feb.GENERO, feb.TASA_MORA) == (0.0, 0.0)


def test_gold_rows_without_macro(spark):
    empty = spark.createDataFrame([], "periodo_date date, inflacion double")
    rates = spark.createDataFrame([(D(2024, 1, 1), 58.0, None)], "periodo_date date, tc_venta double, tc_compra double")
    out = facts.gold_rows(silver_frame(spark, [loan()]), empty, rates)
    assert out.schema.fieldNames() == GOLD_SCHEMA.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in GOLD_SCHEMA]
    row = out.first()
    assert (row.INFLACION, row.TC_VENTA, row.TC_COMPRA) == (0.0, 58.0, 0.0)


def test_facts_equal_silver_totals(spark):
    rng = random.Random(3)
    rows = [loan(provincia="P0" if i % 3 else f"P{i % 5}", deuda=float(rng.randrange(1, 99)), periodo=f"2024-{1 + i % 4:02d}") for i in range(400)]
    total = facts.monthly_facts(silver_frame(spark, rows)).agg(F.sum("DEUDA")).first()[0]
    assert total == sum(r["deuda"] for r in rows)


def test_lookback_start(spark):
    gold = spark.createDataFrame([(D(2024, 3, 1),)], "periodo_date date")
    days = spark.createDataFrame([(D(2024, 1, 1),), (D(2023, 12, 31),)], "d date")
    kept = days.where(F.col("d") >= facts.lookback_start(gold, 2, "2012-01-01")).collect()
    assert [r.d for r in kept] == [D(2024, 1, 1)]
    assert days.where(F.col("d") >= facts.lookback_start(gold.where("false"), 2, "2012-01-01")).count() == 2


def test_macro_shapes(spark):
    wide = spark.createDataFrame([("2024-01-02", "58", "57"), ("2024-01-03", "60", "x")], "fecha string, tc_venta string, tc_compra string")
    long = macro.canonical_macro(wide, "tipo_cambio")
    assert long.count() == 4
    row = macro.monthly_rates(long).first()
    assert (row.periodo_date, row.tc_venta, row.tc_compra) == (D(2024, 1, 1), 59.0, 57.0)
    extracted = spark.createDataFrame([("2024-01", "3.5", "DO")], "Fecha string, inflacion string, pais string")
    assert macro.monthly_mean(macro.canonical_macro(extracted, "inflacion_12m")).first().inflacion == 3.5
    jobs = spark.createDataFrame([("5.1", "2023", "Anual", "DOM", "x")], "tasa_desempleo string, anio string, periodicidad string, pais_id string, pais string")
    assert macro.canonical_macro(jobs, "desempleo_imf").first().fecha == "2023"
    canonical = spark.createDataFrame([("2024-01-05", "DO", "4", None)], "fecha string, pais string, inflacion_anual string, indice_base string")
    assert macro.monthly_mean(macro.canonical_macro(canonical, "inflacion_12m"), since="2024-02-01").count() == 0


def gold_rates(spark, rates, province="P1"):
    rows = [(D(2024, m, 1), 2024, m, province, r, 3.0) for m, r in rates]
    return spark.createDataFrame(rows, "periodo_date date, ANIO bigint, MES bigint, PROVINCIA string, TASA_MORA double, ENTIDAD double")


def test_alert_trend_and_warm_up(spark):
    gold = gold_rates(spark, [(1, 0.1), (2, 0.2), (3, 0.2), (4, 0.1)])

    def trends(*args):
        return [r.tendencia_mora for r in alerts.alert_rows(gold, *args).orderBy("anio", "mes").collect()]

    assert trends() == ["ESTABLE", "SUBIENDO", "ESTABLE", "BAJANDO"]
    assert trends(D(2024, 4, 1), False) == ["ESTABLE"]
    assert trends(D(2024, 4, 1), True) == ["BAJANDO"]
    row = alerts.alert_rows(gold).first()
    assert (row.entidades_afectadas, row.entidades_total) == (1, 3)


@pytest.mark.parametrize(("rate", "level"), [(0.15, "MEDIO"), (0.1501, "ALTO"), (0.08, "BAJO"), (0.0801, "MEDIO")])
def test_alert_level(spark, rate, level):
    assert spark.range(1).select(alerts.alert_level(F.lit(rate))).first()[0] == level


def test_upserted_is_idempotent(spark):
    target = spark.createDataFrame([("m1", "A", 1), ("m2", "A", 1)], "m string, p string, v int")
    source = spark.createDataFrame([("m2", "A", 2), ("m2", "B", 2)], "m string, p string, v int")
    once = merge.upserted(target, source, ["m", "p"])
    want = {("m1", "A", 1), ("m2", "A", 2), ("m2", "B", 2)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in merge.upserted(once, source, ["m", "p"]).collect()} == want


def test_range_replaced(spark):
    target = spark.createDataFrame([(D(2024, m, 1), "old") for m in (1, 2, 3)], "d date, v string")
    fresh = spark.createDataFrame([(D(2024, 2, 1), "new")], "d date, v string")
    got = {(r.d.month, r.v) for r in merge.range_replaced(target, fresh, F.col("d"), D(2024, 2, 1)).collect()}
    assert got == {(1, "old"), (2, "new")}


def test_quality_checks_and_verdict(spark):
    silver = silver_frame(spark, [loan(), loan(periodo="2024-02"), loan(periodo="", periodo_date=None, flg_periodo_invalido=1), loan(provincia=None, flg_importe_negativo=1)])
    gold = spark.createDataFrame([(D(2024, 1, 1), "P1", 0.0), (D(2019, 1, 1), "P1", 0.0)], "periodo_date date, PROVINCIA string, INFLACION double")
    counts = quality.check_counts(silver, gold)
    row = counts.first()
    assert (row.periodos_invalidos, row.importes_negativos, row.claves_silver, row.claves_gold) == (1, 1, 2, 2)
    assert (row.diferencia_claves, row.sin_inflacion) == (0, 1)
    result = quality.verdict(counts).first()
    assert result.status == "WARNING" and result.message.count("ALERTA") == 3
    clean = quality.verdict(counts.select(*[F.lit(0).alias(c) for c in quality.MESSAGES])).first()
    assert (clean.status, clean.message) == ("SUCCESS", quality.ALL_PASSED)
    at_limit = counts.select(*[F.lit(100 if c == "diferencia_claves" else 0).alias(c) for c in quality.MESSAGES])
    assert quality.verdict(at_limit).first().status == "SUCCESS"


def test_quality_checks_on_empty_tables(spark):
    silver = silver_frame(spark, [loan()]).where("false")
    gold = spark.createDataFrame([], "periodo_date date, PROVINCIA string, INFLACION double")
    row = quality.check_counts(silver, gold).first()
    assert [row[c] for c in quality.MESSAGES] == [0, 0, 0, 0]


def test_normalize_helpers(spark):
    df = spark.createDataFrame([("1", "E", "2024-05")], "extra string, entidad string, __periodo string")
    assert normalize.align_columns(df, ["entidad", "region"]).columns == ["entidad", "region"]
    assert normalize.preferred_order(df).columns == ["entidad", "extra", "__periodo"]
    assert normalize.fallback_period(df).first().periodo == "2024-05"
    assert normalize.only_category(df).count() == 1
    kinds = spark.createDataFrame([("CRÉDITOS hipotecarios",), ("otros",), (None,)], "tipoCartera string")
    assert normalize.only_category(kinds).count() == 1
    gaps = spark.createDataFrame([("", "p"), (None, "p"), ("e", None)], "entidad string, provincia string")
    assert [r.entidad for r in normalize.require_fields(gaps, ["entidad", "provincia"]).collect()] == [""]


def test_moving_statistics_follow_the_calendar(spark):
    df = spark.createDataFrame([(D(2023, 1, 1), 1.0), (D(2023, 12, 1), 3.0), (D(2024, 2, 1), 5.0)], "periodo_date date, v double")
    rows = {r.periodo_date: r for r in risk.moving_statistics(df, "v").collect()}
    assert set(rows) == {D(2023, 1, 1), D(2023, 12, 1), D(2024, 2, 1)}
    assert (rows[D(2023, 12, 1)].media_movil, rows[D(2023, 12, 1)].meses) == (2.0, 2)
    assert (rows[D(2024, 2, 1)].media_movil, rows[D(2024, 2, 1)].meses) == (4.0, 2)


def test_evolution_skips_missing_months(spark):
    df = spark.createDataFrame([("P", D(2023, 1, 1), 10.0), ("P", D(2024, 1, 1), 15.0), ("P", D(2024, 3, 1), 30.0)], "k string, periodo_date date, v double")
    rows = {r.periodo_date: r for r in risk.evolution(df, "v", ["k"]).collect()}
    assert rows[D(2024, 1, 1)].variacion_anual == 0.5
    assert rows[D(2024, 3, 1)].variacion_mensual is None
