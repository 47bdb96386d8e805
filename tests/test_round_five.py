"""Loads at size: one capture in place, its date a constant, months without a date pattern."""

from __future__ import annotations

import pytest
from helpers import DAY, land, landing_line
from pyspark.sql import functions as F

from sparklake.functions.periods import FOUR_FORMATS, MACRO_FORMATS, parse_period
from sparklake.plans import bronze
from sparklake.sources.landing import read_captures


def _land_rates(lake, capture: str, files: int, rows: int) -> None:
    import pathlib

    folder = pathlib.Path(lake.macro_landing("inflacion_12m")) / f"dt={capture}"
    folder.mkdir(parents=True)
    for n in range(files):
        lines = [f"2024-{m % 12 + 1:02d},{n}.{m},DO" for m in range(rows)]
        (folder / f"consolidado_{n}.csv").write_text("fecha,inflacion,pais\n" + "\n".join(lines) + "\n")


def test_macro_capture_is_written_by_the_tasks_that_read_it(spark, lake):
    """One capture is one partition value; no task may have to hold and sort all of it."""
    _land_rates(lake, "2024-01-01", 1, 5)
    assert bronze.load_macro(spark, lake, "inflacion_12m") == 5
    _land_rates(lake, "2024-02-01", 4, 50)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert [bronze.load_macro(spark, lake, "inflacion_12m") for _ in range(2)] == [200, 200]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    stored = spark.read.parquet(lake.macro_bronze("inflacion_12m"))
    counts = {r.dt_captura: r["count"] for r in stored.groupBy("dt_captura").count().collect()}
    assert counts == {DAY(2024, 1, 1): 5, DAY(2024, 2, 1): 200}
    new = stored.where("dt_captura = DATE '2024-02-01'")
    assert new.select("archivo_origen").distinct().count() == 4
    assert len([f for f in new.inputFiles() if "2024-02-01" in f]) >= 4


def test_bronze_rows_do_not_parse_their_path_or_a_date_pattern(spark, lake):
    """The date of the one capture is known, and a month is cast: both cost most per row before."""
    land(lake.loans_landing, "2024-02-01", [landing_line(periodo="2024-01"), landing_line(periodo="2024-13")])
    land(lake.loans_landing, "2024-03-01", [landing_line(periodo="2024-2")])
    one = bronze.loans_frame(spark, lake.loans_landing, DAY(2024, 2, 1))
    plan = one._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "regexp_extract" not in plan and "gettimestamp" not in plan
    rows = one.select("periodo", "anio", "mes", "dt_captura").collect()
    assert sorted(map(tuple, rows)) == [("2024-01", 2024, 1, DAY(2024, 2, 1)), ("2024-13", None, None, DAY(2024, 2, 1))]
    both = read_captures(spark, lake.loans_landing, [DAY(2024, 2, 1), DAY(2024, 3, 1)])
    assert sorted(r.dt_captura for r in both.collect()) == [DAY(2024, 2, 1)] * 2 + [DAY(2024, 3, 1)]


@pytest.mark.parametrize(
    ("formats", "text", "day"),
    [
        (FOUR_FORMATS, "2024-1", DAY(2024, 1, 1)), (FOUR_FORMATS, "2024/12", DAY(2024, 12, 1)),
        (FOUR_FORMATS, "3/2024", DAY(2024, 3, 1)), (FOUR_FORMATS, "202402", DAY(2024, 2, 1)),
        (FOUR_FORMATS, "13/2024", None), (FOUR_FORMATS, "2024-00", None), (FOUR_FORMATS, "2024-01-05", None),
        (MACRO_FORMATS, "2024-2-29", DAY(2024, 2, 29)), (MACRO_FORMATS, "2023-02-29", None), (MACRO_FORMATS, "202402", None),
    ],
)
def test_months_of_every_spelling(spark, formats, text, day):
    got = spark.createDataFrame([(text,)], "t string").select(parse_period(F.col("t"), formats).alias("d"))
    assert "gettimestamp" not in got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert got.first().d == day
