"""Clustered files: all rows stay, and a filter on either column needs few files."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sparklake.sinks import clustering


def needed(path, column, low, high):
    """The share of files whose statistics allow a value between the limits."""
    spans = []
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        spans.append((min(s.min for s in stats), max(s.max for s in stats)))
    return sum(a <= high and b >= low for a, b in spans) / len(spans)


def test_a_filter_on_either_column_reads_a_quarter_of_the_files(spark, tmp_path):
    df = spark.range(20_000).select(
        "id",
        F.format_string("p%04d", F.pmod(F.xxhash64("id"), F.lit(1000))).alias("province"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2000)).cast("int")).alias("day"),
    )
    path = str(tmp_path / "t")
    clustering.write_clustered(df, path, ["province", "day"], 64)
    back = spark.read.parquet(path)
    assert back.count() == 20_000 and back.exceptAll(df).count() == 0
    assert needed(path, "province", "p0500", "p0500") <= 0.25
    assert needed(path, "day", dt.date(2021, 6, 1), dt.date(2021, 6, 3)) <= 0.25


def test_nulls_ties_and_empty_tables(spark, tmp_path):
    schema = "province string, n long"
    for i, rows in enumerate([[], [(None, None)] * 3, [("a", 1)] * 50 + [(None, 2), ("", None), ("é", -5)]]):
        path = str(tmp_path / f"t{i}")
        clustering.write_clustered(spark.createDataFrame(rows, schema), path, ["province", "n"], 4)
        back = spark.read.schema(schema).parquet(path)
        assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
