"""Versions of a table: readers of an old one, files written once, what vacuum takes."""

from pathlib import Path

import pytest
from pyspark.sql import types as T

from sparklake.sinks import snapshots
from sparklake.sinks.tables import drop_partitions, partition_values, read_table, replace_from, swap_partitions, upsert, write_partitions

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()), T.StructField("m", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(spark, path, version=None):
    return sorted(map(tuple, read_table(spark, path, SCHEMA, version).select("k", "v", "m").collect()), key=str)


def put(spark, path, rows):
    return upsert(spark, frame(spark, rows), path, SCHEMA, ["k", "m"], "m")


def written(path):
    return {p.name for p in Path(path).rglob("*.parquet")}


def test_an_old_version_is_read_while_a_new_one_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [("a", 1, "x"), ("b", 2, "x"), ("c", 3, "y")]
    put(spark, path, first)
    old = read_table(spark, path, SCHEMA)  # opened, not yet read
    put(spark, path, [("a", 10, "x"), ("d", 4, "z")])
    assert sorted(map(tuple, old.select("k", "v", "m").collect())) == first
    now = [("a", 10, "x"), ("b", 2, "x"), ("c", 3, "y"), ("d", 4, "z")]
    assert rows_of(spark, path) == now
    known = snapshots.versions(spark, path)
    assert rows_of(spark, path, known[-2]) == first and rows_of(spark, path, known[-1]) == now
    with pytest.raises(ValueError, match="has versions"):
        read_table(spark, path, SCHEMA, 99)


def test_each_partition_is_written_once(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(frame(spark, [("a", 1, "x"), ("c", 3, "y")]), path, ["m"])  # a plain table
    before = written(path)
    swap_partitions(spark, frame(spark, [("a", 5, "x")]), path, SCHEMA, "m")
    new = written(path) - before
    assert len(new) == 1 and before <= written(path) and not Path(f"{path}_merge").exists()
    assert rows_of(spark, path) == [("a", 5, "x"), ("c", 3, "y")]


def test_vacuum_takes_only_what_old_versions_name(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [("a", 0, "x"), ("c", 3, "y")])
    for n in range(1, 7):
        put(spark, path, [("a", n, "x")])
    known = snapshots.versions(spark, path)
    assert len(known) == snapshots.KEEP
    assert [rows_of(spark, path, n)[0] for n in known] == [("a", 4, "x"), ("a", 5, "x"), ("a", 6, "x")]
    assert snapshots.vacuum(spark, path, "m", 1) > 0
    assert rows_of(spark, path) == [("a", 6, "x"), ("c", 3, "y")] == sorted(map(tuple, spark.read.parquet(path).select("k", "v", "m").collect()))


def test_appends_and_removed_partitions_are_versions_too(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [("a", 1, "x"), ("b", 2, "y")])
    write_partitions(frame(spark, [("e", 5, "x")]), path, ["m"], mode="append", prefix="carga-" + "0" * 32)
    assert rows_of(spark, path) == [("a", 1, "x"), ("b", 2, "y"), ("e", 5, "x")]
    snapshots.retract(spark, path, "carga-" + "0" * 32)
    assert rows_of(spark, path) == [("a", 1, "x"), ("b", 2, "y")]
    write_partitions(frame(spark, [("f", 6, "x")]), path, ["m"])
    assert rows_of(spark, path) == [("b", 2, "y"), ("f", 6, "x")]
    replace_from(spark, frame(spark, [("g", 7, "z")]), path, "m", "y")
    assert rows_of(spark, path) == [("f", 6, "x"), ("g", 7, "z")] and sorted(partition_values(spark, path, "m")) == ["x", "z"]
    drop_partitions(spark, path, "m", {"x", "z"})
    assert rows_of(spark, path) == []


def test_a_swap_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [])
    assert rows_of(spark, path) == []
    put(spark, path, [("a", 1, "x"), ("n", 2, None)])
    upsert(spark, frame(spark, [("n", 3, None)]), path, SCHEMA, ["k"], "m")  # a null month is a partition too
    assert rows_of(spark, path) == [("a", 1, "x"), ("n", 3, None)]
