"""Folder-level metadata through the Hadoop file system: no file is opened."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote (a staging folder or a vanished partition)."""
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that readers see as a whole: under a hidden name first, then renamed."""
    fs, target = _file_system(spark, path)
    hidden = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.part")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(hidden, target):
        raise OSError(f"{path} is not written")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, target = _file_system(spark, path)
    reader = spark.sparkContext._jvm.java.io.BufferedReader(
        spark.sparkContext._jvm.java.io.InputStreamReader(fs.open(target), "UTF-8")
    )
    try:
        return "\n".join(iter(reader.readLine, None))
    finally:
        reader.close()


def partition_key(spark: SparkSession, table: str) -> str:
    """The column that the folders of a table are named by."""
    fs, path = _file_system(spark, table)
    names = (s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())
    return next(n.split("=")[0] for n in names if "=" in n)


def partition_files(spark: SparkSession, table: str, key: str) -> list[tuple[str, str]]:
    """(value, name) of the files in the ``key=value`` folders of a table."""
    fs, pattern = _file_system(spark, f"{table}/{key}=*/*")
    found = [status.getPath() for status in fs.globStatus(pattern) or []]
    return [(p.getParent().getName()[len(key) + 1 :], p.getName()) for p in found if p.getName()[0] not in "._"]


def delete_matching(spark: SparkSession, table: str, pattern: str, depth: int = 1) -> int:
    """Remove a partitioned table's files whose names match; returns how many there were."""
    fs, path = _file_system(spark, f"{table}{'/*' * depth}/{pattern}")
    found = fs.globStatus(path) or []
    for status in found:
        fs.delete(status.getPath(), False)
    return len(found)


def partition_values(spark: SparkSession, base: str, key: str) -> list[str]:
    """Values of the ``key=value`` folders directly below ``base``, unsorted.

    One listing of one folder. Deriving the same from the rows would read every file.
    """
    fs, hadoop_path = _file_system(spark, base)
    if not fs.exists(hadoop_path):
        return []
    prefix = f"{key}="
    names = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]
    return [n[len(prefix):] for n in names if n.startswith(prefix)]


def capture_dates(spark: SparkSession, base: str, key: str = "dt") -> list[dt.date]:
    """Capture dates of a landing folder, oldest first; ``odd_folders`` names the others."""
    return sorted(filter(None, map(_date, partition_values(spark, base, key))))


def odd_folders(spark: SparkSession, base: str, key: str = "dt") -> list[str]:
    """``key=`` folders whose value is no date: another form, or a day that does not exist."""
    return sorted(v for v in partition_values(spark, base, key) if _date(v) is None)


def _date(text: str) -> dt.date | None:
    try:
        return dt.date.fromisoformat(text) if re.fullmatch(r"\d{4}-\d{2}-\d{2}", text) else None
    except ValueError:
        return None


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Files directly in ``folder`` that Spark would read."""
    fs, hadoop_path = _file_system(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    found = [s.getPath() for s in fs.listStatus(hadoop_path) if s.isFile() and s.getLen()]
    return sorted(p.toString() for p in found if p.getName()[0] not in "._")


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file, its bytes read one to one as characters."""
    jvm = spark.sparkContext._jvm
    fs, hadoop_path = _file_system(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf()).getCodec(hadoop_path)
    stream = fs.open(hadoop_path)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "ISO-8859-1"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def latest_capture(spark: SparkSession, base: str, key: str = "dt") -> dt.date:
    dates = capture_dates(spark, base, key)
    if not dates:
        raise FileNotFoundError(f"no {key}=YYYY-MM-DD folder below {base}")
    return dates[-1]


def new_captures(
    spark: SparkSession, base: str, watermark: dt.date | None, key: str = "dt"
) -> list[dt.date]:
    """Capture dates after ``watermark`` (all of them for an empty target)."""
    return [d for d in capture_dates(spark, base, key) if watermark is None or d > watermark]
