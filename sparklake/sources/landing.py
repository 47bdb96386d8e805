"""Landing CSV scans: all text, header checked, encoding repaired, lineage kept."""

from __future__ import annotations

import datetime as dt
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklake.functions.encoding import utf8_or_latin1, utf8_or_latin1_name
from sparklake.sources import files
from sparklake.sources.headers import by_header

SOURCE_FILE = "archivo_origen"
CAPTURE_DATE = "dt_captura"
_PATH_DATE = r"/dt=(\d{4}-\d{2}-\d{2})/"


def path_date_text(path: Column) -> Column:
    """The ``dt=`` value inside a file path; NULL where the path has none."""
    return F.nullif(F.regexp_extract(path, _PATH_DATE, 1), F.lit(""))


def path_date(path: Column) -> Column:
    return path_date_text(path).cast("date")


def csv_reader(spark, encoding: str = "UTF-8", sep: str = ","):
    """Options shared by batch and stream scans of landing files.

    A header that differs from the expected one raises instead of shifting columns, and a
    row with too few fields gets NULLs at its end.
    """
    return (
        spark.option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("multiLine", False)
        .option("inferSchema", False)
        .option("enforceSchema", False)
    )


def read_text_csv(
    spark: SparkSession,
    paths: str | list[str],
    encoding: str = "auto",
    sep: str = ",",
    schema=None,
) -> DataFrame:
    """CSV scan, all text unless ``schema`` says otherwise, with the source file beside it.

    ``encoding="auto"`` reads bytes one to one and decodes every value as UTF-8 where it
    is valid UTF-8 and as ISO-8859-1 otherwise, in the same pass over the data.
    """
    auto = encoding == "auto"
    reader = csv_reader(spark.read, "ISO-8859-1" if auto else encoding, sep)
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.csv(paths)
    lineage = F.col("_metadata.file_path").alias(SOURCE_FILE)
    if not auto:
        return raw.select("*", lineage)
    decoded = [
        (utf8_or_latin1(F.col(f"`{c}`")) if dtype == "string" else F.col(f"`{c}`")).alias(utf8_or_latin1_name(c))
        for c, dtype in raw.dtypes
    ]
    return raw.select(*decoded, lineage)


def read_captures(
    spark: SparkSession, base: str, dates: list[dt.date], encoding: str = "auto"
) -> DataFrame:
    """Rows of the given ``dt=`` folders, with the date taken from the file path."""
    folders = [f"{base}/dt={day.isoformat()}" for day in dates]
    with ThreadPoolExecutor(8) as pool:
        paths = [p for found in pool.map(lambda f: files.data_files(spark, f), folders) for p in found]
    if not paths:
        raise FileNotFoundError(f"no files in the captures {dates} of {base}")
    return read_files(spark, paths, encoding)


def read_files(spark: SparkSession, paths: list[str], encoding: str = "auto") -> DataFrame:
    """Rows of landing files, whose columns and encodings may differ, with their capture date.

    Files with the same header line are scanned together and the scans are stacked by the
    names of their columns. One job on the executors reads the first lines. The date of a single
    capture is a constant, which no row has to find in its path.
    """
    raw = concat_pieces([read_text_csv(spark, same, encoding) for same in by_header(spark, paths)])
    days = {found[1] if (found := re.search(_PATH_DATE, p)) else None for p in paths}
    one = days.pop() if len(days) == 1 else None
    return raw.withColumn(CAPTURE_DATE, F.lit(dt.date.fromisoformat(one)) if one else path_date(F.col(SOURCE_FILE)))


def concat_pieces(pieces: list[DataFrame]) -> DataFrame:
    """Stack frames whose columns differ; what a piece lacks becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)


def rows_per_file(df: DataFrame, file_col: str = SOURCE_FILE) -> DataFrame:
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("filas"))


def read_partitioned(spark: SparkSession, base: str, view: str | None = None) -> DataFrame:
    """A Parquet layer with its folder keys as columns, optionally named for SQL."""
    df = spark.read.option("basePath", base).parquet(base)
    if view:
        df.createOrReplaceTempView(view)
    return df


def file_listing(spark: SparkSession, base: str) -> DataFrame:
    """One row per file below ``base``; only the paths are read, never the contents."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    return found.select("path")


def latest_loaded_period(listing: DataFrame, path: str = "path") -> DataFrame:
    """Highest YYYY-MM among the ``dt=`` folders of consolidated CSV files (one row)."""
    consolidated = listing.where(F.col(path).contains("consolidado") & F.col(path).contains(".csv"))
    captured = F.regexp_extract(path, r"(?:^|/)dt=([^/]*)", 1)
    period = F.nullif(F.substring(captured, 1, 7), F.lit(""))
    return consolidated.agg(F.max(period).alias("ultimo_periodo"))


def latest_rows(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest ``date_col``; the maximum is a scalar subquery, not a collect."""
    newest = df.select(date_col).agg(F.max(date_col).alias("_newest"))
    return df.where(F.col(date_col) == newest.scalar())


def rows_after(df: DataFrame, date_col: str, target: DataFrame, target_col: str, default: str) -> DataFrame:
    """Rows newer than the target's high-water mark, or than ``default`` when it is empty."""
    mark = target.agg(F.coalesce(F.max(target_col), F.lit(default).cast("date")).alias("_mark"))
    return df.where(F.col(date_col) > mark.scalar())
