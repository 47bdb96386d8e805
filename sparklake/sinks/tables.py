"""Partitioned Parquet tables with idempotent writes.

Every overwrite replaces whole partitions (dynamic mode): Spark writes the new files beside
the old ones and swaps folders when the job commits, so lost executors are retried against
unchanged input. Upserts, which read what they replace, make a new version of the table, see
``snapshots``.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklake.operators.dedup import latest_laid_out, latest_per_key
from sparklake.operators.merge import upserted
from sparklake.schemas import SILVER_KEY
from sparklake.session import shared_dir
from sparklake.sinks import snapshots
from sparklake.sources import files


NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder for rows without a value
MERGE_AT = 16  # unmerged loads of a level that become one


def read_table(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The table, or an empty frame with its schema before the first write.

    Of a table with versions it is the newest one, or the one asked for. Of a key that is in several
    unmerged loads of a partition the latest row is kept, see ``add_unmerged``.
    """
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    parts = snapshots.live_parts(spark, path, version)
    if parts is None:
        return reader.parquet(path)
    if not parts:
        return spark.createDataFrame([], schema)
    partition, several = files.partition_key(spark, path), set(snapshots.unmerged(parts))
    merged, rest = [{v: x for v, x in parts.items() if (v in several) == wanted} for wanted in (True, False)]
    frames = [reader.parquet(*snapshots.globs(path, partition, rest))] if rest else []
    if merged:
        frames.append(latest_per_key(reader.parquet(*snapshots.globs(path, partition, merged)), [*SILVER_KEY, partition]))
    return reduce(DataFrame.unionByName, frames)


def partition_values(spark: SparkSession, path: str, partition: str) -> list[str]:
    """The values of the partition column that the table holds, unsorted."""
    parts = snapshots.live_parts(spark, path)
    return files.partition_values(spark, path, partition) if parts is None else list(parts)


def drop_partitions(spark: SparkSession, path: str, partition: str, values: set[str]) -> None:
    """Remove whole partitions: from the next version, or the folders of a plain table."""
    parts = snapshots.live_parts(spark, path)
    if parts is None:
        for value in values:
            files.delete(spark, f"{path}/{partition}={value}")
    elif values & set(parts):
        snapshots.publish(spark, path, {v: loads for v, loads in parts.items() if v not in values})


def told_by(metrics: Observation) -> dict:
    """The metrics of a finished write; none where Spark has found the input empty and skipped it."""
    try:
        return metrics.get
    except Py4JJavaError:
        return {}


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    sort_by: list[str] | None = None,
    mode: str = "overwrite",
    prefix: str | None = None,
    laid_out: bool = False,
) -> int:
    """Write ``df`` partitioned and clustered; returns the number of rows written."""
    return write_told(df, path, partition_by, sort_by, mode, prefix, laid_out)["rows"]


def write_one(df: DataFrame, path: str, partition: str, value) -> int:
    """Replace the one partition that all rows of ``df`` belong to; returns the number of rows written.

    The tasks that make the rows write them as they come. With a constant for the partition column
    Spark neither shuffles nor sorts, so a task holds no more than the row at hand.
    """
    metrics = Observation()
    counted = df.drop(partition).observe(metrics, F.count(F.lit(1)).alias("rows"))
    writer = counted.withColumn(partition, F.lit(value)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    return told_by(metrics).get("rows", 0)


def write_told(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    sort_by: list[str] | None,
    mode: str,
    prefix: str | None = None,
    laid_out: bool = False,
) -> dict:
    """The write itself; returns the row count and the values of the first partition column.

    With ``prefix`` the names of the files begin with it, as the tasks write them. A table
    with versions gets a new one, in which the files take the place of those of their partitions
    (``overwrite``) or stand beside them.

    The rebalance keeps one partition value together as long as it is small and splits it
    over several tasks when it is not, so a month that holds a third of the rows is
    written by many tasks. Rows that are ``laid_out``, see ``latest_laid_out``, are written as they
    come. Rows and partition values (as many as the table has folders) are gathered in the same pass.
    """
    metrics = Observation()
    first = F.coalesce(F.col(f"`{partition_by[0]}`").cast("string"), F.lit(NULL_FOLDER))
    if not laid_out:
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
        if sort_by:
            df = df.sortWithinPartitions(*partition_by, *sort_by)
    counted = df.observe(
        metrics, F.count(F.lit(1)).alias("rows"), F.collect_set(first).alias("values")
    )
    parts = snapshots.live_parts(df.sparkSession, path)
    if parts is not None:
        prefix = prefix or snapshots.new_prefix()
    writer = counted.write.mode(mode if parts is None else "append").option("partitionOverwriteMode", "dynamic")
    if prefix:
        writer = writer.option("mapreduce.output.basename", prefix)
    writer.partitionBy(*partition_by).parquet(path)
    told = {"rows": 0, "values": []} | told_by(metrics)
    if parts is not None:
        snapshots.publish(df.sparkSession, path, snapshots.changed(parts, told["values"], prefix, mode == "overwrite"))
    return told


def swap_partitions(
    spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType, partition: str, sort_by: list[str] | None = None
) -> None:
    """Replace the partitions that ``rows`` hold, where ``rows`` may read the table itself.

    The new files are written once, beside the old ones, and become the next version. A driver
    that is lost before that leaves the table as it was. Old versions go some swaps later.
    """
    snapshots.taken_over(spark, path, partition)
    if snapshots.live_parts(spark, path) is None:
        snapshots.publish(spark, path, {})
    write_told(rows.select(*schema.fieldNames()), path, [partition], sort_by, "overwrite")
    snapshots.vacuum(spark, path, partition)


def add_unmerged(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    schema: T.StructType,
    partition: str,
    sort_by: list[str] | None = None,
    laid_out: bool = False,
) -> int:
    """Upsert by silver's key, which decides the partition, without reading what the table holds.

    The rows are written once, beside the others, and readers keep the latest row of each key. When
    ``MERGE_AT`` loads have gathered on a level, they become one of the next level, so a row
    is rewritten as often as the number of loads has powers of ``MERGE_AT``, however many months
    each of them touches. Returns the number of rows.
    """
    snapshots.taken_over(spark, path, partition)
    if snapshots.live_parts(spark, path) is None:
        snapshots.publish(spark, path, {})
    rows = rows.select(*schema.fieldNames())
    written = write_told(rows, path, [partition], sort_by, "append", snapshots.unmerged_prefix(), laid_out)
    level = 0
    while True:
        parts = snapshots.live_parts(spark, path)
        loads = {x for held in parts.values() for x in held if snapshots.level_of(x) == level}
        if len(loads) < MERGE_AT:
            break
        some = {v: [x for x in held if x in loads] for v, held in parts.items()}
        reader = spark.read.schema(schema).option("basePath", path)
        old = reader.parquet(*snapshots.globs(path, partition, {v: held for v, held in some.items() if held}))
        once = latest_laid_out(old, partition, sort_by or []).select(*schema.fieldNames())
        write_told(once, path, [partition], sort_by, "append", snapshots.unmerged_prefix(level + 1), True)
        both = snapshots.live_parts(spark, path)
        snapshots.publish(spark, path, {v: [x for x in held if x not in loads] for v, held in both.items()})
        level += 1
    snapshots.vacuum(spark, path, partition)
    return written["rows"]


def settle(spark: SparkSession, path: str, schema: T.StructType, partition: str, sort_by: list[str] | None = None) -> None:
    """Merge the partitions that readers have to merge, so that rows can be put beside them."""
    values = set(snapshots.unmerged(snapshots.live_parts(spark, path) or {}))
    if values:
        value = F.coalesce(F.col(partition).cast("string"), F.lit(NULL_FOLDER))
        swap_partitions(spark, read_table(spark, path, schema).where(value.isin(values)), path, schema, partition, sort_by)


def upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    schema: T.StructType,
    key: list[str],
    partition: str,
    since=None,
    sort_by: list[str] | None = None,
) -> int:
    """Insert or replace rows by ``key`` in the partitions from ``since`` on.

    Only those partitions are read and rewritten. ``source`` must not reach before
    ``since``. Returns the number of rows in ``source``.
    """
    metrics = Observation()
    source = source.observe(metrics, F.count(F.lit(1)).alias("rows"))
    target = read_table(spark, path, schema)
    if since is not None:
        target = target.where(F.col(partition) >= F.lit(since).cast(schema[partition].dataType))
    swap_partitions(spark, upserted(target, source, key), path, schema, partition, sort_by)
    return told_by(metrics).get("rows", 0)


def stage(spark: SparkSession, df: DataFrame, partition_by: list[str]) -> tuple[str, int]:
    """Write ``df`` to a shared folder to cut its lineage; returns the folder and row count."""
    path = shared_dir(spark, "staging")
    return path, write_partitions(df, path, partition_by)


def replace_from(
    spark: SparkSession,
    fresh: DataFrame,
    path: str,
    partition: str,
    start: str,
    sort_by: list[str] | None = None,
    end: str | None = None,
) -> int:
    """Replace all partitions from ``start`` on (to ``end``) by ``fresh``, including those it lacks.

    The partitions ``fresh`` holds are swapped in one job; the others from ``start`` on
    are removed afterwards, so running it again repairs an interrupted run.
    """
    listed = partition_values(spark, path, partition)
    before = {v for v in listed if v >= start and (end is None or v <= end) and v != NULL_FOLDER}
    written = write_told(fresh, path, [partition], sort_by, "overwrite")
    drop_partitions(spark, path, partition, before - set(written["values"]))
    return written["rows"]
