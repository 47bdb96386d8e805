"""Latest row per business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparklake.schemas import SILVER_KEY

SPREAD = 4  # tasks that share a value of a table's partition column, at least


def latest_per_key(
    df: DataFrame, key: list[str] | None = None, order_by: str = "dt_captura"
) -> DataFrame:
    """Keep one row per key: the newest, and among equals the one that sorts first.

    NULLs in the key count as equal. The tie-break runs over all other columns, so the
    result does not depend on file order. Spark plans a rank limit of 1 on both sides of
    the shuffle, so a key that holds most of the rows sends one row per input task.
    """
    key = list(key or SILVER_KEY)
    rest = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in {*key, order_by}]
    window = W.partitionBy(*key).orderBy(F.col(order_by).desc_nulls_last(), *rest)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def spread(df: DataFrame, key: list[str]) -> Column:
    """A number by hash of ``key``, for a few tasks to share each value of a partition column.

    More shuffle partitions, as larger data needs, let more tasks share a value.
    """
    tasks = max(SPREAD, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)
    return F.pmod(F.xxhash64(*key), F.lit(tasks))


def latest_laid_out(
    df: DataFrame, partition: str, sort_by: list[str], key: list[str] | None = None, order_by: str = "dt_captura"
) -> DataFrame:
    """``latest_per_key`` as the files of a table want it: gathered by ``partition``, sorted by it and ``sort_by``.

    ``key`` must decide ``partition`` and hold ``sort_by``. The rows move once and are sorted once for both,
    where a dedup by the key alone is followed by another shuffle and sort of the write.
    """
    key = list(key or SILVER_KEY)
    ordered = [partition, *sort_by, *[c for c in key if c not in {partition, *sort_by}]]
    dealt = df.withColumn("_spread", spread(df, key)).repartition(partition, "_spread")
    # Spark sees that rows of a window's key are together already if what dealt them is part of that key
    return latest_per_key(dealt, [*ordered, "_spread"], order_by).drop("_spread")
