"""Table changes as plain selects: upsert by key, replace a date range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upserted(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``source``, and the rows of ``target`` whose key ``source`` does not have.

    A NULL in a key matches nothing. ``source`` must hold each key once. A full outer join
    evaluates ``source`` a single time, and uses the partitioning an aggregation by the
    same key left behind.
    """
    columns = source.columns
    old = target.select(*key, F.struct(*columns).alias("_old"))
    new = source.select(*key, F.struct(*columns).alias("_new"))
    joined = old.join(new, key, "full_outer")
    return joined.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")


def range_replaced(target: DataFrame, fresh: DataFrame, row_date: Column, start) -> DataFrame:
    """``target`` before ``start``, plus ``fresh`` from ``start`` on."""
    kept = target.where(row_date < F.lit(start).cast("date"))
    return kept.unionByName(fresh)
