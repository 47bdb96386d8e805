"""Monthly facts as a state that merges: partial sums, and the values that distinct counts count.

The state of some rows has, for each month and province, one row with their sums and one row
for each value of each dimension. States of different rows merge by putting their rows
together, so rows that were counted once are never read again; exact distinct counts come from the
values themselves, whichever loads they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklake.functions.scalars import stable_sum
from sparklake.operators.facts import usable_rows
from sparklake.schemas import FACT_DIMENSIONS, FACT_SUMS

PART = "periodo_ym"
_GROUP = ["periodo_date", "provincia"]
_COUNTED = {"cantidadCredito": T.LongType()}  # the others are amounts
STATE_SCHEMA = T.StructType(
    [
        T.StructField("periodo_date", T.DateType()),
        T.StructField("provincia", T.StringType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("valor", T.StringType()),
        *[T.StructField(source, _COUNTED.get(source, T.DoubleType())) for source, _ in FACT_SUMS],
        T.StructField(PART, T.LongType()),
    ]
)


def fact_state(silver: DataFrame) -> DataFrame:
    """The state of these rows.

    Grouping sets expand each row once for the sums and once for each dimension and combine
    before the shuffle, so a hot province sends as many rows a task as it has values.
    """
    rows = usable_rows(silver)
    none = F.lit(None).cast("string")
    alone = F.grouping_id() == 2 ** len(FACT_DIMENSIONS) - 1  # all dimensions are grouped away
    named, value = none, none
    for dimension in FACT_DIMENSIONS:
        mine = F.grouping(dimension) == 0
        named, value = F.when(mine, F.lit(dimension)).otherwise(named), F.when(mine, F.col(dimension)).otherwise(value)
    sums = [F.when(alone, F.sum(F.coalesce(F.col(s), F.lit(0)))).cast(STATE_SCHEMA[s].dataType).alias(s) for s, _ in FACT_SUMS]
    grouped = rows.groupingSets([_GROUP, *[[*_GROUP, d] for d in FACT_DIMENSIONS]], *_GROUP, *FACT_DIMENSIONS).agg(
        named.alias("dimension"), value.alias("valor"), *sums
    )
    month = (F.year("periodo_date") * 100 + F.month("periodo_date")).cast("bigint")
    kept = grouped.where(F.col("dimension").isNull() | F.col("valor").isNotNull())  # NULL is no value to count
    return kept.withColumn(PART, month).select(*STATE_SCHEMA.fieldNames())


def facts_of_state(state: DataFrame, scales: dict[str, int] | None = None) -> DataFrame:
    """The same columns as ``facts.monthly_facts``, from any number of states put together."""
    scales = scales or {}
    once = state.groupBy(*_GROUP, "dimension", "valor").agg(*[F.sum(s).alias(s) for s, _ in FACT_SUMS])
    grouped = once.groupBy("periodo_date", F.col("provincia").alias("PROVINCIA")).agg(
        *[stable_sum(F.col(s), scales.get(s)).alias(g) for s, g in FACT_SUMS],
        *[F.count_if(F.col("dimension") == d).cast("double").alias(d.upper()) for d in FACT_DIMENSIONS],
    )
    return grouped.withColumns(
        {
            "ANIO": F.year("periodo_date").cast("bigint"),
            "MES": F.month("periodo_date").cast("bigint"),
            "PD_AGREGADA": F.lit(1).cast("bigint"),
        }
    )
