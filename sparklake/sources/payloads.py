"""Landed API responses (one JSON document per row) to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklake.functions.scalars import frequency_label
from sparklake.schemas import LOAN_COLUMNS, REQUESTED_PERIOD

_SERIES_ROOT = "$.results[0].result.data.dsr.DS[0].PH[0]"
_MILLISECONDS_FROM = 1e11  # fixed value: larger numbers are timestamps, smaller ones rates
PURCHASE_FACTOR = 0.995  # fixed value: purchase rate as a share of the sale rate


def _text_struct(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def loan_fields(df: DataFrame, body: str = "body", preferred: list[str] = LOAN_COLUMNS) -> list[str]:
    """``preferred``, then every other field name that occurs in the responses.

    One pass over the responses; one row per distinct name comes back.
    """
    kind = T.ArrayType(T.MapType(T.StringType(), T.StringType()))
    listed = F.from_json(body, kind)
    wrapped = F.from_json(body, T.StructType([T.StructField("Data", kind)]))["Data"]
    rows = df.select(F.explode(F.when(F.col(body).rlike(r"^\s*\["), listed).otherwise(wrapped)).alias("row"))
    names = rows.select(F.explode(F.map_keys("row")).alias("name")).distinct()
    return [*preferred, *sorted({r[0] for r in names.collect()} - {*preferred, REQUESTED_PERIOD})]


def loan_rows(
    df: DataFrame, body: str = "body", periodo: str = "periodo_solicitado", fields: list[str] | None = None
) -> DataFrame:
    """Rows of a loan response: a JSON list, or an object holding the list as ``Data``.

    All fields are kept: the preferred ones first, then those that only some responses
    have, see ``loan_fields``; give ``fields`` to fix the columns. An empty or malformed
    response gives no rows. The requested month goes to ``__periodo``.
    """
    row = _text_struct(loan_fields(df, body) if fields is None else fields)
    listed = F.from_json(body, T.ArrayType(row))
    wrapped = F.from_json(body, T.StructType([T.StructField("Data", T.ArrayType(row))]))
    is_list = F.col(body).rlike(r"^\s*\[")
    rows = F.when(is_list, listed).otherwise(wrapped["Data"])
    return df.select(F.col(periodo).alias(REQUESTED_PERIOD), F.inline(rows)).select(
        *row.fieldNames(), REQUESTED_PERIOD
    )


def loan_variants(df: DataFrame, body: str = "body", periodo: str = "periodo_solicitado") -> DataFrame:
    """Rows of a loan response as VARIANT: one parse keeps every field, whatever its name or depth.

    The response is a list of rows, or an object holding the list as ``Data``. Elements that are
    no objects, and responses that are malformed or empty, give no rows. No pass for names is
    needed: ``variant_columns`` takes fields out, and the rest stays in ``fila``.
    """
    whole = df.select(F.col(periodo).alias(REQUESTED_PERIOD), F.try_parse_json(F.col(body)).alias("_v"))
    listed, wrapped = "_v", "try_variant_get(_v, '$.Data', 'variant')"
    rows = F.coalesce(*[F.expr(f"try_cast({v} AS ARRAY<VARIANT>)") for v in (listed, wrapped)])
    each = whole.select(F.explode(rows).alias("fila"), REQUESTED_PERIOD)
    return each.where(F.schema_of_variant("fila").startswith("OBJECT"))


def variant_columns(rows: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Columns by name: ``(path, type)`` in the row's VARIANT; NULL where it is missing or does not fit."""
    taken = [F.try_variant_get("fila", path, kind).alias(name) for name, (path, kind) in fields.items()]
    return rows.select(*taken, *rows.columns)


def _series_pairs(df: DataFrame, body: str) -> DataFrame:
    """The ``C`` arrays below the first key that starts with DM, one row each.

    As the service nests one series per response, the first result set is read.
    """
    blocks = F.from_json(F.get_json_object(body, _SERIES_ROOT), "map<string,string>")
    block = F.map_values(F.map_filter(blocks, lambda k, _: k.startswith("DM")))
    rows = F.from_json(F.try_element_at(block, F.lit(1)), "array<struct<C:array<string>>>")
    return df.select(F.inline(rows))


def _item(c: Column, position: int) -> Column:
    return F.try_element_at(c, F.lit(position)).try_cast("double")


def series_fixed(df: DataFrame, body: str = "body") -> DataFrame:
    """Inflation series: every row is ``[milliseconds, value]``."""
    pairs = _series_pairs(df, body)
    return pairs.select(
        F.timestamp_millis(_item(F.col("C"), 1).cast("bigint")).alias("fecha"),
        _item(F.col("C"), 2).alias("valor"),
    )


def series_detected(df: DataFrame, body: str = "body") -> DataFrame:
    """Exchange-rate series: the larger element is the time, the other one the value.

    Rows with fewer than two elements, without a timestamp or without a number are dropped.
    """
    pairs = _series_pairs(df, body)
    first, second = _item(F.col("C"), 1), _item(F.col("C"), 2)
    ms = F.when(first > _MILLISECONDS_FROM, first).when(second > _MILLISECONDS_FROM, second)
    value = F.when(first > _MILLISECONDS_FROM, second).when(second > _MILLISECONDS_FROM, first)
    return (
        pairs.where(F.size("C") >= 2)
        .select(F.timestamp_millis(ms.cast("bigint")).alias("fecha"), value.alias("valor"))
        .na.drop()
    )


def inflation_series(df: DataFrame, country: str, body: str = "body") -> DataFrame:
    rows = series_fixed(df, body)
    return rows.select(
        F.date_format("fecha", "yyyy-MM").alias("fecha"),
        F.col("valor").alias("inflacion"),
        F.lit(country).alias("pais"),
    )


def derived_rates(df: DataFrame, sale: str = "tc_venta") -> DataFrame:
    """The purchase rate is estimated from the sale rate."""
    return df.withColumn("tc_compra", F.col(sale) * PURCHASE_FACTOR)


def exchange_series(df: DataFrame, body: str = "body") -> DataFrame:
    rows = series_detected(df, body)
    return rows.select(
        F.date_format("fecha", "yyyy-MM-dd").alias("fecha"), F.col("valor").alias("tc_venta")
    ).transform(derived_rates)


def statistics_rows(df: DataFrame, body: str = "body") -> DataFrame:
    """Rows of a statistics response; a value that is not a number becomes NULL."""
    item = _text_struct(["OBS_VALUE", "TIME_PERIOD", "FREQ", "REF_AREA"])
    parsed = F.from_json(body, T.StructType([T.StructField("value", T.ArrayType(item))]))
    rows = df.select(F.inline(parsed["value"]))
    return rows.withColumn("OBS_VALUE", F.col("OBS_VALUE").try_cast("double"))


def unemployment_series(stats: DataFrame, countries: DataFrame) -> DataFrame:
    """Statistics rows with readable frequency and country; unknown codes give NULL.

    ``countries`` is a fixed table of under 200 rows, hence the broadcast.
    """
    named = stats.join(F.broadcast(countries), "REF_AREA", "left")
    return named.select(
        F.col("OBS_VALUE").alias("tasa_desempleo"),
        F.col("TIME_PERIOD").alias("anio"),
        frequency_label(F.col("FREQ")).alias("periodicidad"),
        F.col("REF_AREA").alias("pais_id"),
        F.col("País").alias("pais"),
    )
