"""Month parsing, calendar columns and calendar frames."""

from __future__ import annotations

import datetime as dt
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Accepted spellings of a month: name -> (shape, the same in ISO form). The shape is tested first
# because a failed parse costs a Java exception and a failed match does not. A cast reads the ISO form
# several times faster than a date pattern.
_SPELLINGS = {
    "%Y-%m": (r"^\d{4}-\d{1,2}$", lambda c: c),
    "%Y/%m": (r"^\d{4}/\d{1,2}$", lambda c: F.translate(c, "/", "-")),
    "%m/%Y": (r"^\d{1,2}/\d{4}$", lambda c: F.concat(F.substring(c, -4, 4), F.lit("-"), F.substring_index(c, "/", 1))),
    "%Y%m": (r"^\d{6}$", lambda c: F.concat(F.substring(c, 1, 4), F.lit("-"), F.substring(c, 5, 2))),
    "%Y-%m-%d": (r"^\d{4}-\d{1,2}-\d{1,2}$", lambda c: c),
}
ONE_FORMAT = ("%Y-%m",)
THREE_FORMATS = ("%Y-%m", "%Y/%m", "%m/%Y")
FOUR_FORMATS = ("%Y-%m", "%Y/%m", "%m/%Y", "%Y%m")
MACRO_FORMATS = ("%Y-%m-%d", "%Y-%m")


def parse_period(c: Column, formats: tuple[str, ...] = ONE_FORMAT) -> Column:
    """First of the month for the first spelling in ``formats`` that fits, else NULL."""
    attempts = []
    for name in formats:
        shape, iso = _SPELLINGS[name]
        attempts.append(F.when(c.rlike(shape), iso(c).try_cast("date")))
    return F.coalesce(*attempts) if len(attempts) > 1 else attempts[0]


def with_calendar(df: DataFrame, date_col: str = "periodo_date") -> DataFrame:
    """Add ``anio``, ``mes`` and the sortable ``periodo_ym``."""
    year, month = F.year(date_col).cast("bigint"), F.month(date_col).cast("bigint")
    return df.withColumns({"anio": year, "mes": month, "periodo_ym": year * 100 + month})


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def epoch_ms_text(ms: Column, pattern: str) -> Column:
    """Milliseconds since 1970 as text in ``pattern``; NULL where it is not a number."""
    return F.date_format(F.timestamp_millis(ms.try_cast("bigint")), pattern)


def month_spine(bounds: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """One row per month from ``first`` to ``last`` (dates) of a one-row frame."""
    start, stop = F.trunc(first, "MM"), F.trunc(last, "MM")
    months = F.explode(F.sequence(start, stop, F.expr("interval 1 month")))
    return bounds.select(months.alias("periodo_date"))


def month_range(spark: SparkSession, start_year: int, today: dt.date) -> DataFrame:
    """All months from January of ``start_year`` to the month of ``today``."""
    bounds = spark.range(1).select(
        F.make_date(F.lit(start_year), F.lit(1), F.lit(1)).alias("first"),
        F.lit(today).alias("last"),
    )
    return month_spine(bounds)


def lookback_months(bounds: DataFrame, months: int = 3, last: str = "last") -> DataFrame:
    """The last ``months`` months up to ``last`` (a date column of a one-row frame)."""
    first = F.add_months(F.trunc(last, "MM"), -(months - 1))
    return month_spine(bounds.select(first.alias("first"), F.col(last).alias("last")))


def select_periods(
    df: DataFrame, months: DataFrame, forced: list[str] | None = None, date_col: str = "periodo_date"
) -> DataFrame:
    """Keep the rows of the look-back ``months``, or of the ``forced`` YYYY-MM list."""
    day = F.col(date_col)
    if forced:
        wanted = [F.lit(dt.date(int(p[:4]), int(p[5:7]), 1)) for p in forced]
        within = [(day >= first) & (day < F.add_months(first, 1)) for first in wanted]
        return df.where(reduce(operator.or_, within))
    # the span on the bare column reaches the scan; the semi-join leaves out months in between
    span = months.agg(F.min("periodo_date").alias("first"), F.add_months(F.max("periodo_date"), 1).alias("after"))
    near = df.where((day >= span.select("first").scalar()) & (day < span.select("after").scalar()))
    return near.join(
        months.select(F.col("periodo_date").alias("_month")),
        F.trunc(date_col, "MM") == F.col("_month"),
        "left_semi",
    )


def coverage_gaps(df: DataFrame, date_col: str, group: list[str] | None = None) -> DataFrame:
    """Months without a row between the first and last month seen (per ``group``)."""
    keys = group or []
    seen = df.select(*keys, F.trunc(date_col, "MM").alias("periodo_date")).distinct()
    # the span of a group is spread over its months, never the months over all groups
    span = seen.groupBy(*keys).agg(
        F.min("periodo_date").alias("first"), F.max("periodo_date").alias("last")
    )
    spine = span.select(
        *keys,
        F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("periodo_date"),
    )
    return spine.join(seen, [*keys, "periodo_date"], "left_anti")
