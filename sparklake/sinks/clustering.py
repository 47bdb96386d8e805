"""Tables whose files are clustered by several columns, so that a filter on any of them skips files.

Each column is cut at its quantiles into ranges of about equal numbers of rows; the bits of the
range numbers, interleaved, give the order of the rows, and range partitioning deals that order to
files. Parquet keeps the least and greatest value of each column, by which scans skip row groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 5  # a column's ranges are 2^BITS


def ordinal(df: DataFrame, column: str) -> Column:
    """A number that orders as the column does; texts count by their first six bytes."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.StringType):
        six = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0")
        return F.conv(six, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        value = value.cast("timestamp")
    return value.cast("double")  # numbers and timestamps


def range_bounds(df: DataFrame, columns: list[str], bits: int = BITS) -> list[list[float]]:
    """The quantiles that cut each column, from one pass; a column of nulls has none."""
    at = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(ordinal(df, c), at).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(b or [])) for b in row]


def _cuts_below(value: Column, cuts: list[float]) -> Column:
    below = F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < value)
    return F.size(below) if cuts else F.lit(0)


def interleaved(df: DataFrame, columns: list[str], bounds: list[list[float]], bits: int = BITS) -> Column:
    """The place of a row in the common order; nulls go to a column's first range."""
    parts = []
    for i, (column, cuts) in enumerate(zip(columns, bounds, strict=True)):
        value = ordinal(df, column)
        number = _cuts_below(value, cuts)
        for j in range(bits):
            bit = F.shiftright(number, j).bitwiseAND(F.lit(1)).cast("bigint")
            parts.append(F.shiftleft(bit, j * len(columns) + i))
    return reduce(Column.__add__, parts)


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int, bits: int = BITS, mode: str = "overwrite") -> None:
    """Write ``df`` in ``files`` files; a range of equal places is split by a hash of the row."""
    place = interleaved(df, columns, range_bounds(df, columns, bits), bits)
    names = [F.col(f"`{c}`") for c in df.columns]
    placed = df.select(F.struct(*names).alias("row"), place.alias("place"), F.xxhash64(*names).alias("tie"))
    dealt = placed.repartitionByRange(files, "place", "tie").sortWithinPartitions("place")
    dealt.select("row.*").write.mode(mode).parquet(path)
