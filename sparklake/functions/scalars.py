"""Error-tolerant cleaning of text, numbers and money. All of it stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: every character the Unicode standard calls white space
WHITESPACE = (
    " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Shapes of text that may be cast. Testing the shape first matters: a cast that fails inside
# ``try_cast`` builds a Java exception, which costs many times more than the test and does
# not scale over threads. It also keeps Java literals such as '1.5d' from passing as numbers.
_DOUBLE = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:nan|inf(?:inity)?))\s*$"
_PLAIN = r"^-?\d+(?:\.\d*)?$"
_INTEGER = r"^\s*[+-]?\d+\s*$"
_DECIMAL = r"^\s*[+-]?\d+\.\d*\s*$"

FREQUENCY_LABELS = {"A": "Anual", "M": "Mensual", "Q": "Trimestral"}  # fixed values
UNKNOWN_FREQUENCY = "Desconocido"


def clean_text(c: Column) -> Column:
    """Strip white space of every kind, not just blanks, from both ends."""
    first, last = F.substring(c, 1, 1), F.substring(c, -1, 1)
    # most values start and end with a plain visible character and need no trimming
    return F.when(first.between("!", "~") & last.between("!", "~"), c).otherwise(
        F.trim(c, F.lit(WHITESPACE))
    )


def to_double(c: Column) -> Column:
    """Text to double; whatever is not a number becomes NULL."""
    return F.when(c.rlike(_DOUBLE), c.try_cast("double"))


def to_long(c: Column) -> Column:
    """Text to bigint; fractions and other text become NULL."""
    return F.when(c.rlike(_INTEGER), c.try_cast("bigint"))


def to_int(c: Column) -> Column:
    return F.when(c.rlike(_INTEGER), c.try_cast("int"))


def to_int_truncated(c: Column) -> Column:
    """Text to int without its fraction: ``12.0`` and ``12.7`` are 12; other text is NULL."""
    whole = F.when(c.rlike(_DECIMAL), F.substring_index(c, ".", 1)).otherwise(c)
    return to_int(whole)


def strip_strict(c: Column) -> Column:
    """Drop thousands commas and dollar signs. NULL stays NULL."""
    return F.translate(c, ",$", "")


def strip_lenient(c: Column) -> Column:
    """Keep only digits, dots and minus signs; plain numbers pass as they are.

    NULL counts as zero, an empty text stays empty, and ``(12)`` or ``1e5`` lose their
    meaning: 12 and 15.
    """
    kept = F.regexp_replace(F.coalesce(c, F.lit("0")), r"[^0-9.\-]+", "")
    return F.when(c.rlike(_PLAIN), c).otherwise(kept)


def money_strict(c: Column) -> Column:
    return to_double(strip_strict(c))


def money_lenient(c: Column) -> Column:
    return to_double(strip_lenient(c))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive, otherwise 0."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def frequency_label(code: Column) -> Column:
    """A, M, Q to their Spanish names."""
    names = F.create_map(*[F.lit(x) for pair in FREQUENCY_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, code), F.lit(UNKNOWN_FREQUENCY))


def stable_sum(c: Column, scale: int | None = None) -> Column:
    """Sum of doubles; with ``scale``, rounded back to the inputs' number of decimals.

    Adding doubles in another order changes the last bits. Where the inputs are known to
    hold ``scale`` decimals, rounding the total makes it the same on every run.
    """
    total = F.sum(c)
    return total if scale is None else F.round(total, scale)


def stable_mean(c: Column, scale: int | None = None) -> Column:
    """Mean with the same option as :func:`stable_sum`."""
    return F.avg(c) if scale is None else F.round(F.sum(c), scale) / F.count(c)
