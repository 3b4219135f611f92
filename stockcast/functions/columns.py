"""Column expressions shared by the operators. All of them stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockcast.settings import NONE_TEXT, WHITESPACE


def strip(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def key_text(c: Column) -> Column:
    """Trimmed text; a missing key becomes the literal 'None' so that it still groups and joins."""
    return F.coalesce(strip(c), F.lit(NONE_TEXT))


_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_YEAR_FIRST = r"^[0-9]{4}(-[0-9]{1,2}(-[0-9]{1,2}.*)?)?$"


def _reads_as(c: Column, pattern: str) -> Column:
    """True for text of the pattern and for every value that is no text."""
    return (F.typeof(c) != "string") | strip(c).rlike(pattern)


def day(c: Column) -> Column:
    """Day of a date, timestamp or text column; null if the text is not a date that begins with its year.

    A bare time would otherwise count as today.
    """
    return F.when(_reads_as(c, _YEAR_FIRST), c.try_cast("timestamp").cast("date"))


def plain_number(c: Column) -> Column:
    """Double value; null for text that is no plain number (such as 12d) and for what is not finite."""
    value = F.when(_reads_as(c, _NUMBER), c.try_cast("double"))
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def number(c: Column) -> Column:
    """Double value; bad text, null, NaN and infinities become 0."""
    return F.coalesce(plain_number(c), F.lit(0.0))


def half_even(c: Column) -> Column:
    return F.bround(c).cast("bigint")


def non_negative_int(c: Column) -> Column:
    """Null, NaN and infinities become 0, negatives clip to 0, halves round to even."""
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return half_even(F.when(bad, 0.0).otherwise(F.greatest(c, F.lit(0.0))))


def truncated_int(c: Column) -> Column:
    """Integer part; what is not a finite number becomes 0."""
    return number(c).cast("bigint")


def safe_key(c: Column) -> Column:
    """Text usable in an object path: anything but letters, digits and _ - . becomes _."""
    return F.regexp_replace(c.cast("string"), r"[^\p{L}\p{N}_.\-]", "_")


def uniform(seed: int, *keys: Column) -> Column:
    """Repeatable number in [0, 1) from the row's keys, the same on every run and every executor."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def positive_ints(c: Column) -> Column:
    """Positive whole numbers of an array, first occurrence each; null if none is left."""
    parsed = F.transform(c, lambda x: x.try_cast("int"))
    kept = F.array_distinct(F.filter(parsed, lambda x: x > 0))
    return F.when(F.size(kept) > 0, kept)
