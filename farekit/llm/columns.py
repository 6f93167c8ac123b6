"""Column helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
SEPARATORS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for null and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SEPARATORS))


def word_count(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SEPARATORS))).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unit_interval(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the given values alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(2**53))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns, if present, that an operator is going to add."""
    lowered = {name.lower() for name in names}
    return df.drop(*[c for c in df.columns if c.lower() in lowered])


def fold(key: Column, modulus: int) -> Column:
    """crc32 of an id written as text, modulo; a null id counts as crc32 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")), F.lit(0)) % modulus
