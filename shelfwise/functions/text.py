"""Text, timestamp and ratio expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def squeeze(value: Column) -> Column:
    """Trim, collapse runs of white space to one blank, and turn empty text into NULL."""
    flat = F.trim(F.regexp_replace(value, r"\s+", " "))
    return F.when(flat != "", flat)


def to_timestamp_or_null(value: Column) -> Column:
    """Parse a timestamp text after squeezing; NULL when it is no timestamp."""
    return squeeze(value.cast("string")).try_cast("timestamp_ntz")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives NULL for a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def reason_in(reason: Column, words: Sequence[str]) -> Column:
    """Whether a reason contains one of the words, ignoring case; NULL for a NULL reason."""
    return reason.rlike("(?i)" + "|".join(words))


def is_nan(value: Column) -> Column:
    return value.cast("double").eqNullSafe(F.lit(float("nan")))
