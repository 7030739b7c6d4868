"""Column checks. Each returns a boolean Column named ``{column}_{check}``; NULL stays NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def not_null(name: str) -> Column:
    return F.col(name).isNotNull().alias(f"{name}_not_null")


def allowed(name: str, values: Sequence) -> Column:
    return F.col(name).isin(*values).alias(f"{name}_allowed")


def in_range(name: str, low, high) -> Column:
    return F.col(name).between(low, high).alias(f"{name}_in_range")


def alphanumeric(name: str) -> Column:
    return F.col(name).rlike(r"^[a-zA-Z0-9\-]+$").alias(f"{name}_alphanumeric")


def is_timestamp(name: str) -> Column:
    return F.col(name).try_cast("timestamp").isNotNull().alias(f"{name}_is_timestamp")


def positive(name: str) -> Column:
    return (F.col(name) > 0).alias(f"{name}_positive")


def non_empty(name: str) -> Column:
    return (F.col(name).isNotNull() & (F.length(F.col(name)) > 0)).alias(f"{name}_non_empty")
