"""Derived gold columns as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barmill.schemas import DOWN, FLAT, UP


def traded_value(close: Column, volume: Column) -> Column:
    """Stored as ``Marketcap``; it is price times traded volume."""
    return close * volume


def change(close: Column, previous: Column) -> Column:
    """Stored as ``Volatility``; it is the absolute price change."""
    return close - previous


def relative_change(close: Column, previous: Column) -> Column:
    """Null, not an error, when the previous close is zero."""
    return F.try_divide(close, previous) - F.lit(1.0)


def direction(delta: Column, null_is_fall: bool = False) -> Column:
    named = F.when(delta > 0, UP).when(delta == 0, FLAT)
    return named.otherwise(DOWN) if null_is_fall else named.when(delta < 0, DOWN)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
