"""Columns the consumers of the gold tables read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.config import DAY, Granularity
from barmill.functions import measures
from barmill.functions.times import display_date
from barmill.operators.reshape import quoted
from barmill.schemas import LABELS, ROUNDED, gold


def derive(
    bars: DataFrame,
    granularity: Granularity,
    null_is_fall: bool = False,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """Measures, direction label, display dates and the serving key.

    Daily rows are rounded to two places after the label is taken from the
    exact change; hourly rows carry ``Date2`` two hours ahead and no rounding.
    """
    close, previous = F.col("Adj_Close"), F.col("Adj_Close_ant")
    delta = measures.change(close, previous)
    shown = display_date(F.col("Date"))
    columns = {
        "Marketcap": measures.traded_value(close, F.col("Volume")),
        "Volatility": delta,
        "Volatility_perc": measures.relative_change(close, previous),
        "Volatility_label": measures.direction(delta, null_is_fall),
    }
    if granularity is DAY:
        columns["Date2"] = shown
    else:
        columns["Date2"] = F.col("Date") + F.expr("INTERVAL 2 HOURS")
        columns["Date_label"] = shown
    columns["key"] = F.concat(shown, F.col("Ticker"))
    derived = bars.withColumns(columns)
    if granularity is DAY:
        derived = derived.withColumns({c: F.round(c, 2) for c in ROUNDED})
    return derived.select(*(quoted(c) for c in gold(labels, granularity.gold_hourly).fieldNames()))
