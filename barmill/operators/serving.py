"""Views for the consumers: one table per granularity, and their relation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.schemas import PARTITION


def stack(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, matched by name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def relate(hourly: DataFrame, daily: DataFrame, suffix: str = "_daily") -> DataFrame:
    """Hourly rows with the daily row of the same ``key`` beside them.

    ``key`` is made of the day and the instrument, so rows meet by these two;
    stored tables are then pruned by day, and rows without an instrument,
    which match nothing, are spread over all tasks by the day.
    """
    day = F.col(PARTITION) if PARTITION in daily.columns else F.to_date("Date")
    columns = [c for c in daily.columns if c not in ("key", PARTITION)]
    renamed = daily.select(
        day.alias("_day"), F.col("Ticker").alias("_ticker"), *[F.col(c).alias(c + suffix) for c in columns]
    )
    own = F.col(PARTITION) if PARTITION in hourly.columns else F.to_date("Date")
    left = hourly.withColumn("_own", own)
    same = (F.col("_own") == F.col("_day")) & (F.col("Ticker") == F.col("_ticker"))
    names = [c for c in hourly.columns if c != PARTITION]
    return left.join(renamed, same, "left").select(*names, *[c + suffix for c in columns])
