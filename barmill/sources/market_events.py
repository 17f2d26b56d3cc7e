"""Price bars from the ``events`` table: the user is the instrument.

Open and close are the values of the first and last event of a bar, high and
low the extremes, volume the number of events. Grouping runs on the integer
user id and combines on the map side, so a dominant user or hour ships one
partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.config import DAY, Granularity
from barmill.functions.times import day_start, hour_start


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticker(user: Column) -> Column:
    return F.concat(F.lit("U"), user.cast("string"))


def bar_start(granularity: Granularity) -> Column:
    return day_start(F.col("ts")) if granularity is DAY else hour_start(F.col("ts"))


def priced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that can make a price: time, user and a real value are there."""
    return scan(spark, sf_dir, "events").filter(
        F.col("ts").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("value").isNotNull()
        & ~F.isnan("value")
    )


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bar days: those of events that can make a price."""
    return priced_events(spark, sf_dir).select(day_start(F.col("ts")).alias("Date"))


def event_bars(spark: SparkSession, sf_dir: str, granularity: Granularity) -> DataFrame:
    """Tidy landing bars: Date, Ticker and one column per price label."""
    close = F.max_by("value", "event_id")
    grouped = (
        priced_events(spark, sf_dir)
        .groupBy(bar_start(granularity).alias("Date"), "user_id")
        .agg(
            close.alias("Close"),
            F.max("value").alias("High"),
            F.min("value").alias("Low"),
            F.min_by("value", "event_id").alias("Open"),
            F.count(F.lit(1)).cast("double").alias("Volume"),
        )
    )
    return grouped.select(
        "Date",
        ticker(F.col("user_id")).alias("Ticker"),
        F.col("Close").alias("Adj Close"),
        "Close",
        "High",
        "Low",
        "Open",
        "Volume",
    )


def event_prices(spark: SparkSession, sf_dir: str, granularity: Granularity) -> DataFrame:
    """A long form whose labels are the event types, one row per event."""
    return priced_events(spark, sf_dir).select(
        bar_start(granularity).alias("Date"),
        F.col("event_type").alias("Price"),
        ticker(F.col("user_id")).alias("Ticker"),
        "value",
        "event_id",
    )
