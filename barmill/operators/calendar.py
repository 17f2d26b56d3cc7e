"""Business days, trading hours and the map to the previous market day."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barmill.functions.times import in_hours, is_holiday, is_weekday, national_holidays
from barmill.schemas import HOLIDAYS, PARTITION


def holiday_table(spark: SparkSession, years: Iterable[int]) -> DataFrame:
    """National holidays of the given years, for display; filters use ``is_holiday``."""
    return spark.createDataFrame(list(national_holidays(years)), HOLIDAYS)


def business_days(df: DataFrame, holidays: DataFrame | None = None, column: str = "Date") -> DataFrame:
    """Rows on a weekday that is no holiday: a national one by rule, or one of ``holidays``.

    The broadcast side holds distinct dates, and dates are bounded by the
    calendar: all of them together stay far below the broadcast limit.
    """
    if holidays is None:
        return df.filter(is_weekday(F.col(column)) & ~is_holiday(F.col(column)))
    closed = F.broadcast(holidays.select(F.to_date("holiday").alias("_day")).distinct())
    open_days = df.filter(is_weekday(F.col(column)))
    return open_days.join(closed, F.to_date(F.col(column)) == F.col("_day"), "left_anti")


def trading_hours(df: DataFrame, first: int = 12, last: int = 21, column: str = "Date") -> DataFrame:
    return df.filter(in_hours(F.col(column), first, last))


def market_days(df: DataFrame) -> DataFrame:
    """Distinct days on which any instrument has a bar, as column ``Dia``.

    A stored table answers from its partition column and reads no data column.
    """
    day = F.col(PARTITION) if PARTITION in df.columns else F.to_date("Date")
    return df.select(day.alias("Dia")).filter(F.col("Dia").isNotNull()).distinct()


def day_map(days: DataFrame) -> DataFrame:
    """Each market day with the market day before it and its position.

    The ordering window has no partition key, so it runs in one task; its
    input is one row per calendar day, whatever the size of the tables.
    """
    order = Window.orderBy("Dia")
    return days.select(
        "Dia", F.lag("Dia").over(order).alias("Dia2"), F.row_number().over(order).alias("Pos")
    )


def asof_day_map(bar_days: DataFrame, close_days: DataFrame) -> DataFrame:
    """Each bar day with the greatest close day before it.

    A bar day needs no close of its own, so hourly bars find the previous
    close before the closes of their day are loaded.
    """
    both = bar_days.withColumn("_close", F.lit(None).cast("date")).unionByName(
        close_days.withColumn("_close", F.col("Dia"))
    )
    merged = both.groupBy("Dia").agg(F.max("_close").alias("_close"))
    before = Window.orderBy("Dia").rowsBetween(Window.unboundedPreceding, -1)
    mapped = merged.select("Dia", F.last("_close", ignorenulls=True).over(before).alias("Dia2"))
    return mapped.filter(F.col("Dia2").isNotNull())
