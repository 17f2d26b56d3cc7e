"""High-water mark and the rows beyond it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.schemas import PARTITION


@dataclass(frozen=True)
class Mark:
    """Where a stage goes on: after the ``last`` stored bar, or from ``start`` before the first load."""

    last: datetime | None = None
    start: datetime | None = None

    @property
    def day(self) -> date | None:
        """The first day that the stage computes; ``None`` means from the beginning."""
        moment = self.last or self.start
        return moment.date() if moment else None


def newest_day(table: DataFrame) -> DataFrame:
    """Only the newest partition of a day-partitioned table.

    The newest day comes from the partition column, which costs no data
    column; the outer scan is then pruned to that day.
    """
    top = table.agg(F.max(PARTITION).alias("top")).scalar()
    return table.filter(F.col(PARTITION) == top)


def watermark(df: DataFrame) -> DataFrame:
    """One row: the last ``Date`` of a table, null when it is empty."""
    source = newest_day(df) if PARTITION in df.columns else df
    return source.agg(F.max("Date").alias("last_date"))


def since(df: DataFrame, last: datetime | None) -> DataFrame:
    """Rows strictly later than ``last``; everything when there is no mark."""
    if last is None:
        return df
    rows = df.filter(F.col("Date") > F.lit(last).cast("timestamp_ntz"))
    return from_day(rows, last.date()) if PARTITION in df.columns else rows


def from_mark(df: DataFrame, mark: Mark, whole_days: bool) -> DataFrame:
    """Rows a stage has to process: strictly later ones, or the whole last day and all later ones.

    Before the first load rows count from ``mark.start`` on.
    """
    if mark.last is None and mark.start is not None:
        rows = df.filter(F.col("Date") >= F.lit(mark.start).cast("timestamp_ntz"))
        return from_day(rows, mark.day) if PARTITION in df.columns else rows
    return from_day(df, mark.day) if whole_days else since(df, mark.last)


def from_day(df: DataFrame, first: date | None) -> DataFrame:
    """Whole days from ``first`` on, by partition pruning."""
    return df if first is None else df.filter(F.col(PARTITION) >= F.lit(first))
