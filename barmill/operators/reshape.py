"""Melt, pivot and duplicate removal between the wide and the long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.functions.measures import nan_to_null
from barmill.schemas import INGESTED, LABELS, LANDING_SEPARATOR, WIDE_NAMES


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _long(df: DataFrame) -> DataFrame:
    return df.select("Date", "Price", "Ticker", nan_to_null(F.col("value")).alias("value"))


def melt_bars(bars: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Tidy bars to one row per (Date, Price, Ticker); nulls are kept."""
    names = [quoted(label) for label in labels]
    return _long(bars.unpivot(["Date", "Ticker"], names, "Price", "value"))


def melt_landing(wide: DataFrame, date: str = "Date") -> DataFrame:
    """Melt a download with one ``label|ticker`` column per series.

    Both header levels become columns, nulls are kept.
    """
    series = [c for c in wide.columns if c != date]
    renamed = wide.withColumnRenamed(date, "Date")
    long = renamed.unpivot(["Date"], [quoted(c) for c in series], "_series", "value")
    parts = F.split(F.col("_series"), f"[{LANDING_SEPARATOR}]", 2)
    return _long(long.select("Date", parts[0].alias("Price"), parts[1].alias("Ticker"), "value"))


def _latest(
    order: str | None, value: Column, here: Column | None = None, unique_order: bool = False
) -> Column:
    """Aggregate for the value with the greatest order among the rows ``here``.

    Ties fall to the larger value, so that a task run twice cannot choose
    differently. That needs a struct in the aggregation buffer, hence a sort
    in each task; an order without ties allows the cheaper hash aggregate.
    """

    def kept(column: Column) -> Column:
        return column if here is None else F.when(here, column)

    if order is None:
        return F.max(kept(value))
    if unique_order:
        return F.max_by(kept(value), kept(F.col(order)))
    return F.max(kept(F.struct(F.col(order), value.alias("value"))))["value"]


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str = "value",
    unique_order: bool = False,
) -> DataFrame:
    """One row per key: the value with the greatest order.

    An aggregate rather than a ranking window: copies of a key are combined
    before the shuffle, so a key with very many copies costs no single task.
    """
    chosen = _latest(order, F.col(value), unique_order=unique_order)
    return df.groupBy(*keys).agg(chosen.alias(value))


def pivot_labels(
    long: DataFrame,
    labels: Sequence[str] = LABELS,
    duplicates: str = "latest",
    order: str | None = None,
) -> DataFrame:
    """One row per (Date, Ticker), one column per label.

    With ``duplicates="latest"`` copies of (Date, Ticker, Price) collapse to
    the one with the greatest ``order``; with ``"sum"`` they are added up, and
    with ``"max"`` the greatest value stays. Stored rows carry the time of
    their load, of which each key has one row; that order has no ties and
    needs a hash aggregate only. Rows without an order are refused.

    Labels are given, so none has to be discovered by an extra job, a label
    outside the list or a null one makes no column (``left_out`` counts them),
    and an empty input still has the full schema. Each label is a conditional aggregate of one
    ``groupBy``: one shuffle, where ``pivot`` plans an aggregation per key and
    label and then a second one.
    """
    unique = order is None and INGESTED in long.columns
    order = INGESTED if unique else order
    if duplicates == "latest" and order is None:
        raise ValueError("the latest copy needs an order; say duplicates='max' or 'sum' for rows without one")
    cells = {}
    for label in labels:
        here = F.col("Price") == label
        if duplicates == "sum":
            cells[label] = F.sum(F.when(here, F.col("value")))
        else:
            kept = None if duplicates == "max" else order
            cells[label] = _latest(kept, F.col("value"), here, unique_order=unique)
    return long.groupBy("Date", "Ticker").agg(
        *[cell.alias(WIDE_NAMES.get(label, label)) for label, cell in cells.items()]
    )


def discover_labels(long: DataFrame, most: int = 1000) -> list[str]:
    """The labels present, sorted. Runs a job; more than ``most`` cannot be columns and are an error."""
    found = long.filter(F.col("Price").isNotNull()).select("Price").distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} labels; pass the ones to keep")
    return sorted(row[0] for row in found)


def left_out(long: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``label`` and ``rows`` of the labels that a pivot to ``labels`` leaves out, null among them."""
    other = F.col("Price").isNull() | ~F.col("Price").isin(list(labels))
    return long.filter(other).groupBy(F.col("Price").alias("label")).agg(F.count(F.lit(1)).alias("rows"))


def complete_bars(wide: DataFrame) -> DataFrame:
    """Bars with an adjusted close; the others did not trade."""
    return wide.filter(F.col("Adj_Close").isNotNull())
