"""New bars from the landing area, and the symbols to load."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmill.functions.measures import nan_to_null
from barmill.operators.reshape import quoted
from barmill.schemas import LABELS, LANDED_AT, LANDED_IN, LANDING_SEPARATOR


def is_tidy(landing: DataFrame, labels: Sequence[str] = LABELS) -> bool:
    """Whether a landing table is tidy (Date, Ticker, labels) or wide (Date, label|ticker).

    Any other table is refused, before anything of it is stored.
    """
    names = set(landing.columns)
    if "Date" not in names:
        raise ValueError(f"a landing table needs a Date column, got {landing.columns[:10]}")
    if "Ticker" in names:
        missing = [label for label in labels if label not in names]
        if missing:
            raise ValueError(f"a tidy landing table needs the columns {missing}")
        return True
    series = [c for c in landing.columns if LANDING_SEPARATOR in c]
    if not series:
        raise ValueError(f"no Ticker column and no label{LANDING_SEPARATOR}ticker column in {landing.columns[:10]}")
    return False


def open_landing(
    spark: SparkSession, path: str, fmt: str = "parquet", files: Sequence[str] | None = None
) -> DataFrame:
    """A stored landing table with the columns of all its files, and when and from which file each row landed.

    ``files`` are the only ones that are opened.
    """
    reader = spark.read.format(fmt).option("mergeSchema", "true")
    table = reader.load(path) if files is None else reader.option("basePath", path).load(list(files))
    return table.withColumns(
        {LANDED_AT: F.col("_metadata.file_modification_time"), LANDED_IN: F.col("_metadata.file_path")}
    )


def landing_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``path``, ``modified`` and ``size`` of a landing table's files, by listing alone: no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").load(path)
    return listed.where("length > 0").select(
        "path", F.col("modificationTime").alias("modified"), F.col("length").alias("size")
    )


def landing_order(landing: DataFrame, sequence: str | None = None) -> list[str]:
    """The columns by which copies of a bar or of a cell are told apart: the given one, then where they landed."""
    own = [sequence] if sequence else []
    return own + [c for c in (LANDED_AT, LANDED_IN) if c in landing.columns]


def tidy_labels(landing: DataFrame, labels: Sequence[str] = LABELS, sequence: str | None = None) -> list[str]:
    """Labels of a tidy table: the given ones that it has, and all its other numbers."""
    none = {"Date", "Ticker", sequence, LANDED_AT, LANDED_IN}
    numbers = [f.name for f in landing.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in none]
    own = [label for label in labels if label in landing.columns]
    return own + [c for c in numbers if c not in own]


def typed(landing: DataFrame, labels: Sequence[str], tidy: bool, order: Sequence[str] = ()) -> DataFrame:
    """The columns a load needs, in the types of the stored tables, and those that order copies."""
    names = list(labels) if tidy else [c for c in landing.columns if LANDING_SEPARATOR in c]
    return landing.select(
        F.col("Date").cast(T.TimestampNTZType()).alias("Date"),
        *([F.col("Ticker").cast("string").alias("Ticker")] if tidy else []),
        *(F.col(quoted(c)).cast("double").alias(c) for c in names),
        *(F.col(quoted(c)) for c in order),
    )


def new_bars(
    landing: DataFrame, last: datetime | None, step: timedelta, start: datetime | None = None
) -> DataFrame:
    """Bars from one step after the last loaded one; before any load, from ``start``.

    A bar without a date belongs to no day and is never loaded.
    """
    if last is not None:
        return landing.filter(F.col("Date") >= F.lit(last).cast("timestamp_ntz") + F.lit(step))
    if start is not None:
        return landing.filter(F.col("Date") >= F.lit(start).cast("timestamp_ntz"))
    return landing.filter(F.col("Date").isNotNull())


def one_copy(bars: DataFrame, keys: Sequence[str], order: str | Sequence[str] | None = None) -> DataFrame:
    """One whole row for each key: the last by ``order``, then the greatest.

    Taking the row whole keeps a bar's prices together.
    """
    ordered = [order] if isinstance(order, str) else list(order or ())
    values = [c for c in bars.columns if c not in keys and c not in ordered]
    first = [F.col(quoted(c)).alias(f"_order{k}") for k, c in enumerate(ordered)]
    chosen = F.max(F.struct(*first, *(F.col(quoted(c)) for c in values))).alias("_row")
    rows = bars.groupBy(*keys).agg(chosen)
    kept = [c for c in bars.columns if c not in ordered]
    return rows.select(*(F.col(c) if c in keys else F.col(f"_row.{quoted(c)}") for c in kept))


def merge_cells(wide: DataFrame, keys: Sequence[str] = ("Date",), order: Sequence[str] = ()) -> DataFrame:
    """One row for each key, of each other column the last value that is there, by ``order``, then the greatest.

    A wide row holds many instruments, and files may hold some of them each, or correct single cells; so rows of one
    date are merged cell by cell. An empty cell, or one that is no number, says nothing about its instrument.
    """

    def last(c: str) -> Column:
        cell = nan_to_null(F.col(quoted(c)))
        copy = F.struct(*(F.col(quoted(o)).alias(f"_order{k}") for k, o in enumerate(order)), cell.alias("_cell"))
        return F.max(F.when(cell.isNotNull(), copy))["_cell"].alias(c)

    return wide.groupBy(*keys).agg(*(last(c) for c in wide.columns if c not in keys and c not in order))


def symbol_universe(
    listed: DataFrame, country: str, longest: int | None = 5, suffix: str = ".SA"
) -> DataFrame:
    """Tickers of one country's ``(symbol, country)`` listing.

    Symbols longer than ``longest`` name other instruments and are left out;
    ``None`` keeps all.
    """
    kept = listed.filter(F.col("country") == country)
    if longest is not None:
        kept = kept.filter(F.length("symbol") <= longest)
    return kept.select(F.concat("symbol", F.lit(suffix)).alias("Ticker"))


def bars_for_symbols(bars: DataFrame, symbols: DataFrame) -> DataFrame:
    """Keep bars of listed tickers.

    A semi join: repeated symbols multiply nothing. No hint is given, so Spark
    broadcasts the symbols only when their size is under its threshold and
    otherwise shuffles, splitting a ticker that dominates.
    """
    return bars.join(symbols.select("Ticker"), "Ticker", "left_semi").select(*bars.columns)
