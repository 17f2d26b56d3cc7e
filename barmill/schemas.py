"""Column names and schemas of every stored table.

All times are ``timestamp_ntz``: bars carry exchange-local wall time and no
zone, so no session setting can shift them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Price labels as they stand in the long form, in column order.
LABELS = ("Adj Close", "Close", "High", "Low", "Open", "Volume")

# Wide columns differ from the labels only in the blank of the first.
WIDE_NAMES = {"Adj Close": "Adj_Close"}
MEASURES = tuple(WIDE_NAMES.get(label, label) for label in LABELS)

# Measures that daily gold rounds to two places.
ROUNDED = (
    "Adj_Close",
    "Close",
    "High",
    "Low",
    "Open",
    "Marketcap",
    "Volatility",
    "Volatility_perc",
)

# Direction labels.
UP, FLAT, DOWN = "Increasing", "Stable", "Decreasing"

INGESTED = "ingested_at"
PARTITION = "p_date"
LANDING_SEPARATOR = "|"

# Columns of an opened landing table: when and in which file a row came.
LANDED_AT, LANDED_IN = "_landed_at", "_landed_in"


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


_TS = T.TimestampNTZType()
_STR = T.StringType()
_DBL = T.DoubleType()

BRONZE = T.StructType(
    _fields(_TS, "Date") + _fields(_STR, "Price", "Ticker") + _fields(_DBL, "value")
)
BRONZE_STORED = T.StructType(BRONZE.fields + _fields(_TS, INGESTED))


def wide_names(labels: Iterable[str]) -> list[str]:
    return [WIDE_NAMES.get(label, label) for label in labels]


def landing(labels: Iterable[str] = LABELS) -> T.StructType:
    return T.StructType(_fields(_TS, "Date") + _fields(_STR, "Ticker") + _fields(_DBL, *labels))


def silver(labels: Iterable[str] = LABELS) -> T.StructType:
    return T.StructType(_fields(_TS, "Date") + _fields(_STR, "Ticker") + _fields(_DBL, *wide_names(labels)))


def gold(labels: Iterable[str] = LABELS, hourly: bool = False) -> T.StructType:
    """Gold columns; labels beyond the usual ones follow them."""
    derived = _fields(_DBL, "Adj_Close_ant", "Marketcap", "Volatility", "Volatility_perc")
    shown = _fields(_TS, "Date2") + _fields(_STR, "Date_label", "key") if hourly else _fields(_STR, "Date2", "key")
    measures = _fields(_TS, "Date") + _fields(_DBL, *wide_names(labels))
    return T.StructType(measures + _fields(_STR, "Ticker", "Dia2") + derived + _fields(_STR, "Volatility_label") + shown)


LANDING, SILVER = landing(), silver()
GOLD_DAILY, GOLD_HOURLY = gold(), gold(hourly=True)

SYMBOLS = T.StructType(_fields(_STR, "symbol", "country"))
HOLIDAYS = T.StructType(_fields(T.DateType(), "holiday") + _fields(_STR, "name"))

# Ledgers of what loads have read, changed and seen.
CONSUMED_FILES = T.StructType(
    _fields(_STR, "path") + _fields(T.TimestampType(), "modified") + _fields(T.LongType(), "size") + _fields(_TS, "stamp")
)
CHANGED_DAYS = T.StructType(_fields(_STR, "layer", "granularity") + _fields(_TS, "stamp") + _fields(T.DateType(), "day"))
PROGRESS = T.StructType(_fields(_STR, "layer", "granularity", "source", "source_granularity") + _fields(_TS, "upto"))
COMPACTIONS = T.StructType(
    _fields(_STR, "layer", "granularity", "folder", "state") + _fields(_TS, "upto") + _fields(T.DateType(), "day")
)
SEEN_LABELS = T.StructType(_fields(_STR, "label") + _fields(_TS, "stamp"))

LOG_LINE = T.StructType(_fields(_STR, "Log"))
RUN_LOG = T.StructType(
    _fields(_STR, "run_id", "layer", "granularity", "step")
    + _fields(_TS, "ts")
    + _fields(_STR, "status")
    + _fields(T.LongType(), "rows_out")
    + _fields(_STR, "message")
)
