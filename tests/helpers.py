"""Small hand-written inputs shared by the tests."""

from datetime import datetime

from barmill import schemas
from barmill.config import MaskKey

KEY = MaskKey.from_text("cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4=")
OTHER_KEY = MaskKey(bytes(range(32)))


def at(text):
    return datetime.fromisoformat(text)


def long_rows(spark, rows):
    """(day or time, label, ticker, value) rows in bronze form."""
    return spark.createDataFrame([(at(d), p, t, v) for d, p, t, v in rows], schemas.BRONZE)


def wide_rows(spark, rows):
    """(time, ticker, close, volume) as silver bars with a clear ticker."""
    data = [(at(d), t, c, c, c, c, c, v) for d, t, c, v in rows]
    return spark.createDataFrame(data, schemas.SILVER)


def landing_rows(spark, rows):
    data = [(at(d), t, c, c, c, c, c, v) for d, t, c, v in rows]
    return spark.createDataFrame(data, schemas.LANDING)


def as_set(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# Daily example: close and volume, with the expected gold values.
EXAMPLE = [
    # day, ticker, close, volume, Dia2, previous, marketcap, change, relative, label
    ("2024-01-02", "AAAA3.SA", 10.0, 100.0, None, None, 1000.0, None, None, None),
    ("2024-01-03", "AAAA3.SA", 11.0, 200.0, "2024-01-02", 10.0, 2200.0, 1.0, 0.1, "Increasing"),
    ("2024-01-04", "AAAA3.SA", 11.0, 50.0, "2024-01-03", 11.0, 550.0, 0.0, 0.0, "Stable"),
    ("2024-01-05", "AAAA3.SA", 9.9, 100.0, "2024-01-04", 11.0, 990.0, -1.1, -0.1, "Decreasing"),
    ("2024-01-02", "BBBB4.SA", 5.0, 10.0, None, None, 50.0, None, None, None),
    ("2024-01-04", "BBBB4.SA", 6.0, 20.0, "2024-01-03", None, 120.0, None, None, None),
    ("2024-01-05", "BBBB4.SA", 5.4, 10.0, "2024-01-04", 6.0, 54.0, -0.6, -0.1, "Decreasing"),
    ("2024-01-03", "CCCC3.SA", 0.0, 5.0, "2024-01-02", None, 0.0, None, None, None),
    ("2024-01-04", "CCCC3.SA", 2.0, 5.0, "2024-01-03", 0.0, 10.0, 2.0, None, "Increasing"),
]
EXAMPLE_BARS = [row[:4] for row in EXAMPLE]
