"""The close of the previous market day, per instrument.

"Previous" is a day of the whole market: when an instrument did not trade on
it, the result is null and not an older close.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmill.functions.times import day_text
from barmill.operators.calendar import asof_day_map, day_map, market_days

# Market days per block: one row in BLOCK is shuffled twice.
BLOCK = 32


def with_previous_close(bars: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Daily bars with ``Dia2`` and ``Adj_Close_ant`` from the bars themselves.

    One shuffle, no self join: market days get consecutive positions, and a
    range frame of exactly one position back finds the row of the previous
    market day or nothing. Rows are grouped by instrument and block of days,
    so an instrument with a long history spreads over many tasks; the last day
    of a block is sent to the next block too and dropped there.

    ``days`` may pass the market days from a cheaper source than the bars.
    Rows without an instrument match nothing, and are spread by their content.
    """
    calendar = F.broadcast(day_map(market_days(bars if days is None else days)))
    placed = bars.withColumn("Dia", F.to_date("Date")).join(calendar, "Dia", "left")
    own = F.expr(f"Pos div {BLOCK}")
    ends_block = F.col("Pos") % BLOCK == BLOCK - 1
    spread = placed.withColumn("_own", own).withColumn(
        "_block",
        F.explode(
            F.when(ends_block, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))
        ),
    )
    nobody = F.when(F.col("Ticker").isNull(), F.xxhash64("Date", "Adj_Close", "Volume"))
    frame = (
        Window.partitionBy("Ticker", "_block", "_nobody").orderBy("Pos").rangeBetween(-1, -1)
    )
    last_close = F.max_by("Adj_Close", "Date").over(frame)
    found = spread.withColumn("_nobody", nobody).withColumn(
        "Adj_Close_ant", F.when(F.col("Ticker").isNotNull(), last_close)
    )
    return found.filter(F.col("_block").eqNullSafe(F.col("_own"))).select(
        *bars.columns, day_text(F.col("Dia2")).alias("Dia2"), "Adj_Close_ant"
    )


def with_daily_close(
    bars: DataFrame,
    closes: DataFrame,
    lookback: str = "history",
    days: DataFrame | None = None,
    close_days: DataFrame | None = None,
) -> DataFrame:
    """Hourly bars with ``Dia2`` and ``Adj_Close_ant`` from the daily table.

    ``closes`` holds one row per instrument and day, as the silver pivot
    guarantees. The day map is broadcast (one row per calendar day). The close
    join has no hint: Spark broadcasts a small slice of closes by its size,
    and otherwise shuffles both sides straight into the join, where adaptive
    execution can split an instrument-day that dominates the bars.

    ``lookback="slice"`` takes the day list from the closes alone: a bar day
    without closes of its own then has no previous day. ``days`` and
    ``close_days`` may pass the days of either side from a cheaper source; the
    same frame for both is read once.
    """
    closed = market_days(closes if close_days is None else close_days)
    if lookback == "slice" or (days is not None and days is close_days):
        calendar = day_map(closed).select("Dia", "Dia2")
    else:
        calendar = asof_day_map(market_days(bars if days is None else days), closed)
    placed = (
        bars.withColumn("Dia", F.to_date("Date"))
        .join(F.broadcast(calendar), "Dia", "left")
        .drop("Dia")
        .alias("b")
    )
    last = closes.select(
        "Ticker", F.to_date("Date").alias("Dia"), F.col("Adj_Close").alias("Adj_Close_ant")
    ).alias("c")
    same = (F.col("b.Ticker") == F.col("c.Ticker")) & (F.col("b.Dia2") == F.col("c.Dia"))
    return placed.join(last, same, "left").select(
        *[F.col(f"b.`{c}`") for c in bars.columns],
        day_text(F.col("b.Dia2")).alias("Dia2"),
        "c.Adj_Close_ant",
    )
