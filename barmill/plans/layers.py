"""What each layer computes from the layer before it; lazy frames only."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill import schemas
from barmill.config import DAY, RunConfig
from barmill.operators.gold import derive
from barmill.operators.incremental import Mark, from_day, from_mark
from barmill.operators.masking import mask, unmask_last
from barmill.operators.previous_close import with_daily_close, with_previous_close
from barmill.operators.reshape import complete_bars, melt_bars, melt_landing, pivot_labels
from barmill.schemas import INGESTED, PARTITION
from barmill.sources.landing import (
    bars_for_symbols, is_tidy, landing_order, merge_cells, new_bars, one_copy, tidy_labels, typed,
)
from barmill.sources.tables import by_day, by_instrument, data_columns, sort_days, spread_days


def new_rows(table: DataFrame, cfg: RunConfig, mark: Mark) -> DataFrame:
    """The rows a stage has to process.

    In append mode strictly later ones. In overwrite mode the whole last day
    and all later ones: an hourly load may resume in the middle of a day, and
    the day partition it replaces must keep its earlier bars.
    """
    return from_mark(table, mark, whole_days=cfg.write == "overwrite")


def bronze(
    landing: DataFrame,
    cfg: RunConfig,
    mark: Mark,
    loaded_at: datetime,
    symbols: DataFrame | None = None,
) -> DataFrame:
    """New landing bars in long form, stamped with the time of the load.

    The landing table may be tidy or wide; any other is refused. Of copies of a
    tidy bar in one load one is kept whole, and rows of a wide table that share
    a time are merged cell by cell, while still wide, but where copies are to
    be added up. A tidy bar without an instrument is nobody's and is left out.
    Loads by file take no empty cell of a wide table, since another file may
    hold it. Rows are shuffled to their days while still wide too: melting
    first would repeat time and instrument for every label on the wire.
    """
    tidy = is_tidy(landing, schemas.LABELS)
    order = landing_order(landing, cfg.sequence)
    labels = tidy_labels(landing, [*schemas.LABELS, *(c for c in cfg.labels if c not in schemas.LABELS)], cfg.sequence)
    fresh = new_bars(landing, mark.last, cfg.granularity.step, mark.start)
    fresh = typed(fresh, labels, tidy, order)
    if tidy and symbols is not None:
        fresh = bars_for_symbols(fresh, symbols)
    if cfg.compat:
        fresh = fresh.drop(*order)
    elif tidy:
        fresh = one_copy(fresh.filter(F.col("Ticker").isNotNull()), ("Date", "Ticker"), order)
    else:
        fresh = merge_cells(fresh, ("Date",), order)
    spread = data_columns(spread_days(fresh))
    long = melt_bars(spread, labels) if tidy else melt_landing(spread)
    if not tidy and cfg.consume == "files":
        long = long.filter(F.col("value").isNotNull())
    if not tidy and symbols is not None:
        long = bars_for_symbols(long, symbols)
    stamped = long.withColumn(INGESTED, F.lit(loaded_at).cast("timestamp_ntz"))
    return sort_days(stamped, "Date", "Ticker")


def on_days(table: DataFrame, days: Collection[date]) -> DataFrame:
    """Whole days of a stored table, by partition pruning."""
    return table.filter(F.col(PARTITION).isin([F.lit(d) for d in sorted(days)]))


def silver(bronze_rows: DataFrame, cfg: RunConfig) -> DataFrame:
    """Wide complete bars with the instrument masked.

    Masking comes last, after the shuffle that lays out the days: tokens are
    long, and drawn at random, so they should be neither shuffled nor drawn
    again for a retried exchange.
    """
    duplicates = "sum" if cfg.compat else "latest"
    wide = complete_bars(pivot_labels(data_columns(bronze_rows), cfg.labels, duplicates=duplicates))
    return mask(by_day(wide), cfg.key, token=cfg.token, unique=("Date", "Ticker"))


def previous_day(table: DataFrame, first: date) -> DataFrame:
    """One row: the last day of a table before ``first``, null if none.

    Touches the partition column only, so no data column is read.
    """
    return table.filter(F.col(PARTITION) < F.lit(first)).agg(F.max(PARTITION).alias("day"))


def gold(
    silver_bars: DataFrame,
    cfg: RunConfig,
    mark: Mark,
    first_close_day: date | None,
    silver_closes: DataFrame | None = None,
) -> DataFrame:
    """New silver bars unmasked, with their previous close and derived columns.

    ``first_close_day`` is the market day before the first new one; closes are
    read from there on, by partition pruning.
    """
    options = {"token": cfg.token, "bad_token": cfg.bad_token}
    bars = new_rows(silver_bars, cfg, mark)

    def clear(table: DataFrame) -> DataFrame:
        return unmask_last(data_columns(table), cfg.key, **options)

    if cfg.granularity is DAY:
        wanted = bars
        if cfg.lookback == "history":
            wanted = from_day(silver_bars, first_close_day)
        # Days come from the stored dates, so that branch decrypts nothing.
        closed = with_previous_close(clear(wanted), days=wanted)
        if cfg.lookback == "history":
            closed = _only_new(closed, cfg, mark)
    else:
        closes = (
            from_day(silver_closes, first_close_day)
            if cfg.lookback == "history"
            else from_mark(silver_closes, mark, whole_days=False)
        )
        closed = with_daily_close(
            clear(bars), clear(closes), cfg.lookback, days=bars, close_days=closes
        )
    return laid_out(derive(closed, cfg.granularity, cfg.compat, cfg.labels), cfg)


def laid_out(rows: DataFrame, cfg: RunConfig) -> DataFrame:
    return by_instrument(rows) if cfg.gold_layout == "instrument" else by_day(rows)


def gold_days(
    silver_bars: DataFrame,
    cfg: RunConfig,
    compute: Collection[date],
    read: Collection[date],
    days: DataFrame,
    silver_closes: DataFrame | None = None,
    close_days: DataFrame | None = None,
) -> DataFrame:
    """Gold of some days, whole, as a load of everything would make it.

    ``days`` are all market days of the bars, and ``close_days`` those of the
    daily closes that hourly bars need; both come without opening a data file.
    ``read`` are the days that closes are read from.
    """
    options = {"token": cfg.token, "bad_token": cfg.bad_token}

    def clear(table: DataFrame) -> DataFrame:
        return unmask_last(data_columns(table), cfg.key, **options)

    if cfg.granularity is DAY:
        closed = with_previous_close(clear(on_days(silver_bars, read)), days=days)
        closed = closed.filter(F.to_date("Date").isin([F.lit(d) for d in sorted(compute)]))
    else:
        bars, closes = clear(on_days(silver_bars, compute)), clear(on_days(silver_closes, read))
        closed = with_daily_close(bars, closes, days=days, close_days=close_days)
    return laid_out(derive(closed, cfg.granularity, cfg.compat, cfg.labels), cfg)


def _only_new(rows: DataFrame, cfg: RunConfig, mark: Mark) -> DataFrame:
    if mark.last is None:
        return from_mark(rows, mark, whole_days=False)
    if cfg.write == "append":
        return rows.filter(F.col("Date") > F.lit(mark.last).cast("timestamp_ntz"))
    return rows.filter(F.to_date("Date") >= F.lit(mark.day))
