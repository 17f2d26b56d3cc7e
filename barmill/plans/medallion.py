"""Stage runs: guard, high-water mark, transform, write, log.

The only module that runs jobs. Each stage reads one mark, writes once and
appends its log; row counts are observed during the write.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barmill import schemas
from barmill.config import DAY, Granularity, RunConfig
from barmill.functions.times import is_business_moment
from barmill.operators.incremental import Mark, watermark
from barmill.operators.reshape import left_out
from barmill.plans import affected, layers, ledger
from barmill.plans.runlog import RunLog
from barmill.sources.landing import is_tidy, new_bars, open_landing, symbol_universe
from barmill.sources.tables import (
    SELF_DESCRIBING,
    data_columns,
    drop_days,
    find_table,
    listed_days,
    read_table,
    stored_days,
    write_days,
)

LAYERS = ("bronze", "silver", "gold")

# How far back the first, cheap look into a table goes.
RECENT = timedelta(days=31)

# Labels without a column that a log line names.
LISTED = 20


def clock(cfg: RunConfig) -> datetime:
    """Wall time in the market's zone, without the zone."""
    return cfg.clock() if cfg.clock else datetime.now(ZoneInfo(cfg.zone)).replace(tzinfo=None)


def load_time(cfg: RunConfig) -> datetime:
    """The order of loads: a time that no clock change sets back."""
    return cfg.clock() if cfg.clock else datetime.now(timezone.utc).replace(tzinfo=None)


def may_run(cfg: RunConfig, moment: datetime) -> bool:
    if not cfg.guard:
        return True
    if cfg.compat:
        return moment.weekday() < 5
    hours = cfg.trading_hours if cfg.granularity.guard_hours else None
    return is_business_moment(moment, cfg.holidays, hours)


def open_layer(
    spark: SparkSession, cfg: RunConfig, layer: str, granularity: Granularity | None = None
) -> DataFrame:
    path = cfg.table(layer, granularity)
    return read_table(spark, path, cfg.stored_schema(layer), cfg.fmt)


def read_layer(spark: SparkSession, cfg: RunConfig, layer: str) -> DataFrame:
    """A layer's rows without the partition column."""
    return data_columns(open_layer(spark, with_known_labels(spark, cfg), layer))


#: Columns that a label of the registry must not replace.
_TAKEN = {
    name.lower()
    for schema in (schemas.SILVER, schemas.GOLD_DAILY, schemas.GOLD_HOURLY, schemas.BRONZE_STORED)
    for name in (*schema.fieldNames(), schemas.PARTITION)
}


def with_known_labels(spark: SparkSession, cfg: RunConfig) -> RunConfig:
    """The configuration with the labels that bronze has met as columns, where the registry is asked for.

    A label named like a column of the layers cannot be one, whatever its case; its rows stay in bronze and are counted.
    """
    if not cfg.label_registry:
        return cfg
    own, taken = list(cfg.labels), _TAKEN | {label.lower() for label in cfg.labels}
    for label in ledger.known_labels(spark, cfg):
        if label.lower() not in taken:
            own.append(label)
            taken.add(label.lower())
    return replace(cfg, labels=tuple(own))


def recent_first(
    table: DataFrame, near: date, ask: Callable[[DataFrame], DataFrame]
) -> datetime | date | None:
    """The one value ``ask`` finds, from recent partitions if they hold any.

    Both questions asked here are for the greatest value, so an answer from
    the newest partitions is the answer for the table; the rest of the table
    is opened only when those are empty.
    """
    recent = table.filter(F.col(schemas.PARTITION) >= F.lit(near - RECENT))
    for part in (recent, table):
        found = ask(part).first()[0]
        if found is not None:
            return found
    return None


def last_loaded(spark: SparkSession, cfg: RunConfig, layer: str, moment: datetime) -> Mark:
    """Where a layer ends; before its first load it begins at ``since``."""
    table = find_table(spark, cfg.table(layer), cfg.stored_schema(layer), cfg.fmt)
    found = None if table is None else recent_first(table, moment.date(), watermark)
    return Mark(found, cfg.since)


def first_close_day(closes: DataFrame, mark: Mark) -> date | None:
    """The market day before the first one a gold run computes.

    ``None`` means that closes are read from the beginning.
    """
    if mark.day is None:
        return None
    return recent_first(closes, mark.day, lambda t: layers.previous_day(t, mark.day)) or mark.day


def symbols_to_load(spark: SparkSession, cfg: RunConfig) -> DataFrame | None:
    """Tickers of the configured table: its own, or its listing of one country."""
    if cfg.symbols is None:
        return None
    table = spark.read.format(cfg.fmt).load(cfg.symbols)
    if "Ticker" in table.columns:
        return table.select("Ticker")
    return symbol_universe(table, cfg.country, cfg.longest_symbol, cfg.symbol_suffix)


@dataclass
class Work:
    """What a stage computes: its rows, from the source frame they come from, and the ledger entries they are worth.

    ``days`` are the days that the rows replace; without them the days from the mark on.
    """

    rows: DataFrame | None
    mark: Mark
    source: DataFrame | None = None
    days: set[date] | None = None
    files: list = field(default_factory=list)
    through: list = field(default_factory=list)


def bronze_work(
    spark: SparkSession, cfg: RunConfig, mark: Mark, loaded_at: datetime, landing: DataFrame | None
) -> Work:
    """New bars of the landing table, which is opened once; by files only those that no load has read."""
    files = []
    if cfg.consume == "files" and landing is None:
        mark = Mark(None, cfg.since)
        files = ledger.new_files(spark, cfg)
        if not files:
            return Work(None, mark)
    if landing is None:
        landing = open_landing(spark, cfg.landing, cfg.fmt, [f[0] for f in files] or None)
    return Work(layers.bronze(landing, cfg, mark, loaded_at, symbols_to_load(spark, cfg)), mark, landing, files=files)


def silver_work(spark: SparkSession, cfg: RunConfig, mark: Mark) -> Work:
    bronze = open_layer(spark, cfg, "bronze")
    if cfg.late != "recompute":
        rows = layers.new_rows(bronze, cfg, mark)
        return Work(layers.silver(rows, cfg), mark, rows)
    days, upto = ledger.pending(spark, cfg, "silver", "bronze")
    if cfg.consume == "dates":
        # Such a load is not done again, so its days count even if it broke off before it could note them.
        stored = listed_days(spark, cfg.table("bronze"), cfg.fmt)
        last = mark.last.date() if mark.last else None
        days |= {d for d in (calendar_days(stored) if stored else ()) if last is None or d >= last}
    if not days:
        return Work(None, mark)
    rows = layers.on_days(bronze, days)
    return Work(layers.silver(rows, cfg), mark, rows, days, through=[("bronze", cfg.granularity, upto)])


def gold_work(spark: SparkSession, cfg: RunConfig, mark: Mark) -> Work:
    bars = open_layer(spark, cfg, "silver")
    daily = cfg.granularity is DAY
    closes = None if daily else open_layer(spark, cfg, "silver", DAY)
    if cfg.late != "recompute":
        first = first_close_day(bars if daily else closes, mark)
        return Work(layers.gold(bars, cfg, mark, first, closes), mark)
    touched, upto = ledger.pending(spark, cfg, "gold", "silver")
    through = [("silver", cfg.granularity, upto)]
    market = market_calendar(spark, cfg, cfg.granularity)
    if daily:
        compute, read = affected.daily_gold(touched, calendar_days(market))
        close_market = None
    else:
        touched_closes, closes_upto = ledger.pending(spark, cfg, "gold", "silver", DAY)
        through.append(("silver", DAY, closes_upto))
        close_market = market_calendar(spark, cfg, DAY)
        compute, read = affected.hourly_gold(touched, touched_closes, calendar_days(market), calendar_days(close_market))
    if not compute:
        return Work(None, mark, through=through)
    rows = layers.gold_days(bars, cfg, compute, read, market, closes, close_market)
    return Work(rows, mark, days=compute, through=through)


def market_calendar(spark: SparkSession, cfg: RunConfig, granularity: Granularity) -> DataFrame:
    """Days of a silver table, from its listing alone."""
    days = listed_days(spark, cfg.table("silver", granularity), cfg.fmt)
    return spark.createDataFrame([], f"{schemas.PARTITION} date") if days is None else days


def calendar_days(days: DataFrame) -> set[date]:
    """The days themselves: at most one value for each calendar day."""
    return {r[0] for r in days.collect() if r[0] is not None}


def losses(cfg: RunConfig, layer: str, work: Work) -> list[tuple[str, int]]:
    """What a load cannot keep, with counts: bars without a date or instrument, rows of labels that have no column.

    An aggregate of its own over one column of the new rows, so that a task
    that runs twice counts once. At most LISTED labels are named, the most
    frequent ones; the rest is one number.
    """
    if layer == "bronze":
        return lost_bars(cfg, work)
    if layer != "silver":
        return []
    found = left_out(work.source, cfg.labels).orderBy(F.desc("rows"), "label")
    listed = found.limit(LISTED + 1).collect()
    out = [("without a label" if r["label"] is None else f"of label {r['label']}", r["rows"]) for r in listed]
    if len(listed) > LISTED:
        total = found.agg(F.sum("rows")).first()[0]
        out = [*out[:LISTED], ("of other labels", total - sum(n for _, n in out[:LISTED]))]
    return out


def lost_bars(cfg: RunConfig, work: Work) -> list[tuple[str, int]]:
    undated = work.source.filter(F.col("Date").isNull()).count()
    out = [("without a date", undated)] if undated else []
    if is_tidy(work.source) and not cfg.compat:
        fresh = new_bars(work.source, work.mark.last, cfg.granularity.step, work.mark.start)
        nobody = fresh.filter(F.col("Ticker").isNull()).count()
        out += [("without a ticker", nobody)] if nobody else []
    return out


def run_stage(
    spark: SparkSession,
    cfg: RunConfig,
    layer: str,
    landing: DataFrame | None = None,
    log: RunLog | None = None,
) -> bool:
    """Run one layer; false when the guard keeps it from running.

    A failure is written to the log and raised, so that nothing after it runs.
    A log that is passed in is saved by its owner.
    """
    own = RunLog(cfg) if log is None else log
    error = None
    try:
        return _stage(spark, cfg, layer, landing, own)
    except Exception as raised:
        error = raised
        own.add(layer, "failed", clock(cfg), f"{type(raised).__name__}: {raised}", status="failed")
        raise
    finally:
        if log is None:
            own.save_after(spark, error)


def _stage(
    spark: SparkSession, cfg: RunConfig, layer: str, landing: DataFrame | None, log: RunLog
) -> bool:
    moment = clock(cfg)
    if not may_run(cfg, moment):
        log.add(layer, "guard", moment, "not a business moment, nothing done", status="skipped")
        return False
    cfg = with_known_labels(spark, cfg)
    mark = last_loaded(spark, cfg, layer, moment)
    log.add(layer, "watermark", clock(cfg), f"most recent bar: {mark.last}")
    loaded_at = load_time(cfg)
    work = {
        "bronze": lambda: bronze_work(spark, cfg, mark, loaded_at, landing),
        "silver": lambda: silver_work(spark, cfg, mark),
        "gold": lambda: gold_work(spark, cfg, mark),
    }[layer]()
    if work.rows is None:
        ledger.got_through(spark, cfg, layer, work.through)
        log.add(layer, "write", clock(cfg), "nothing new", rows_out=0)
        return True
    log.add(layer, "transform", clock(cfg), f"{layer} transformation planned")
    lost = losses(cfg, layer, work)
    # Bronze is a record of loads and only ever grows.
    mode = "append" if layer == "bronze" else cfg.write
    path = cfg.table(layer)
    before = work.days or set()
    if mode == "overwrite" and cfg.fmt not in SELF_DESCRIBING:
        before = stored_days(find_table(spark, path, cfg.stored_schema(layer), cfg.fmt), work.mark.day, work.days)
    written = Observation("written")
    registered = layer == "bronze" and cfg.label_registry
    counted = work.rows.observe(
        written, F.count(F.lit(1)).alias("rows"), F.collect_set(schemas.PARTITION).alias("days"),
        *([F.collect_set("Price").alias("labels")] if registered else []),
    )
    write_days(counted, path, mode, cfg.fmt, work.mark.day, work.days)
    seen = written.get
    days = set(seen.get("days") or ())
    if mode == "overwrite" and cfg.fmt not in SELF_DESCRIBING:
        drop_days(spark, path, before - days)
    said = [f", {n} rows {what}" for what, n in lost]
    if registered:
        new = ledger.labels_seen(spark, cfg, (label for label in seen.get("labels") or () if label not in schemas.LABELS), loaded_at)
        said += [f", new label {label}" for label in new]
    if cfg.late == "recompute":
        ledger.days_changed(spark, cfg, layer, days | (work.days or set()), loaded_at)
    ledger.got_through(spark, cfg, layer, work.through)
    ledger.files_read(spark, cfg, work.files, loaded_at)
    log.add(layer, "write", clock(cfg), "".join(["table saved", *said]), rows_out=seen["rows"])
    return True


def run_chain(spark: SparkSession, cfg: RunConfig, landing: DataFrame | None = None) -> None:
    """Bronze, silver and gold in order; an error ends the chain. The log is written once."""
    log = RunLog(cfg)
    error = None
    try:
        for layer in LAYERS:
            if not run_stage(spark, cfg, layer, landing if layer == "bronze" else None, log):
                return
    except Exception as raised:
        error = raised
        raise
    finally:
        log.save_after(spark, error)
