"""Named queries over the test tables, one or more per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill import schemas
from barmill.config import DAY, HOUR, Granularity, MaskKey, RunConfig
from barmill.operators import calendar, incremental, masking, reshape, serving
from barmill.operators.gold import derive
from barmill.operators.previous_close import with_daily_close, with_previous_close
from barmill.plans import compaction, layers, medallion
from barmill.plans.runlog import read_run_log, read_text_log
from barmill.sources import landing, tables
from barmill.sources.market_events import (
    event_bars,
    event_days,
    event_prices,
    scan,
    ticker,
)

Query = Callable[[SparkSession, str], DataFrame]

# The published test key of the token format, and the load mark
# the incremental queries start from.
TEST_KEY = MaskKey.from_text("cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4=")
LOADED_DAY = datetime(2024, 1, 15)
LOADED_HOUR = datetime(2024, 1, 15, 12)

# Fixed clocks of the guarded runs: a holiday and the business day after it.
HOLIDAY = datetime(2024, 1, 1, 15)
WORKDAY = datetime(2024, 1, 2, 15)


def scratch(spark: SparkSession) -> str:
    """A new folder for a lake in the shared folder. Whoever runs the queries removes the lakes."""
    return f"{tables.shared_folder(spark)}/barmill-{uuid.uuid4().hex}"


# --- shared inputs ---------------------------------------------------------


def bronze_rows(spark: SparkSession, sf_dir: str, granularity: Granularity) -> DataFrame:
    return reshape.melt_bars(event_bars(spark, sf_dir, granularity))


def silver_bars(spark: SparkSession, sf_dir: str, granularity: Granularity) -> DataFrame:
    """Bars through the long form and back, as the two first layers do it."""
    long = bronze_rows(spark, sf_dir, granularity)
    return reshape.complete_bars(reshape.pivot_labels(long, duplicates="max"))


def wide_bars(spark: SparkSession, sf_dir: str, granularity: Granularity) -> DataFrame:
    return event_bars(spark, sf_dir, granularity).withColumnRenamed("Adj Close", "Adj_Close")


def business_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily closes of business days only, so that some bar days have none."""
    return calendar.business_days(wide_bars(spark, sf_dir, DAY))


def business_event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.business_days(event_days(spark, sf_dir))


# --- bronze ----------------------------------------------------------------


def bronze_melt(granularity: Granularity) -> Query:
    return lambda spark, sf_dir: bronze_rows(spark, sf_dir, granularity)


def bronze_melt_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-level header (label, event type) melted; empty hours stay null."""
    prices = event_prices(spark, sf_dir, HOUR)
    cells = {}
    for kind in reshape.discover_labels(prices):
        here = F.col("Price") == kind
        priced = F.when(here, F.col("value"))
        cells[f"Close|{kind}"] = F.max_by(priced, F.when(here, F.col("event_id")))
        cells[f"High|{kind}"] = F.max(priced)
        cells[f"Low|{kind}"] = F.min(priced)
        cells[f"Volume|{kind}"] = F.count(priced).cast("double")
    wide = prices.groupBy("Date").agg(*[c.alias(name) for name, c in cells.items()])
    return reshape.melt_landing(wide)


def symbol_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = scan(spark, sf_dir, "part").select(
        F.col("p_brand").alias("symbol"), F.col("p_type").alias("country")
    )
    return landing.symbol_universe(listed.distinct(), "PROMO", longest=7)


def listed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of instruments by nation."""
    nation = scan(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        scan(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(ticker(F.col("c_custkey")).alias("symbol"), F.col("n_name").alias("country"))
    )


def bars_for_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of the instruments one nation lists."""
    listed = listed_customers(spark, sf_dir)
    symbols = landing.symbol_universe(listed, "NATION_7", longest=None, suffix="")
    return landing.bars_for_symbols(wide_bars(spark, sf_dir, DAY), symbols)


def landing_increment(granularity: Granularity, last: datetime) -> Query:
    return lambda spark, sf_dir: landing.new_bars(
        event_bars(spark, sf_dir, granularity), last, granularity.step
    )


def watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.watermark(event_prices(spark, sf_dir, HOUR))


def incremental_slice(granularity: Granularity, last: datetime) -> Query:
    return lambda spark, sf_dir: incremental.since(bronze_rows(spark, sf_dir, granularity), last)


# --- silver ----------------------------------------------------------------


def silver_pivot(granularity: Granularity) -> Query:
    return lambda spark, sf_dir: silver_bars(spark, sf_dir, granularity)


def silver_pivot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates added up: daily value per instrument and event type.

    Values have two decimals, so adding them as decimals is exact.
    """
    prices = event_prices(spark, sf_dir, DAY).withColumn(
        "value", F.col("value").cast("decimal(18,2)")
    )
    kinds = reshape.discover_labels(prices)
    summed = reshape.pivot_labels(prices, kinds, duplicates="sum")
    return summed.withColumns({c: F.col(c).cast("double") for c in kinds})


def silver_pivot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies in one load and in two: hourly bars as copies of a day's bar.

    In a load the last hour counts, and the second load, of the morning hours,
    counts before the first.
    """
    cfg = run_config(scratch(spark), DAY, sequence="hour")
    hourly = event_bars(spark, sf_dir, HOUR).withColumn("hour", F.hour("Date"))
    copies = hourly.withColumn("Date", F.to_date("Date").cast("timestamp_ntz"))
    for number, part in enumerate((copies, copies.filter("hour < 12"))):
        load = layers.bronze(part, cfg, incremental.Mark(), WORKDAY + timedelta(seconds=number))
        tables.write_days(load, cfg.table("bronze"), "append")
    return reshape.complete_bars(reshape.pivot_labels(medallion.read_layer(spark, cfg, "bronze")))


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.dedupe_latest(
        event_prices(spark, sf_dir, DAY),
        ["Date", "Price", "Ticker"],
        order="event_id",
        unique_order=True,
    )


def mask_round_trip(token: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        masked = masking.mask(wide_bars(spark, sf_dir, DAY), TEST_KEY, token=token)
        return masking.unmask_last(masked, TEST_KEY, token=token)

    return query


def masked_bars(spark: SparkSession, sf_dir: str, token: str) -> DataFrame:
    """Masked tickers with the clear one beside them."""
    bars = wide_bars(spark, sf_dir, DAY).select("Date", "Volume", F.col("Ticker").alias("clear"), "Ticker")
    return masking.mask(bars, TEST_KEY, token=token, unique=("Date", "clear"))


def mask_hides_plaintext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per instrument and token form: every row has a token of its own, long, without the text, that opens."""

    def seen(token: str) -> DataFrame:
        both = masked_bars(spark, sf_dir, token).withColumn("token", F.col("Ticker"))
        opened = masking.unmask(both, TEST_KEY, token=token)
        return opened.groupBy("clear").agg(
            F.count_if(F.col("token").isin(F.col("clear"), F.reverse("clear"))).alias("shown"),
            F.count_if(F.length("token") < 40).alias("short"),
            F.count_distinct("token").alias("tokens"),
            F.count_if(F.col("Ticker") == F.col("clear")).alias("opened"),
        ).withColumn("form", F.lit(token))

    return seen("fernet").unionByName(seen("gcm"))


def mask_damaged_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of a bar whose volume is a multiple of three has one character changed."""

    def opened(token: str) -> DataFrame:
        at = F.substring("Ticker", 30, 1)
        changed = F.overlay("Ticker", F.when(at == "A", "B").otherwise("A"), F.lit(30))
        damaged = masked_bars(spark, sf_dir, token).withColumn(
            "Ticker", F.when(F.col("Volume") % 3 == 0, changed).otherwise(F.col("Ticker"))
        )
        return masking.unmask(damaged, TEST_KEY, token=token).groupBy("clear").agg(
            F.count_if(F.col("Ticker").isNull()).alias("lost"),
            F.count_if(F.col("Ticker") == F.col("clear")).alias("opened"),
        ).withColumn("form", F.lit(token))

    return opened("fernet").unionByName(opened("gcm"))


# --- calendar --------------------------------------------------------------


def business_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return business_closes(spark, sf_dir)


def trading_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.trading_hours(wide_bars(spark, sf_dir, HOUR))


def day_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.day_map(calendar.market_days(event_days(spark, sf_dir)))


def day_map_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.asof_day_map(
        calendar.market_days(event_days(spark, sf_dir)),
        calendar.market_days(business_event_days(spark, sf_dir)),
    )


# --- previous close --------------------------------------------------------


def prev_close_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = wide_bars(spark, sf_dir, DAY)
    return with_previous_close(bars, days=event_days(spark, sf_dir))


def prev_close_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_daily_close(
        wide_bars(spark, sf_dir, HOUR),
        business_closes(spark, sf_dir),
        days=event_days(spark, sf_dir),
        close_days=business_event_days(spark, sf_dir),
    )


def prev_close_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the rows being loaded count: their first day has no previous one."""
    bars = incremental.since(wide_bars(spark, sf_dir, DAY), LOADED_DAY)
    return with_previous_close(bars, incremental.since(event_days(spark, sf_dir), LOADED_DAY))


def prev_close_slice_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily closes are cut at the hourly mark too."""
    bars = incremental.since(wide_bars(spark, sf_dir, HOUR), LOADED_HOUR)
    closes = incremental.since(business_closes(spark, sf_dir), LOADED_HOUR)
    days = incremental.since(business_event_days(spark, sf_dir), LOADED_HOUR)
    return with_daily_close(bars, closes, lookback="slice", close_days=days)


# --- gold and serving ------------------------------------------------------


def gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = silver_bars(spark, sf_dir, DAY)
    return derive(with_previous_close(bars, days=event_days(spark, sf_dir)), DAY)


def gold_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars, closes = silver_bars(spark, sf_dir, HOUR), wide_bars(spark, sf_dir, DAY)
    days = event_days(spark, sf_dir)
    return derive(with_daily_close(bars, closes, days=days, close_days=days), HOUR)


def coarse_bars(spark: SparkSession, sf_dir: str, granularity: Granularity) -> DataFrame:
    """Bars in whole fifties, so that closes repeat and are zero; High is no number where the volume is even."""
    bars = event_bars(spark, sf_dir, granularity)
    prices = ("Adj Close", "Close", "High", "Low", "Open")
    coarse = bars.withColumns({c: F.floor(F.col(c) / 50) * 50.0 for c in prices})
    nan = F.when(F.col("Volume") % 2 == 0, float("nan")).otherwise(F.col("High"))
    long = reshape.melt_bars(coarse.withColumn("High", nan))
    return reshape.complete_bars(reshape.pivot_labels(long, duplicates="max"))


def gold_daily_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = coarse_bars(spark, sf_dir, DAY)
    return derive(with_previous_close(bars, days=event_days(spark, sf_dir)), DAY)


def gold_hourly_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars, closes = coarse_bars(spark, sf_dir, HOUR), coarse_bars(spark, sf_dir, DAY)
    days = event_days(spark, sf_dir)
    return derive(with_daily_close(bars, closes, days=days, close_days=days), HOUR)


def gold_daily_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(prev_close_slice(spark, sf_dir), DAY, null_is_fall=True)


def gold_hourly_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(prev_close_slice_hourly(spark, sf_dir), HOUR, null_is_fall=True)


def stack_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended loads of one table, read back and stacked."""
    bars = wide_bars(spark, sf_dir, DAY)
    path = scratch(spark) + "/bars"
    later = F.col("Date") > F.lit(LOADED_DAY).cast("timestamp_ntz")
    for part in (bars.filter(~later), bars.filter(later)):
        tables.write_days(tables.by_day(part), path, "append")
    return tables.serving_table(spark, path)


def serving_hourly_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both golds stored by day, and related from there."""
    root = scratch(spark)
    stored = []
    for granularity, rows in ((HOUR, gold_hourly(spark, sf_dir)), (DAY, gold_daily(spark, sf_dir))):
        path = f"{root}/{granularity.name}"
        tables.write_days(tables.by_day(rows), path, "append")
        stored.append(tables.read_table(spark, path, schemas.gold(hourly=granularity is HOUR)))
    return serving.relate(*stored)


def stack_changed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of one table, the early ones with whole volumes and without a column that the later ones have."""
    bars = wide_bars(spark, sf_dir, DAY)
    path = scratch(spark) + "/bars"
    late = F.col("Date") > F.lit(LOADED_DAY).cast("timestamp_ntz")
    whole = bars.filter(~late).withColumn("Volume", F.col("Volume").cast("int"))
    for part in (whole, bars.filter(late).withColumn("Dividends", F.col("Volume") / 2)):
        tables.write_days(tables.by_day(part), path, "append")
    return tables.serving_table(spark, path)


def serving_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both golds in buckets of day and instrument, and related without a shuffle."""
    root = scratch(spark)
    stored = []
    for granularity, rows in ((HOUR, gold_hourly(spark, sf_dir)), (DAY, gold_daily(spark, sf_dir))):
        name = f"gold_{granularity.name}_{root.rsplit('-', 1)[1]}"
        placed = rows.withColumn(schemas.PARTITION, F.to_date("Date"))
        tables.write_bucketed(placed, name, f"{root}/{granularity.name}", (schemas.PARTITION, "Ticker"), 8)
        stored.append(spark.table(name))
    return serving.relate(*stored)


def instrument_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of one instrument, from files laid out by instrument."""
    cfg = run_daily(spark, sf_dir, scratch(spark), gold_layout="instrument")
    return medallion.read_layer(spark, cfg, "gold").filter(F.col("Ticker") == "U7")


# --- whole runs ------------------------------------------------------------


def run_config(root: str, granularity: Granularity, **options) -> RunConfig:
    return RunConfig(root=root, granularity=granularity, key=TEST_KEY, **{"guard": False, **options})


def run_daily(spark: SparkSession, sf_dir: str, root: str, **options) -> RunConfig:
    cfg = run_config(root, DAY, **options)
    medallion.run_chain(spark, cfg, event_bars(spark, sf_dir, DAY))
    return cfg


def medallion_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = run_daily(spark, sf_dir, scratch(spark))
    return medallion.read_layer(spark, cfg, "gold")


def medallion_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table loaded in two runs, the second one repeated."""
    cfg = run_config(scratch(spark), DAY)
    bars = event_bars(spark, sf_dir, DAY)
    early = bars.filter(F.col("Date") <= F.lit(LOADED_DAY).cast("timestamp_ntz"))
    for part in (early, bars, bars):
        medallion.run_chain(spark, cfg, part)
    return medallion.read_layer(spark, cfg, "gold")


def compacted_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars loaded day by day in two halves each, then compacted: rows and files of bronze by day."""
    cfg = run_config(scratch(spark), HOUR)
    bars = event_bars(spark, sf_dir, HOUR)
    for hour in range(0, 24, 6):
        part = layers.bronze(bars.filter(F.floor(F.hour("Date") / 6) * 6 == hour), cfg, incremental.Mark(), WORKDAY + timedelta(hours=hour))
        tables.write_days(part, cfg.table("bronze"), "append")
    compaction.compact(spark, cfg, "bronze", least=4)
    few = tables.day_files(spark, cfg.table("bronze")).select(schemas.PARTITION, (F.col("files") < 4).alias("few"))
    rows = medallion.open_layer(spark, cfg, "bronze").groupBy(schemas.PARTITION).agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("Price") == "Volume", F.col("value"))).alias("volume")
    )
    return rows.join(few, schemas.PARTITION)


def medallion_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly gold over a daily silver, the hourly load resumed in mid-day."""
    root = scratch(spark)
    daily = run_config(root, DAY)
    for layer in ("bronze", "silver"):
        medallion.run_stage(spark, daily, layer, event_bars(spark, sf_dir, DAY))
    hourly = run_config(root, HOUR)
    bars = event_bars(spark, sf_dir, HOUR)
    early = bars.filter(F.col("Date") <= F.lit(LOADED_HOUR).cast("timestamp_ntz"))
    for part in (early, bars):
        medallion.run_chain(spark, hourly, part)
    return medallion.read_layer(spark, hourly, "gold")


def kind_wide(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """A wide table: an instrument for each event type, a column for each label of it."""
    prices = event_prices(spark, sf_dir, DAY)
    cells = {}
    for kind in reshape.discover_labels(prices):
        here = F.col("Price") == kind
        priced, order = F.when(here, F.col("value")), F.when(here, F.col("event_id"))
        cells[f"Adj Close|{kind}"] = cells[f"Close|{kind}"] = F.max_by(priced, order)
        cells[f"High|{kind}"], cells[f"Low|{kind}"] = F.max(priced), F.min(priced)
        cells[f"Open|{kind}"] = F.min_by(priced, order)
        cells[f"Volume|{kind}"] = F.count(priced).cast("double")
        cells |= {f"{label}|{kind}": F.count(priced) / 2 for label in extra}
    return prices.groupBy("Date").agg(*[c.alias(name) for name, c in cells.items()])


def kind_landing(spark: SparkSession, sf_dir: str, path: str, *extra: str) -> None:
    kind_wide(spark, sf_dir, *extra).write.parquet(path)


def landing_wide_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain over two files of the same dates: each holds some instruments, the second corrects cells of the first."""
    root = scratch(spark)
    wide = kind_wide(spark, sf_dir)
    kinds = sorted({c.split("|")[1] for c in wide.columns if "|" in c})
    own = {kind: [c for c in wide.columns if c.endswith(f"|{kind}")] for kind in kinds}
    corrected = f"Adj Close|{kinds[0]}"
    late = F.col("Date") > F.lit(LOADED_DAY).cast("timestamp_ntz")
    first = wide.select("Date", *(c for kind in kinds[:3] for c in own[kind]))
    second = wide.select(
        "Date", *(c for kind in kinds[3:] for c in own[kind]), F.when(late, F.col(corrected) + 1).alias(corrected)
    )
    for part in (first, second):
        part.write.mode("append").parquet(f"{root}/landing")
    cfg = run_config(root, DAY, landing=f"{root}/landing")
    medallion.run_chain(spark, cfg)
    return medallion.read_layer(spark, cfg, "gold")


def landing_tidy_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with a seventh number, some without an instrument: rows of each label in bronze, and what the log says."""
    root = scratch(spark)
    bars = event_bars(spark, sf_dir, DAY).withColumns(
        {"Dividends": F.col("Volume") / 2, "Ticker": F.when(F.col("Volume") % 3 != 0, F.col("Ticker"))}
    )
    bars.write.parquet(f"{root}/landing")
    cfg = run_config(root, DAY, landing=f"{root}/landing")
    for layer in ("bronze", "silver"):
        medallion.run_stage(spark, cfg, layer)
    labels = medallion.read_layer(spark, cfg, "bronze").groupBy(F.col("Price").alias("what")).agg(F.count("value").alias("n"))
    log = read_run_log(spark, cfg).filter("step = 'write'").select(F.concat_ws(": ", "layer", "message").alias("what"))
    return labels.unionByName(log.withColumn("n", F.lit(0).cast("long")))


def landing_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files consumed one by one, the later dates first; the last run finds no new file."""
    root = scratch(spark)
    bars = event_bars(spark, sf_dir, DAY)
    early = F.col("Date") <= F.lit(LOADED_DAY).cast("timestamp_ntz")
    cfg = run_config(root, DAY, landing=f"{root}/landing", consume="files", late="recompute")
    for part in (bars.filter(~early), bars.filter(early), None):
        if part is not None:
            part.write.mode("append").parquet(f"{root}/landing")
        medallion.run_chain(spark, cfg)
    stored = medallion.read_layer(spark, cfg, "bronze").count()
    return medallion.read_layer(spark, cfg, "gold").withColumn("bronze_rows", F.lit(stored).cast("long"))


def late_parts(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars that come in time, and those that come late: one whole day and, of another, each with an even volume."""
    day = F.dayofmonth("Date")
    late = (day == 10) | ((day == 20) & (F.col("Volume") % 2 == 0))
    return bars.filter(~late), bars.filter(late)


def medallion_late_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day, and some bars of another, come after later days were loaded: gold is what one load would make."""
    root = scratch(spark)
    cfg = run_config(root, DAY, landing=f"{root}/landing", consume="files", late="recompute")
    for part in late_parts(event_bars(spark, sf_dir, DAY)):
        part.write.mode("append").parquet(f"{root}/landing")
        medallion.run_chain(spark, cfg)
    return medallion.read_layer(spark, cfg, "gold")


def medallion_late_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily closes come late, and hourly gold is computed again for the hours that look back on them."""
    root = scratch(spark)
    daily = run_config(root, DAY, landing=f"{root}/landing", consume="files", late="recompute")
    hourly = run_config(root, HOUR, late="recompute")
    hours = event_bars(spark, sf_dir, HOUR)
    for part in late_parts(event_bars(spark, sf_dir, DAY)):
        part.write.mode("append").parquet(f"{root}/landing")
        for layer in ("bronze", "silver"):
            medallion.run_stage(spark, daily, layer)
        medallion.run_chain(spark, hourly, hours)
    return medallion.read_layer(spark, hourly, "gold")


def silver_new_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label that first comes with the second load is a column from then on, null before, without being configured."""
    cfg = run_config(scratch(spark), DAY, label_registry=True)
    bars = event_bars(spark, sf_dir, DAY)
    early = bars.filter(F.col("Date") <= F.lit(LOADED_DAY).cast("timestamp_ntz"))
    for part in (early, bars.withColumn("Dividends", F.col("Volume") / 2)):
        medallion.run_chain(spark, cfg, part)
    return medallion.read_layer(spark, cfg, "gold")


def medallion_landing_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain that reads the wide table from its path."""
    root = scratch(spark)
    kind_landing(spark, sf_dir, f"{root}/landing")
    cfg = run_config(root, DAY, landing=f"{root}/landing")
    medallion.run_chain(spark, cfg)
    return medallion.read_layer(spark, cfg, "gold")


def medallion_landing_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain that reads tidy bars and a listing of symbols from their paths."""
    root = scratch(spark)
    event_bars(spark, sf_dir, DAY).write.parquet(f"{root}/landing")
    listed_customers(spark, sf_dir).write.parquet(f"{root}/symbols")
    cfg = run_config(
        root, DAY, landing=f"{root}/landing", symbols=f"{root}/symbols", country="NATION_7",
        longest_symbol=None, symbol_suffix="",
    )
    medallion.run_chain(spark, cfg)
    return medallion.read_layer(spark, cfg, "gold")


def silver_pivot_extra_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seventh label carried to gold."""
    cfg = run_config(scratch(spark), DAY, labels=(*schemas.LABELS, "Dividends"))
    bars = event_bars(spark, sf_dir, DAY).withColumn("Dividends", F.col("Volume") / 2)
    medallion.run_chain(spark, cfg, bars)
    return medallion.read_layer(spark, cfg, "gold")


def labels_left_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What silver logs about a label that has no column."""
    root = scratch(spark)
    kind_landing(spark, sf_dir, f"{root}/landing", "Dividends")
    cfg = run_config(root, DAY, landing=f"{root}/landing")
    for layer in ("bronze", "silver"):
        medallion.run_stage(spark, cfg, layer)
    return read_run_log(spark, cfg).filter("step = 'write'").select("layer", "message")


def medallion_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load takes back the close of every bar of the last day, so that the day goes."""
    cfg = run_config(scratch(spark), DAY)
    bars = event_bars(spark, sf_dir, DAY)
    day = F.lit(LOADED_DAY).cast("timestamp_ntz")
    medallion.run_chain(spark, cfg, bars.filter(F.col("Date") <= day))
    withdrawn = bars.filter(F.col("Date") == day).withColumn("Adj Close", F.lit(None).cast("double"))
    later = layers.bronze(withdrawn, cfg, incremental.Mark(), medallion.load_time(cfg))
    tables.write_days(later, cfg.table("bronze"), "append")
    for layer in ("silver", "gold"):
        medallion.run_stage(spark, cfg, layer)
    return medallion.read_layer(spark, cfg, "gold")


def medallion_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal mode: every bar comes twice and is added up."""
    cfg = run_config(scratch(spark), DAY, compat=True)
    bars = event_bars(spark, sf_dir, DAY)
    medallion.run_chain(spark, cfg, bars.unionByName(bars))
    return medallion.read_layer(spark, cfg, "gold")


def medallion_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that add strictly later rows."""
    cfg = run_config(scratch(spark), DAY, write="append")
    bars = event_bars(spark, sf_dir, DAY)
    for part in (bars.filter(F.col("Date") <= F.lit(LOADED_DAY).cast("timestamp_ntz")), bars):
        medallion.run_chain(spark, cfg, part)
    return medallion.read_layer(spark, cfg, "gold")


def guarded_run(spark: SparkSession, sf_dir: str) -> RunConfig:
    """A run on a holiday, which the guard stops, and one on the next business day."""
    root = scratch(spark)
    for moment in (HOLIDAY, WORKDAY):
        cfg = run_config(root, DAY, guard=True, clock=lambda m=moment: m)
        medallion.run_chain(spark, cfg, event_bars(spark, sf_dir, DAY))
    return cfg


def medallion_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.read_layer(spark, guarded_run(spark, sf_dir), "gold")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guarded runs log."""
    log = read_run_log(spark, guarded_run(spark, sf_dir))
    return log.select("layer", "granularity", "step", "ts", "status", "rows_out", "message")


def text_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_text_log(spark, guarded_run(spark, sf_dir))


def run_log_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain over a landing table of another kind: it ends in bronze, says so, and stores nothing."""
    root = scratch(spark)
    scan(spark, sf_dir, "nation").write.parquet(f"{root}/landing")
    cfg = run_config(root, DAY, landing=f"{root}/landing", clock=lambda: WORKDAY)
    try:
        medallion.run_chain(spark, cfg)
    except ValueError:
        stored = medallion.read_layer(spark, cfg, "bronze").count()
        log = read_run_log(spark, cfg).select("layer", "step", "status", F.substring_index("message", ",", 1).alias("message"))
        return log.withColumn("stored", F.lit(stored))
    raise AssertionError("the wrong table was accepted")


QUERIES: dict[str, Query] = {
    "bronze_melt_daily": bronze_melt(DAY),
    "bronze_melt_hourly": bronze_melt(HOUR),
    "bronze_melt_landing": bronze_melt_landing,
    "symbol_universe": symbol_universe,
    "bars_for_symbols": bars_for_symbols,
    "landing_increment_daily": landing_increment(DAY, LOADED_DAY),
    "landing_increment_hourly": landing_increment(HOUR, LOADED_HOUR),
    "watermark": watermark,
    "incremental_slice_daily": incremental_slice(DAY, LOADED_DAY),
    "incremental_slice_hourly": incremental_slice(HOUR, LOADED_HOUR),
    "silver_pivot_daily": silver_pivot(DAY),
    "silver_pivot_hourly": silver_pivot(HOUR),
    "silver_pivot_events": silver_pivot_events,
    "silver_pivot_latest": silver_pivot_latest,
    "silver_pivot_extra_labels": silver_pivot_extra_labels,
    "silver_new_label": silver_new_label,
    "labels_left_out": labels_left_out,
    "landing_wide_files": landing_wide_files,
    "landing_tidy_extra": landing_tidy_extra,
    "landing_late_file": landing_late_file,
    "dedupe_latest": dedupe_latest,
    "mask_round_trip_gcm": mask_round_trip("gcm"),
    "mask_round_trip_fernet": mask_round_trip("fernet"),
    "mask_hides_plaintext": mask_hides_plaintext,
    "mask_damaged_tokens": mask_damaged_tokens,
    "business_days": business_days,
    "trading_hours": trading_hours,
    "day_map": day_map,
    "day_map_asof": day_map_asof,
    "prev_close_daily": prev_close_daily,
    "prev_close_hourly": prev_close_hourly,
    "prev_close_slice": prev_close_slice,
    "prev_close_slice_hourly": prev_close_slice_hourly,
    "gold_daily": gold_daily,
    "gold_hourly": gold_hourly,
    "gold_daily_edges": gold_daily_edges,
    "gold_hourly_edges": gold_hourly_edges,
    "gold_daily_compat": gold_daily_compat,
    "gold_hourly_compat": gold_hourly_compat,
    "stack_partitions": stack_partitions,
    "stack_changed_types": stack_changed_types,
    "compacted_appends": compacted_appends,
    "instrument_history": instrument_history,
    "serving_bucketed": serving_bucketed,
    "serving_hourly_daily": serving_hourly_daily,
    "medallion_daily": medallion_daily,
    "medallion_increments": medallion_increments,
    "medallion_hourly": medallion_hourly,
    "medallion_landing_wide": medallion_landing_wide,
    "medallion_landing_symbols": medallion_landing_symbols,
    "medallion_correction": medallion_correction,
    "medallion_late_bar": medallion_late_bar,
    "medallion_late_close": medallion_late_close,
    "medallion_compat": medallion_compat,
    "medallion_append": medallion_append,
    "medallion_guarded": medallion_guarded,
    "run_log": run_log,
    "run_log_failure": run_log_failure,
    "text_log": text_log,
}
