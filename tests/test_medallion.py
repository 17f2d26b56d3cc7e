"""Stage runs in fresh folders: increments, reruns, modes, failures, logs."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barmill import schemas
from barmill.config import DAY, HOUR, MaskKey, RunConfig
from barmill.operators import masking, reshape
from barmill.operators.previous_close import with_previous_close
from barmill.plans import medallion
from barmill.plans.runlog import RunLog, read_run_log, read_text_log
from barmill.sources import tables
from helpers import EXAMPLE, EXAMPLE_BARS, KEY, OTHER_KEY, as_set, at, landing_rows


def config(tmp_path, granularity=DAY, **options):
    options.setdefault("guard", False)
    return RunConfig(root=str(tmp_path / "lake"), granularity=granularity, key=KEY, **options)


def load(spark, cfg, rows):
    medallion.run_chain(spark, cfg, landing_rows(spark, rows))
    return medallion.read_layer(spark, cfg, "gold")


COMPARED = ("Date", "Ticker", "Dia2", "Adj_Close_ant", "Volatility_label")


def expected(rows=EXAMPLE, fall=False):
    return sorted(
        ((at(r[0]), r[1], r[4], r[5], r[9] or ("Decreasing" if fall else None)) for r in rows),
        key=repr,
    )


def test_first_run_creates_all_layers(spark, tmp_path):
    cfg = config(tmp_path)
    gold = load(spark, cfg, EXAMPLE_BARS)
    assert gold.columns == schemas.GOLD_DAILY.fieldNames()
    assert as_set(gold, *COMPARED) == expected()
    silver = medallion.read_layer(spark, cfg, "silver")
    assert silver.columns == schemas.SILVER.fieldNames()
    clear = {r[1] for r in EXAMPLE_BARS}
    assert not clear & {r[0] for r in silver.select("Ticker").collect()}


@pytest.mark.parametrize("write", ["overwrite", "append"])
def test_increments_equal_one_load_and_reruns_change_nothing(spark, tmp_path, write):
    cfg = config(tmp_path, write=write)
    for last in ("2024-01-02", "2024-01-04", "2024-01-05"):
        gold = load(spark, cfg, [r for r in EXAMPLE_BARS if r[0] <= last])
    assert as_set(gold, *COMPARED) == expected()
    gold = load(spark, cfg, EXAMPLE_BARS)
    assert as_set(gold, *COMPARED) == expected()
    bronze = medallion.read_layer(spark, cfg, "bronze")
    assert bronze.count() == 6 * len(EXAMPLE_BARS)


def test_slice_lookback_loses_the_first_day_of_an_increment(spark, tmp_path):
    cfg = config(tmp_path, lookback="slice", write="append")
    load(spark, cfg, [r for r in EXAMPLE_BARS if r[0] <= "2024-01-04"])
    gold = load(spark, cfg, EXAMPLE_BARS)
    last = gold.filter(F.to_date("Date") == F.lit(date(2024, 1, 5)))
    assert as_set(last, "Dia2", "Adj_Close_ant") == [(None, None)] * 2


def test_previous_close_is_found_however_old(spark, tmp_path):
    cfg = config(tmp_path)
    load(spark, cfg, [("2023-01-02", "A", 1.0, 1.0)])
    gold = load(spark, cfg, [("2023-01-02", "A", 1.0, 1.0), ("2024-01-02", "A", 3.0, 1.0)])
    assert as_set(gold, "Date", "Dia2", "Adj_Close_ant") == [
        (at("2023-01-02"), None, None),
        (at("2024-01-02"), "2023-01-02", 1.0),
    ]


def test_compat_sums_duplicates_and_labels_nulls_as_falls(spark, tmp_path):
    cfg = config(tmp_path, compat=True)
    gold = load(spark, cfg, EXAMPLE_BARS + [("2024-01-05", "AAAA3.SA", 1.1, 1.0)])
    row = gold.filter("key = '05/01/2024AAAA3.SA'").first()
    assert (row["Adj_Close"], row["Volume"]) == (11.0, 101.0)
    first = gold.filter("Dia2 is null").select("Volatility_label").distinct()
    assert as_set(first, "Volatility_label") == [("Decreasing",)]


def test_duplicates_in_one_load_do_not_add_up(spark, tmp_path):
    gold = load(spark, config(tmp_path), EXAMPLE_BARS + EXAMPLE_BARS)
    assert as_set(gold, *COMPARED) == expected()


def test_since_limits_a_first_run(spark, tmp_path):
    cfg = config(tmp_path, since=at("2024-01-04"))
    gold = load(spark, cfg, EXAMPLE_BARS)
    assert gold.agg(F.min("Date")).first()[0] == at("2024-01-04")
    assert gold.count() == 5


def test_hourly_load_resumed_in_mid_day(spark, tmp_path):
    daily = config(tmp_path, DAY)
    load(spark, daily, EXAMPLE_BARS)
    cfg = config(tmp_path, HOUR)
    hours = [(f"2024-01-05T{h}:00", "AAAA3.SA", 9.0, 1.0) for h in (10, 11, 12, 13)]
    load(spark, cfg, hours[:3])
    gold = load(spark, cfg, hours)
    assert gold.columns == schemas.GOLD_HOURLY.fieldNames()
    assert as_set(gold, "Date", "Dia2", "Adj_Close_ant") == [
        (at(h[0]), "2024-01-04", 11.0) for h in hours
    ]
    silver = medallion.open_layer(spark, cfg, "silver")
    assert silver.select(schemas.PARTITION).distinct().count() == 1
    assert silver.count() == 4


def test_hourly_gold_without_any_daily_table(spark, tmp_path):
    cfg = config(tmp_path, HOUR)
    gold = load(spark, cfg, [("2024-01-05T10:00", "A", 9.0, 1.0)])
    assert as_set(gold, "Ticker", "Dia2", "Adj_Close_ant") == [("A", None, None)]


def test_symbols_and_landing_files(spark, tmp_path):
    landing_rows(spark, EXAMPLE_BARS).write.parquet(str(tmp_path / "landing"))
    spark.createDataFrame([("BBBB4.SA",)], "Ticker string").write.parquet(str(tmp_path / "symbols"))
    cfg = config(tmp_path, landing=str(tmp_path / "landing"), symbols=str(tmp_path / "symbols"))
    medallion.run_chain(spark, cfg)
    assert medallion.read_layer(spark, cfg, "gold").count() == 3


def test_header_wide_landing(spark, tmp_path):
    wide = spark.createDataFrame(
        [(at("2024-01-02"), 10.0, 5.0, None), (at("2024-01-03"), 11.0, 6.0, 2.0)],
        "Date timestamp_ntz, `Adj Close|AAAA3.SA` double, `Volume|AAAA3.SA` double, "
        "`Adj Close|BBBB4.SA` double",
    )
    symbols = str(tmp_path / "symbols")
    spark.createDataFrame([("AAAA3.SA",), ("BBBB4.SA",)], "Ticker string").write.parquet(symbols)
    cfg = config(tmp_path, symbols=symbols)
    medallion.run_chain(spark, cfg, wide)
    assert medallion.read_layer(spark, cfg, "bronze").count() == 6
    gold = medallion.read_layer(spark, cfg, "gold")
    assert as_set(gold, "Ticker", "Adj_Close", "Volume", "Adj_Close_ant") == [
        ("AAAA3.SA", 10.0, 5.0, None),
        ("AAAA3.SA", 11.0, 6.0, 10.0),
        ("BBBB4.SA", 2.0, None, None),
    ]


def test_orc_tables(spark, tmp_path):
    cfg = config(tmp_path, fmt="orc")
    for last in ("2024-01-04", "2024-01-05"):
        gold = load(spark, cfg, [r for r in EXAMPLE_BARS if r[0] <= last])
    assert as_set(gold, *COMPARED) == expected()
    stacked = tables.serving_table(spark, cfg.table("gold"), fmt="orc")
    assert as_set(stacked, *COMPARED) == expected()


def test_gcm_tokens(spark, tmp_path):
    gold = load(spark, config(tmp_path, token="gcm"), EXAMPLE_BARS)
    assert as_set(gold, *COMPARED) == expected()


def test_rows_of_another_key(spark, tmp_path):
    cfg = config(tmp_path)
    landing = landing_rows(spark, EXAMPLE_BARS)
    for layer in ("bronze", "silver"):
        medallion.run_stage(spark, cfg, layer, landing)
    wrong = {"root": cfg.root, "granularity": DAY, "key": OTHER_KEY, "guard": False}
    with pytest.raises(Exception, match="invalid token"):
        medallion.run_stage(spark, RunConfig(bad_token="raise", **wrong), "gold")
    medallion.run_stage(spark, RunConfig(**wrong), "gold")
    gold = medallion.read_layer(spark, cfg, "gold")
    assert as_set(gold, "Ticker", "key", "Adj_Close_ant") == [(None, None, None)] * len(EXAMPLE)


def test_failure_is_logged_raised_and_ends_the_chain(spark, tmp_path):
    cfg = config(tmp_path)
    broken = landing_rows(spark, EXAMPLE_BARS).drop("Close")
    with pytest.raises(Exception):
        medallion.run_chain(spark, cfg, broken)
    log = read_run_log(spark, cfg)
    assert as_set(log.filter("status = 'failed'"), "layer", "step") == [("bronze", "failed")]
    assert as_set(log.select("layer").distinct(), "layer") == [("bronze",)]
    assert tables.find_table(spark, cfg.table("bronze"), schemas.BRONZE_STORED) is None
    assert tables.find_table(spark, cfg.table("silver"), schemas.SILVER) is None


def test_a_log_that_fails_does_not_hide_the_failure(spark, tmp_path, monkeypatch):
    def fail(*_):
        raise OSError("disk full")

    monkeypatch.setattr(RunLog, "save", fail)
    with pytest.raises(ValueError, match="landing table") as caught:
        medallion.run_chain(spark, config(tmp_path), landing_rows(spark, EXAMPLE_BARS).drop("Close"))
    assert "disk full" in caught.value.__notes__[0]
    with pytest.raises(OSError, match="disk full"):
        medallion.run_stage(spark, config(tmp_path), "bronze", landing_rows(spark, EXAMPLE_BARS))


def test_wide_landing_on_a_path_is_recognised_and_a_wrong_one_refused(spark, tmp_path):
    path = str(tmp_path / "landing")
    wide = spark.createDataFrame([(at("2024-01-02"), 10.0, 5.0)], "Date timestamp_ntz, `Adj Close|A` double, `Volume|A` double")
    wide.write.parquet(path)
    later = wide.withColumns({"Date": F.col("Date") + F.expr("interval 1 day"), "Adj Close|B": F.lit(7.0)})
    later.write.mode("append").parquet(path)
    cfg = config(tmp_path, landing=path)
    medallion.run_chain(spark, cfg)
    gold = medallion.read_layer(spark, cfg, "gold")
    assert as_set(gold, "Ticker", "Adj_Close", "Volume") == [("A", 10.0, 5.0), ("A", 10.0, 5.0), ("B", 7.0, None)]
    for wrong in (wide.drop("Date"), wide.select("Date"), landing_rows(spark, EXAMPLE_BARS).drop("Volume")):
        other = config(tmp_path / "wrong")
        with pytest.raises(ValueError, match="landing table|no Ticker"):
            medallion.run_chain(spark, other, wrong)
        assert tables.find_table(spark, other.table("bronze"), schemas.BRONZE_STORED) is None


def test_listing_of_symbols(spark, tmp_path):
    listing = [("AAAA3", "brazil"), ("BBBB4", "chile"), ("CCCC3", "brazil"), ("LONGER3", "brazil")]
    spark.createDataFrame(listing, schemas.SYMBOLS).write.parquet(str(tmp_path / "symbols"))
    gold = load(spark, config(tmp_path, symbols=str(tmp_path / "symbols")), EXAMPLE_BARS)
    assert as_set(gold.select("Ticker").distinct(), "Ticker") == [("AAAA3.SA",), ("CCCC3.SA",)]


def test_extra_labels_are_carried_and_others_counted(spark, tmp_path):
    bars = landing_rows(spark, EXAMPLE_BARS).withColumns({"Dividends": F.lit(0.5), "Splits": F.lit(2.0)})
    cfg = config(tmp_path, labels=(*schemas.LABELS, "Dividends"))
    medallion.run_chain(spark, cfg, bars)
    gold = medallion.read_layer(spark, cfg, "gold")
    assert as_set(gold.select("Dividends").distinct(), "Dividends") == [(0.5,)]
    assert as_set(gold, *COMPARED) == expected()
    fewer = RunConfig(root=cfg.root, granularity=DAY, key=KEY, guard=False)
    medallion.run_stage(spark, fewer, "silver")
    messages = [r["message"] for r in read_run_log(spark, cfg).filter("step = 'write' and layer = 'silver'").collect()]
    assert sorted(messages) == [
        "table saved, 2 rows of label Dividends, 2 rows of label Splits",
        f"table saved, {len(EXAMPLE_BARS)} rows of label Splits",
    ]
    with pytest.raises(ValueError, match="labels must start"):
        config(tmp_path, labels=("Close",))


def test_bars_without_a_date_are_counted_by_every_run(spark, tmp_path):
    cfg = config(tmp_path)
    bars = landing_rows(spark, EXAMPLE_BARS)
    undated = bars.limit(2).withColumn("Date", F.lit(None).cast("timestamp_ntz"))
    for part in (undated.unionByName(bars.filter("Date < '2024-01-04'")), undated.unionByName(bars)):
        medallion.run_chain(spark, cfg, part)
    assert as_set(medallion.read_layer(spark, cfg, "gold"), *COMPARED) == expected()
    saved = read_run_log(spark, cfg).filter("layer = 'bronze' and step = 'write'").select("message").distinct()
    assert as_set(saved, "message") == [("table saved, 2 rows without a date",)]


def test_a_day_that_became_empty_goes(spark, tmp_path):
    cfg = config(tmp_path)
    load(spark, cfg, EXAMPLE_BARS)
    gone = [(at("2024-01-05"), "Adj Close", t, None, at("2030-01-01")) for t in ("AAAA3.SA", "BBBB4.SA")]
    tables.write_days(tables.by_day(spark.createDataFrame(gone, schemas.BRONZE_STORED)), cfg.table("bronze"), "append")
    for layer in ("silver", "gold"):
        medallion.run_stage(spark, cfg, layer)
        days = as_set(medallion.open_layer(spark, cfg, layer).select("p_date").distinct(), "p_date")
        assert days == [(date(2024, 1, d),) for d in (2, 3, 4)]


def test_since_is_a_start_and_no_mark(spark, tmp_path):
    cfg = config(tmp_path, since=at("2024-01-04"))
    medallion.run_stage(spark, config(tmp_path), "bronze", landing_rows(spark, EXAMPLE_BARS))
    for layer in ("silver", "gold"):
        medallion.run_stage(spark, cfg, layer)
        assert medallion.read_layer(spark, cfg, layer).agg(F.min("Date")).first()[0] == at("2024-01-04")


def test_late_columns_are_served(spark, tmp_path):
    load(spark, config(tmp_path), [r for r in EXAMPLE_BARS if r[0] < "2024-01-04"])
    more = config(tmp_path, labels=(*schemas.LABELS, "Dividends"))
    medallion.run_chain(spark, more, landing_rows(spark, EXAMPLE_BARS).withColumn("Dividends", F.lit(1.0)))
    served = tables.serving_table(spark, more.table("gold"))
    assert as_set(served.filter("Dividends is not null").select(F.to_date("Date").alias("d")).distinct(), "d") == [(date(2024, 1, 4),), (date(2024, 1, 5),)]
    assert served.count() == len(EXAMPLE)


def test_logs(spark, tmp_path):
    moment = at("2024-01-05T19:00:01")
    cfg = config(tmp_path, clock=lambda: moment)
    load(spark, cfg, EXAMPLE_BARS)
    log = read_run_log(spark, cfg)
    assert log.columns == schemas.RUN_LOG.fieldNames()
    written = as_set(log.filter("step = 'write'"), "layer", "rows_out", "status")
    assert written == [("bronze", 54, "ok"), ("gold", 9, "ok"), ("silver", 9, "ok")]
    lines = [r["Log"] for r in read_text_log(spark, cfg).filter("layer = 'bronze'").collect()]
    assert sorted(lines) == [
        "bronze transformation planned, 2024-01-05 19:00:01",
        "most recent bar: None, 2024-01-05 19:00:01",
        "table saved, 2024-01-05 19:00:01",
    ]
    stacked = tables.serving_table(spark, cfg.table("gold"))
    assert stacked.count() == 9


def test_rows_without_a_label_are_counted(spark, tmp_path):
    cfg = config(tmp_path)
    medallion.run_stage(spark, cfg, "bronze", landing_rows(spark, EXAMPLE_BARS))
    stray = spark.createDataFrame(
        [(at("2024-01-05"), None, "AAAA3.SA", 7.0, at("2024-01-05T20:00"))], schemas.BRONZE_STORED
    )
    tables.write_days(tables.by_day(stray), cfg.table("bronze"), "append")
    medallion.run_stage(spark, cfg, "silver")
    assert medallion.read_layer(spark, cfg, "silver").columns == schemas.SILVER.fieldNames()
    saved = read_run_log(spark, cfg).filter("layer = 'silver' and step = 'write'").first()
    assert (saved["message"], saved["rows_out"]) == ("table saved, 1 rows without a label", 9)


@pytest.mark.parametrize(
    "granularity, moment, ran",
    [
        (DAY, "2024-01-02T19:00", True),
        (DAY, "2024-01-01T19:00", False),
        (DAY, "2024-01-06T19:00", False),
        (HOUR, "2024-01-02T22:00", False),
        (HOUR, "2024-01-02T13:00", True),
    ],
)
def test_guard_decides_whether_a_stage_runs(tmp_path, granularity, moment, ran):
    cfg = config(tmp_path, granularity, guard=True)
    assert medallion.may_run(cfg, at(moment)) is ran
    literal = config(tmp_path, granularity, guard=True, compat=True)
    assert medallion.may_run(literal, at(moment)) is (moment != "2024-01-06T19:00")


def test_skipped_stage_is_logged(spark, tmp_path):
    cfg = config(tmp_path, guard=True, clock=lambda: at("2024-01-06T12:00"))
    assert medallion.run_stage(spark, cfg, "bronze") is False
    assert as_set(read_run_log(spark, cfg), "step", "status") == [("guard", "skipped")]


def test_configuration_is_checked(tmp_path, monkeypatch):
    with pytest.raises(ValueError, match="32 bytes"):
        MaskKey(b"short")
    with pytest.raises(ValueError, match="lookback"):
        config(tmp_path, lookback="forever")
    assert "730ff4" not in repr(config(tmp_path)).lower() and repr(KEY.raw) not in repr(KEY)
    monkeypatch.setenv("BARMILL_TEST_KEY", "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4=")
    assert MaskKey.from_env("BARMILL_TEST_KEY") == KEY
    with pytest.raises(KeyError):
        MaskKey.from_env("BARMILL_NO_SUCH_KEY")


def test_existing_tokens_of_a_table_can_be_read(spark):
    """A table masked elsewhere with the same public format unmasks."""
    token = (
        "gAAAAAAdwJ6wAAECAwQFBgcICQoLDA0ODy021cpGVWKZ_eEwCGM4BLLF_5CV9dOPmrhuVUPgJobwOz7JcbmrR64j"
        "VmpU4IwqDA=="
    )
    df = spark.createDataFrame([(token, 1.0)], "Ticker string, Close double")
    assert masking.unmask_last(df, KEY).first() == (1.0, "hello")


def test_ninety_days_in_weekly_loads(spark, tmp_path):
    """Blocks of the window and the bounded look back agree with one load."""
    first = date(2024, 1, 1)
    rows = [
        ((first + timedelta(days=i)).isoformat(), f"T{t}", float(i + t), 1.0)
        for i in range(90)
        for t in range(3)
        if (i + t) % 5
    ]
    cfg = config(tmp_path)
    for weeks in (40, 60, 91):
        gold = load(spark, cfg, [r for r in rows if r[0] < (first + timedelta(days=weeks)).isoformat()])
    whole = reshape.pivot_labels(reshape.melt_bars(landing_rows(spark, rows)), duplicates="max")
    again = with_previous_close(whole)
    names = ("Date", "Ticker", "Dia2", "Adj_Close_ant")
    assert as_set(gold, *names) == as_set(again, *names)
