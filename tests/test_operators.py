"""Operators on hand-written rows."""

from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barmill import schemas
from barmill.config import DAY, HOUR
from barmill.functions import crypto
from barmill.functions.times import (easter_day, easter_sunday, is_holiday,
    easter_sunday,
    hour_start,
    is_business_moment,
    national_holidays,
)
from barmill.operators import calendar, incremental, masking, reshape, serving
from barmill.operators.gold import derive
from barmill.operators.previous_close import with_daily_close, with_previous_close
from barmill.sources import landing, tables
from helpers import (
    EXAMPLE,
    EXAMPLE_BARS,
    KEY,
    OTHER_KEY,
    as_set,
    at,
    landing_rows,
    long_rows,
    wide_rows,
)

MASK_TEXT = "hello"
MASK_TOKEN = (
    "gAAAAAAdwJ6wAAECAwQFBgcICQoLDA0ODy021cpGVWKZ_eEwCGM4BLLF_5CV9dOPmrhuVUPgJobwOz7JcbmrR64j"
    "VmpU4IwqDA=="
)


# --- melt and pivot --------------------------------------------------------


def test_melt_bars_keeps_nulls_and_turns_nan_into_null(spark):
    bars = landing_rows(spark, [("2024-01-02", "A", float("nan"), None)])
    rows = as_set(reshape.melt_bars(bars), "Price", "Ticker", "value")
    assert rows == sorted([(p, "A", None) for p in schemas.LABELS], key=repr)
    assert reshape.melt_bars(bars).columns == schemas.BRONZE.fieldNames()


def test_melt_landing_splits_two_header_levels(spark):
    wide = spark.createDataFrame(
        [(at("2024-01-02"), 1.0, None), (at("2024-01-03"), 2.0, 3.0)],
        "`index` timestamp_ntz, `Adj Close|AAAA3.SA` double, `Volume|BBBB4.SA` double",
    )
    assert as_set(reshape.melt_landing(wide, date="index"), "Date", "Price", "Ticker", "value") == [
        (at("2024-01-02"), "Adj Close", "AAAA3.SA", 1.0),
        (at("2024-01-02"), "Volume", "BBBB4.SA", None),
        (at("2024-01-03"), "Adj Close", "AAAA3.SA", 2.0),
        (at("2024-01-03"), "Volume", "BBBB4.SA", 3.0),
    ]


def test_pivot_of_melt_gives_the_bars_back(spark):
    bars = landing_rows(spark, EXAMPLE_BARS)
    back = reshape.pivot_labels(reshape.melt_bars(bars), duplicates="max")
    assert back.columns == schemas.SILVER.fieldNames()
    renamed = bars.withColumnRenamed("Adj Close", "Adj_Close")
    assert as_set(back, *back.columns) == as_set(renamed, *back.columns)


def test_pivot_takes_the_latest_load_of_a_duplicate(spark):
    rows = [
        (at("2024-01-02"), "Close", "A", 10.0, at("2024-01-02T19:00")),
        (at("2024-01-02"), "Close", "A", 9.0, at("2024-01-03T19:00")),
        (at("2024-01-02"), "Open", "A", 8.0, at("2024-01-02T19:00")),
        (at("2024-01-02"), "Open", "A", None, at("2024-01-03T19:00")),
    ]
    df = spark.createDataFrame(rows, schemas.BRONZE_STORED)
    assert as_set(reshape.pivot_labels(df), "Close", "Open") == [(9.0, None)]
    assert as_set(reshape.pivot_labels(df, duplicates="sum"), "Close") == [(19.0,)]
    with pytest.raises(ValueError, match="needs an order"):
        reshape.pivot_labels(df.drop(schemas.INGESTED))


def test_labels_left_out_are_counted(spark):
    df = long_rows(spark, [("2024-01-02", p, "A", 1.0) for p in (None, "Bid", "Bid", "Close")])
    assert as_set(reshape.left_out(df, schemas.LABELS), "label", "rows") == [("Bid", 2), (None, 1)]
    with pytest.raises(ValueError, match="more than 1"):
        reshape.discover_labels(df, most=1)


def test_copies_of_a_load_are_taken_whole(spark):
    rows = [(at("2024-01-02"), "A", 1.0, 9.0, 1), (at("2024-01-02"), "A", 2.0, 3.0, 2), (at("2024-01-02"), "B", 2.0, 1.0, 1), (at("2024-01-02"), "B", 1.0, 7.0, 1)]
    df = spark.createDataFrame(rows, "Date timestamp_ntz, Ticker string, Low double, High double, seq int")
    assert as_set(landing.one_copy(df, ("Date", "Ticker"), "seq"), "Ticker", "Low", "High") == [("A", 2.0, 3.0), ("B", 2.0, 1.0)]
    assert as_set(landing.one_copy(df.drop("seq"), ("Date", "Ticker")), "Ticker", "Low", "High") == [("A", 2.0, 3.0), ("B", 2.0, 1.0)]


def test_bars_without_a_date_are_never_new(spark):
    bars = landing_rows(spark, EXAMPLE_BARS).withColumn("Date", F.when(F.col("Ticker") != "CCCC3.SA", F.col("Date")))
    whole = landing.new_bars(bars, None, DAY.step)
    late = landing.new_bars(bars, at("2023-01-01"), DAY.step)
    since = landing.new_bars(bars, None, DAY.step, at("2023-01-02"))
    assert whole.count() == late.count() == since.count() == bars.filter("Date is not null").count()


def test_pivot_ignores_null_and_unknown_labels(spark):
    df = long_rows(spark, [("2024-01-02", None, "A", 1.0), ("2024-01-02", "Bid", "A", 2.0)])
    wide = reshape.pivot_labels(df, duplicates="max")
    assert wide.columns == schemas.SILVER.fieldNames()
    assert as_set(wide, "Close", "Volume") == [(None, None)]
    assert reshape.discover_labels(df) == ["Bid"]


def test_pivot_of_nothing_has_the_full_schema(spark):
    empty = reshape.complete_bars(reshape.pivot_labels(long_rows(spark, []), duplicates="max"))
    assert empty.columns == schemas.SILVER.fieldNames()
    assert empty.count() == 0


def test_complete_bars_need_an_adjusted_close_only(spark):
    df = long_rows(
        spark,
        [
            ("2024-01-02", "Adj Close", "A", 1.0),
            ("2024-01-02", "Volume", "B", 1.0),
            ("2024-01-02", "Adj Close", "C", None),
        ],
    )
    wide = reshape.complete_bars(reshape.pivot_labels(df, duplicates="max"))
    assert as_set(wide, "Ticker", "Volume") == [("A", None)]


@pytest.mark.parametrize("unique_order", [False, True])
def test_dedupe_latest(spark, unique_order):
    df = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 3, 1.0), ("a", 2, 9.0), ("b", 1, None)], "k string, o int, value double"
    )
    kept = reshape.dedupe_latest(df, ["k"], "o", unique_order=unique_order)
    assert as_set(kept, "k", "value") == [("a", 1.0), ("b", None)]


# --- sources ---------------------------------------------------------------


def test_symbol_universe_filters_country_and_length(spark):
    listed = spark.createDataFrame(
        [("ABCD3", "brazil"), ("ABCD11", "brazil"), ("XYZ", "chile")], schemas.SYMBOLS
    )
    assert as_set(landing.symbol_universe(listed, "brazil"), "Ticker") == [("ABCD3.SA",)]
    every = landing.symbol_universe(listed, "brazil", longest=None)
    assert as_set(every, "Ticker") == [("ABCD11.SA",), ("ABCD3.SA",)]


def test_bars_for_symbols_keeps_each_bar_once(spark):
    bars = wide_rows(spark, EXAMPLE_BARS)
    symbols = spark.createDataFrame([("BBBB4.SA",), ("BBBB4.SA",)], "Ticker string")
    kept = landing.bars_for_symbols(bars, symbols)
    assert kept.columns == bars.columns
    assert kept.count() == 3


def test_new_bars_start_one_step_later(spark):
    bars = wide_rows(spark, EXAMPLE_BARS)
    assert landing.new_bars(bars, None, DAY.step).count() == len(EXAMPLE_BARS)
    assert landing.new_bars(bars, at("2024-01-04"), DAY.step).count() == 2
    hourly = wide_rows(spark, [(f"2024-01-02T{h}:00", "A", 1.0, 1.0) for h in (10, 11, 12)])
    assert as_set(landing.new_bars(hourly, at("2024-01-02T10:00"), HOUR.step), "Date") == [
        (at("2024-01-02T11:00"),),
        (at("2024-01-02T12:00"),),
    ]


def test_from_pandas_turns_nan_into_null(spark):
    pdf = pd.DataFrame({"Date": [at("2024-01-02")], "Price": ["Close"], "Ticker": ["A"]})
    pdf["value"] = [float("nan")]
    for arrow in ("true", "false"):
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", arrow)
        df = tables.from_pandas(spark, pdf, schemas.BRONZE)
        assert as_set(df, "Date", "value") == [(at("2024-01-02"), None)]
    spark.conf.unset("spark.sql.execution.arrow.pyspark.enabled")


def test_serving_table_skips_logs_and_stacks(spark, tmp_path):
    bars = wide_rows(spark, EXAMPLE_BARS)
    roots = [str(tmp_path / "a"), str(tmp_path / "b")]
    tables.write_days(tables.by_day(bars), roots[0], "append")
    tables.write_days(tables.by_day(bars.drop("Volume")), roots[1], "append")
    lines = spark.createDataFrame([("x",)], schemas.LOG_LINE)
    tables.append_lines(lines, roots[0] + "/_log_daily")
    stacked = tables.serving_table(spark, *roots)
    assert stacked.count() == 2 * len(EXAMPLE_BARS)
    assert stacked.filter(F.col("Volume").isNull()).count() == len(EXAMPLE_BARS)
    assert schemas.PARTITION not in stacked.columns


# --- incremental -----------------------------------------------------------


def test_since_is_strict(spark):
    bars = wide_rows(spark, EXAMPLE_BARS)
    assert as_set(incremental.since(bars, at("2024-01-04")).select("Date").distinct(), "Date") == [
        (at("2024-01-05"),)
    ]
    assert incremental.since(bars, None).count() == len(EXAMPLE_BARS)


def test_watermark_of_frame_table_and_nothing(spark, tmp_path):
    bars = wide_rows(spark, EXAMPLE_BARS)
    assert incremental.watermark(bars).first()[0] == at("2024-01-05")
    assert incremental.watermark(bars.limit(0)).first()[0] is None
    path = str(tmp_path / "t")
    tables.write_days(tables.by_day(bars), path, "append")
    table = tables.read_table(spark, path, schemas.SILVER)
    assert incremental.watermark(table).first()[0] == at("2024-01-05")
    assert tables.find_table(spark, str(tmp_path / "none"), schemas.SILVER) is None
    assert tables.read_table(spark, str(tmp_path / "none"), schemas.SILVER).count() == 0


# --- calendar --------------------------------------------------------------


@pytest.mark.parametrize(
    "year, day",
    [
        (1954, date(1954, 4, 18)),
        (1981, date(1981, 4, 19)),
        (2000, date(2000, 4, 23)),
        (2019, date(2019, 4, 21)),
        (2024, date(2024, 3, 31)),
        (2025, date(2025, 4, 20)),
        (2038, date(2038, 4, 25)),
        (2049, date(2049, 4, 18)),
        (2076, date(2076, 4, 19)),
    ],
)
def test_easter(year, day):
    assert easter_sunday(year) == day


def test_national_holidays():
    days = dict(national_holidays([2023, 2024]))
    assert date(2024, 1, 1) in days and date(2024, 3, 29) in days
    assert date(2024, 11, 20) in days and date(2023, 11, 20) not in days


def test_business_days(spark):
    days = wide_rows(
        spark,
        [(d, "A", 1.0, 1.0) for d in ("2024-01-01", "2024-01-06", "2024-01-02", "2024-01-03T15:00")],
    )
    kept = calendar.business_days(days)
    assert as_set(kept, "Date") == [(at("2024-01-02"),), (at("2024-01-03T15:00"),)]
    own = spark.createDataFrame([(date(2024, 1, 2), "strike")], schemas.HOLIDAYS)
    assert as_set(calendar.business_days(days, own), "Date") == [
        (at("2024-01-01"),),
        (at("2024-01-03T15:00"),),
    ]


def test_holidays_of_any_year(spark):
    years = [1, 1583, 1969, 1979, 1980, 2000, 2023, 2024, 2038, 2101, 4099]
    days = spark.sql("select explode(sequence(date'1960-01-01', date'2110-12-31')) as d")
    found = {r[0] for r in days.filter(is_holiday(F.col("d"))).collect()}
    assert found == {d for d, _ in national_holidays(range(1960, 2111))}
    assert {date(1969, 12, 25), date(2101, 4, 15)} <= found
    easter = spark.createDataFrame([(y,) for y in years], "y int").select("y", easter_day(F.col("y")).alias("e"))
    assert {r.y: r.e for r in easter.collect()} == {y: easter_sunday(y) for y in years}


def test_trading_hours(spark):
    bars = wide_rows(spark, [(f"2024-01-02T{h}:00", "A", 1.0, 1.0) for h in (11, 12, 21, 22)])
    assert [r[0].hour for r in as_set(calendar.trading_hours(bars), "Date")] == [12, 21]


@pytest.mark.parametrize(
    "moment, hours, allowed",
    [
        ("2024-01-01T13:00", None, False),
        ("2024-01-06T13:00", None, False),
        ("2024-01-02T23:00", None, True),
        ("2024-01-02T11:59", (12, 21), False),
        ("2024-01-02T12:00", (12, 21), True),
        ("2024-01-02T21:59", (12, 21), True),
        ("2024-01-02T22:00", (12, 21), False),
    ],
)
def test_guard(moment, hours, allowed):
    assert is_business_moment(at(moment), hours=hours) is allowed


def test_day_map_is_consecutive_without_adaptive_execution(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        first = datetime(2024, 1, 1)
        rows = [(first + timedelta(days=i),) for i in range(30)] * 3
        days = spark.createDataFrame(rows, "Date timestamp_ntz").repartition(13)
        mapped = sorted(tuple(r) for r in calendar.day_map(calendar.market_days(days)).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    expected = [date(2024, 1, 1) + timedelta(days=i) for i in range(30)]
    assert [m[0] for m in mapped] == expected
    assert [m[1] for m in mapped] == [None, *expected[:-1]]
    assert [m[2] for m in mapped] == list(range(1, 31))


# --- masking ---------------------------------------------------------------


def one(spark, text):
    return spark.createDataFrame([(text,)], "Ticker string")


def test_fernet_matches_the_published_vector(spark):
    df = one(spark, MASK_TEXT).select(
        crypto.fernet_body(
            F.col("Ticker"), KEY, seconds=F.lit(499162800), iv=crypto.binary(bytes(range(16)))
        ).alias("body")
    )
    assert df.select(crypto.fernet_sign(F.col("body"), KEY)).first()[0] == MASK_TOKEN
    assert masking.unmask(one(spark, MASK_TOKEN), KEY).first()[0] == MASK_TEXT


@pytest.mark.parametrize("token", ["fernet", "gcm"])
def test_mask_round_trip(spark, token):
    texts = [None, "", "A", "AAAA3.SA", "ção ü", "x" * 500]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "Ticker string, i int")
    masked = masking.mask(df, KEY, token=token).cache()
    assert masked.filter(F.col("Ticker").contains("\n") | F.col("Ticker").contains("\r")).count() == 0
    back = masking.unmask_last(masked, KEY, token=token)
    assert back.columns == ["i", "Ticker"]
    assert as_set(back, "i", "Ticker") == sorted(enumerate(texts), key=repr)


@pytest.mark.parametrize("token", ["fernet", "gcm"])
def test_tokens_are_randomised(spark, token):
    df = spark.range(10000).select(F.lit("AAAA3.SA").alias("Ticker"))
    tokens = [r[0] for r in masking.mask(df, KEY, token=token).collect()]
    assert len(set(tokens)) == 10000
    again = spark.createDataFrame([(t,) for t in tokens], "Ticker string")
    assert masking.unmask(again, KEY, token=token).filter("Ticker = 'AAAA3.SA'").count() == 10000


@pytest.mark.parametrize("token", ["fernet", "gcm"])
def test_bad_tokens_give_null_or_raise(spark, token):
    good = masking.mask(one(spark, "AAAA3.SA"), KEY, token=token).first()[0]
    broken = good[:30] + ("A" if good[30] != "A" else "B") + good[31:]
    for text in (broken, "", "no token", "AAAA"):
        assert masking.unmask(one(spark, text), KEY, token=token).first()[0] is None
        with pytest.raises(Exception, match="invalid token"):
            masking.unmask(one(spark, text), KEY, token=token, bad_token="raise").collect()
    assert masking.unmask(one(spark, good), OTHER_KEY, token=token).first()[0] is None
    kept = masking.unmask(one(spark, None), KEY, token=token, bad_token="raise")
    assert kept.first()[0] is None
    assert masking.unmask(one(spark, good), KEY, token=token, bad_token="raise").first()[0] == "AAAA3.SA"


# --- previous close and gold -----------------------------------------------


def test_gold_daily_example(spark):
    gold = derive(with_previous_close(wide_rows(spark, EXAMPLE_BARS)), DAY)
    assert gold.columns == schemas.GOLD_DAILY.fieldNames()
    assert [f.dataType for f in gold.schema] == [f.dataType for f in schemas.GOLD_DAILY]
    got = as_set(
        gold.withColumn("day", F.to_date("Date").cast("string")),
        "day", "Ticker", "Adj_Close", "Volume", "Dia2", "Adj_Close_ant",
        "Marketcap", "Volatility", "Volatility_perc", "Volatility_label",
    )
    assert got == sorted(EXAMPLE, key=repr)
    row = gold.filter("Ticker = 'AAAA3.SA' and Dia2 = '2024-01-04'").first()
    assert (row["Date2"], row["key"]) == ("05/01/2024", "05/01/2024AAAA3.SA")


def test_rounding_is_half_up_after_the_label(spark):
    bars = wide_rows(spark, [("2024-01-02", "A", 1.0, 1.0), ("2024-01-03", "A", 1.005, 1.0)])
    row = derive(with_previous_close(bars), DAY).filter("Dia2 is not null").first()
    got = (row["Adj_Close"], row["Volatility"], row["Volatility_label"])
    assert got == (1.01, 0.0, "Increasing")


def test_compat_labels_a_missing_change_as_a_fall(spark):
    bars = with_previous_close(wide_rows(spark, EXAMPLE_BARS))
    labels = as_set(derive(bars, DAY, null_is_fall=True).filter("Volatility is null"), "Volatility_label")
    assert labels == [("Decreasing",)] * 4


def test_gold_hourly_columns(spark):
    bars = wide_rows(spark, [("2024-01-03T23:00", "A", 1.005, 2.0)])
    closes = wide_rows(spark, [("2024-01-02", "A", 1.0, 1.0)])
    gold = derive(with_daily_close(bars, closes), HOUR)
    assert gold.columns == schemas.GOLD_HOURLY.fieldNames()
    assert [f.dataType for f in gold.schema] == [f.dataType for f in schemas.GOLD_HOURLY]
    row = gold.first()
    assert row["Date2"] == at("2024-01-04T01:00")
    assert (row["Date_label"], row["key"]) == ("03/01/2024", "03/01/2024A")
    assert row["Adj_Close"] == 1.005 and row["Volatility"] == 1.005 - 1.0


def test_slice_has_no_previous_close_on_its_first_day(spark):
    bars = incremental.since(wide_rows(spark, EXAMPLE_BARS), at("2024-01-04"))
    assert as_set(with_previous_close(bars), "Dia2", "Adj_Close_ant") == [(None, None)] * 2


def test_hourly_bars_before_their_own_close_is_loaded(spark):
    bars = wide_rows(spark, [(f"2024-01-05T{h}:00", "AAAA3.SA", 9.0, 1.0) for h in (13, 14, 15)])
    closes = wide_rows(spark, [r for r in EXAMPLE_BARS if r[0] < "2024-01-05"])
    history = with_daily_close(bars, closes)
    assert as_set(history, "Dia2", "Adj_Close_ant") == [("2024-01-04", 11.0)] * 3
    assert as_set(with_daily_close(bars, closes, "slice"), "Dia2", "Adj_Close_ant") == [(None, None)] * 3


def test_rows_without_ticker_match_nothing(spark):
    bars = wide_rows(spark, [("2024-01-02", None, 1.0, 1.0), ("2024-01-03", None, 2.0, 1.0)])
    assert as_set(with_previous_close(bars), "Dia2", "Adj_Close_ant") == [
        ("2024-01-02", None),
        (None, None),
    ]
    assert as_set(with_daily_close(bars, bars), "Dia2", "Adj_Close_ant") == [
        ("2024-01-02", None),
        (None, None),
    ]


def test_previous_close_across_blocks_against_brute_force(spark):
    first = date(2023, 1, 1)
    closes = {}
    for i in range(150):
        if i % 7 == 3:
            continue
        for t in range(5):
            if (i * 31 + t * 17) % 11 < 8:
                closes[(first + timedelta(days=i), f"T{t}")] = float(i * 10 + t)
    bars = wide_rows(spark, [(d.isoformat(), t, c, 1.0) for (d, t), c in closes.items()])
    days = sorted({d for d, _ in closes})
    before = dict(zip(days[1:], days))
    expected = sorted(
        (
            (
                datetime.combine(d, datetime.min.time()),
                t,
                before[d].isoformat() if d in before else None,
                closes.get((before.get(d), t)),
            )
            for d, t in closes
        ),
        key=repr,
    )
    assert as_set(with_previous_close(bars), "Date", "Ticker", "Dia2", "Adj_Close_ant") == expected
    assert as_set(with_daily_close(bars, bars), "Date", "Ticker", "Dia2", "Adj_Close_ant") == expected


# --- serving ---------------------------------------------------------------


def test_relate_keeps_every_hourly_row(spark):
    daily = derive(with_previous_close(wide_rows(spark, EXAMPLE_BARS)), DAY)
    bars = wide_rows(spark, [("2024-01-03T13:00", "AAAA3.SA", 9.0, 1.0), ("2024-01-03T14:00", "Z", 9.0, 1.0)])
    hourly = derive(with_daily_close(bars, wide_rows(spark, EXAMPLE_BARS)), HOUR)
    both = serving.relate(hourly, daily)
    assert both.columns == [*hourly.columns, *(c + "_daily" for c in daily.columns if c != "key")]
    assert as_set(both, "Ticker", "Adj_Close_daily") == [("AAAA3.SA", 11.0), ("Z", None)]


def test_stack_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3,)], "x int")
    assert as_set(serving.stack(a, b), "x", "y") == [(1, 2), (3, None)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "America/Sao_Paulo", "Asia/Tokyo"])
def test_session_zone_moves_nothing(spark, zone):
    """Clock changes of the session zone touch neither bars nor labels."""
    times = ("2018-11-04T00:00", "2024-03-10T02:30", "2024-11-03T01:30")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        bars = wide_rows(spark, [(t, "A", 1.0, 1.0) for t in times])
        hours = as_set(bars.select(hour_start(F.col("Date")).alias("h")), "h")
        gold = derive(with_daily_close(bars, bars), HOUR)
        rows = as_set(gold, "Date", "Dia2", "Date2", "Date_label", "key")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert sorted(hours) == [(at(t[:14] + "00"),) for t in times]
    assert sorted(rows) == [
        (at(times[0]), None, at("2018-11-04T02:00"), "04/11/2018", "04/11/2018A"),
        (at(times[1]), "2018-11-04", at("2024-03-10T04:30"), "10/03/2024", "10/03/2024A"),
        (at(times[2]), "2024-03-10", at("2024-11-03T03:30"), "03/11/2024", "03/11/2024A"),
    ]
