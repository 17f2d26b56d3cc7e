"""Landing by file, late bars, labels without configuration, layouts and compaction."""

import random
from datetime import date, timedelta
from glob import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmill import schemas
from barmill.config import DAY, HOUR, RunConfig
from barmill.plans import affected, compaction, ledger, medallion
from barmill.plans.runlog import read_run_log
from barmill.operators import serving
from barmill.sources import landing, tables
from helpers import EXAMPLE, EXAMPLE_BARS, KEY, as_set, at, landing_rows


def config(tmp_path, granularity=DAY, **options):
    options.setdefault("guard", False)
    return RunConfig(root=str(tmp_path / "lake"), granularity=granularity, key=KEY, landing=str(tmp_path / "landing"), **options)


def by_file(tmp_path, **options):
    return config(tmp_path, consume="files", late="recompute", **options)


def land(df, tmp_path):
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))


COMPARED = ("Date", "Ticker", "Dia2", "Adj_Close_ant", "Volatility_label")
EXPECTED = sorted(((at(r[0]), r[1], r[4], r[5], r[9]) for r in EXAMPLE), key=repr)


def gold(spark, cfg):
    return as_set(medallion.read_layer(spark, cfg, "gold"), *COMPARED)


# --- affected days ---------------------------------------------------------


def previous(calendar):
    days = sorted(calendar)
    return dict(zip(days, [None, *days], strict=False))


def test_affected_days_are_all_that_change():
    rnd = random.Random(3)
    every = [date(2024, 1, 1) + timedelta(days=k) for k in range(40)]
    for _ in range(300):
        old, touched = set(rnd.sample(every, 15)), set(rnd.sample(every, 4))
        new = (old | touched) - set(rnd.sample(sorted(touched), 1))
        compute, read = affected.daily_gold(touched, new)
        was, now = previous(old), previous(new)
        changed = {d for d in new if d in touched or was.get(d) != now[d] or now[d] in touched}
        assert changed <= compute and {now[d] for d in changed if now[d]} <= read
        assert len(compute) <= 2 * len(touched)

        bars = set(rnd.sample(every, 20))
        own = set(rnd.sample(sorted(bars), 2))
        compute, read = affected.hourly_gold(own, touched, bars, new)
        close = {d: max((c for c in new if c < d), default=None) for d in bars}
        was = {d: max((c for c in old if c < d), default=None) for d in bars}
        changed = {d for d in bars if d in own or close[d] != was[d] or close[d] in touched}
        assert changed <= compute and {close[d] for d in changed if close[d]} <= read


# --- landing by file -------------------------------------------------------


def test_late_files_give_what_one_load_gives(spark, tmp_path):
    cfg = by_file(tmp_path)
    for days in (("2024-01-05",), ("2024-01-02", "2024-01-04"), ("2024-01-03",)):
        land(landing_rows(spark, [r for r in EXAMPLE_BARS if r[0] in days]), tmp_path)
        medallion.run_chain(spark, cfg)
    assert gold(spark, cfg) == EXPECTED
    stored = medallion.read_layer(spark, cfg, "bronze").count()
    medallion.run_chain(spark, cfg)
    assert medallion.read_layer(spark, cfg, "bronze").count() == stored == 6 * len(EXAMPLE_BARS)
    said = read_run_log(spark, cfg).filter("step = 'write' and rows_out = 0").select("message").distinct()
    assert as_set(said, "message") == [("nothing new",)]


def test_a_load_that_breaks_off_is_done_again(spark, tmp_path, monkeypatch):
    cfg = by_file(tmp_path)
    land(landing_rows(spark, [r for r in EXAMPLE_BARS if r[0] != "2024-01-03"]), tmp_path)
    medallion.run_chain(spark, cfg)
    land(landing_rows(spark, [r for r in EXAMPLE_BARS if r[0] == "2024-01-03"]), tmp_path)
    for name, layer in (("files_read", "bronze"), ("got_through", "silver"), ("got_through", "gold")):
        with monkeypatch.context() as broken:
            broken.setattr(ledger, name, lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                medallion.run_stage(spark, cfg, layer)
        medallion.run_stage(spark, cfg, layer)
    assert gold(spark, cfg) == EXPECTED


def test_a_load_by_dates_that_breaks_off_loses_no_day(spark, tmp_path, monkeypatch):
    cfg = config(tmp_path, late="recompute")
    medallion.run_chain(spark, cfg, landing_rows(spark, [r for r in EXAMPLE_BARS if r[0] < "2024-01-04"]))
    with monkeypatch.context() as broken:
        broken.setattr(ledger, "days_changed", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            medallion.run_stage(spark, cfg, "bronze", landing_rows(spark, EXAMPLE_BARS))
    medallion.run_chain(spark, cfg, landing_rows(spark, EXAMPLE_BARS))
    assert gold(spark, cfg) == EXPECTED


def test_a_withdrawn_day_goes_and_the_next_one_looks_further_back(spark, tmp_path):
    cfg = by_file(tmp_path)
    land(landing_rows(spark, EXAMPLE_BARS), tmp_path)
    medallion.run_chain(spark, cfg)
    land(landing_rows(spark, [(d, t, None, v) for d, t, _, v in EXAMPLE_BARS if d == "2024-01-03"]), tmp_path)
    medallion.run_chain(spark, cfg)
    rows = {(r[0].day, r[1]): r[2:4] for r in gold(spark, cfg)}
    assert {day for day, _ in rows} == {2, 4, 5}
    assert rows[4, "AAAA3.SA"] == ("2024-01-02", 10.0) and rows[4, "CCCC3.SA"] == ("2024-01-02", None)


def test_a_file_written_anew_is_read_again(spark, tmp_path):
    cfg = by_file(tmp_path)
    for close in (1.0, 2.0):
        landing_rows(spark, [("2024-01-02", "A", close, 5.0)]).coalesce(1).write.mode("overwrite").parquet(cfg.landing)
        medallion.run_chain(spark, cfg)
    assert as_set(medallion.read_layer(spark, cfg, "gold"), "Ticker", "Close") == [("A", 2.0)]


def test_empty_cells_of_a_late_wide_file_say_nothing(spark, tmp_path):
    cfg = by_file(tmp_path)
    labels = [f"{label}|{t}" for t in ("A", "B") for label in schemas.LABELS]
    kind = "Date timestamp_ntz, " + ", ".join(f"`{c}` double" for c in labels)
    day = at("2024-01-02")
    for cells in ([1.0] * 6 + [None] * 6, [None] * 6 + [3.0] * 6, [None, 2.0, *[None] * 10]):
        land(spark.createDataFrame([(day, *cells)], kind), tmp_path)
        medallion.run_chain(spark, cfg)
    assert as_set(medallion.read_layer(spark, cfg, "gold"), "Ticker", "Adj_Close", "Close") == [("A", 1.0, 2.0), ("B", 3.0, 3.0)]


def test_recompute_needs_whole_days_and_history(tmp_path):
    with pytest.raises(ValueError, match="whole days"):
        config(tmp_path, late="recompute", write="append")
    with pytest.raises(ValueError, match="consume"):
        config(tmp_path, consume="rows")


# --- cells, copies, labels -------------------------------------------------


def test_cells_are_merged_in_order(spark):
    nan = float("nan")
    rows = [(1, 2, 1.0, None, 7.0), (1, 1, 5.0, 4.0, 8.0), (1, 3, nan, None, None), (1, 2, 0.5, None, 7.5), (2, 1, None, nan, None)]
    df = spark.createDataFrame(rows, "Date int, n int, `a|x` double, `b.y|x` double, c double")
    got = as_set(landing.merge_cells(df, ("Date",), ["n"]), "Date", "`a|x`", "`b.y|x`", "c")
    assert got == [(1, 1.0, 4.0, 7.5), (2, None, None, None)]


def test_the_later_file_wins(spark, tmp_path):
    cfg = config(tmp_path)
    for close in (9.0, 2.0):
        land(landing_rows(spark, [("2024-01-02", "A", close, 5.0)]), tmp_path)
    medallion.run_chain(spark, cfg)
    assert as_set(medallion.read_layer(spark, cfg, "gold"), "Close") == [(2.0,)]


def test_bars_without_an_instrument_are_counted(spark, tmp_path):
    cfg = config(tmp_path)
    rows = [("2024-01-02", None, 1.0, 5.0), ("2024-01-02", None, 2.0, 6.0), ("2024-01-02", "A", 3.0, 7.0)]
    medallion.run_chain(spark, cfg, landing_rows(spark, rows))
    said = read_run_log(spark, cfg).filter("layer = 'bronze' and step = 'write'").select("message")
    assert as_set(said, "message") == [("table saved, 2 rows without a ticker",)]
    assert as_set(medallion.read_layer(spark, cfg, "gold"), "Ticker") == [("A",)]


def test_labels_become_columns_but_for_taken_names(spark, tmp_path, monkeypatch):
    cfg = config(tmp_path, label_registry=True)
    first = landing_rows(spark, EXAMPLE_BARS[:1])
    medallion.run_chain(spark, cfg, first)
    later = landing_rows(spark, EXAMPLE_BARS[1:3]).withColumns({"Splits": F.lit(2), "KEY": F.lit(1.0), "splits ": F.lit(4.0), "note": F.lit("text")})
    medallion.run_chain(spark, cfg, later)
    table = medallion.read_layer(spark, cfg, "gold")
    assert [c for c in table.columns if c not in schemas.GOLD_DAILY.fieldNames()] == ["Splits", "splits "]
    assert as_set(table, "Date", "Splits", "`splits `") == [(at("2024-01-02"), None, None), (at("2024-01-03"), 2.0, 4.0), (at("2024-01-04"), 2.0, 4.0)]
    said = " ".join(r["message"] for r in read_run_log(spark, cfg).filter("step = 'write'").collect())
    assert "new label Splits" in said and "2 rows of label KEY" in said
    monkeypatch.setattr(ledger, "MOST_LABELS", 3)
    with pytest.raises(ValueError, match="cannot be columns"):
        ledger.labels_seen(spark, cfg, ["x", "y"], at("2024-01-09"))


# --- layouts ---------------------------------------------------------------


@pytest.fixture
def conf(spark):
    kept = {}

    def put(name, value):
        kept.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield put
    for name, value in kept.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_bucketed_golds_join_without_a_shuffle(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    schema = "Date timestamp_ntz, Ticker string, key string, Close double, p_date date"
    days = [at("2024-01-02") + timedelta(days=k) for k in range(5)]
    rows = [(d, f"T{k}", f"{d}T{k}", float(k), d.date()) for d in days for k in range(40)] + [(days[0], None, None, 1.0, days[0].date())]
    name = "golds_" + tmp_path.name.replace("-", "_")
    for part in ("hourly", "daily"):
        tables.write_bucketed(spark.createDataFrame(rows, schema), f"{name}_{part}", str(tmp_path / part), ("p_date", "Ticker"), 4)
    joined = serving.relate(spark.table(f"{name}_hourly"), spark.table(f"{name}_daily"))
    got = joined.filter("Close = Close_daily").count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert got == 200 and joined.count() == 201


def test_one_instrument_meets_few_row_groups(spark, tmp_path, conf):
    conf("spark.sql.shuffle.partitions", "4")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    hot = spark.range(60_000).select(
        (F.lit(at("2024-01-02")) + F.make_dt_interval(secs=F.col("id") % 80_000)).cast("timestamp_ntz").alias("Date"),
        F.format_string("T%03d", F.col("id") % 300).alias("Ticker"), F.rand(1).alias("Close"),
    )
    few = hot.limit(50).withColumn("Date", F.lit(at("2024-01-03")).cast("timestamp_ntz"))
    path = str(tmp_path / "gold")
    writer = tables.by_instrument(hot.unionByName(few)).write.partitionBy("p_date")
    writer.option("parquet.block.size", "16384").option("parquet.page.row.count.limit", "500").parquet(path)
    groups = met = 0
    files = glob(f"{path}/p_date=2024-01-02/*.parquet")
    for file in files:
        meta = pq.ParquetFile(file).metadata
        at_ = meta.schema.names.index("Ticker")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at_).statistics
            groups += 1
            met += stats.min <= "T123" <= stats.max
    assert len(files) > 1 and groups >= 20 and met <= 3
    plan = spark.read.parquet(path).filter("Ticker = 'T123'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Ticker,T123)" in plan


def test_days_come_from_the_listing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(at("2024-01-02"), 1), (at("2024-01-03"), 2)], "Date timestamp_ntz, n int")
    assert tables.listed_days(spark, path) is None
    tables.write_days(tables.by_day(df), path, "append")
    days = tables.listed_days(spark, path)
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "FileScan binaryFile" in plan and "ReadSchema: struct<length:bigint>" in plan
    assert as_set(days, "p_date") == [(date(2024, 1, 2),), (date(2024, 1, 3),)]
    tables.drop_days(spark, path, [date(2024, 1, 2)])
    assert as_set(tables.listed_days(spark, path), "p_date") == [(date(2024, 1, 3),)]
    assert as_set(tables.read_table(spark, path, df.schema), "n") == [(2,)] == as_set(tables.serving_table(spark, path), "n")


# --- compaction ------------------------------------------------------------


def appended(spark, tmp_path, loads=12):
    cfg = config(tmp_path, HOUR)
    for hour in range(loads):
        rows = [(f"2024-01-02T{hour:02}:00", t, float(hour), 1.0) for t in ("A", "B")]
        medallion.run_stage(spark, cfg, "bronze", landing_rows(spark, rows))
    return cfg


def bronze(spark, cfg):
    return as_set(medallion.read_layer(spark, cfg, "bronze"), "Date", "Price", "Ticker", "value", "ingested_at")


def test_compaction_leaves_rows_and_few_files(spark, tmp_path):
    cfg = appended(spark, tmp_path)
    before = bronze(spark, cfg)
    assert compaction.compact(spark, cfg, "silver") == set()
    assert compaction.compact(spark, cfg, "bronze", least=100) == set()
    assert compaction.compact(spark, cfg, "bronze") == {date(2024, 1, 2)}
    assert bronze(spark, cfg) == before and len(before) == 12 * 12
    assert tables.day_files(spark, cfg.table("bronze")).first()["files"] <= 2
    assert compaction.compact(spark, cfg, "bronze") == set()


def test_broken_compaction_is_taken_up_with_later_loads(spark, tmp_path, monkeypatch):
    cfg = appended(spark, tmp_path)
    write = compaction.write_days

    def broken(df, path, mode, *args, **options):
        if mode == "overwrite":
            tables.drop_days(spark, path, [date(2024, 1, 2)])  # the worst place: the day is gone, its copy not there yet
            raise OSError("lost")
        write(df, path, mode, *args, **options)

    before = bronze(spark, cfg)
    with monkeypatch.context() as patched:
        patched.setattr(compaction, "write_days", broken)
        with pytest.raises(OSError):
            compaction.compact(spark, cfg, "bronze")
    late = [("2024-01-02T20:00", "A", 5.0, 1.0)]
    medallion.run_stage(spark, config(tmp_path, HOUR), "bronze", landing_rows(spark, late))
    added = bronze(spark, cfg)
    assert compaction.compact(spark, cfg, "bronze") == {date(2024, 1, 2)}
    assert bronze(spark, cfg) == sorted(before + added, key=repr) and len(added) == 6


# --- changed types ---------------------------------------------------------


@pytest.mark.parametrize(
    "a, b, wide",
    [
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.IntegerType(), T.DoubleType(), T.DoubleType()),
        (T.DecimalType(10, 2), T.DecimalType(8, 4), T.DecimalType(12, 4)),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.StringType(), T.DoubleType(), T.StringType()),
    ],
)
def test_the_wider_type(a, b, wide):
    assert tables.wider(a, b) == tables.wider(b, a) == wide


def test_many_changes_of_type_are_stacked(spark, tmp_path):
    path = str(tmp_path / "t")
    kinds = ["int", "int", "double", "int", "string", "string"]
    for n, kind in enumerate(kinds):
        part = spark.range(1).select(F.lit(f"2024-01-0{n + 1}").cast("date").alias("p_date"), F.lit(n).cast(kind).alias("v"), *([F.lit(n).alias("late")] if n > 3 else []))
        part.write.mode("append").partitionBy("p_date").parquet(path)
    got = tables.serving_table(spark, path)
    assert as_set(got, "v", "late") == sorted([("0", None), ("1", None), ("2.0", None), ("3", None), ("4", 4), ("5", 5)], key=repr)
