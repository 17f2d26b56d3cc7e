"""SQL for DuckDB that states each catalog query independently of Spark."""

from __future__ import annotations

# Two-place rounding as Spark does it: half up on the decimal text of the double.
_ROUND = "CAST(round(CAST(CAST({0} AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE)"

# Good Friday by another rule than the engine's: the golden number, the epact
# and the Sunday after the full moon.
_GOLDEN = '(year("Date") % 19)'
_CENTURY = '(year("Date") // 100)'
_EPACT = (
    f"((19 * {_GOLDEN} + {_CENTURY} - {_CENTURY} // 4 - (({_CENTURY} - ({_CENTURY} + 8) // 25 + 1) // 3) + 15) % 30)"
)
_TO_SUNDAY = f"""((32 + 2 * ({_CENTURY} % 4) + 2 * ((year("Date") % 100) // 4) - {_EPACT} - (year("Date") % 100) % 4) % 7)"""
_LATE = f"(({_GOLDEN} + 11 * {_EPACT} + 22 * {_TO_SUNDAY}) // 451)"
_GOOD_FRIDAY = (
    f"""(make_date(year("Date"), 3, 22) + CAST({_EPACT} + {_TO_SUNDAY} - 7 * {_LATE} - 2 AS INTEGER))"""
)

# Public holidays by month and day, two of them from a year on.
_CLOSED = f"""(
    strftime("Date", '%m-%d') IN ('01-01', '04-21', '05-01', '09-07', '11-02', '11-15', '12-25')
    OR (strftime("Date", '%m-%d') = '10-12' AND year("Date") >= 1980)
    OR (strftime("Date", '%m-%d') = '11-20' AND year("Date") >= 2024)
    OR CAST("Date" AS DATE) = {_GOOD_FRIDAY})"""

_EVENTS = """
priced AS (
  SELECT * FROM events
  WHERE ts IS NOT NULL AND user_id IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)
)"""


def _bars(name: str, unit: str) -> str:
    return f"""
{name} AS (
  SELECT CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS "Date", 'U' || user_id AS "Ticker",
         arg_max(value, event_id) AS "Adj_Close", arg_max(value, event_id) AS "Close",
         max(value) AS "High", min(value) AS "Low", arg_min(value, event_id) AS "Open",
         CAST(count(*) AS DOUBLE) AS "Volume"
  FROM priced GROUP BY 1, 2
)"""


_BASE = (
    "WITH "
    + ",".join(
        [
            _EVENTS,
            _bars("daily", "day"),
            _bars("hourly", "hour"),
            f"""
closes AS (
  SELECT * FROM daily WHERE isodow("Date") <= 5 AND NOT {_CLOSED}
)""",
        ]
    )
)

_DAY = "TIMESTAMP '2024-01-15 00:00:00'"
_HOUR = "TIMESTAMP '2024-01-15 12:00:00'"


def _melt(table: str, where: str = "TRUE") -> str:
    return f"""{_BASE}
SELECT "Date", CASE WHEN label = 'Adj_Close' THEN 'Adj Close' ELSE label END AS "Price",
       "Ticker", v AS value
FROM (SELECT * FROM {table} WHERE {where})
UNPIVOT INCLUDE NULLS (v FOR label IN ("Adj_Close", "Close", "High", "Low", "Open", "Volume"))"""


def _landing(table: str, where: str) -> str:
    return f"""{_BASE}
SELECT "Date", "Ticker", "Adj_Close" AS "Adj Close", "Close", "High", "Low", "Open", "Volume"
FROM {table} WHERE {where}"""


def _previous(name: str, bars: str, closes: str, day_map: str) -> str:
    return f"""
{name} AS (
  SELECT b.*, strftime(m.prev, '%Y-%m-%d') AS "Dia2", c."Adj_Close" AS "Adj_Close_ant"
  FROM {bars} b
  LEFT JOIN ({day_map}) m ON CAST(b."Date" AS DATE) = m.day
  LEFT JOIN {closes} c ON c."Ticker" = b."Ticker" AND CAST(c."Date" AS DATE) = m.prev
)"""


def _lagged(table: str) -> str:
    return f"""SELECT day, lag(day) OVER (ORDER BY day) AS prev
    FROM (SELECT DISTINCT CAST("Date" AS DATE) AS day FROM {table})"""


def _asof(bars: str, closes: str) -> str:
    return f"""SELECT x.day, max(y.day) AS prev
    FROM (SELECT DISTINCT CAST("Date" AS DATE) AS day FROM {bars}) x
    JOIN (SELECT DISTINCT CAST("Date" AS DATE) AS day FROM {closes}) y ON y.day < x.day
    GROUP BY x.day"""


def _gold(name: str, source: str, hourly: bool, null_label: str = "NULL") -> str:
    delta = '("Adj_Close" - "Adj_Close_ant")'
    label = f"""CASE WHEN {delta} > 0 THEN 'Increasing' WHEN {delta} = 0 THEN 'Stable'
         WHEN {delta} < 0 THEN 'Decreasing' ELSE {null_label} END"""
    perc = '("Adj_Close" / nullif("Adj_Close_ant", 0) - 1)'
    shown = "strftime(\"Date\", '%d/%m/%Y')"

    def r(expression: str) -> str:
        return expression if hourly else _ROUND.format(expression)

    dates = (
        f'"Date" + INTERVAL 2 HOUR AS "Date2", {shown} AS "Date_label"'
        if hourly
        else f'{shown} AS "Date2"'
    )
    prices = ", ".join(
        f'{r(chr(34) + c + chr(34))} AS "{c}"' for c in ("Adj_Close", "Close", "High", "Low", "Open")
    )
    return f"""
{name} AS (
  SELECT "Date", {prices}, "Volume", "Ticker", "Dia2", "Adj_Close_ant",
         {r('("Adj_Close" * "Volume")')} AS "Marketcap", {r(delta)} AS "Volatility",
         {r(perc)} AS "Volatility_perc", {label} AS "Volatility_label",
         {dates}, {shown} || "Ticker" AS "key"
  FROM {source}
)"""


_WIDE = '"Date", "Ticker", "Adj_Close", "Close", "High", "Low", "Open", "Volume"'

_SLICES = f"""
daily_slice AS (SELECT * FROM daily WHERE "Date" > {_DAY}),
hourly_slice AS (SELECT * FROM hourly WHERE "Date" > {_HOUR}),
close_slice AS (SELECT * FROM closes WHERE "Date" > {_HOUR})"""

_PREV_DAILY = _previous("prev_daily", "daily", "daily", _lagged("daily"))
_PREV_HOURLY = _previous("prev_hourly", "hourly", "closes", _asof("hourly", "closes"))
_PREV_HOURLY_ALL = _previous("prev_hourly_all", "hourly", "daily", _asof("hourly", "daily"))
_PREV_SLICE = _previous("prev_slice", "daily_slice", "daily_slice", _lagged("daily_slice"))
_PREV_SLICE_HOURLY = _previous(
    "prev_slice_hourly", "hourly_slice", "close_slice", _lagged("close_slice")
)
_GOLD_DAILY = _gold("gold_daily", "prev_daily", hourly=False)
_GOLD_HOURLY = _gold("gold_hourly", "prev_hourly_all", hourly=True)

_DAILY_RESULT = f"{_BASE}, {_PREV_DAILY}, {_GOLD_DAILY} SELECT * FROM gold_daily"
_HOURLY_RESULT = f"{_BASE}, {_PREV_HOURLY_ALL}, {_GOLD_HOURLY} SELECT * FROM gold_hourly"

# Daily bars with the event type as instrument, of listed instruments only, in
# whole fifties, and with every value twice.
_KIND_BARS = """
kinds AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS "Date", event_type AS "Ticker",
         arg_max(value, event_id) AS "Adj_Close", arg_max(value, event_id) AS "Close",
         max(value) AS "High", min(value) AS "Low", arg_min(value, event_id) AS "Open",
         CAST(count(*) AS DOUBLE) AS "Volume"
  FROM priced GROUP BY 1, 2
)"""
_LISTED = """
listed AS (
  SELECT * FROM daily d WHERE EXISTS (
    SELECT 1 FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name = 'NATION_7' AND 'U' || c_custkey = d."Ticker")
)"""


def _coarse(name: str, table: str) -> str:
    prices = ", ".join(f'floor("{c}" / 50) * 50 AS "{c}"' for c in ("Adj_Close", "Close", "Low", "Open"))
    high = """CASE WHEN "Volume" % 2 <> 0 THEN floor("High" / 50) * 50 END AS "High" """
    return f"""
{name} AS (SELECT "Date", "Ticker", {prices}, {high}, "Volume" FROM {table})"""


_TWICE = f"""
twice AS (
  SELECT "Date", "Ticker", {", ".join(f'2 * "{c}" AS "{c}"' for c in ("Adj_Close", "Close", "High", "Low", "Open", "Volume"))}
  FROM daily
)"""


def _gold_of(bars: str, *ctes: str, null_label: str = "NULL") -> str:
    """Daily gold of a table of bars."""
    previous = _previous("previous", bars, bars, _lagged(bars))
    gold = _gold("result", "previous", hourly=False, null_label=null_label)
    return ",".join([_BASE, *ctes, previous, gold]) + " SELECT * FROM result"


_KINDS = ("click", "error", "purchase", "signup", "view")

_LANDING_CELLS = " UNION ALL ".join(
    f"""SELECT h."Date", '{label}' AS "Price", k.kind AS "Ticker", {value} AS value
FROM hours h CROSS JOIN (VALUES {", ".join(f"('{kind}')" for kind in _KINDS)}) k(kind)
LEFT JOIN cells c ON c."Date" = h."Date" AND c.kind = k.kind"""
    for label, value in (
        ("Close", "c.last_value"),
        ("High", "c.high"),
        ("Low", "c.low"),
        ("Volume", "coalesce(c.n, CAST(0 AS DOUBLE))"),
    )
)

# The log of a run on a holiday and one on the next business day.
_LOG = f"""{_BASE},
counts AS (SELECT count(*) AS n FROM daily),
steps AS (
  SELECT 'bronze' AS layer, 'guard' AS step, TIMESTAMP '2024-01-01 15:00:00' AS ts, 'skipped' AS status,
         CAST(NULL AS BIGINT) AS rows_out, 'not a business moment, nothing done' AS message
  UNION ALL
  SELECT l.layer, s.step, TIMESTAMP '2024-01-02 15:00:00', 'ok',
         CASE WHEN s.step = 'write' THEN l.factor * c.n END, replace(s.message, '?', l.layer)
  FROM counts c
  CROSS JOIN (VALUES ('bronze', 6), ('silver', 1), ('gold', 1)) l(layer, factor)
  CROSS JOIN (VALUES ('watermark', 'most recent bar: None'), ('transform', '? transformation planned'),
              ('write', 'table saved')) s(step, message)
)"""

_DAILY_NAMES = (
    "Date", "Adj_Close", "Close", "High", "Low", "Open", "Volume", "Ticker", "Dia2",
    "Adj_Close_ant", "Marketcap", "Volatility", "Volatility_perc", "Volatility_label", "Date2",
)

_RELATED = f"""{_BASE}, {_PREV_DAILY}, {_GOLD_DAILY},
{_PREV_HOURLY_ALL}, {_GOLD_HOURLY}
SELECT h.*, {", ".join(f'd."{c}" AS "{c}_daily"' for c in _DAILY_NAMES)}
FROM gold_hourly h LEFT JOIN gold_daily d ON d."key" = h."key" """

ORACLES: dict[str, str] = {
    "bronze_melt_daily": _melt("daily"),
    "bronze_melt_hourly": _melt("hourly"),
    "bronze_melt_landing": f"""WITH {_EVENTS},
cells AS (
  SELECT date_trunc('hour', ts) AS "Date", event_type AS kind,
         arg_max(value, event_id) AS last_value, max(value) AS high, min(value) AS low,
         CAST(count(*) AS DOUBLE) AS n
  FROM priced GROUP BY 1, 2
),
hours AS (SELECT DISTINCT "Date" FROM cells)
{_LANDING_CELLS}""",
    "symbol_universe": """
SELECT DISTINCT p_brand || '.SA' AS "Ticker" FROM part
WHERE p_type = 'PROMO' AND length(p_brand) <= 7""",
    "bars_for_symbols": f"""{_BASE}
SELECT {_WIDE} FROM daily d
WHERE EXISTS (
  SELECT 1 FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE n_name = 'NATION_7' AND 'U' || c_custkey = d."Ticker"
)""",
    "landing_increment_daily": _landing("daily", f'"Date" >= {_DAY} + INTERVAL 1 DAY'),
    "landing_increment_hourly": _landing("hourly", f'"Date" >= {_HOUR} + INTERVAL 1 HOUR'),
    "watermark": f"""WITH {_EVENTS}
SELECT max(CAST(date_trunc('hour', ts) AS TIMESTAMP)) AS last_date FROM priced""",
    "incremental_slice_daily": _melt("daily", f'"Date" > {_DAY}'),
    "incremental_slice_hourly": _melt("hourly", f'"Date" > {_HOUR}'),
    "silver_pivot_daily": f"{_BASE} SELECT {_WIDE} FROM daily WHERE \"Adj_Close\" IS NOT NULL",
    "silver_pivot_hourly": f"{_BASE} SELECT {_WIDE} FROM hourly WHERE \"Adj_Close\" IS NOT NULL",
    "silver_pivot_events": f"""WITH {_EVENTS}
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS "Date", 'U' || user_id AS "Ticker", """
    + ", ".join(
        f"""CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = '{k}') AS DOUBLE) AS "{k}" """
        for k in _KINDS
    )
    + "FROM priced GROUP BY 1, 2",
    "silver_pivot_latest": f"""{_BASE},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY CAST("Date" AS DATE), "Ticker" ORDER BY hour("Date") < 12 DESC, "Date" DESC) AS rn
  FROM hourly
)
SELECT CAST(date_trunc('day', "Date") AS TIMESTAMP) AS "Date", "Ticker", "Adj_Close", "Close", "High",
       "Low", "Open", "Volume"
FROM ranked WHERE rn = 1""",
    "silver_pivot_extra_labels": f"""{_BASE}, {_PREV_DAILY}, {_GOLD_DAILY}
SELECT *, "Volume" / 2 AS "Dividends" FROM gold_daily""",
    "silver_new_label": f"""{_BASE}, {_PREV_DAILY}, {_GOLD_DAILY}
SELECT *, CASE WHEN "Date" > {_DAY} THEN "Volume" / 2 END AS "Dividends" FROM gold_daily""",
    "landing_wide_files": _gold_of("corrected", _KIND_BARS, f"""
corrected AS (
  SELECT * REPLACE (CASE WHEN "Ticker" = (SELECT min("Ticker") FROM kinds) AND "Date" > {_DAY}
    THEN "Adj_Close" + 1 ELSE "Adj_Close" END AS "Adj_Close") FROM kinds
)"""),
    "landing_tidy_extra": f"""{_BASE},
counts AS (SELECT count(*) FILTER ("Volume" % 3 <> 0) AS n, count(*) FILTER ("Volume" % 3 = 0) AS nobody FROM daily)
SELECT what, n FROM counts CROSS JOIN
  (VALUES ('Adj Close'), ('Close'), ('High'), ('Low'), ('Open'), ('Volume'), ('Dividends')) l(what)
UNION ALL SELECT 'bronze: table saved, ' || nobody || ' rows without a ticker', 0 FROM counts
UNION ALL SELECT 'silver: table saved, ' || n || ' rows of label Dividends', 0 FROM counts""",
    "landing_late_file": f"""{_BASE}, {_PREV_DAILY}, {_GOLD_DAILY}
SELECT *, 6 * (SELECT count(*) FROM daily) AS bronze_rows FROM gold_daily""",
    "medallion_late_bar": _DAILY_RESULT,
    "medallion_late_close": _HOURLY_RESULT,
    "labels_left_out": f"""{_BASE}, {_KIND_BARS},
cells AS (SELECT count(DISTINCT "Date") * count(DISTINCT "Ticker") AS n FROM kinds)
SELECT 'bronze' AS layer, 'table saved' AS message
UNION ALL SELECT 'silver', 'table saved, ' || n || ' rows of label Dividends' FROM cells""",
    "dedupe_latest": f"""WITH {_EVENTS},
ranked AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS "Date", event_type AS "Price",
         'U' || user_id AS "Ticker", value,
         row_number() OVER (
           PARTITION BY date_trunc('day', ts), event_type, user_id ORDER BY event_id DESC
         ) AS rn
  FROM priced
)
SELECT "Date", "Price", "Ticker", value FROM ranked WHERE rn = 1""",
    "mask_round_trip_gcm": f"{_BASE} SELECT {_WIDE} FROM daily",
    "mask_round_trip_fernet": f"{_BASE} SELECT {_WIDE} FROM daily",
    "mask_hides_plaintext": f"""{_BASE}
SELECT "Ticker" AS clear, form, CAST(0 AS BIGINT) AS shown, CAST(0 AS BIGINT) AS short,
       count(*) AS tokens, count(*) AS opened
FROM daily CROSS JOIN (VALUES ('fernet'), ('gcm')) f(form) GROUP BY ALL""",
    "mask_damaged_tokens": f"""{_BASE}
SELECT "Ticker" AS clear, form, count(*) FILTER ("Volume" % 3 = 0) AS lost,
       count(*) FILTER ("Volume" % 3 <> 0) AS opened
FROM daily CROSS JOIN (VALUES ('fernet'), ('gcm')) f(form) GROUP BY ALL""",
    "business_days": f"{_BASE} SELECT {_WIDE} FROM closes",
    "trading_hours": f"""{_BASE}
SELECT {_WIDE} FROM hourly WHERE hour("Date") BETWEEN 12 AND 21""",
    "day_map": f"""{_BASE}
SELECT day AS "Dia", prev AS "Dia2",
       CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS "Pos"
FROM ({_lagged("daily")})""",
    "day_map_asof": f"""{_BASE}
SELECT day AS "Dia", prev AS "Dia2" FROM ({_asof("daily", "closes")})""",
    "prev_close_daily": f"{_BASE}, {_PREV_DAILY} SELECT * FROM prev_daily",
    "prev_close_hourly": f"{_BASE}, {_PREV_HOURLY} SELECT * FROM prev_hourly",
    "prev_close_slice": f"{_BASE}, {_SLICES}, {_PREV_SLICE} SELECT * FROM prev_slice",
    "prev_close_slice_hourly": f"""{_BASE}, {_SLICES}, {_PREV_SLICE_HOURLY}
SELECT * FROM prev_slice_hourly""",
    "gold_daily": _DAILY_RESULT,
    "gold_hourly": _HOURLY_RESULT,
    "gold_daily_compat": f"""{_BASE}, {_SLICES}, {_PREV_SLICE},
{_gold("result", "prev_slice", hourly=False, null_label="'Decreasing'")} SELECT * FROM result""",
    "gold_hourly_compat": f"""{_BASE}, {_SLICES}, {_PREV_SLICE_HOURLY},
{_gold("result", "prev_slice_hourly", hourly=True, null_label="'Decreasing'")}
SELECT * FROM result""",
    "stack_partitions": f"{_BASE} SELECT {_WIDE} FROM daily",
    "serving_hourly_daily": _RELATED,
    "serving_bucketed": _RELATED,
    "stack_changed_types": f"""{_BASE}
SELECT {_WIDE}, CASE WHEN "Date" > {_DAY} THEN "Volume" / 2 END AS "Dividends" FROM daily""",
    "instrument_history": f"{_DAILY_RESULT} WHERE \"Ticker\" = 'U7'",
    "compacted_appends": f"""{_BASE}
SELECT CAST("Date" AS DATE) AS p_date, 6 * count(*) AS n, sum("Volume") AS volume, TRUE AS few FROM hourly GROUP BY 1""",
    "gold_daily_edges": _gold_of("coarse", _coarse("coarse", "daily")),
    "gold_hourly_edges": ",".join([
        _BASE, _coarse("coarse", "daily"), _coarse("coarse_hourly", "hourly"),
        _previous("previous", "coarse_hourly", "coarse", _asof("hourly", "daily")),
        _gold("result", "previous", hourly=True),
    ]) + " SELECT * FROM result",
    "medallion_landing_wide": _gold_of("kinds", _KIND_BARS),
    "medallion_landing_symbols": _gold_of("listed", _LISTED),
    "medallion_correction": _gold_of("early", f"""
early AS (SELECT * FROM daily WHERE "Date" < {_DAY})"""),
    "medallion_compat": _gold_of("twice", _TWICE, null_label="'Decreasing'"),
    "medallion_append": _DAILY_RESULT,
    "medallion_guarded": _DAILY_RESULT,
    "medallion_daily": _DAILY_RESULT,
    "medallion_increments": _DAILY_RESULT,
    "medallion_hourly": _HOURLY_RESULT,
    "run_log": f"""{_LOG}
SELECT layer, 'daily' AS granularity, step, ts, status, rows_out, message FROM steps""",
    "text_log": f"""{_LOG}
SELECT layer, message || ', ' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS "Log" FROM steps""",
    "run_log_failure": """
SELECT 'bronze' AS layer, step, status, message, CAST(0 AS INTEGER) AS stored
FROM (VALUES ('watermark', 'ok', 'most recent bar: None'),
             ('failed', 'failed', 'ValueError: a landing table needs a Date column')) v(step, status, message)""",
}
