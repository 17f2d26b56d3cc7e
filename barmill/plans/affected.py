"""Which days have to be computed again when some days of a layer have changed.

Works on sets of calendar days, which are small whatever the tables hold.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Sequence
from datetime import date


def after(day: date, calendar: Sequence[date]) -> date | None:
    """The first day of an ascending calendar that is later."""
    at = bisect_right(calendar, day)
    return calendar[at] if at < len(calendar) else None


def before(day: date, calendar: Sequence[date]) -> date | None:
    at = bisect_left(calendar, day)
    return calendar[at - 1] if at else None


def daily_gold(touched: Iterable[date], market: Iterable[date]) -> tuple[set[date], set[date]]:
    """Days to compute, and days to read for them, of daily gold.

    A changed day's own rows change, and those of the market day after it, whose previous close lies on it; also where
    the changed day is gone from the market or new in it. To compute a day, the market day before it is read as well.
    """
    calendar = sorted(set(market))
    touched = set(touched)
    compute = touched | {d for d in (after(t, calendar) for t in touched) if d}
    read = compute | {d for d in (before(c, calendar) for c in compute) if d}
    return compute, read


def hourly_gold(
    touched: Iterable[date], touched_closes: Iterable[date], bars: Iterable[date], closes: Iterable[date]
) -> tuple[set[date], set[date]]:
    """Days to compute of hourly gold, and days of closes to read for them.

    The closes of a day serve all bar days after it, up to and including the next day with closes.
    """
    bar_days, close_days = sorted(set(bars)), sorted(set(closes))
    compute = set(touched)
    for t in set(touched_closes):
        last = after(t, close_days)
        until = len(bar_days) if last is None else bisect_right(bar_days, last)
        compute.update(bar_days[bisect_right(bar_days, t) : until])
    return compute, {d for d in (before(c, close_days) for c in compute) if d}
