"""Calendar expressions and the national holiday rule.

Truncation avoids ``date_trunc``, which would pass a zone-free time through
the session zone and move bars in the hour a clock change skips.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (month, day, first year, name) of the public national holidays.
FIXED_HOLIDAYS = (
    (1, 1, 1, "Confraternização Universal"),
    (4, 21, 1, "Tiradentes"),
    (5, 1, 1, "Dia do Trabalhador"),
    (9, 7, 1, "Independência do Brasil"),
    (10, 12, 1980, "Nossa Senhora Aparecida"),
    (11, 2, 1, "Finados"),
    (11, 15, 1, "Proclamação da República"),
    (11, 20, 2024, "Dia Nacional de Zumbi e da Consciência Negra"),
    (12, 25, 1, "Natal"),
)
GOOD_FRIDAY = "Sexta-feira Santa"


def day_start(ts: Column) -> Column:
    return F.to_date(ts).cast("timestamp_ntz")


def hour_start(ts: Column) -> Column:
    return day_start(ts) + F.make_dt_interval(hours=F.hour(ts))


def is_weekday(ts: Column) -> Column:
    return F.weekday(ts) < 5


def in_hours(ts: Column, first: int, last: int) -> Column:
    """Whole hours ``first`` to ``last``, both included."""
    return F.hour(ts).between(first, last)


def day_text(day: Column) -> Column:
    return F.date_format(F.to_date(day), "yyyy-MM-dd")


def display_date(ts: Column) -> Column:
    return F.date_format(F.to_date(ts), "dd/MM/yyyy")


def easter_sunday(year: int) -> date:
    """Western Easter by Gauss's rule with its Gregorian corrections."""
    century = year // 100
    leap_skips = century - century // 4
    moon_term = (15 - (13 + 8 * century) // 25 + leap_skips) % 30
    full_moon = (19 * (year % 19) + moon_term) % 30
    to_sunday = (2 * (year % 4) + 4 * (year % 7) + 6 * full_moon + 4 + leap_skips) % 7
    late = full_moon == 29 or (full_moon == 28 and (11 * moon_term + 11) % 30 < 19)
    week_back = 7 if late and to_sunday == 6 else 0
    return date(year, 3, 22) + timedelta(days=full_moon + to_sunday - week_back)


def easter_day(year: Column) -> Column:
    """``easter_sunday`` as an expression of whole numbers, for any year."""

    def div(a: Column, by: int) -> Column:
        return F.call_function("div", a, F.lit(by))

    century = div(year, 100)
    skips = century - div(century, 4)
    moon = F.pmod(15 - div(13 + 8 * century, 25) + skips, F.lit(30))
    full = F.pmod(19 * F.pmod(year, F.lit(19)) + moon, F.lit(30))
    sunday = F.pmod(2 * F.pmod(year, F.lit(4)) + 4 * F.pmod(year, F.lit(7)) + 6 * full + 4 + skips, F.lit(7))
    late = (full == 29) | ((full == 28) & (F.pmod(11 * moon + 11, F.lit(30)) < 19))
    back = F.when(late & (sunday == 6), 7).otherwise(0)
    return F.date_add(F.make_date(year.cast("int"), F.lit(3), F.lit(22)), (full + sunday - back).cast("int"))


def is_holiday(ts: Column) -> Column:
    """Whether a time falls on a public national holiday; an expression of its date, without a table of years.

    One number of month and day is looked up; Easter is worked out only for the Fridays of March and April.
    """
    day = F.to_date(ts)
    year, place = F.year(day), 100 * F.month(day) + F.dayofmonth(day)
    always = [100 * m + d for m, d, first, _ in FIXED_HOLIDAYS if first == 1]
    fixed = [place.isin(always), *((place == 100 * m + d) & (year >= first) for m, d, first, _ in FIXED_HOLIDAYS if first > 1)]
    spring_friday = F.month(day).isin(3, 4) & (F.weekday(day) == 4)
    movable = F.when(spring_friday, day == F.date_sub(easter_day(year), 2)).otherwise(F.isnull(day) & F.lit(None))
    return reduce(lambda a, b: a | b, fixed, movable)


def national_holidays(years: Iterable[int]) -> Iterator[tuple[date, str]]:
    for year in years:
        for month, day, first_year, name in FIXED_HOLIDAYS:
            if year >= first_year:
                yield date(year, month, day), name
        yield easter_sunday(year) - timedelta(days=2), GOOD_FRIDAY


def is_business_moment(
    moment: datetime,
    holidays: Iterable[date] | None = None,
    hours: tuple[int, int] | None = None,
) -> bool:
    """Scheduling guard for one clock reading on the driver."""
    days = set(holidays) if holidays is not None else {d for d, _ in national_holidays([moment.year])}
    if moment.weekday() >= 5 or moment.date() in days:
        return False
    return hours is None or hours[0] <= moment.hour <= hours[1]
