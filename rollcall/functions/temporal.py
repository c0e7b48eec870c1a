"""Date and time expressions, cut on the session clock (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
MINUTE_US = 60_000_000


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch, for both timestamp flavours."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def floor_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole 24-hour periods between two instants, rounded towards minus infinity."""
    return floor_div(micros(later) - micros(earlier), DAY_US)


def floor_div(value: Column, divisor: int) -> Column:
    """Exact floor division of longs (``div`` alone truncates towards zero)."""
    d = F.lit(divisor).cast("long")
    return F.call_function("div", value - F.pmod(value, d), d)


def minute_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of minute marks crossed between two instants."""
    return floor_div(micros(end), MINUTE_US) - floor_div(micros(start), MINUTE_US)


def birth_year(date: Column | str) -> Column:
    return F.year(date)


def add_working_days(date: Column | str, n: Column | str | int) -> Column:
    """The date ``n`` weekdays away; zero leaves the date alone, weekend or not.

    Closed form: Monday-based weekday arithmetic instead of a day-by-day walk.
    """
    date = F.col(date) if isinstance(date, str) else date
    n = F.lit(n) if isinstance(n, int) else (F.col(n) if isinstance(n, str) else n)
    n = n.cast("int")
    weekday = F.weekday(date)
    # A weekend start behaves like the Friday before it going forward, and like
    # the Monday after it going back.
    forward_base = F.date_sub(date, F.greatest(weekday - 4, F.lit(0)))
    back_base = F.date_add(date, F.when(weekday > 4, 7 - weekday).otherwise(0))
    forward_day = F.least(weekday, F.lit(4))
    back_day = F.when(weekday > 4, 0).otherwise(weekday)
    ahead = forward_day + n
    behind = back_day + n
    forward = F.date_add(
        forward_base,
        (F.floor(ahead / 5) * 7 + F.pmod(ahead, F.lit(5)) - forward_day).cast("int"),
    )
    back = F.date_add(
        back_base,
        (F.floor(behind / 5) * 7 + F.pmod(behind, F.lit(5)) - back_day).cast("int"),
    )
    return F.when(n == 0, F.to_date(date)).when(n > 0, forward).otherwise(back)


def month_start(ts: Column | str) -> Column:
    return F.trunc(F.to_date(ts), "MM")


def weekday_monday0(ts: Column | str) -> Column:
    return F.weekday(ts)


def easter_day(year: Column) -> Column:
    """Easter Sunday of a Gregorian year, by whole-number arithmetic."""

    def div(a: Column, b: int) -> Column:
        return F.call_function("div", a, F.lit(b))

    moon_year = year % 19
    century, rest = div(year, 100), year % 100
    # Age of the moon, corrected for the leap days and the lunar equation of the centuries.
    age = (19 * moon_year + century - div(century, 4) - div(8 * century + 13, 25) + 15) % 30
    days = age - div(moon_year + 11 * age, 319)
    to_sunday = (2 * (century % 4) + 2 * div(rest, 4) - (rest % 4) - days + 32) % 7
    after_march = days + to_sunday
    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), after_march.cast("int"))
