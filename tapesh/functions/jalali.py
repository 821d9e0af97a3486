"""The Jalali calendar as integer column arithmetic; nothing leaves whole-stage code generation.

A day is a number of days since 1970-01-01, a date a DATE. The leap rule is
the 33-year cycle, right for the years 1300 to 1499. Null in, null out;
valid_jalali() tells whether year, month and day name a day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The leap years of the 33-year cycle.
LEAP_REMAINDERS = (1, 5, 9, 13, 17, 22, 26, 30)
#: Days from 1970-01-01 to 1600-01-01, and 79 more to the first day of Jalali year 979.
_BASE = -135140 + 79


def _div(a: Column, b: int) -> Column:
    """Integer quotient of a non-negative a."""
    return F.floor(a / F.lit(b)).cast("int")


def is_leap(y: Column) -> Column:
    return F.pmod(y, F.lit(33)).isin(*LEAP_REMAINDERS)


def month_length(y: Column, m: Column) -> Column:
    return F.when(m <= 6, 31).when(m <= 11, 30).otherwise(F.when(is_leap(y), 30).otherwise(29))


def valid_jalali(y: Column, m: Column, d: Column) -> Column:
    return m.between(1, 12) & (d >= 1) & (d <= month_length(y, m))


def jalali_to_epoch_day(y: Column, m: Column, d: Column) -> Column:
    n = y - 979
    cycle = F.floor(n / F.lit(33)).cast("int")
    rest = n - cycle * 33
    before = F.when(m <= 7, (m - 1) * 31).otherwise((m - 7) * 30 + 186)
    return (n * 365 + cycle * 8 + _div(rest + 3, 4) + before + d - 1 + _BASE).cast("int")


def gregorian_to_epoch_day(y: Column, m: Column, d: Column) -> Column:
    """The proleptic Gregorian calendar, years from 1 on."""
    yy = F.when(m <= 2, y - 1).otherwise(y)
    era = _div(yy, 400)
    of_era = yy - era * 400
    of_year = _div((m + F.when(m > 2, -3).otherwise(9)) * 153 + 2, 5) + d - 1
    return (era * 146097 + of_era * 365 + _div(of_era, 4) - _div(of_era, 100) + of_year - 719468).cast("int")


def valid_gregorian(y: Column, m: Column, d: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    length = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    return m.between(1, 12) & (d >= 1) & (d <= length) & (y >= 1)


def epoch_day(date: Column) -> Column:
    return F.datediff(date.cast("date"), F.lit("1970-01-01").cast("date"))


def to_jalali(date: Column) -> Column:
    """struct<y, m, d> of a DATE or TIMESTAMP."""
    n = epoch_day(date) - _BASE
    c = F.floor(n / F.lit(12053)).cast("int")
    r = n - c * 12053
    four = _div(r, 1461)
    q0 = r - four * 1461
    past = q0 >= 366
    y = c * 33 + 979 + four * 4 + F.when(past, _div(q0 - 1, 365)).otherwise(0)
    q = F.when(past, (q0 - 1) % 365).otherwise(q0)
    first = q < 186
    m = F.when(first, _div(q, 31) + 1).otherwise(_div(q - 186, 30) + 7)
    d = F.when(first, q % 31 + 1).otherwise((q - 186) % 30 + 1)
    return F.struct(y.cast("int").alias("y"), m.cast("int").alias("m"), d.cast("int").alias("d"))


def format_jalali(j: Column, sep: str = "/") -> Column:
    """'yyyy/MM/dd' of a to_jalali() struct."""
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.concat_ws(sep, pad(j["y"], 4), pad(j["m"], 2), pad(j["d"], 2))


def from_jalali(y: Column, m: Column, d: Column) -> Column:
    """DATE, or null if there is no such day."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), jalali_to_epoch_day(y, m, d))
    return F.when(valid_jalali(y, m, d), day)


def parse_jalali(text: Column, sep: str = "/") -> Column:
    """DATE of 'yyyy<sep>MM<sep>dd', or null."""
    part = F.split(text, sep)
    num = lambda i: F.try_element_at(part, F.lit(i)).try_cast("int")
    return F.when(F.size(part) == 3, from_jalali(num(1), num(2), num(3)))


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value worked out, and written into the plan, once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def add_months(j: Column, months: Column) -> Column:
    """A to_jalali() struct moved by months, its day held to the length of the month reached."""

    def moved(x: Column) -> Column:
        y = F.floor(x["at"] / F.lit(12)).cast("int")
        m = (x["at"] - y * 12 + 1).cast("int")
        return F.struct(y.alias("y"), m.alias("m"), F.least(x["d"], month_length(y, m)).cast("int").alias("d"))

    start = _let(j, lambda x: F.when(x.isNotNull(), F.struct((x["y"] * 12 + x["m"] - 1 + months).alias("at"), x["d"].alias("d"))))
    return _let(start, lambda x: F.when(x["at"].isNotNull(), moved(x)))


def weekday(date: Column) -> Column:
    """Saturday 0 to Friday 6."""
    return F.dayofweek(date) % 7


def day_of(y: int, m: int, d: int) -> int:
    """Epoch day of a Jalali date, for code that runs in Python; ValueError if there is none."""
    leap = y % 33 in LEAP_REMAINDERS
    if not (1 <= m <= 12 and 1 <= d <= (31 if m <= 6 else 30 if m <= 11 else 29 + leap)):
        raise ValueError("no such day")
    n = y - 979
    return 365 * n + n // 33 * 8 + (n % 33 + 3) // 4 + (31 * (m - 1) if m <= 7 else 186 + 30 * (m - 7)) + d - 1 + _BASE


def date_of(day: int) -> tuple[int, int, int]:
    """Jalali year, month and day of an epoch day."""
    cycles, rest = divmod(day - _BASE, 12053)
    fours, of_four = divmod(rest, 1461)
    years, of_year = divmod(of_four - 1, 365) if of_four >= 366 else (0, of_four)
    y = 979 + 33 * cycles + 4 * fours + years
    return (y, of_year // 31 + 1, of_year % 31 + 1) if of_year < 186 else (y, (of_year - 186) // 30 + 7, (of_year - 186) % 30 + 1)


def standard_time(value: Column) -> Column:
    """TIMESTAMP_NTZ of a Jalali or Gregorian time as text; 1970-01-01 for what is missing or cannot be read."""
    head = F.substring_index(F.replace(F.trim(value), F.lit("/"), F.lit("-")), " ", 1)
    jalali = parse_jalali(head, "-").cast("timestamp_ntz")
    gregorian = F.trim(value).try_cast("timestamp_ntz")
    return F.coalesce(F.when(F.trim(value).rlike("^1[34]"), jalali).otherwise(gregorian), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
