"""Date and age expressions. "Now" is always the ``as_of`` argument."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"
DAYS_PER_YEAR = 365.25
PIVOT = 69  # two-digit years from here on belong to the last century


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(value: Column | date | datetime | str) -> Column:
    """A zone-free timestamp column from a column, a date, a datetime or ISO text."""
    return (value if isinstance(value, Column) else F.lit(str(value))).cast(NTZ)


def parse_mdy_timestamp(col: Column | str) -> Column:
    """``m/d/y h:m:s`` text to a timestamp; years have two or four digits, bad text gives null."""

    def stamp(part: Column) -> Column:
        num = [F.get(part, F.lit(i)).try_cast("int") for i in range(6)]
        width = F.length(F.get(part, F.lit(2)))
        year = (
            F.when(width == 4, num[2])
            .when((width == 2) & (num[2] < PIVOT), num[2] + 2000)
            .when(width == 2, num[2] + 1900)
        )
        made = F.try_make_timestamp_ntz(year, num[0], num[1], num[3], num[4], num[5])
        return F.when(F.size(part) == 6, made)

    # A lambda argument is evaluated once, so the text is split once per row.
    return F.get(F.transform(F.array(F.split(F.trim(_col(col)), "[/ :]+")), stamp), F.lit(0))


def correct_future_date(col: Column | str, as_of: Column | date | str, nyears: float = 2) -> Column:
    """Move a date lying more than ``nyears`` after ``as_of`` back by 100 years of 365.25 days."""
    c = _col(col)
    limit = moment(as_of) + F.make_dt_interval(days=F.lit(0), secs=F.lit(int(nyears * DAYS_PER_YEAR * 86400)))
    return F.when(c.cast(NTZ) > limit, c.cast(NTZ) - F.make_dt_interval(days=F.lit(36525))).otherwise(c.cast(NTZ))


def combine_date_time(date_col: Column | str, time_col: Column | str) -> Column:
    """Day of ``date_col`` plus time of day of ``time_col`` (midnight when that is missing)."""
    t = _col(time_col)
    clock = t.cast(NTZ) - t.cast("date").cast(NTZ)
    midnight = F.make_dt_interval(days=F.lit(0))
    return _col(date_col).cast("date").cast(NTZ) + F.coalesce(clock, midnight)


def age_years_exact(when: Column | str, dob: Column | str) -> Column:
    """Days between two dates over 365.25."""
    return F.datediff(_col(when), _col(dob)) / F.lit(DAYS_PER_YEAR)


def age_years_whole_days(when: Column | str, dob: Column | str) -> Column:
    """Whole days elapsed between a timestamp and a birth date, over 365.25."""
    elapsed = _col(when).cast(NTZ) - _col(dob).cast(NTZ)
    return F.extract(F.lit("DAY"), elapsed) / F.lit(DAYS_PER_YEAR)


def current_age(dob: Column | str, as_of: Column | date | str) -> Column:
    return age_years_whole_days(moment(as_of), dob)


def current_age_floor(dob: Column | str, as_of: Column | date | str) -> Column:
    return F.floor(current_age(dob, as_of)).cast("double")


def format_day_stamp(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyyMMdd")
