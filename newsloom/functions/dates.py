"""Column functions over dates, times of editions and cue times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days from subscription to the next check, by cadence; other cadences take DEFAULT_DAYS.
CHECK_DAYS = {"daily": 3, "weekly": 9, "biweekly": 16, "3x-weekly": 5, "monthly": 32}
DEFAULT_DAYS = 9


def check_days(cadence: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in CHECK_DAYS.items() for x in kv))
    return F.coalesce(F.try_element_at(known, F.lower(F.trim(cadence))), F.lit(DEFAULT_DAYS))


def next_check(subscribed: Column, cadence: Column) -> Column:
    """The date of the next check; null for a null date."""
    return F.date_add(subscribed, check_days(cadence))


def to_date_or_null(text: Column) -> Column:
    return F.try_to_date(text)


def filled_check(current: Column, subscribed: Column, cadence: Column) -> Column:
    """The current value where there is one, else the computed one."""
    return F.coalesce(current, next_check(subscribed, cadence))


def cue_seconds(stamp: Column) -> Column:
    """`hh:mm:ss.mmm` in seconds; null for other texts."""
    part = lambda i: F.regexp_extract(stamp, r"^(\d{2}):(\d{2}):(\d{2})[.,](\d{3})", i).try_cast("double")
    return part(1) * 3600 + part(2) * 60 + part(3) + part(4) / 1000


def is_all_day(stamp: Column) -> Column:
    return ~F.contains(stamp, F.lit("T"))


def edition_instant(day: Column, clock: str, zone: str = "America/New_York") -> Column:
    """The UTC instant of a wall-clock time of an edition, by the zone's rules on that day."""
    return F.to_utc_timestamp(F.to_timestamp(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(f" {clock}:00")), "yyyy-MM-dd HH:mm:ss"), zone)


def is_friday(day: Column) -> Column:
    return F.dayofweek(day) == 6
