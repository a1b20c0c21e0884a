"""Clock, date and time-zone columns.

The session time zone is UTC (see ``tramline.session``): a TIMESTAMP then shows
its UTC wall clock, and ``from_utc_timestamp`` / ``to_utc_timestamp`` move
between UTC and local wall clocks without further shifts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EASTERN = "America/New_York"

# Local clock times before this hour belong to the previous service day.
SERVICE_DAY_START_HOUR = 4


def clock_seconds(clock: Column) -> Column:
    """``HH:MM:SS`` (the hour may pass 24) or plain seconds -> seconds; null stays null."""
    part = F.split(clock, ":")
    h, m, s = (F.get(part, F.lit(i)).try_cast("long") for i in range(3))
    return F.when(F.contains(clock, F.lit(":")), h * 3600 + m * 60 + s).otherwise(clock.try_cast("long"))


def date_int(date: Column) -> Column:
    """date -> ``YYYYMMDD`` as long."""
    return F.year(date).cast("long") * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def int_date(value: Column) -> Column:
    """``YYYYMMDD`` number or text -> date; null when it is not a date."""
    return F.try_to_date(value.cast("string"), "yyyyMMdd")


def local_wall_clock(utc: Column, tz: str = EASTERN) -> Column:
    """UTC timestamp -> local wall clock."""
    return F.from_utc_timestamp(utc, tz)


def local_from_epoch(epoch: Column, tz: str = EASTERN) -> Column:
    """Epoch seconds -> local wall clock."""
    return local_wall_clock(F.timestamp_seconds(epoch), tz)


def service_date(epoch: Column, tz: str = EASTERN) -> Column:
    """Epoch seconds -> service date ``YYYYMMDD``; the day turns at 04:00 local.

    The hours come off the local wall clock, never off the instant, so days
    on which the clocks change are right too.
    """
    local = local_from_epoch(epoch, tz)
    return date_int(F.to_date(local - F.make_dt_interval(hours=F.lit(SERVICE_DAY_START_HOUR))))


def fill_service_date(known: Column, epoch: Column, tz: str = EASTERN) -> Column:
    """The given service date, or the one the timestamp falls on."""
    return F.coalesce(known.cast("long"), service_date(epoch, tz))


def seconds_after_service_midnight(epoch: Column, tz: str = EASTERN) -> Column:
    """Epoch seconds -> seconds since local midnight of the service date."""
    midnight = F.to_utc_timestamp(int_date(service_date(epoch, tz)).cast("timestamp"), tz)
    return epoch - F.unix_timestamp(midnight)


def utc_from_local_seconds(date: Column, seconds: Column, tz: str = EASTERN) -> Column:
    """Local date plus wall-clock seconds -> UTC; doubled autumn hours mean the earlier."""
    return F.to_utc_timestamp(scheduled_at(date, seconds), tz)


def scheduled_at(date: Column, seconds: Column) -> Column:
    """Date plus seconds after midnight -> wall-clock timestamp."""
    return F.timestamp_seconds(F.unix_timestamp(date.cast("timestamp")) + seconds)


def calendar_date(calendar_id: Column) -> Column:
    """``1YYYYMMDD`` -> date."""
    return F.try_to_date(F.substring(calendar_id.cast("string"), 2, 8), "yyyyMMdd")


def wall_seconds_since(date: Column, wall_clock: Column) -> Column:
    """Whole seconds from midnight of ``date`` to a wall-clock timestamp."""
    return F.unix_timestamp(wall_clock) - F.unix_timestamp(date.cast("timestamp"))


# The two ways a schedule version text carries its publish date.
ISO_STAMP = r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})"
US_DATE = r"(\d{1,2}/\d{1,2}/\d{2})"


def published_at(version_text: Column, tz: str = EASTERN) -> Column:
    """Publish wall-clock time found in free text: ISO UTC stamp, else ``M/D/YY``."""
    iso = F.nullif(F.regexp_extract(version_text, ISO_STAMP, 1), F.lit(""))
    short = F.nullif(F.regexp_extract(version_text, US_DATE, 1), F.lit(""))
    return F.coalesce(
        local_wall_clock(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ss")), tz),
        F.try_to_timestamp(short, F.lit("M/d/yy")),
    )


def feed_active_date(version_text: Column, start_date: Column, tz: str = EASTERN) -> Column:
    """Local date of the offset-carrying ISO stamp in a version text, else the start date."""
    stamp = F.nullif(
        F.regexp_extract(version_text, r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+\d{2}:\d{2})", 1), F.lit("")
    )
    utc = F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    return F.coalesce(date_int(F.to_date(local_wall_clock(utc, tz))), start_date.cast("long"))


def tolerant_timestamp(text: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp, or null where the text does not parse."""
    return F.try_to_timestamp(text, F.lit(fmt))


def tolerant_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date, or null where the text does not parse."""
    return F.try_to_date(text, fmt)
