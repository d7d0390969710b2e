"""Date parsing, elapsed time, ages and seasons. Timestamps are read in the session time zone (UTC)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from faultline.config import DEFAULT_INSTALL_DATES, MIN_VALID_YEAR

DAY_US = 86_400_000_000
_EPOCH_SERIAL_DAYS = 25_569  # 1899-12-30 .. 1970-01-01


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(value: str | dt.datetime | dt.date) -> Column:
    """A literal that takes the type of the timestamp column it is compared with, so filters reach the scan."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value))


def micros(c: str | Column) -> Column:
    return F.unix_micros(col(c).cast("timestamp"))


def moment_micros(value: str | dt.datetime | dt.date) -> Column:
    return micros(moment(value))


def elapsed_us(start: Column | str, end: Column | str) -> Column:
    return micros(end) - micros(start)


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Whole days, rounded down (minus twelve hours is minus one day)."""
    return F.floor(elapsed_us(start, end) / F.lit(DAY_US))


_UNIT_US = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": DAY_US}


def duration(start: Column | str, end: Column | str, unit: str = "hour") -> Column:
    return elapsed_us(start, end) / F.lit(_UNIT_US[unit])


def duration_minutes(value: Column | str, unit: str = "minute") -> Column:
    """A recorded duration as minutes: hours are multiplied, text that is no number is null."""
    return col(value).cast("string").try_cast("double") * F.lit({"minute": 1.0, "hour": 60.0}[unit])


# Accepted date shapes in order of precedence, the day before the month; the month-first
# reading is tried only when the day-first one fails.
_SHAPES = (
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", ("yyyy-M-d H:m:s",)),
    (r"^\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", ("d-M-yyyy H:m:s",)),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", ("d/M/yyyy H:m:s", "M/d/yyyy H:m:s")),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", ("yyyy-M-d",)),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", ("d-M-yyyy",)),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", ("d/M/yyyy", "M/d/yyyy")),
    (r"^\d{1,2}\.\d{1,2}\.\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", ("d.M.yyyy H:m:s",)),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", ("d.M.yyyy",)),
)


def from_serial(c: Column | str) -> Column:
    """Spreadsheet day number 1..100000, counted from 1899-12-30."""
    number = col(c).cast("string").try_cast("double")
    shifted = F.round((number - _EPOCH_SERIAL_DAYS) * DAY_US).cast("bigint")
    return F.when(number.between(1, 100_000), F.timestamp_micros(shifted))


def parse_date(c: Column | str) -> Column:
    """Text in any accepted shape, or a spreadsheet serial, to a timestamp; anything else is null.

    The shape is recognised first, so one format is tried per row and no failed attempt is paid for.
    """
    text = F.trim(col(c).cast("string"))
    parsed = None
    for shape, formats in _SHAPES:
        attempts = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
        value = F.coalesce(*attempts) if len(attempts) > 1 else attempts[0]
        parsed = F.when(text.rlike(shape), value) if parsed is None else parsed.when(text.rlike(shape), value)
    return parsed.otherwise(from_serial(text))


def is_time_only(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string").rlike(r"^\s*\d{1,2}:\d{2}(:\d{2})?\s*$"), F.lit(False))


def valid_date(
    c: Column | str,
    max_year: int,
    min_year: int = MIN_VALID_YEAR,
    install_cutoff: str | None = None,
) -> Column:
    """Null where the timestamp is out of the year range or is the 1900-01-01 placeholder.

    With ``install_cutoff`` a midnight value later than thirty days before it is a default too.
    """
    ts = col(c).cast("timestamp")
    ok = F.year(ts).between(min_year, max_year) & (ts != moment("1900-01-01 00:00:00").cast("timestamp"))
    if install_cutoff is not None:
        midnight = (F.hour(ts) == 0) & (F.minute(ts) == 0) & (F.second(ts) == 0)
        recent = micros(ts) >= moment_micros(install_cutoff) - F.lit(30 * DAY_US)
        ok = ok & ~(midnight & recent)
    return F.when(ok, ts)


def asset_age_days(install: Column | str, cutoff: str) -> Column:
    """Days in service at the cutoff; null when not installed before it."""
    return F.when(micros(install) < moment_micros(cutoff), elapsed_days(install, moment(cutoff)))


def age_source(install: Column | str, cutoff: str) -> Column:
    return F.when(micros(install) < moment_micros(cutoff), F.lit("GRID_CONNECTION")).otherwise(F.lit("MISSING"))


def years(days: Column | str) -> Column:
    return col(days) / F.lit(365.25)


def age_by_year(install: Column | str, year: int) -> Column:
    return F.lit(year) - F.year(col(install))


def suspicious_age_flag(age_years: Column | str) -> Column:
    return F.coalesce(col(age_years) > 60, F.lit(False)).cast("int")


def default_date_flag(install: Column | str) -> Column:
    stamp = F.date_format(col(install), "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(stamp.isin(*[f"{d} 00:00:00" for d in DEFAULT_INSTALL_DATES]), F.lit(False)).cast("int")


def summer_flag(ts: Column | str) -> Column:
    return F.coalesce(F.month(col(ts)).isin(6, 7, 8, 9), F.lit(False)).cast("int")


def winter_flag(ts: Column | str) -> Column:
    return F.coalesce(F.month(col(ts)).isin(12, 1, 2), F.lit(False)).cast("int")


def season(ts: Column | str, names: tuple[str, str, str, str] = ("Kış", "İlkbahar", "Yaz", "Sonbahar")) -> Column:
    """Season by month; ``names`` are winter, spring, summer, autumn."""
    month = F.month(col(ts))
    return (
        F.when(month.isNull(), F.lit(None).cast("string"))
        .when(month.isin(12, 1, 2), F.lit(names[0]))
        .when(month.isin(3, 4, 5), F.lit(names[1]))
        .when(month.isin(6, 7, 8), F.lit(names[2]))
        .otherwise(F.lit(names[3]))
    )


def recency_flag(ts: Column | str, cutoff: str, days: int) -> Column:
    inside = micros(ts) >= moment_micros(cutoff) - F.lit(days * DAY_US)
    return F.coalesce(inside, F.lit(False)).cast("int")


def first_failure_band(years_to_first: Column | str) -> Column:
    y = col(years_to_first)
    return (
        F.when(y.isNull(), F.lit("Unknown"))
        .when(y < 0, F.lit("Invalid (negative)"))
        .when(y < 1, F.lit("Infant Mortality (<1y)"))
        .when(y < 3, F.lit("Early Failure (1-3y)"))
        .when(y < 5, F.lit("Normal Operation (3-5y)"))
        .otherwise(F.lit("Survived Burn-in (>5y)"))
    )
