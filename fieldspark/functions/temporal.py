"""Dates, times and periods as column expressions."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_date(c: Column, formats: list[str]) -> Column:
    """The date by the first format that fits (Java patterns)."""
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def local_to_utc(naive: Column, zone: str) -> Column:
    """UTC instant of a wall-clock time; null where the zone's clock skipped it or showed it twice."""
    utc = F.to_utc_timestamp(naive, zone)
    back = F.from_utc_timestamp(utc, zone)
    twice = F.lit(False)
    for hours in (-1, 1):
        other = F.from_utc_timestamp(utc + F.expr(f"INTERVAL {hours} HOUR"), zone)
        twice = twice | (other == naive)
    return F.when((back == naive) & ~twice, utc)


def day_of_parts(y: Column, m: Column, d: Column) -> Column:
    """Date of year, month and day, or null where there is no such day."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", y.cast("int"), m.cast("int"), d.cast("int")), "yyyy-MM-dd")


def clock_text(c: Column, formats: tuple[str, ...] = ("H:mm", "H:mm:ss", "h:mm a", "HHmm")) -> Column:
    """Time of day as HH:mm by the first format that fits."""
    return F.date_format(F.coalesce(*[F.try_to_timestamp(F.upper(F.trim(c)), F.lit(f)) for f in formats]), "HH:mm")


def minutes_of(clock: Column) -> Column:
    return F.substring(clock, 1, 2).try_cast("int") * 60 + F.substring(clock, 4, 2).try_cast("int")


def plausible_start(start: Column, end: Column) -> Column:
    """Start of an encounter (HH:mm) if it lies from 04:00 to 21:00 and the encounter lasts 0 to 16 hours."""
    a, b = minutes_of(start), minutes_of(end)
    lasting = F.coalesce((b - a).between(0, 16 * 60), F.lit(True))
    return F.when(a.between(4 * 60, 21 * 60) & lasting, start)


def week_start(d: Column) -> Column:
    return F.date_trunc("week", d).cast("date")


def period_fields(start: Column, frequency: str) -> dict[str, Column]:
    """Calendar fields of a period; a week's year is the calendar year of its Monday."""
    days = {"daily": 0, "weekly": 6}[frequency]
    return {
        "year": F.year(start),
        "day_of_year": F.dayofyear(start),
        "iso_year": F.extract(F.lit("YEAROFWEEK"), start),
        "iso_week": F.weekofyear(start),
        "period_end": F.date_add(start, days),
    }


def year_wave(d: Column) -> tuple[Column, Column]:
    angle = 2 * pi * F.dayofyear(d) / 365.25
    return F.sin(angle), F.cos(angle)


def daylight_hours(lat: Column, d: Column) -> Column:
    """Length of the day from the sun's declination, held to 0 and 24 hours."""
    tilt = F.radians(F.lit(23.44)) * F.sin(2 * pi * (F.dayofyear(d) - 81) / 365.0)
    x = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -F.tan(F.radians(lat)) * F.tan(tilt)))
    return 24 / pi * F.acos(x)


def season(d: Column) -> Column:
    m = F.month(d)
    return F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring").when(m.isin(6, 7, 8), "summer").otherwise("autumn")


def era(d: Column) -> Column:
    """Five-year span that a date falls in, as ``2020-2024``."""
    low = (F.floor(F.year(d) / 5) * 5).cast("int")
    return F.concat_ws("-", low.cast("string"), (low + 4).cast("string"))


def event_fields(explicit: Column, instant: Column, raw_date: Column, created: Column, retrieved: Column, zone: str) -> dict[str, Column]:
    """Resolved date of an event, what it rests on, and when it became known.

    An explicit date wins, then the instant's date in the model's zone, then the raw text; a day without an instant is
    stamped at noon UTC.
    """
    of_instant = F.from_utc_timestamp(instant, zone).cast("date")
    date = F.coalesce(explicit, of_instant, raw_date)
    noon = (F.to_timestamp(F.date_format(date, "yyyy-MM-dd")) + F.expr("INTERVAL 12 HOURS")).cast("timestamp")
    return {
        "sighting_date": date,
        "date_basis": F.when(explicit.isNotNull(), "EXPLICIT_DATE").when(of_instant.isNotNull(), "TIMESTAMP").when(raw_date.isNotNull(), "RAW_DATE"),
        "date_conflict": F.coalesce(explicit != of_instant, F.lit(False)),
        "sighting_at": F.coalesce(instant, noon),
        "time_precision": F.when(instant.isNotNull(), "TIMESTAMP").otherwise("DATE"),
        "available_at": F.coalesce(created, retrieved),
    }
