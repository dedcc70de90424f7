"""Local days, gates and grids on UTC timestamps without a zone.

All instants are `timestamp_ntz` in UTC; zone work goes through convert_timezone, so the session's zone never matters. Both passes of
the doubled autumn hour have one wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZONE = "Europe/Berlin"


def local(ts: Column, zone: str = ZONE) -> Column:
    """Wall clock of a UTC instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def utc(wall: Column, zone: str = ZONE) -> Column:
    """UTC instant of a wall clock."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)


def local_day(ts: Column, zone: str = ZONE) -> Column:
    return F.to_date(local(ts, zone))


def hours(n: int) -> Column:
    return F.expr(f"INTERVAL '{n}' HOUR")


def minutes(n: int) -> Column:
    return F.expr(f"INTERVAL '{n}' MINUTE")


def day_start(day: Column, zone: str = ZONE) -> Column:
    """UTC instant at which a local day begins."""
    return utc(day.cast("timestamp_ntz"), zone)


def day_end(day: Column, zone: str = ZONE) -> Column:
    return day_start(F.date_add(day, 1), zone)


def seconds(ts: Column) -> Column:
    """Seconds since 1970."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def expected_slots(start: Column, end: Column, step_minutes: int) -> Column:
    """Grid points in [start, end); on clock-change days this is 92 or 100 quarter hours."""
    return (F.timestamp_diff("MINUTE", start, end) / step_minutes).cast("long")


def gate_closure(day: Column, *, wall_clock: bool = False, zone: str = ZONE) -> Column:
    """Noon of the day before: twelve elapsed hours after its midnight, or twelve on the clock."""
    before = F.date_sub(day, 1)
    return utc(before.cast("timestamp_ntz") + hours(12), zone) if wall_clock else day_start(before, zone) + hours(12)


def run_init(day: Column, hour: int = 0) -> Column:
    """The weather run that may be used for a delivery day."""
    return F.date_sub(day, 1).cast("timestamp_ntz") + hours(hour)


def next_delivery_day(as_of: Column, zone: str = ZONE) -> Column:
    return F.date_add(local_day(as_of, zone), 1)


def spine(days: DataFrame, step_minutes: int, day: str = "day", zone: str = ZONE) -> DataFrame:
    """days with one row for each slot `ts` of the local day."""
    d = F.col(day)
    return days.withColumn("ts", F.explode(F.sequence(day_start(d, zone), day_end(d, zone) - minutes(step_minutes), minutes(step_minutes))))


def truncate(ts: Column, step_minutes: int) -> Column:
    """Start of the slot that holds an instant."""
    if step_minutes == 60:
        return F.date_trunc("HOUR", ts).cast("timestamp_ntz")
    return F.timestamp_seconds(F.floor(seconds(ts) / (60 * step_minutes)) * 60 * step_minutes).cast("timestamp_ntz")


def cyclical(position: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a position in its period."""
    angle = 2 * F.pi() * position / period
    return F.sin(angle), F.cos(angle)


def easter(year: Column) -> Column:
    """Easter Sunday by the Gregorian computus."""
    a, b, c = year % 19, F.floor(year / 100), year % 100
    d, e = F.floor(b / 4), b % 4
    g = F.floor((8 * b + 13) / 25)
    h = (19 * a + b - d - g + 15) % 30
    i, k = F.floor(c / 4), c % 4
    weekday = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * weekday) / 451)
    n = h + weekday - 7 * m + 114
    return F.make_date(year, F.floor(n / 31).cast("int"), (n % 31 + 1).cast("int"))


#: Fixed days (month, day) of nationwide and of two regional holidays, and offsets from Easter Sunday.
NATIONWIDE, FROM_EASTER = ((1, 1), (5, 1), (10, 3), (12, 25), (12, 26)), (-2, 1, 39, 50)
REGIONAL, REGIONAL_FROM_EASTER = {"corpus_christi": None, "all_saints": (11, 1)}, {"corpus_christi": 60}


def is_nationwide_holiday(day: Column) -> Column:
    fixed = [(F.month(day) == m) & (F.dayofmonth(day) == d) for m, d in NATIONWIDE]
    moving = F.date_diff(day, easter(F.year(day))).isin(*FROM_EASTER)
    out = moving
    for f in fixed:
        out = out | f
    return out


def local_window(day: Column, back_start: int, back_end: int, zone: str = ZONE) -> tuple[Column, Column]:
    """Local midnights of the days back_start and back_end before day, each from the calendar, so a clock change between them counts (C2). A negative number reaches past day."""
    return day_start(F.date_sub(day, back_start), zone), day_start(F.date_sub(day, back_end), zone)
