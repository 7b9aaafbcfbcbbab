"""Increments of the reporting tables.

The `*_increment` functions are pure: they give the new rows for a day or a range. `refresh` writes them. Its
default replaces whole partitions, so that running it twice, or late, gives what a full build would give;
`mode="append"` only adds rows, as a plain INSERT does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions import times as T
from bookloom.operators.running import latest_before
from bookloom.plans import gold
from bookloom.plans.ranges import skip
from bookloom.sinks.tables import overwrite_partitions, overwrite_table, partitions_in, write_table
from bookloom.sources.tables import load_or_empty


def received(df: DataFrame, start: T.Day | None, end: T.Day | None) -> DataFrame:
    """Rows of the partitions `dt` from `start` to `end`."""
    return df.filter(T.in_days(F.col("dt"), start, end))


# New rows

def daily_bookings_increment(events: DataFrame, start: T.Day, end: T.Day, distinct: bool = True) -> DataFrame:
    return gold.daily_bookings(received(events, start, end), distinct)


def cumulative_increment(events: DataFrame, stored: DataFrame, start: T.Day, end: T.Day | None) -> DataFrame:
    """Days from `start` on, carried on from the last stored total before `start`. Later totals are not repaired."""
    carry = latest_before(stored, "source", "dt", "cumulative_bookings", start)
    return gold.cumulative_bookings(received(events, start, end), carry)


def campaign_increment(
    events: DataFrame, spend: DataFrame, start: T.Day, end: T.Day, mode: str = "proportional",
) -> DataFrame:
    return gold.campaign_daily(received(events, start, end), received(spend, start, end), mode)


def booked_within(start: T.Day, end: T.Day, zone: str) -> Column:
    """Booking time on a local day of the range, stated on the stored columns so that it reaches the scan."""
    created, arrived = F.col("booking_created_at"), F.col("webhook_received_at")
    return T.within_local_days(created, start, end, zone) | (
        created.isNull() & T.within_local_days(arrived, start, end, zone))


def in_any(condition: Callable[[T.Day, T.Day], Column], stretches: list[tuple[T.Day, T.Day]]) -> Column:
    return reduce(Column.__or__, [condition(start, end) for start, end in stretches])


def time_features_on_days(
    events: DataFrame, days: Iterable[T.Day], zone: str = T.NEW_YORK, ranges: DataFrame | None = None,
) -> DataFrame:
    """Complete local days.

    The time filter reaches the scan, each run of consecutive days for itself. A booking may be received on any later
    day; with the recorded `ranges` (see plans.ranges) only the partitions that hold such bookings are opened, else all.
    """
    chosen = sorted(T.iso(d) for d in days)
    if not chosen:
        return gold.time_features(events, zone).limit(0)
    runs = T.stretches(chosen)
    if ranges is not None:
        events = skip(events, ranges, "booked", runs, zone)
    near = events.filter(in_any(lambda start, end: booked_within(start, end, zone), runs))
    return gold.time_features(near, zone).filter(T.on_any_day(F.col("booking_date_local"), chosen))


def time_features_received(events: DataFrame, start: T.Day, end: T.Day, zone: str = T.NEW_YORK) -> DataFrame:
    """Bookings by day of receipt; their local days may be incomplete."""
    return gold.time_features(received(events, start, end), zone)


def meeting_features_on_days(
    events: DataFrame, start: T.Day, end: T.Day, zone: str = T.NEW_YORK, ranges: DataFrame | None = None,
) -> DataFrame:
    """Meetings of the local days from `start` to `end`."""
    if ranges is not None:
        events = skip(events, ranges, "meeting", [(start, end)], zone)
    near = events.filter(T.within_local_days(F.col("scheduled_event_start"), start, end, zone))
    return gold.meeting_features(near, zone).filter(T.in_days(F.col("meeting_date"), start, end))


def meeting_features_on_day(events: DataFrame, day: T.Day, zone: str = T.NEW_YORK) -> DataFrame:
    return meeting_features_on_days(events, day, day, zone)


def meeting_features_in_weeks(
    events: DataFrame, weeks: Iterable[T.Day], zone: str = T.NEW_YORK, ranges: DataFrame | None = None,
) -> DataFrame:
    """Meetings of whole weeks, named by their Mondays; weeks that do not follow each other are filtered each for itself."""
    mondays = sorted(T.iso(w) for w in weeks)
    if not mondays:
        return gold.meeting_features(events, zone).limit(0)
    runs = T.stretches(day for m in mondays for day in T.date_range(m, T.as_day(m) + timedelta(days=6)))
    if ranges is not None:
        events = skip(events, ranges, "meeting", runs, zone)
    near = events.filter(in_any(lambda start, end: T.within_local_days(F.col("scheduled_event_start"), start, end, zone), runs))
    return gold.meeting_features(near, zone).filter(T.in_weeks(F.col("week_start_date"), mondays))


# Writing

def write_slice(rows: DataFrame, path: str, layout: schemas.TableLayout, mode: str, scope: Column | None) -> list[str]:
    ordered = rows.select(*layout.columns)
    if mode == "append":
        write_table(ordered, path, layout.by)
        return []
    if mode != "overwrite":
        raise ValueError(f"unknown mode {mode!r}")
    return overwrite_partitions(ordered, path, layout.by[0], scope)


def build(path: str, layout: schemas.TableLayout, rows: DataFrame) -> None:
    """First build of a table, or a rebuild of all of it."""
    if layout.by:
        write_table(rows.select(*layout.columns), path, layout.by, mode="overwrite")
    else:
        overwrite_table(rows.select(*layout.columns), path)


def refresh_daily_bookings(
    events: DataFrame, path: str, start: T.Day, end: T.Day, mode: str = "overwrite", distinct: bool = True,
) -> list[str]:
    rows = daily_bookings_increment(events, start, end, distinct)
    return write_slice(rows, path, schemas.DAILY_BOOKINGS, mode, T.in_days(F.col("booking_date"), start, end))


def refresh_cpb(events: DataFrame, spend: DataFrame, path: str) -> None:
    """This table has no days: it is replaced as a whole."""
    build(path, schemas.CPB, gold.cpb_by_channel(events, spend))


def refresh_cumulative(
    events: DataFrame, path: str, start: T.Day, end: T.Day | None = None, mode: str = "overwrite",
) -> list[str]:
    """Recompute from `start` to the last day there is, because a late booking changes every later total.

    `mode="append"` adds the days up to `end` and leaves later ones as they are.
    """
    stored = load_or_empty(events.sparkSession, path, schemas.CUMULATIVE)
    rows = cumulative_increment(events, stored, start, end if mode == "append" else None)
    return write_slice(rows, path, schemas.CUMULATIVE, mode, T.in_days(F.col("dt"), start, None))


def refresh_campaign_daily(
    events: DataFrame, spend: DataFrame, path: str, start: T.Day, end: T.Day, mode: str = "overwrite",
    allocation: str = "proportional",
) -> list[str]:
    rows = campaign_increment(events, spend, start, end, allocation)
    return write_slice(rows, path, schemas.CAMPAIGN_DAILY, mode, T.in_days(F.col("dt"), start, end))


def refresh_time_features(
    events: DataFrame, path: str, start: T.Day, end: T.Day, mode: str = "overwrite", by: str = "local_day",
    zone: str = T.NEW_YORK, ranges: DataFrame | None = None,
) -> list[str]:
    """`by="local_day"`: the local days of the range. `by="ingest_day"`: what was received in the range.

    A day of receipt touches several local days, each only in part. Replacing therefore rebuilds every touched local
    day from all events; appending adds just the received rows.
    """
    if by == "local_day":
        days = T.date_range(start, end)
    elif by != "ingest_day":
        raise ValueError(f"unknown selector {by!r}")
    elif mode == "append":
        return write_slice(time_features_received(events, start, end, zone), path, schemas.TIME_FEATURES, mode, None)
    else:
        days = partitions_in(time_features_received(events, start, end, zone), "booking_date_local")
    scope = T.on_any_day(F.col("booking_date_local"), days)
    rows = time_features_on_days(events, days, zone, ranges)
    return write_slice(rows, path, schemas.TIME_FEATURES, mode, scope)


def refresh_meeting_features(
    events: DataFrame, path: str, day: T.Day | None = None, weeks: Iterable[T.Day] | None = None,
    mode: str = "overwrite", zone: str = T.NEW_YORK, last_day: T.Day | None = None, ranges: DataFrame | None = None,
) -> list[str]:
    """Either local days (`day`, up to `last_day` if given) or whole weeks. The table is stored by week, so replacing
    days rebuilds their weeks."""
    if (day is None) == (weeks is None):
        raise ValueError("name either a day or weeks")
    if day is not None and mode == "append":
        rows = meeting_features_on_days(events, day, last_day or day, zone, ranges)
        return write_slice(rows, path, schemas.MEETING_FEATURES, mode, None)
    if weeks is None:
        weeks = {T.monday_of(d) for d in T.date_range(day, last_day or day)}
    mondays = list(weeks)
    scope = T.in_weeks(F.col("week_start_date"), mondays)
    rows = meeting_features_in_weeks(events, mondays, zone, ranges)
    return write_slice(rows, path, schemas.MEETING_FEATURES, mode, scope)


def refresh_range(
    name: str, events: DataFrame, spend: DataFrame, path: str, start: T.Day, end: T.Day, mode: str = "overwrite",
    ranges: DataFrame | None = None,
) -> list[str]:
    """The days from `start` to `end` of one table, in one run."""
    if name == schemas.DAILY_BOOKINGS.name:
        return refresh_daily_bookings(events, path, start, end, mode)
    if name == schemas.CPB.name:
        refresh_cpb(events, spend, path)
        return []
    if name == schemas.CUMULATIVE.name:
        return refresh_cumulative(events, path, start, end, mode)
    if name == schemas.CAMPAIGN_DAILY.name:
        return refresh_campaign_daily(events, spend, path, start, end, mode)
    if name == schemas.TIME_FEATURES.name:
        # Bookings received after midnight UTC belong to the local day before, so replacing goes by day of receipt.
        by = "local_day" if mode == "append" else "ingest_day"
        return refresh_time_features(events, path, start, end, mode, by, ranges=ranges)
    if name == schemas.MEETING_FEATURES.name:
        return refresh_meeting_features(events, path, day=start, last_day=end, mode=mode, ranges=ranges)
    raise ValueError(f"unknown table {name!r}")


def refresh(
    name: str, events: DataFrame, spend: DataFrame, path: str, as_of: T.Day, mode: str = "overwrite",
    ranges: DataFrame | None = None,
) -> list[str]:
    """The daily run of one table: the day before `as_of`."""
    day = T.yesterday(as_of)
    return refresh_range(name, events, spend, path, day, day, mode, ranges)
