"""Days, weeks and local time. Days are passed as `date` or ISO text; nothing here asks for the current date."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"
UTC_NAMES = ("UTC", "Etc/UTC", "Z", "+00:00")

Day = date | str


def as_day(day: Day) -> date:
    if isinstance(day, datetime):
        return day.date()
    return day if isinstance(day, date) else date.fromisoformat(day)


def iso(day: Day) -> str:
    return as_day(day).isoformat()


def yesterday(as_of: Day) -> date:
    return as_day(as_of) - timedelta(days=1)


def date_range(start: Day, end: Day) -> list[str]:
    """Every day from `start` to `end`, both included, as ISO text."""
    first, last = as_day(start), as_day(end)
    return [(first + timedelta(days=n)).isoformat() for n in range((last - first).days + 1)]


def next_day(day: Day) -> date:
    return as_day(day) + timedelta(days=1)


def stretches(days: Iterable[Day]) -> list[tuple[date, date]]:
    """Days as first and last of each run of consecutive ones."""
    out: list[tuple[date, date]] = []
    for day in sorted({as_day(d) for d in days}):
        if out and day == next_day(out[-1][1]):
            out[-1] = (out[-1][0], day)
        else:
            out.append((day, day))
    return out


def monday_of(day: Day) -> date:
    d = as_day(day)
    return d - timedelta(days=d.weekday())


# Predicates. The column stays bare and is compared with a literal, so partition columns prune and data columns
# are pushed to the Parquet scan, whether they hold dates or ISO text.

def in_days(column: Column, start: Day | None, end: Day | None) -> Column:
    """Between two days, both included; a missing bound is open."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (column >= F.lit(iso(start)))
    if end is not None:
        condition = condition & (column <= F.lit(iso(end)))
    return condition


def on_day(column: Column, day: Day) -> Column:
    return column == F.lit(iso(day))


def before(column: Column, day: Day) -> Column:
    return column < F.lit(iso(day))


def on_any_day(column: Column, days: Iterable[Day]) -> Column:
    return column.isin([iso(d) for d in days])


def in_weeks(column: Column, weeks: Iterable[Day]) -> Column:
    """Week start is one of the given Mondays."""
    return on_any_day(column, weeks)


# Local time

def local_time(instant: Column, zone: str = NEW_YORK) -> Column:
    """Wall-clock time in `zone`, daylight saving included; read it with the session zone UTC.

    `convert_timezone` would do for any session zone, but takes four times as long.
    """
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.sql.session.timeZone") not in UTC_NAMES:
        raise ValueError("local times need the session time zone UTC; see session.configure")
    return F.from_utc_timestamp(instant, zone)


def week_start(column: Column) -> Column:
    """Monday of the week, as a date."""
    return F.to_date(F.date_trunc("week", column))


def iso_weekday(column: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return (F.weekday(column) + 1).cast("int")


def weekday_name(column: Column) -> Column:
    return F.date_format(column, "EEE")


def midnight(day: Day, zone: str) -> Column:
    """The instant at which `day` starts in `zone`; folds to a literal."""
    d = as_day(day)
    return F.make_timestamp(*[F.lit(n) for n in (d.year, d.month, d.day, 0, 0, 0)], F.lit(zone))


def within_local_days(instant: Column, start: Day, end: Day, zone: str = NEW_YORK) -> Column:
    """`instant` falls on a local day between `start` and `end`.

    Stated on the stored column, so the scan can skip row groups by their statistics; a condition on the converted
    local date could not be pushed down.
    """
    return (instant >= midnight(start, zone)) & (instant < midnight(as_day(end) + timedelta(days=1), zone))


def iso_timestamp(column: Column) -> Column:
    """Timestamp from ISO text; bad text is null."""
    return F.try_to_timestamp(column)


def written_date(column: Column) -> Column:
    """The date as written in ISO text, whatever offset follows it; bad text is null."""
    return column.try_cast("date")
