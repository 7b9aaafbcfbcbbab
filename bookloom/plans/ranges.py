"""What the silver partitions hold: first and last booking time and meeting start of each, to skip partitions without loss.

A booking may be received weeks after it was made, so the day of receipt says nothing certain about the days inside. The
recorded ranges do. A partition without a record is always read: `forget` takes the records away before a partition is
written, `record` brings them back when it is whole, and a run that dies between the two costs time only. Whoever writes
the silver table by other means calls both as well, or reads without ranges.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions import times as T
from bookloom.sinks.tables import empty_partitions, overwrite_partitions, partitions_in
from bookloom.sources.tables import load_or_empty, load_table, path_exists


def booked_at() -> Column:
    return F.coalesce("booking_created_at", "webhook_received_at")


def forget(spark: SparkSession, path: str, scope: Column) -> None:
    """Drop the records of the partitions in `scope`, a condition on `dt`."""
    if path_exists(spark, path):
        known = load_table(spark, path, schemas.EVENT_RANGES)
        empty_partitions(known, path, "dt", partitions_in(known.filter(scope), "dt"))


def record(spark: SparkSession, silver_path: str, path: str, scope: Column) -> list[str]:
    """Note the ranges of the partitions in `scope`; reads three columns of these."""
    events = load_table(spark, silver_path, schemas.EVENTS).filter(scope)
    found = events.groupBy("dt").agg(
        F.min(booked_at()).alias("first_booked"), F.max(booked_at()).alias("last_booked"),
        F.min("scheduled_event_start").alias("first_meeting"), F.max("scheduled_event_start").alias("last_meeting"))
    return overwrite_partitions(found.select(*schemas.EVENT_RANGES.columns), path, "dt")


def skip(events: DataFrame, ranges: DataFrame, kind: str, stretches: Iterable[tuple[T.Day, T.Day]], zone: str) -> DataFrame:
    """Leave out the partitions whose recorded range (`kind`: booked or meeting) meets none of the stretches of local
    days. The days left out go into the plan as literals, so these partitions are not opened."""
    first, last, meets = F.col(f"first_{kind}"), F.col(f"last_{kind}"), F.lit(False)
    for start, end in stretches:
        meets = meets | ((last >= T.midnight(start, zone)) & (first < T.midnight(T.next_day(end), zone)))
    closed = partitions_in(ranges.filter(~F.coalesce(meets, F.lit(False))), "dt")
    return events.filter(~F.col("dt").isin(closed)) if closed else events


def load(spark: SparkSession, path: str) -> DataFrame:
    """The recorded ranges; none before the first record, so that every partition is read."""
    return load_or_empty(spark, path, schemas.EVENT_RANGES)
