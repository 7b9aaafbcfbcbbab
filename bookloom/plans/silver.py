"""Silver tables: flat booking events and clean ad spend."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions import times as T
from bookloom.functions import webhooks as W
from bookloom.functions.numbers import as_money
from bookloom.operators.selection import dedup_latest
from bookloom.plans import ranges
from bookloom.sinks.tables import overwrite_partitions, replace_days, write_table
from bookloom.sources.spend import ALL, read_spend
from bookloom.sources.webhooks import read_bronze


# Meetings lie weeks after the day of receipt; in this order a week of meetings is found without reading every page.
SORT_EVENTS_BY = "scheduled_event_start"


def flatten_events(bronze: DataFrame, channel_map: dict[str, str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Parsed webhooks -> the silver event columns, in one projection; columns in `keep` go along."""
    payload = F.col("payload")
    meeting = payload["scheduled_event"]
    tracking = payload["tracking"]
    members = meeting["event_memberships"]
    columns = {
        "booking_id": W.id_in(payload["uri"], W.INVITEE_ID),
        "scheduled_event_id": W.id_in(meeting["uri"], W.SCHEDULED_EVENT_ID),
        "event_type_url": meeting["event_type"],
        "channel": W.channel_of_event_type(meeting["event_type"], channel_map),
        "event_name": meeting["name"],
        "webhook_event_name": F.col("event"),
        "booking_created_at": T.iso_timestamp(payload["created_at"]),
        "booking_date": T.written_date(meeting["start_time"]),
        "scheduled_event_start": T.iso_timestamp(meeting["start_time"]),
        "scheduled_event_end": T.iso_timestamp(meeting["end_time"]),
        "invitee_email": F.lower(payload["email"]),
        "invitee_uri": payload["uri"],
        "organizer_email": W.first_member(members, "user_email"),
        "organizer_name": W.first_member(members, "user_name"),
        "organizer_uri": W.first_member(members, "user"),
        "location_type": meeting["location"]["type"],
        "location_url": meeting["location"]["join_url"],
        "webhook_received_at": T.iso_timestamp(F.col("created_at")),
        "webhook_received_by": F.col("created_by"),
        "dt": F.col("dt"),
    }
    columns.update({f"invitee_{f}": payload[f] for f in ("name", "status", "timezone")})
    columns.update({f: payload[f] for f in ("rescheduled", "cancel_url", "reschedule_url", "text_reminder_number")})
    columns.update({f"utm_{f}": tracking[f"utm_{f}"] for f in ("source", "campaign", "medium", "content", "term")})
    return bronze.select(*[columns[name].alias(name) for name in schemas.EVENTS.columns], *keep)


def normalize_spend(raw: DataFrame) -> DataFrame:
    """Source records -> (dt, channel, spend) with a readable amount; keeps `source_file`, drops rows without keys."""
    typed = raw.select(
        F.col("date").cast("string").alias("dt"),
        F.col("channel").cast("string").alias("channel"),
        as_money(F.col("spend")).alias("spend"),
        "source_file",
    )
    return typed.filter(F.col("dt").isNotNull() & F.col("channel").isNotNull())


def clean_spend(raw: DataFrame) -> DataFrame:
    """One amount per day and channel: the latest file wins, within it the highest amount."""
    latest = dedup_latest(
        normalize_spend(raw), ["dt", "channel"], [F.desc("source_file"), F.desc_nulls_last("spend")])
    return latest.select("dt", "channel", "spend")


# Jobs

def rebuild_events(
    spark: SparkSession, bronze_root: str, silver_path: str, start: T.Day, end: T.Day,
    channel_map: dict[str, str] | None = None, mode: str = "overwrite", compact: bool = True, ranges_path: str | None = None,
) -> None:
    """Backfill or daily run over stored webhook JSON: all days in one job.

    `overwrite` replaces exactly the days from `start` to `end`; `append` adds rows and doubles them on a second run.
    `compact` spends a shuffle on well-sized output files; one event per input file makes that worth while. With
    `ranges_path` the time ranges of the written days are recorded there.
    """
    events = flatten_events(read_bronze(spark, bronze_root, start, end), channel_map)
    scope = T.in_days(F.col("dt"), start, end)
    if ranges_path is not None:
        ranges.forget(spark, ranges_path, scope)
    if mode == "append":
        write_table(events, silver_path, schemas.EVENTS.by, rebalance=compact, sort_by=SORT_EVENTS_BY)
    else:
        overwrite_partitions(events, silver_path, "dt", scope, rebalance=compact, sort_by=SORT_EVENTS_BY)
    if ranges_path is not None:
        ranges.record(spark, silver_path, ranges_path, scope)


def rebuild_yesterday(
    spark: SparkSession, bronze_root: str, silver_path: str, as_of: T.Day, channel_map: dict[str, str] | None = None,
) -> None:
    day = T.yesterday(as_of)
    rebuild_events(spark, bronze_root, silver_path, day, day, channel_map)


def build_spend(
    spark: SparkSession, prefix: str, silver_path: str, day: T.Day = ALL, days: Iterable[T.Day] | None = None,
) -> list[str]:
    """Load spend files and replace every day they hold (or only `days`); returns the replaced days.

    Without a valid row nothing is written.
    """
    records = read_spend(spark, prefix, day)
    if normalize_spend(records).isEmpty():
        return []
    return replace_days(clean_spend(records), silver_path, "dt", days)
