"""The six reporting tables. Pure functions of the silver frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions.numbers import divide, round_half_up, safe_ratio, sum_money
from bookloom.functions.text import NO_CAMPAIGN, blank_to_null, default, present
from bookloom.functions.times import NEW_YORK, iso_weekday, local_time, week_start, weekday_name
from bookloom.operators.aggregates import count_bookings
from bookloom.operators.running import running_sum

# Spellings of a cancelled booking, compared as written.
CANCELLED = ("canceled", "cancelled")


def with_channel(rows: DataFrame) -> DataFrame:
    """Rows that name a channel. The value itself is not trimmed."""
    return rows.filter(present(F.col("channel")))


def daily_bookings(events: DataFrame, distinct: bool = True) -> DataFrame:
    """Bookings per channel and day of receipt; `distinct=False` counts rows."""
    counted = count_bookings(with_channel(events), ["channel", F.to_date("dt").alias("booking_date")], distinct)
    return counted.select(*schemas.DAILY_BOOKINGS.columns)


def cpb_by_channel(events: DataFrame, spend: DataFrame) -> DataFrame:
    """Spend, bookings and cost per booking for channels that have both."""
    return cost_per_booking(count_bookings(with_channel(events), ["channel"]), spend)


def cost_per_booking(booked: DataFrame, spend: DataFrame) -> DataFrame:
    """`booked` (channel, bookings) with the channel's whole spend."""
    spent = with_channel(spend).groupBy("channel").agg(sum_money(F.col("spend"), strict=True).alias("total_spend"))
    return booked.join(spent, "channel").select(
        "channel",
        "total_spend",
        F.col("bookings").alias("total_bookings"),
        safe_ratio(F.col("total_spend"), F.col("bookings")).alias("cpb"),
    )


def daily_by_source(events: DataFrame) -> DataFrame:
    return count_bookings(with_channel(events), [F.col("channel").alias("source"), F.to_date("dt").alias("dt")])


def cumulative_bookings(events: DataFrame, carry: DataFrame | None = None) -> DataFrame:
    """Bookings per source and day with their running total; days without bookings have no row.

    `carry` (source, value) is the total reached before the first day of `events`.
    """
    total = running_sum(daily_by_source(events), "source", "dt", "bookings", "cumulative_bookings", carry)
    return total.select(*schemas.CUMULATIVE.columns)


def campaign_daily(events: DataFrame, spend: DataFrame, mode: str = "proportional") -> DataFrame:
    """Channel spend of a day shared out to campaigns by their part of the channel's bookings.

    A booking with several campaigns counts once for each of them and once for the channel. `mode="integer"`
    truncates the part to 0 or more whole times, as a division of two bigints does.

    The rows are made distinct once, and both counts are taken from these: one scan and one shuffle of the ids. The
    day-and-channel side is small and is broadcast by its measured size, so the campaign side is not shuffled again.
    """
    if mode not in ("proportional", "integer"):
        raise ValueError(f"unknown mode {mode!r}")
    booked = with_channel(events).select(
        F.to_date("dt").alias("dt"),
        F.col("channel").alias("source"),
        blank_to_null(F.col("utm_campaign")).alias("campaign"),
        "booking_id",
    ).distinct()
    per_campaign = count_bookings(booked, ["dt", "source", "campaign"], distinct=False)
    per_channel = count_bookings(booked, ["dt", "source"]).withColumnRenamed("bookings", "channel_bookings")
    spent = with_channel(spend).groupBy(F.to_date("dt").alias("dt"), F.col("channel").alias("source")).agg(
        sum_money(F.col("spend")).alias("channel_spend"))
    share = divide(F.col("bookings"), F.col("channel_bookings"), integer=mode == "integer")
    allocated = per_campaign.join(per_channel.join(spent, ["dt", "source"], "left"), ["dt", "source"]).select(
        "source",
        default(F.col("campaign"), NO_CAMPAIGN).alias("campaign"),
        F.col("bookings").alias("total_bookings"),
        F.when(F.col("channel_bookings") > 0, default(F.col("channel_spend"), 0.0) * share)
        .otherwise(F.lit(0.0)).alias("total_spend"),
        "dt",
    )
    cpb = F.when(F.col("total_bookings") > 0, F.col("total_spend") / F.col("total_bookings"))
    return allocated.withColumn("cpb", round_half_up(cpb)).select(*schemas.CAMPAIGN_DAILY.columns)


def booked_at() -> Column:
    """When a booking was made, else when its webhook arrived."""
    return F.coalesce("booking_created_at", "webhook_received_at")


def time_features(events: DataFrame, zone: str = NEW_YORK) -> DataFrame:
    """Local hour, weekday and date of every booking row."""
    local = with_channel(events).select(
        F.col("channel").alias("source"), "booking_id", local_time(booked_at(), zone).alias("at"))
    return local.filter(F.col("at").isNotNull()).select(
        "source",
        "booking_id",
        F.hour("at").alias("hour_of_day"),
        iso_weekday(F.col("at")).alias("dow_num"),
        weekday_name(F.col("at")).alias("dow_name"),
        F.to_date("at").alias("booking_date_local"),
    )


def not_cancelled(status: Column) -> Column:
    """Any status but the two spellings of a cancellation; a missing status counts as not cancelled."""
    return ~default(status, "").isin(*CANCELLED)


def meeting_features(events: DataFrame, zone: str = NEW_YORK) -> DataFrame:
    """One row per invitee of a meeting that was not cancelled, with the local date and week of the meeting."""
    starts = local_time(F.col("scheduled_event_start"), zone)
    kept = events.filter(present(F.col("organizer_email")) & not_cancelled(F.col("invitee_status")))
    return kept.select(
        F.col("organizer_email").alias("employee_id"),
        F.col("scheduled_event_id").alias("meeting_id"),
        F.to_date(starts).alias("meeting_date"),
        week_start(starts).alias("week_start_date"),
    )
