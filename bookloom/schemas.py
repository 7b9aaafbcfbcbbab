"""Column layouts of every table, stated once: readers pin them, writers follow their order."""

from __future__ import annotations

from dataclasses import dataclass

# Schemas are DDL text, which readers, `from_json` and `createDataFrame` take as they are.

WEBHOOK = """
    event string, created_at string, created_by string,
    payload struct<
        uri: string, created_at: string, email: string, name: string, status: string, timezone: string,
        rescheduled: boolean, cancel_url: string, reschedule_url: string, text_reminder_number: string,
        scheduled_event: struct<
            uri: string, event_type: string, start_time: string, end_time: string, status: string, name: string,
            location: struct<type: string, join_url: string>,
            event_memberships: array<struct<user_email: string, user_name: string, user: string>>>,
        tracking: struct<utm_source: string, utm_campaign: string, utm_medium: string,
            utm_content: string, utm_term: string>>
"""

WEBHOOK_BY_DAY = WEBHOOK + ", dt string"
ENVELOPE = "body string, is_base64 boolean, received_at timestamp"
SPEND_RECORD = "date string, channel string, spend string"


@dataclass(frozen=True)
class TableLayout:
    """Flat columns in table order (partition columns last) as DDL text, and the partition columns."""

    name: str
    ddl: str
    by: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [column.split()[0] for column in self.ddl.split(",")]


BRONZE = TableLayout(
    "bronze_webhooks", "event_id string, body string, received_at timestamp, dt string, event string", ("dt", "event"))

REJECTS = TableLayout(
    "rejected_webhooks",
    "reject_id string, body string, is_base64 boolean, received_at timestamp, reason string, dt string", ("dt",))

# A second and any later delivery of an event that bronze holds.
REPEATS = TableLayout("repeated_webhooks", BRONZE.ddl, ("dt", "event"))

# Deliveries parsed once, on their way into the three tables above; `row` tells them apart.
STAGED = TableLayout(
    "staged_webhooks",
    "event_id string, body string, is_base64 boolean, received_at timestamp, reason string, event string, dt string, row bigint")

EVENTS = TableLayout(
    "booking_events",
    """booking_id string, scheduled_event_id string, event_type_url string, channel string,
       event_name string, webhook_event_name string,
       booking_created_at timestamp, booking_date date,
       scheduled_event_start timestamp, scheduled_event_end timestamp,
       invitee_email string, invitee_name string, invitee_status string, invitee_uri string,
       invitee_timezone string, rescheduled boolean, cancel_url string, reschedule_url string,
       text_reminder_number string, organizer_email string, organizer_name string, organizer_uri string,
       location_type string, location_url string,
       utm_source string, utm_campaign string, utm_medium string, utm_content string, utm_term string,
       webhook_received_at timestamp, webhook_received_by string, dt string""",
    ("dt",))

# Silver as a stream keeps it: the key of the delivery behind each row, and the micro-batch that wrote it.
LIVE_EVENTS = TableLayout(
    "booking_events_live",
    EVENTS.ddl.removesuffix(", dt string") + ", event string, event_id string, received_at timestamp, dt string, part string", ("dt", "part"))

EVENT_RANGES = TableLayout(
    "booking_event_ranges",
    "first_booked timestamp, last_booked timestamp, first_meeting timestamp, last_meeting timestamp, dt string", ("dt",))

SPEND = TableLayout("events_spend", "channel string, spend double, dt string", ("dt",))

DAILY_BOOKINGS = TableLayout(
    "daily_bookings_by_channel", "channel string, bookings bigint, booking_date date", ("booking_date",))
CPB = TableLayout(
    "cpb_by_channel", "channel string, total_spend double, total_bookings bigint, cpb double")
CUMULATIVE = TableLayout(
    "cumulative_bookings_by_source_daily_dt",
    "source string, bookings bigint, cumulative_bookings bigint, dt date", ("dt",))
CAMPAIGN_DAILY = TableLayout(
    "channel_campaign_daily_dt",
    "source string, campaign string, total_bookings bigint, total_spend double, cpb double, dt date", ("dt",))
TIME_FEATURES = TableLayout(
    "booking_time_features",
    "source string, booking_id string, hour_of_day int, dow_num int, dow_name string, booking_date_local date",
    ("booking_date_local",))
MEETING_FEATURES = TableLayout(
    "employee_meetings_features",
    "employee_id string, meeting_id string, meeting_date date, week_start_date date", ("week_start_date",))

# Sets of booking and meeting numbers, from which counts over any range follow (see operators.bitmaps).
SLOT_SETS = TableLayout(
    "booking_slot_sets",
    "source string, dow_num int, dow_name string, hour_of_day int, bucket bigint, bits binary, booking_date_local date",
    ("booking_date_local",))
MEETING_SETS = TableLayout(
    "employee_meeting_sets", "employee_id string, bucket bigint, bits binary, week_start_date date", ("week_start_date",))

GOLD = {t.name: t for t in (
    DAILY_BOOKINGS, CPB, CUMULATIVE, CAMPAIGN_DAILY, TIME_FEATURES, MEETING_FEATURES)}
