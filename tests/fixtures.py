"""Hand-made rows for the silver and gold tests."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

from bookloom import schemas

FACEBOOK_TYPE = "https://api.example.com/event_types/d639ecd3-8718-4068-955a-436b10d72c78"

# Nine days of ad spend in published sample files; the first file holds seven days, the second all.
CHANNELS = ("facebook_paid_ads", "youtube_paid_ads", "tiktok_paid_ads")
SPEND = {
    "2025-09-30": (423.73, 766.12, 457.4),
    "2025-10-01": (498.44, 797.09, 389.17),
    "2025-10-02": (411.39, 815.41, 245.61),
    "2025-10-03": (444.35, 801.36, 415.64),
    "2025-10-04": (440.94, 880.74, 303.24),
    "2025-10-05": (568.41, 414.68, 474.1),
    "2025-10-06": (510.03, 339.59, 415.68),
    "2025-10-07": (526.12, 823.8, 458.61),
    "2025-10-08": (592.07, 445.42, 520.84),
}
FIRST_TOTALS = {"facebook_paid_ads": 3297.29, "youtube_paid_ads": 4814.99, "tiktok_paid_ads": 2700.84}
SECOND_TOTALS = {"facebook_paid_ads": 4415.48, "youtube_paid_ads": 6084.21, "tiktok_paid_ads": 3680.29}


def spend_records(last_day: str) -> list[dict]:
    return [{"date": day, "channel": channel, "spend": amount}
            for day, amounts in SPEND.items() if day <= last_day for channel, amount in zip(CHANNELS, amounts)]


def write_spend_file(folder: Path, day: str, records: list[dict]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"spend_data_{day}.json").write_text(json.dumps(records, indent=2))


def webhook(booking="B1", meeting="S1", **changes) -> dict:
    """A complete webhook; `changes` replaces top-level, payload or scheduled-event fields by name."""
    event = {
        "uri": f"https://api.example.com/scheduled_events/{meeting}", "event_type": FACEBOOK_TYPE,
        "start_time": "2025-10-08T02:30:00Z", "end_time": "2025-10-08T03:00:00Z", "status": "active", "name": "Intro",
        "location": {"type": "zoom", "join_url": "https://z"},
        "event_memberships": [{"user_email": "a@x.com", "user_name": "A", "user": "u/1"},
                              {"user_email": "b@x.com", "user_name": "B", "user": "u/2"}],
    }
    payload = {
        "uri": f"https://api.example.com/scheduled_events/{meeting}/invitees/{booking}",
        "created_at": "2025-10-07T00:10:00.000000Z", "email": "Ann@Example.COM", "name": "Ann", "status": "active",
        "timezone": "America/New_York", "rescheduled": False, "cancel_url": "c", "reschedule_url": "r",
        "text_reminder_number": None, "scheduled_event": event,
        "tracking": {"utm_source": "fb", "utm_campaign": "cmp", "utm_medium": None, "utm_content": None,
                     "utm_term": None},
    }
    body = {"event": "invitee.created", "created_at": "2025-10-07T00:10:05Z", "created_by": "me", "payload": payload}
    for name, value in changes.items():
        target = next((part for part in (body, payload, event) if name in part), payload)
        if value is ...:
            del target[name]
        else:
            target[name] = value
    return body


def write_bronze(root: Path, day: str, bodies: list[dict | str], event: str = "invitee.created") -> None:
    folder = root / f"dt={day}" / event
    folder.mkdir(parents=True, exist_ok=True)
    start = len(list(folder.iterdir()))
    for n, body in enumerate(bodies, start):
        (folder / f"{n}.json").write_text(body if isinstance(body, str) else json.dumps(body))


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


EVENT_DDL = """booking_id string, scheduled_event_id string, channel string, utm_campaign string,
    booking_created_at timestamp, webhook_received_at timestamp, scheduled_event_start timestamp,
    organizer_email string, invitee_status string, dt string"""
EVENT_DEFAULTS = {
    "booking_id": "b1", "scheduled_event_id": "s1", "channel": "facebook_paid_ads", "utm_campaign": None,
    "booking_created_at": ts("2025-10-07 15:00:00"), "webhook_received_at": ts("2025-10-07 15:00:05"),
    "scheduled_event_start": ts("2025-10-08 15:00:00"), "organizer_email": "a@x.com", "invitee_status": "active",
    "dt": "2025-10-07"}


def events(spark, *rows: dict):
    return spark.createDataFrame([tuple({**EVENT_DEFAULTS, **r}.values()) for r in rows], EVENT_DDL)


def spend(spark, *rows: tuple):
    return spark.createDataFrame(list(rows), "dt string, channel string, spend double")


class Rows(list):
    """Rows that equal others in any order."""

    def __eq__(self, other):
        return sorted(self, key=repr) == sorted(other, key=repr)


def values(df) -> Rows:
    return Rows(sorted((tuple(r) for r in df.collect()), key=repr))


def envelopes(spark, *rows: tuple):
    return spark.createDataFrame(list(rows), schemas.ENVELOPE)
