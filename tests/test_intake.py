import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from bookloom.plans.intake import ingest_webhooks
from fixtures import envelopes, ts, values, webhook

AT = ts("2025-10-07 00:10:00")
URI = webhook()["payload"]["uri"]


def b64(text):
    return base64.b64encode(text.encode() if isinstance(text, str) else text).decode()


def stored(spark, body, is_base64=False):
    bronze, rejects = ingest_webhooks(envelopes(spark, (body, is_base64, AT)))
    return [r.asDict() for r in bronze.collect()], [r.asDict() for r in rejects.collect()]


def test_known_event(spark):
    body = json.dumps(webhook())
    [row], rejects = stored(spark, body)
    assert not rejects
    assert (row["dt"], row["event"], row["body"]) == ("2025-10-07", "invitee.created", body)
    assert row["event_id"] == hashlib.sha256(URI.encode()).hexdigest()


def test_base64_gives_the_same_row(spark):
    body = json.dumps(webhook(name="Zoë"), ensure_ascii=False)
    assert stored(spark, b64(body), True) == stored(spark, body)


@pytest.mark.parametrize("changes, uri", [
    ({"uri": None}, "https://api.example.com/scheduled_events/S1"),
    ({"uri": ""}, "https://api.example.com/scheduled_events/S1"),
])
def test_id_falls_back_to_the_meeting(spark, changes, uri):
    body = webhook()
    body["payload"].update(changes)
    [row], _ = stored(spark, json.dumps(body))
    assert row["event_id"] == hashlib.sha256(uri.encode()).hexdigest()


@pytest.mark.parametrize("payload", [{}, {"uri": 5}, "text", None, {"uri": "", "scheduled_event": None}])
def test_id_is_random_without_uri(spark, payload):
    bronze, _ = ingest_webhooks(envelopes(spark, *[(json.dumps({"payload": payload}), False, AT)] * 2))
    ids = [r.event_id for r in bronze.collect()]
    assert len(set(ids)) == 2 and all(len(i) == 36 for i in ids)


@pytest.mark.parametrize("body, is_base64", [(None, None), ("", False), ("", True), ("e30=", True), ("!!!!", True)])
def test_empty_body_is_an_empty_object(spark, body, is_base64):
    [row], rejects = stored(spark, body, is_base64)
    assert (row["event"], row["body"], rejects) == ("unknown_event", "{}", [])


@pytest.mark.parametrize("body", [
    "junk", '{"a": 1} junk', '{"a": 1}{"b": 2}', '{"a": 1},{"b": 2}', "{'a': 1}", '"open', "   ", '{"a": 01}',
    '{"event":"x","payload":{"uri":"u"}}], [1', "1], [2"])
def test_no_json_is_kept_as_raw(spark, body):
    [row], rejects = stored(spark, body)
    assert json.loads(row["body"]) == {"raw": body} and row["event"] == "unknown_event" and not rejects


def test_bytes_that_are_no_text_are_dropped_from_raw(spark):
    [row], _ = stored(spark, b64(b'{"a": "\xff"}'), True)
    assert json.loads(row["body"]) == {"raw": '{"a": ""}'}


@pytest.mark.parametrize("body, is_base64, reason", [
    ("[1]", False, "not_an_object"), ("null", False, "not_an_object"), ('"x"', False, "not_an_object"),
    ("12", False, "not_an_object"), (b64("[]"), True, "not_an_object"), ("abc", True, "bad_base64")])
def test_rejects(spark, body, is_base64, reason):
    rows, [reject] = stored(spark, body, is_base64)
    assert not rows and (reject["reason"], reject["body"], reject["dt"]) == (reason, body, "2025-10-07")


def test_last_of_repeated_keys_wins(spark):
    [row], _ = stored(spark, '{"event": "a", "event": "b"}')
    assert row["event"] == "b"


def test_repeats_on_one_day_leave_the_last_copy(spark):
    old, new = json.dumps(webhook(name="old")), json.dumps(webhook(name="new"))
    bronze, _ = ingest_webhooks(envelopes(
        spark, (new, False, ts("2025-10-07 09:00:00")), (b64(old), True, ts("2025-10-07 08:00:00")),
        (old, False, ts("2025-10-08 00:00:30"))))
    assert values(bronze.select("dt", F.get_json_object("body", "$.payload.name"))) == [
        ("2025-10-07", "new"), ("2025-10-08", "old")]


def test_the_event_is_part_of_the_key(spark):
    made, cancelled = json.dumps(webhook()), json.dumps(webhook(event="invitee.canceled"))
    bronze, _ = ingest_webhooks(envelopes(spark, (made, False, AT), (cancelled, False, AT)))
    assert bronze.count() == 2
