import datetime as dt

import pytest
from pyspark.sql import functions as F

from bookloom.plans import gold
from fixtures import events, spend, ts, values

FB, YT = "facebook_paid_ads", "youtube_paid_ads"
DAY = dt.date(2025, 10, 7)


def test_channel_presence(spark):
    df = events(spark, {"channel": None}, {"channel": ""}, {"channel": "   "}, {"channel": "\t"}, {"channel": " x "})
    assert values(gold.daily_bookings(df).select("channel")) == [("\t",), (" x ",)]


def test_daily_bookings(spark):
    df = events(spark, {}, {}, {"booking_id": ""}, {"booking_id": None}, {"dt": "2025-10-08"})
    assert values(gold.daily_bookings(df)) == [(FB, 1, dt.date(2025, 10, 8)), (FB, 2, DAY)]
    assert values(gold.daily_bookings(df, distinct=False)) == [(FB, 1, dt.date(2025, 10, 8)), (FB, 3, DAY)]


def test_cpb_needs_both_sides(spark):
    df = events(spark, {}, {"booking_id": "b2"}, {"booking_id": "b3"}, {"channel": "no spend"})
    money = spend(spark, ("2025-10-01", FB, 5.0), ("2025-10-02", FB, 5.0), ("2025-10-02", "no bookings", 1.0))
    assert values(gold.cpb_by_channel(df, money)) == [(FB, 10.0, 3, 3.33)]


def test_cpb_without_booking_ids(spark):
    assert values(gold.cpb_by_channel(events(spark, {"booking_id": None}), spend(spark, ("2025-10-01", FB, 5.0)))) == [
        (FB, 5.0, 0, None)]


def test_cumulative_has_no_rows_for_days_without_bookings(spark):
    df = events(spark, {"dt": "2025-10-01"}, {"dt": "2025-10-04"}, {"dt": "2025-10-04", "booking_id": "b2"},
                {"dt": "2025-10-02", "channel": YT})
    assert values(gold.cumulative_bookings(df)) == [
        (FB, 1, 1, dt.date(2025, 10, 1)), (FB, 2, 3, dt.date(2025, 10, 4)), (YT, 1, 1, dt.date(2025, 10, 2))]


def campaign_rows(spark):
    return events(
        spark, {"utm_campaign": " a "}, {"utm_campaign": "a", "booking_id": "b2"}, {"utm_campaign": "", "booking_id": "b3"},
        {"utm_campaign": None, "booking_id": "b3"}, {"utm_campaign": "b", "booking_id": "b1"}, {"channel": YT})


def test_campaign_shares(spark):
    money = spend(spark, ("2025-10-07", FB, 30.0), ("2025-10-07", "other", 1.0))
    assert values(gold.campaign_daily(campaign_rows(spark), money)) == [
        (FB, "(none)", 1, 10.0, 10.0, DAY), (FB, "a", 2, 20.0, 10.0, DAY), (FB, "b", 1, 10.0, 10.0, DAY),
        (YT, "(none)", 1, 0.0, 0.0, DAY)]
    assert values(gold.campaign_daily(campaign_rows(spark), money, "integer").select("campaign", "total_spend")) == [
        ("(none)", 0.0), ("(none)", 0.0), ("a", 0.0), ("b", 0.0)]
    one = events(spark, {"utm_campaign": "a"})
    assert gold.campaign_daily(one, money, "integer").first().total_spend == 30.0
    with pytest.raises(ValueError):
        gold.campaign_daily(one, money, "other")


def test_shares_add_up_when_bookings_have_one_campaign(spark):
    df = events(spark, *[{"booking_id": f"b{n}", "utm_campaign": f"c{n % 7}"} for n in range(50)])
    total = gold.campaign_daily(df, spend(spark, ("2025-10-07", FB, 123.45))).agg(F.sum("total_spend")).first()[0]
    assert total == pytest.approx(123.45)


def test_spend_text_that_is_no_number(spark):
    text = spark.createDataFrame([("2025-10-07", FB, "x"), ("2025-10-07", FB, "4")], "dt string, channel string, spend string")
    assert gold.campaign_daily(events(spark, {}), text).first().total_spend == 4.0


def test_time_features_near_midnight_and_daylight_saving(spark):
    df = events(
        spark,
        {"booking_id": "before", "booking_created_at": ts("2025-10-07 03:59:59")},
        {"booking_id": "after", "booking_created_at": ts("2025-10-07 04:00:00")},
        {"booking_id": "summer", "booking_created_at": ts("2025-11-02 05:30:00")},
        {"booking_id": "winter", "booking_created_at": ts("2025-11-02 06:30:00")},
        {"booking_id": "fallback", "booking_created_at": None},
        {"booking_id": "never", "booking_created_at": None, "webhook_received_at": None},
        {"booking_id": "blank", "channel": " "})
    rows = {r.booking_id: tuple(r)[2:] for r in gold.time_features(df).collect()}
    assert rows == {
        "before": (23, 1, "Mon", dt.date(2025, 10, 6)), "after": (0, 2, "Tue", dt.date(2025, 10, 7)),
        "summer": (1, 7, "Sun", dt.date(2025, 11, 2)), "winter": (1, 7, "Sun", dt.date(2025, 11, 2)),
        "fallback": (11, 2, "Tue", dt.date(2025, 10, 7))}


def test_meeting_features(spark):
    df = events(
        spark, {"invitee_status": "canceled"}, {"invitee_status": "cancelled"}, {"invitee_status": "Canceled"},
        {"invitee_status": None, "scheduled_event_start": ts("2025-10-13 03:00:00")}, {"organizer_email": "  "},
        {"organizer_email": None}, {"scheduled_event_start": None, "scheduled_event_id": "s9"})
    assert values(gold.meeting_features(df)) == [
        ("a@x.com", "s1", dt.date(2025, 10, 12), dt.date(2025, 10, 6)),
        ("a@x.com", "s1", dt.date(2025, 10, 8), dt.date(2025, 10, 6)), ("a@x.com", "s9", None, None)]


def test_local_time_refuses_another_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError):
            gold.time_features(events(spark, {}))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
