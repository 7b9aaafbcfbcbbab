import datetime as dt

import pytest
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions.webhooks import map_channel
from bookloom.operators.lookup import map_channel_table
from bookloom.plans import silver
from bookloom.sources.spend import read_spend
from bookloom.sources.tables import load_table
from bookloom.sources.webhooks import read_bronze
from fixtures import (
    FACEBOOK_TYPE, FIRST_TOTALS, SECOND_TOTALS, SPEND, spend_records, values, webhook, write_bronze, write_spend_file)


def flat(spark, tmp_path, *bodies):
    write_bronze(tmp_path, "2025-10-07", list(bodies))
    return silver.flatten_events(read_bronze(spark, str(tmp_path)))


def test_columns_and_values(spark, tmp_path):
    df = flat(spark, tmp_path, webhook())
    assert df.columns == schemas.EVENTS.columns and len(df.columns) == 32
    row = df.first()
    assert (row.booking_id, row.scheduled_event_id, row.channel) == ("B1", "S1", "facebook_paid_ads")
    assert row.booking_created_at == dt.datetime(2025, 10, 7, 0, 10)
    assert row.booking_date == dt.date(2025, 10, 8)
    assert (row.invitee_email, row.organizer_email, row.organizer_name, row.organizer_uri) == (
        "ann@example.com", "a@x.com", "A", "u/1")
    assert (row.location_type, row.rescheduled, row.utm_source, row.utm_term) == ("zoom", False, "fb", None)
    assert (row.webhook_event_name, row.webhook_received_by, row.dt) == ("invitee.created", "me", "2025-10-07")


@pytest.mark.parametrize("members", [[], None, ...])
def test_no_organizer(spark, tmp_path, members):
    row = flat(spark, tmp_path, webhook(event_memberships=members)).first()
    assert (row.organizer_email, row.organizer_name, row.organizer_uri) == (None, None, None)


@pytest.mark.parametrize("uri, expected", [
    ("https://x/scheduled_events/S/invitees/B9", "B9"), ("https://x/invitees/B9?q=1", ""), ("https://x", "")])
def test_booking_id(spark, tmp_path, uri, expected):
    body = webhook()
    body["payload"]["uri"] = uri
    assert flat(spark, tmp_path, body).first().booking_id == expected


def test_bad_times_and_unknown_type(spark, tmp_path):
    row = flat(spark, tmp_path, webhook(
        start_time="soon", created_at="2025-10-07T01:00:00+02:00", event_type="https://x/event_types/none")).first()
    assert (row.scheduled_event_start, row.booking_date, row.channel) == (None, None, None)
    assert row.webhook_received_at == dt.datetime(2025, 10, 6, 23, 0)


def test_raw_and_broken_files_give_empty_events(spark, tmp_path):
    df = flat(spark, tmp_path, {"raw": "junk"}, "{broken", webhook())
    assert values(df.select("booking_id", "dt")) == [
        ("B1", "2025-10-07"), (None, "2025-10-07"), (None, "2025-10-07")]


def test_own_channel_mapping(spark, tmp_path):
    write_bronze(tmp_path, "2025-10-07", [webhook()])
    bronze = read_bronze(spark, str(tmp_path))
    assert silver.flatten_events(bronze, {FACEBOOK_TYPE: "mine"}).first().channel == "mine"
    assert silver.flatten_events(bronze, {}).first().channel is None
    assert bronze.select(map_channel(F.lit("a"), {"a": "b"})).first()[0] == "b"
    mapping = spark.createDataFrame([(FACEBOOK_TYPE, "mine"), (FACEBOOK_TYPE, "mine")], "event_type_url string, channel string")
    assert [r.channel for r in map_channel_table(silver.flatten_events(bronze), mapping).collect()] == ["mine"]


def test_read_bronze_days(spark, tmp_path):
    for day in ("2025-10-06", "2025-10-07", "2025-10-09"):
        write_bronze(tmp_path, day, [webhook(booking=day)])
    write_bronze(tmp_path, "2025-10-07", [webhook(booking="c")], event="invitee.canceled")
    days = lambda *bounds: [r.dt for r in read_bronze(spark, str(tmp_path), *bounds).orderBy("dt").collect()]
    assert days("2025-10-07", "2025-10-08") == ["2025-10-07", "2025-10-07"]
    assert days("2025-10-07") == ["2025-10-07", "2025-10-07", "2025-10-09"]
    assert days("2025-11-01", "2025-11-02") == []
    assert days() == ["2025-10-06", "2025-10-07", "2025-10-07", "2025-10-09"]
    files = read_bronze(spark, str(tmp_path), "2025-10-07", "2025-10-07").inputFiles()
    assert len(files) == 2


def test_rebuild_events(spark, tmp_path):
    root, out = tmp_path / "bronze", str(tmp_path / "silver")
    write_bronze(root, "2025-10-06", [webhook(booking="x")])
    write_bronze(root, "2025-10-07", [webhook(booking="y")])
    run = lambda **kw: silver.rebuild_events(spark, str(root), out, "2025-10-06", "2025-10-07", **kw)
    read = lambda: values(load_table(spark, out, schemas.EVENTS).select("booking_id", "dt"))
    run()
    run()
    assert read() == [("x", "2025-10-06"), ("y", "2025-10-07")]
    write_bronze(root, "2025-10-07", [webhook(booking="late")])
    silver.rebuild_yesterday(spark, str(root), out, "2025-10-08")
    assert read() == [("late", "2025-10-07"), ("x", "2025-10-06"), ("y", "2025-10-07")]
    run(mode="append")
    assert len(read()) == 6
    # A day whose bronze has gone is emptied, other days stay.
    silver.rebuild_events(spark, str(tmp_path / "nothing"), out, "2025-10-07", "2025-10-07")
    assert read() == [("x", "2025-10-06"), ("x", "2025-10-06")]


def test_silver_files_are_ordered_by_meeting(spark, tmp_path):
    root, out = tmp_path / "bronze", str(tmp_path / "silver")
    starts = [f"2025-11-{d:02d}T10:00:00Z" for d in (9, 3, 27, 1, 15)]
    write_bronze(root, "2025-10-06", [webhook(booking=s, start_time=s) for s in starts])
    silver.rebuild_events(spark, str(root), out, "2025-10-06", "2025-10-06")
    [file] = spark.read.parquet(out).inputFiles()
    assert [r.booking_id for r in spark.read.parquet(file).coalesce(1).collect()] == sorted(starts)


def test_spend_goldens(spark, tmp_path):
    files = tmp_path / "in"
    write_spend_file(files, "2025-10-06", spend_records("2025-10-06"))
    write_spend_file(files, "2025-10-08", spend_records("2025-10-08"))

    def totals(df):
        return {r.channel: round(r.total, 2) for r in df.groupBy("channel").agg(F.sum("spend").alias("total")).collect()}

    assert totals(silver.clean_spend(read_spend(spark, str(files), "2025-10-06"))) == FIRST_TOTALS
    everything = read_spend(spark, str(files))
    assert everything.count() == 48
    clean = silver.clean_spend(everything)
    assert clean.count() == 27 and totals(clean) == SECOND_TOTALS
    assert clean.columns == ["dt", "channel", "spend"]


def test_spend_edges(spark, tmp_path):
    write_spend_file(tmp_path, "2025-10-01", [
        {"date": "2025-10-01", "channel": "a", "spend": 1.5}, {"date": "2025-10-01", "channel": "b", "spend": 9},
        {"date": None, "channel": "a", "spend": 1}, {"date": "2025-10-01", "channel": None, "spend": 1},
        {"channel": "a", "spend": 1}])
    write_spend_file(tmp_path, "2025-10-02", [
        {"date": "2025-10-01", "channel": "a", "spend": 2}, {"date": "2025-10-01", "channel": "a", "spend": "3.25"},
        {"date": "2025-10-02", "channel": "a", "spend": "n/a"}])
    assert values(silver.clean_spend(read_spend(spark, str(tmp_path)))) == [
        ("2025-10-01", "a", 3.25), ("2025-10-01", "b", 9.0), ("2025-10-02", "a", None)]


def test_build_spend(spark, tmp_path):
    files, out = tmp_path / "in", str(tmp_path / "out")
    write_spend_file(files, "2025-10-06", spend_records("2025-10-06"))
    assert len(silver.build_spend(spark, str(files), out, "2025-10-06")) == 7
    later = spend_records("2025-10-08")
    later[0]["spend"] = 1.0
    write_spend_file(files, "2025-10-08", later)
    assert silver.build_spend(spark, str(files), out, "2025-10-08") == sorted(SPEND)
    table = load_table(spark, out, schemas.SPEND)
    assert table.count() == 27
    assert table.filter("dt = '2025-09-30' and channel = 'facebook_paid_ads'").first().spend == 1.0
    write_spend_file(files, "2025-10-09", [{"date": None, "channel": "x", "spend": 1}])
    assert silver.build_spend(spark, str(files), out, "2025-10-09") == []
    assert load_table(spark, out, schemas.SPEND).count() == 27
