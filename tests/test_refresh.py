"""Increments: day by day equals the full build, and running twice changes nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions import times as T
from bookloom.plans import gold, ranges, refresh
from bookloom.queries import adapters as A
from bookloom.sources.tables import load_table
from fixtures import events, ts, values

SF = "/root/testdata/sf0.001"
DAYS = T.date_range("2024-01-05", "2024-01-08")


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """A few days of bookings and spend as stored silver tables."""
    root = tmp_path_factory.mktemp("silver")
    keep = T.in_days(F.col("dt"), DAYS[0], DAYS[-1])
    bookings = A.bookings(spark, SF).filter(keep)
    bookings.write.partitionBy("dt").parquet(f"{root}/events")
    A.spend(spark, SF).filter(keep).write.partitionBy("dt").parquet(f"{root}/spend")
    return (spark.read.schema(bookings.schema).parquet(f"{root}/events"),
            load_table(spark, f"{root}/spend", schemas.SPEND))


FULL = {
    schemas.DAILY_BOOKINGS: lambda e, s: gold.daily_bookings(e),
    schemas.CPB: gold.cpb_by_channel,
    schemas.CUMULATIVE: lambda e, s: gold.cumulative_bookings(e),
    schemas.CAMPAIGN_DAILY: gold.campaign_daily,
}


@pytest.mark.parametrize("layout", FULL, ids=lambda t: t.name)
def test_day_by_day_equals_full_build(spark, silver, tmp_path, layout):
    path = str(tmp_path / layout.name)
    for day in (*DAYS, DAYS[1]):
        refresh.refresh(layout.name, *silver, path, as_of=T.as_day(day) + dt.timedelta(days=1))
    stored = load_table(spark, path, layout)
    assert values(stored) == values(FULL[layout](*silver).select(*layout.columns))


def test_time_features_by_day_of_receipt_equals_full_build(spark, silver, tmp_path):
    path = str(tmp_path / "t")
    for day in (*DAYS, DAYS[1]):
        refresh.refresh_time_features(silver[0], path, day, day, by="ingest_day")
    stored = load_table(spark, path, schemas.TIME_FEATURES)
    assert values(stored) == values(gold.time_features(silver[0]))


def test_a_booking_received_late_survives_a_refresh(spark, silver, tmp_path):
    late = silver[0].limit(1).withColumns({
        "booking_created_at": F.lit("2024-01-06 18:00:00").cast("timestamp"), "channel": F.lit("late"), "dt": F.lit("2024-03-01")})
    events = silver[0].unionByName(late.select(*silver[0].columns))
    path = str(tmp_path / "t")
    refresh.refresh_time_features(events, path, "2024-01-06", "2024-01-06")
    stored = load_table(spark, path, schemas.TIME_FEATURES)
    assert stored.filter("source = 'late'").count() == 1
    assert values(stored) == values(gold.time_features(events).filter("booking_date_local = date '2024-01-06'"))


def test_recorded_ranges_choose_partitions_without_loss(spark, silver, tmp_path):
    late = silver[0].limit(1).withColumns({
        "booking_created_at": F.lit("2024-01-06 18:00:00").cast("timestamp"), "channel": F.lit("late"), "dt": F.lit("2024-03-01")})
    stored, known = str(tmp_path / "events"), str(tmp_path / "ranges")
    silver[0].unionByName(late.select(*silver[0].columns)).write.partitionBy("dt").parquet(stored)
    everything = F.lit(True)
    ranges.record(spark, stored, known, everything)
    rows = load_table(spark, stored, schemas.EVENTS)
    chosen = refresh.time_features_on_days(rows, ["2024-01-06"], ranges=ranges.load(spark, known))
    assert values(chosen) == values(gold.time_features(rows).filter("booking_date_local = date '2024-01-06'"))
    assert "late" in {r.source for r in chosen.collect()}
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [NOT dt" in plan and "2024-01-08" in plan and "2024-03-01" not in plan
    ranges.forget(spark, known, everything)
    unknown = refresh.time_features_on_days(rows, ["2024-01-06"], ranges=ranges.load(spark, known))
    assert "PartitionFilters: []" in unknown._jdf.queryExecution().executedPlan().toString()
    weeks = refresh.meeting_features_in_weeks(rows, ["2024-01-01", "2024-01-29"], ranges=ranges.load(spark, known))
    assert values(weeks) == values(gold.meeting_features(rows).filter("week_start_date = date '2024-01-01'"))


def test_a_range_in_one_run(spark, silver, tmp_path):
    for layout in (schemas.DAILY_BOOKINGS, schemas.CAMPAIGN_DAILY):
        path = str(tmp_path / layout.name)
        refresh.refresh_range(layout.name, *silver, path, DAYS[0], DAYS[-1])
        assert values(load_table(spark, path, layout)) == values(FULL[layout](*silver).select(*layout.columns))
    path = str(tmp_path / "m")
    refresh.refresh_range(schemas.MEETING_FEATURES.name, *silver, path, DAYS[0], "2024-01-10")
    assert values(load_table(spark, path, schemas.MEETING_FEATURES)) == values(gold.meeting_features(silver[0]))


def test_stretches():
    days = [dt.date(2024, 1, d) for d in (5, 6, 9, 1)]
    assert T.stretches(days) == [(days[3], days[3]), (days[0], days[1]), (days[2], days[2])]


def test_full_build_replaces_all_days_in_either_overwrite_mode(spark, silver, tmp_path):
    for mode in ("static", "dynamic"):
        path = str(tmp_path / mode)
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        try:
            rows = gold.daily_bookings(silver[0])
            refresh.build(path, schemas.DAILY_BOOKINGS, rows)
            few = rows.filter("booking_date < date '2024-01-10'")
            refresh.build(path, schemas.DAILY_BOOKINGS, few)
        finally:
            spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
        assert values(load_table(spark, path, schemas.DAILY_BOOKINGS)) == values(few.select(*schemas.DAILY_BOOKINGS.columns))


def test_time_features_by_local_day(spark, silver, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        refresh.refresh_time_features(silver[0], path, "2024-01-06", "2024-01-06")
    wanted = gold.time_features(silver[0]).filter("booking_date_local = date '2024-01-06'")
    assert values(load_table(spark, path, schemas.TIME_FEATURES)) == values(wanted)
    refresh.refresh(schemas.TIME_FEATURES.name, *silver, path, as_of="2024-01-07", mode="append")
    assert load_table(spark, path, schemas.TIME_FEATURES).count() == 2 * wanted.count()


def test_meeting_features_by_day_and_week(spark, silver, tmp_path):
    path, full = str(tmp_path / "m"), gold.meeting_features(silver[0])
    for day in T.date_range("2024-01-05", "2024-01-10"):
        refresh.refresh(schemas.MEETING_FEATURES.name, *silver, path, as_of=day)
    refresh.refresh_meeting_features(silver[0], path, weeks=["2024-01-01", "2024-01-08"])
    assert values(load_table(spark, path, schemas.MEETING_FEATURES)) == values(full)
    one = str(tmp_path / "one")
    refresh.refresh_meeting_features(silver[0], one, day="2024-01-08", mode="append")
    assert values(load_table(spark, one, schemas.MEETING_FEATURES)) == values(
        full.filter("meeting_date = date '2024-01-08'"))
    with pytest.raises(ValueError):
        refresh.refresh_meeting_features(silver[0], one)


def test_late_booking_repairs_later_totals(spark, tmp_path):
    path = str(tmp_path / "c")
    first = events(spark, {"dt": "2025-10-01"}, {"dt": "2025-10-03", "booking_id": "b2"})
    refresh.build(path, schemas.CUMULATIVE, gold.cumulative_bookings(first))
    late = first.unionByName(events(spark, {"dt": "2025-10-02", "booking_id": "late"}))
    refresh.refresh_cumulative(late, path, "2025-10-02")
    assert values(load_table(spark, path, schemas.CUMULATIVE)) == values(gold.cumulative_bookings(late))


def test_appended_day_leaves_later_totals(spark, tmp_path):
    path = str(tmp_path / "c")
    first = events(spark, {"dt": "2025-10-01"}, {"dt": "2025-10-03", "booking_id": "b2"})
    refresh.build(path, schemas.CUMULATIVE, gold.cumulative_bookings(first))
    late = first.unionByName(events(spark, {"dt": "2025-10-02", "booking_id": "late"}))
    refresh.refresh_cumulative(late, path, "2025-10-02", "2025-10-02", mode="append")
    stored = load_table(spark, path, schemas.CUMULATIVE).select("dt", "cumulative_bookings")
    assert [n for _, n in values(stored)] == [1, 2, 2]


def test_first_increment_without_table_and_new_source(spark, tmp_path):
    path = str(tmp_path / "c")
    df = events(spark, {"dt": "2025-10-01"}, {"dt": "2025-10-02", "channel": "new"})
    for day in ("2025-10-01", "2025-10-02"):
        refresh.refresh_cumulative(df, path, day)
    assert values(load_table(spark, path, schemas.CUMULATIVE)) == values(gold.cumulative_bookings(df))


def test_day_that_lost_its_bookings_is_emptied(spark, tmp_path):
    path = str(tmp_path / "d")
    df = events(spark, {"dt": "2025-10-01"}, {"dt": "2025-10-02"}, {"dt": "2025-10-03"})
    refresh.build(path, schemas.DAILY_BOOKINGS, gold.daily_bookings(df))
    less = df.filter("dt <> '2025-10-02'")
    replaced = refresh.refresh_daily_bookings(less, path, "2025-10-02", "2025-10-03")
    assert replaced == ["2025-10-02", "2025-10-03"]
    assert values(load_table(spark, path, schemas.DAILY_BOOKINGS)) == values(gold.daily_bookings(less))


def test_booking_after_midnight_utc_reaches_the_local_day_before(spark, tmp_path):
    path = str(tmp_path / "t")
    df = events(spark, {}, {"dt": "2025-10-08", "booking_id": "late", "booking_created_at": ts("2025-10-08 01:00:00")})
    refresh.build(path, schemas.TIME_FEATURES, gold.time_features(df.filter("dt = '2025-10-07'")))
    refresh.refresh_time_features(df, path, "2025-10-08", "2025-10-08", by="ingest_day")
    assert values(load_table(spark, path, schemas.TIME_FEATURES)) == values(gold.time_features(df))


def test_unknown_names(spark, silver, tmp_path):
    with pytest.raises(ValueError):
        refresh.refresh("other", *silver, str(tmp_path), as_of="2024-01-01")
    with pytest.raises(ValueError):
        refresh.refresh_daily_bookings(silver[0], str(tmp_path / "x"), DAYS[0], DAYS[0], mode="merge")
