"""Report frames against the same figures worked out in pandas."""

import datetime as dt

import pandas as pd
import pytest

from bookloom import schemas
from bookloom.operators.aggregates import pivot_fill, pivot_values
from bookloom.operators.selection import date_bounds, optional_in, options
from bookloom.plans import reports
from fixtures import values

D = dt.date
SOURCES = ["facebook_paid_ads", "tiktok_paid_ads", "youtube_paid_ads"]


@pytest.fixture(scope="module")
def daily(spark):
    rows = [(c, (7 * d + 3 * n) % 11 + 1, D(2025, 10, d)) for d in range(1, 9) for n, c in enumerate(SOURCES) if (d + n) % 4]
    return spark.createDataFrame(rows, schemas.DAILY_BOOKINGS.ddl)


@pytest.fixture(scope="module")
def cumulative(spark):
    rows = [(c, d + n, 100 + d, D(2025, 10, d)) for d in range(1, 20) for n, c in enumerate(SOURCES)]
    return spark.createDataFrame(rows, schemas.CUMULATIVE.ddl)


@pytest.fixture(scope="module")
def campaigns(spark):
    rows = [(s, c, n, 10.005 * n + k, 1.0, D(2025, 10, d)) for d in (1, 2) for k, s in enumerate(SOURCES)
            for n, c in ((3, "a"), (0, "b"), (2 * k, "(none)"), (1, ""), (1, None)) if (s, c) != (SOURCES[0], "a")]
    return spark.createDataFrame(rows, schemas.CAMPAIGN_DAILY.ddl)


def frame(df):
    return pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns)


def test_daily(daily):
    detail = reports.daily_detail(daily, "2025-10-02", "2025-10-07")
    pdf = frame(detail)
    assert list(pdf.booking_date) == sorted(pdf.booking_date) and pdf.booking_date.min() == D(2025, 10, 2)
    kpis = reports.daily_kpis(detail).first()
    per_day = pdf.groupby("booking_date")["bookings"].sum()
    assert (kpis.total_bookings, kpis.avg_per_period, kpis.channels) == (
        pdf.bookings.sum(), round(per_day.mean(), 2), pdf.channel.nunique())
    expected = pdf.pivot_table(index="booking_date", columns="channel", values="bookings", fill_value=0)
    expected["TOTAL"] = expected.sum(axis=1)
    expected = expected.reset_index()
    got = frame(reports.daily_pivot(detail).orderBy("booking_date"))
    assert list(got.columns) == list(expected.columns)
    assert got.values.tolist() == expected.values.tolist()


def test_doubled_rows_average_in_the_pivot(daily):
    twice = reports.daily_pivot(daily.unionAll(daily))
    assert values(twice) == values(reports.daily_pivot(daily))


def test_half_cases_round_to_even(spark):
    df = spark.createDataFrame([("a", n, D(2025, 10, d)) for d, n in enumerate([2] * 7 + [3], 1)], schemas.DAILY_BOOKINGS.ddl)
    assert reports.daily_kpis(df).first().avg_per_period == round(17 / 8, 2) == 2.12


def test_cpb(spark):
    df = spark.createDataFrame([("b_x", 10.0, 4, 2.5), ("a", 6.0, 6, 1.0), ("c", 1.0, 0, None)], schemas.CPB.ddl)
    assert [tuple(r) for r in reports.cpb_leaderboard(df).collect()] == [
        ("a", 6.0, 6, 1.0, "A"), ("b_x", 10.0, 4, 2.5, "B X"), ("c", 1.0, 0, None, "C")]
    assert tuple(reports.cpb_kpis(df).first()) == (10, 17.0, 1.7)
    assert reports.cpb_kpis(df.filter("channel = 'c'")).first().avg_cpb_weighted == 0.0


def test_trend(cumulative):
    detail = reports.trend_daily(cumulative, "2025-10-03", "2025-10-16", SOURCES[:2], SOURCES)
    pdf = frame(detail)
    assert set(pdf.source) == set(SOURCES[:2]) and pdf.cumulative_bookings.min() == 103
    weekly = frame(reports.trend_weekly(cumulative, "2025-10-03", "2025-10-16", SOURCES[:2], SOURCES))
    by_week = pdf.assign(week_start=[d - dt.timedelta(days=d.weekday()) for d in pdf.dt])
    expected = by_week.groupby(["source", "week_start"], as_index=False)["bookings"].sum()
    expected["cumulative_bookings"] = expected.groupby("source")["bookings"].cumsum()
    expected = expected.sort_values(["week_start", "source"])[weekly.columns]
    assert weekly.values.tolist() == expected.values.tolist()


def test_selecting_all_or_nothing_is_no_filter(cumulative):
    everything = cumulative.count()
    for chosen in (None, [], SOURCES):
        assert optional_in(cumulative, "source", chosen, SOURCES).count() == everything
    assert optional_in(cumulative, "source", ["it's"], SOURCES).count() == 0
    assert optional_in(cumulative, "source", ["x", "y", "z"], SOURCES).count() == 0
    one = optional_in(cumulative, "source", [SOURCES[0]] * 5, SOURCES)
    assert {r.source for r in one.collect()} == {SOURCES[0]}


def test_attribution(campaigns):
    agg = reports.attribution(campaigns)
    pdf = frame(agg)
    source = frame(campaigns).groupby(["source", "campaign"], dropna=False)[["total_bookings", "total_spend"]].sum()
    assert len(pdf) == len(source)
    zero = pdf[(pdf.source == SOURCES[0]) & (pdf.campaign == "b")].iloc[0]
    assert zero.bookings == 0 and pd.isna(zero.cpb)
    assert set(pdf[pdf.campaign.isna() | (pdf.campaign == "")].campaign_display) == {"(none)"}
    rows = reports.attribution(campaigns).collect()
    board = reports.attribution_leaderboard(agg).collect()
    assert len(board) == len(rows) and [r.bookings for r in board] == sorted((r.bookings for r in rows), reverse=True)
    kpis = reports.attribution_kpis(agg).first()
    booked, spent = sum(r.bookings for r in rows), sum(r.spend for r in rows)
    assert kpis.total_bookings == booked and kpis.blended_cpb == pytest.approx(spent / booked)


def by_source(campaigns):
    """Bookings and spend of each source, added up by hand."""
    sums = {}
    for r in campaigns.collect():
        booked, spent = sums.get(r.source, (0, 0.0))
        sums[r.source] = (booked + r.total_bookings, spent + r.total_spend)
    return sums


def test_top_sources(campaigns):
    sums = by_source(campaigns)
    top = reports.top_sources(reports.attribution(campaigns), 2).collect()
    assert [r.source for r in top] == sorted(sums, key=lambda s: -sums[s][0])[:2]
    for r in top:
        assert r.cpb == pytest.approx(sums[r.source][1] / sums[r.source][0])
    assert reports.top_sources(reports.attribution(campaigns)).count() == 3


def test_attribution_pivots(campaigns):
    agg = reports.attribution(campaigns)
    cells = {(r.source, r.campaign): r for r in agg.collect() if r.campaign is not None}
    for r in reports.attribution_cpb_pivot(agg).collect():
        for campaign in {c for _, c in cells}:
            want = cells[r.source, campaign].cpb if (r.source, campaign) in cells else None
            assert r[campaign] == (want if want is None else pytest.approx(want))
    for r in reports.attribution_bookings_pivot(agg).collect():
        for campaign in {c for _, c in cells}:
            assert r[campaign] == (cells[r.source, campaign].bookings if (r.source, campaign) in cells else 0)


def test_slots(spark):
    df = spark.createDataFrame(
        [("x", "b1", 9, 1, "Mon", D(2025, 10, 6)), ("x", "b1", 9, 1, "Mon", D(2025, 10, 6)),
         ("y", "b2", 9, 1, "Mon", D(2025, 10, 13)), ("y", "b3", 23, 7, "Sun", D(2025, 10, 12))], schemas.TIME_FEATURES.ddl)
    assert [tuple(r) for r in reports.slots_heatmap(df).collect()] == [(1, "Mon", 9, 2), (7, "Sun", 23, 1)]
    assert [tuple(r) for r in reports.slots_by_hour(df, "2025-10-12", "2025-10-13").collect()] == [(9, 1), (23, 1)]
    assert [tuple(r) for r in reports.slots_by_weekday(df, sources=["x"], universe=["x", "y"]).collect()] == [(1, "Mon", 1)]


def test_meeting_load(spark):
    weeks = [D(2025, 9, 29), D(2025, 10, 6), D(2025, 10, 13)]
    df = spark.createDataFrame(
        [("a", "m1", weeks[0], weeks[0]), ("a", "m1", weeks[0], weeks[0]), ("a", "m2", weeks[1], weeks[1]),
         ("a", "m3", weeks[1], weeks[1]), ("b", "m4", weeks[2], weeks[2])], schemas.MEETING_FEATURES.ddl)
    load = reports.load_by_employee(df)
    assert [tuple(r) for r in load.collect()] == [("a", 3, 2, 1.5), ("b", 1, 1, 1.0)]
    assert [tuple(r) for r in reports.load_by_employee(df, integer=True).collect()] == [("a", 3, 2, 1.0), ("b", 1, 1, 1.0)]
    assert tuple(reports.load_kpis(load).first()) == (4, 3, 1)
    assert values(reports.load_weekly(df, weeks[1], weeks[2], ["a"], ["a", "b"])) == [("a", weeks[1], 2)]


def test_options_and_bounds(cumulative, campaigns):
    assert [r[0] for r in options(campaigns, "campaign").collect()] == ["", "(none)", "a", "b"]
    assert tuple(date_bounds(cumulative, "dt").first()) == (D(2025, 10, 1), D(2025, 10, 19))
    assert tuple(date_bounds(cumulative.limit(0), "dt").first()) == (None, None)


def test_pivot_headings(spark, campaigns):
    assert pivot_values(campaigns, "source") == SOURCES
    named = pivot_fill(campaigns, "source", "campaign", "total_bookings", "sum", ["a", "zzz"], fill=0)
    assert named.columns == ["source", "a", "zzz"]
    spark.conf.set("spark.sql.pivotMaxValues", "2")
    try:
        with pytest.raises(ValueError):
            pivot_values(campaigns, "source")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
