import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bookloom.functions import numbers as N
from bookloom.functions import text, times
from bookloom.operators.running import latest_before, running_sum
from bookloom.operators.selection import dedup_latest
from fixtures import values


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("value", ["facebook_paid_ads", "a-b_c", "they're", "3com ads", "ÉCOLE_du", "", "__", "ALL CAPS"])
def test_display_label_is_title_case(spark, value):
    assert one(spark, text.display_label, value) == value.replace("_", " ").title()


@pytest.mark.parametrize("value, expected", [(None, None), ("", None), ("  ", None), (" a ", "a"), ("\t", "\t")])
def test_blank_to_null(spark, value, expected):
    assert one(spark, text.blank_to_null, value) == expected


@pytest.mark.parametrize("value, expected", [(None, "(none)"), ("", "(none)"), (" ", " "), ("x", "x")])
def test_campaign_label(spark, value, expected):
    assert one(spark, text.campaign_label, value) == expected


@pytest.mark.parametrize("value, expected", [(1.005, 1.0), (2.125, 2.13), (-2.125, -2.13), (None, None), (1e300, 1e300)])
def test_round_half_up(spark, value, expected):
    assert one(spark, N.round_half_up, value, "double") == (None if expected is None else pytest.approx(expected))


def test_round_half_even_is_numpy_rounding(spark):
    import numpy as np
    numbers = [n / 8 for n in range(-40, 40)] + [1.005, 2.675, 1.015]
    df = spark.createDataFrame([(n,) for n in numbers], "v double")
    got = [r[0] for r in df.select(N.round_half_even(F.col("v"))).collect()]
    assert got == [float(np.round(n, 2)) for n in numbers]


def test_ratios(spark):
    df = spark.createDataFrame([(7, 2), (1, 0), (None, 2), (-7, 2)], "a bigint, b bigint")
    plain, whole = (N.safe_ratio(F.col("a"), F.col("b"), integer=i) for i in (False, True))
    assert [tuple(r) for r in df.select(plain, whole).collect()] == [(3.5, 3.0), (None, None), (None, None), (-3.5, -3.0)]


def test_money_text(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert df.agg(N.sum_money(F.col("v"))).first()[0] == 1.5
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.agg(N.sum_money(F.col("v"), strict=True)).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="no amount of money: x"):
            df.agg(N.sum_money(F.col("v"), strict=True)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_days():
    assert times.date_range("2025-02-27", "2025-03-01") == ["2025-02-27", "2025-02-28", "2025-03-01"]
    assert times.date_range("2025-03-01", "2025-02-27") == []
    assert times.yesterday("2025-03-01") == dt.date(2025, 2, 28)
    assert times.monday_of("2025-10-12") == dt.date(2025, 10, 6) == times.monday_of(dt.datetime(2025, 10, 6, 1))
    assert times.iso(dt.datetime(2025, 10, 6, 1)) == "2025-10-06"


def test_local_days_reach_over_clock_changes(spark):
    hours = [(dt.datetime(2025, 11, 1) + dt.timedelta(hours=n),) for n in range(72)]
    df = spark.createDataFrame(hours, "at timestamp")
    local = F.to_date(times.local_time(F.col("at")))
    for day in ("2025-11-01", "2025-11-02", "2025-11-03"):
        picked = df.filter(times.within_local_days(F.col("at"), day, day))
        assert values(picked) == values(df.filter(local == F.lit(day).cast("date")))


@given(st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2035, 1, 1)))
@settings(max_examples=15, deadline=None)
def test_local_time_parts(spark, at):
    from zoneinfo import ZoneInfo
    wall = at.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(times.NEW_YORK))
    local = times.local_time(F.col("v"))
    row = spark.createDataFrame([(at,)], "v timestamp").select(
        F.hour(local), times.iso_weekday(local), times.weekday_name(local), F.to_date(local), times.week_start(local)).first()
    assert tuple(row) == (wall.hour, wall.isoweekday(), wall.strftime("%a"), wall.date(), times.monday_of(wall.date()))


def test_dates_as_written(spark):
    assert one(spark, times.written_date, "2025-10-08T23:30:00-05:00") == dt.date(2025, 10, 8)
    assert one(spark, times.written_date, "soon") is None
    assert one(spark, times.iso_timestamp, "2025-10-08T23:30:00-05:00") == dt.datetime(2025, 10, 9, 4, 30)
    assert one(spark, times.iso_timestamp, "soon") is None


@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=20))
@settings(max_examples=8, deadline=None)
def test_dedup_latest_keeps_the_greatest(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, v int")
    expected = {}
    for k, t, v in rows:
        expected[k] = max(expected.get(k, (t, v)), (t, v))
    got = dedup_latest(df, ["k"], [F.desc("t"), F.desc("v")])
    assert values(got) == [(k, *tv) for k, tv in expected.items()]


def test_running_sum_and_carry(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("b", 2, 1)], "p string, o int, v bigint")
    carry = spark.createDataFrame([("a", 100), ("z", 9)], "p string, prev bigint")
    assert values(running_sum(df, "p", "o", "v", "s")) == [("a", 1, 5, 5), ("a", 2, 7, 12), ("b", 2, 1, 1)]
    assert values(running_sum(df, "p", "o", "v", "s", carry)) == [("a", 1, 5, 105), ("a", 2, 7, 112), ("b", 2, 1, 1)]


def test_latest_before(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2025, 1, 1), 1), ("a", dt.date(2025, 1, 3), 3), ("b", dt.date(2025, 1, 5), 5)], "k string, d date, v int")
    assert values(latest_before(df, "k", "d", "v", "2025-01-05")) == [("a", 3)]


def test_shuffle_partitions():
    from bookloom.session import shuffle_partitions
    assert (shuffle_partitions(0), shuffle_partitions(256 * 1024 ** 2 * 300 + 1)) == (200, 301)
