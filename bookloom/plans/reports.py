"""Report frames: what each tab of the reporting front end shows and offers for download.

Input is a reporting table, output is the frame behind one chart, figure or list. Everything stays in Spark; only
final frames are small enough to leave the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookloom.functions import times as T
from bookloom.functions.numbers import divide, round_half_even, round_half_up, safe_ratio
from bookloom.functions.text import campaign_label, display_label
from bookloom.operators.aggregates import count_bookings, count_ids, pivot_fill
from bookloom.operators.bitmaps import BITS, count_sketched
from bookloom.operators.pages import cells, headings, paged
from bookloom.operators.running import running_sum
from bookloom.operators.selection import optional_in

Names = Sequence[str] | None
Bound = T.Day | None


def within(table: DataFrame, day: str, start: Bound, end: Bound) -> DataFrame:
    return table.filter(T.in_days(F.col(day), start, end))


def period_kpis(detail: DataFrame, period: str, group: str) -> DataFrame:
    """Total bookings, average of the totals per period, number of groups; one row.

    The average of the per-period sums is the total over the number of periods, so one aggregation is enough.
    """
    return detail.agg(
        F.sum("bookings").alias("total_bookings"),
        round_half_even(F.sum("bookings") / F.nullif(F.count_distinct(period), F.lit(0))).alias("avg_per_period"),
        F.count_distinct(group).alias("n_groups"),
    )


def weighted_cost(spend: str, bookings: str) -> Column:
    """Spend over bookings of all rows together; 0 without bookings."""
    return F.coalesce(divide(F.sum(spend), F.sum(bookings)), F.lit(0.0))


# Tab 1: daily bookings by channel

def daily_detail(table: DataFrame, start: Bound = None, end: Bound = None) -> DataFrame:
    rows = within(table, "booking_date", start, end)
    return rows.select("booking_date", "channel", "bookings").orderBy("booking_date", "channel")


def daily_kpis(detail: DataFrame) -> DataFrame:
    return period_kpis(detail, "booking_date", "channel").withColumnRenamed("n_groups", "channels")


def daily_pivot(detail: DataFrame, channels: Names = None) -> DataFrame:
    """Day by channel with a TOTAL column. Cells are averages: equal to the value while (day, channel) is unique."""
    return pivot_fill(detail, "booking_date", "channel", "bookings", "avg", channels, fill=0, total=True)


# Tab 2: cost per booking by channel

def cpb_detail(table: DataFrame) -> DataFrame:
    return table.select(
        "channel", "total_spend", "total_bookings", "cpb", display_label(F.col("channel")).alias("channel_display"))


def cpb_kpis(table: DataFrame) -> DataFrame:
    return table.agg(
        F.sum("total_bookings").alias("total_bookings"),
        F.sum("total_spend").alias("total_spend"),
        weighted_cost("total_spend", "total_bookings").alias("avg_cpb_weighted"),
    )


def cpb_leaderboard(table: DataFrame) -> DataFrame:
    """Cheapest channel first."""
    return cpb_detail(table).orderBy(F.asc_nulls_last("cpb"), "channel")


# Tab 3: bookings over time

def trend_daily(
    table: DataFrame, start: Bound = None, end: Bound = None, sources: Names = None, universe: Names = None,
) -> DataFrame:
    """Stored daily figures; the running total is the one over all time."""
    rows = optional_in(within(table, "dt", start, end), "source", sources, universe)
    return rows.select(
        "dt",
        "source",
        F.col("bookings").cast("long").alias("bookings"),
        F.col("cumulative_bookings").cast("long").alias("cumulative_bookings"),
    ).orderBy("dt", "source")


def trend_weekly(
    table: DataFrame, start: Bound = None, end: Bound = None, sources: Names = None, universe: Names = None,
) -> DataFrame:
    """Weekly figures; here the running total starts with the chosen range."""
    rows = optional_in(within(table, "dt", start, end), "source", sources, universe)
    weekly = rows.groupBy(T.week_start(F.col("dt")).alias("week_start"), "source").agg(
        F.sum(F.col("bookings").cast("long")).alias("bookings"))
    total = running_sum(weekly, "source", "week_start", "bookings", "cumulative_bookings")
    return total.orderBy("week_start", "source")


def trend_kpis(detail: DataFrame, period: str = "dt") -> DataFrame:
    return period_kpis(detail, period, "source").withColumnRenamed("n_groups", "sources")


def trend_pivot(detail: DataFrame, period: str = "dt", sources: Names = None) -> DataFrame:
    return pivot_fill(detail, period, "source", "bookings", "avg", sources, fill=0)


# Tab 4: channel attribution

def attribution(
    table: DataFrame, start: Bound = None, end: Bound = None,
    sources: Names = None, all_sources: Names = None, campaigns: Names = None, all_campaigns: Names = None,
) -> DataFrame:
    """Bookings, spend and cost per booking of every source and campaign."""
    rows = within(table, "dt", start, end)
    rows = optional_in(rows, "source", sources, all_sources)
    rows = optional_in(rows, "campaign", campaigns, all_campaigns)
    # The last digits of a sum of doubles depend on the order of addition; without them a half cent rounds one way only.
    spend, bookings = round_half_up(F.sum(F.col("total_spend").cast("double")), 9), F.sum(F.col("total_bookings").cast("long"))
    return rows.groupBy("source", "campaign").agg(
        bookings.alias("bookings"),
        round_half_up(spend).alias("spend"),
        safe_ratio(spend, bookings).alias("cpb"),
    ).select(
        "*",
        display_label(F.col("source")).alias("source_display"),
        campaign_label(F.col("campaign")).alias("campaign_display"),
    )


def attribution_kpis(agg: DataFrame) -> DataFrame:
    return agg.agg(
        F.sum("bookings").alias("total_bookings"),
        F.sum("spend").alias("total_spend"),
        weighted_cost("spend", "bookings").alias("blended_cpb"),
    )


def attribution_leaderboard(agg: DataFrame) -> DataFrame:
    """Most bookings first, then the cheapest; unknown cost last."""
    return agg.select("source", "campaign", "bookings", "spend", "cpb").orderBy(
        F.desc("bookings"), F.asc_nulls_last("cpb"), "source", "campaign")


def source_rollup(agg: DataFrame) -> DataFrame:
    """Campaign rows added up to sources. Spend is added after it was rounded per campaign."""
    totals = agg.groupBy("source").agg(F.sum("bookings").alias("bookings"), F.sum("spend").alias("spend"))
    return totals.select(
        "*",
        divide(F.col("spend"), F.col("bookings")).alias("cpb"),
        display_label(F.col("source")).alias("source_display"),
    )


def top_sources(agg: DataFrame, n: int = 10) -> DataFrame:
    """The `n` sources with most bookings; equal counts are ordered by name."""
    return source_rollup(agg).orderBy(F.desc("bookings"), "source").limit(n)


def attribution_cpb_pivot(agg: DataFrame, campaigns: Names = None) -> DataFrame:
    """Cost per booking, source by campaign; pairs that do not occur stay null."""
    return pivot_fill(agg, "source", "campaign", "cpb", "avg", campaigns)


def attribution_bookings_pivot(agg: DataFrame, campaigns: Names = None) -> DataFrame:
    return pivot_fill(agg, "source", "campaign", "bookings", "sum", campaigns, fill=0)


def attribution_pages(agg: DataFrame, width: int, value: str = "bookings") -> tuple[DataFrame, DataFrame]:
    """The cross tables for any number of campaigns: wide blocks, and the headings of their columns. `value` is bookings
    (missing ones 0) or cpb (missing ones null)."""
    names = headings(agg, "campaign", width)
    long = cells(agg, "source", "campaign", value, "sum" if value == "bookings" else "avg")
    return paged(long, names, "source", width, fill=0 if value == "bookings" else None), names


# Tab 5: time of day and day of week

def slots(
    table: DataFrame, keys: Sequence[str], start: Bound = None, end: Bound = None,
    sources: Names = None, universe: Names = None,
) -> DataFrame:
    """Distinct bookings per slot, from the table of bookings or from the stored sets of their numbers."""
    rows = optional_in(within(table, "booking_date_local", start, end), "source", sources, universe)
    counted = count_sketched(rows, keys, "bookings") if BITS in table.columns else count_bookings(rows, list(keys))
    return counted.orderBy(*[k for k in keys if k != "dow_name"])


def slots_heatmap(table: DataFrame, *args, **kwargs) -> DataFrame:
    return slots(table, ("dow_num", "dow_name", "hour_of_day"), *args, **kwargs)


def slots_by_hour(table: DataFrame, *args, **kwargs) -> DataFrame:
    return slots(table, ("hour_of_day",), *args, **kwargs)


def slots_by_weekday(table: DataFrame, *args, **kwargs) -> DataFrame:
    return slots(table, ("dow_num", "dow_name"), *args, **kwargs)


# Tab 6: meeting load

def weekly_meetings(
    table: DataFrame, start: Bound = None, end: Bound = None, employees: Names = None, universe: Names = None,
) -> DataFrame:
    """Distinct meetings per employee and week, from the table of meetings or from the stored sets of their numbers."""
    rows = optional_in(within(table, "week_start_date", start, end), "employee_id", employees, universe)
    if BITS in table.columns:
        return count_sketched(rows, ["employee_id", "week_start_date"], "meetings")
    return count_ids(rows, ["employee_id", "week_start_date"], "meeting_id", "meetings")


def load_by_employee(
    table: DataFrame, start: Bound = None, end: Bound = None, employees: Names = None, universe: Names = None,
    integer: bool = False,
) -> DataFrame:
    """Meetings, weeks with meetings and meetings per week of every employee; the busiest first.

    `integer` truncates the average, as a division of two bigints does.
    """
    weekly = weekly_meetings(table, start, end, employees, universe)
    # One row per employee and week, so counting rows counts weeks.
    meetings, weeks = F.sum("meetings"), F.count("week_start_date")
    totals = weekly.groupBy("employee_id").agg(
        meetings.alias("total_meetings"),
        weeks.alias("weeks_present"),
        safe_ratio(meetings, weeks, integer=integer).alias("avg_meetings_per_week"),
    )
    return totals.orderBy(F.desc("avg_meetings_per_week"), "employee_id")


def load_kpis(by_employee: DataFrame) -> DataFrame:
    return by_employee.agg(
        F.sum("total_meetings").alias("total_meetings"),
        F.max("total_meetings").alias("max_meetings"),
        F.min("total_meetings").alias("min_meetings"),
    )


def load_weekly(
    table: DataFrame, start: Bound = None, end: Bound = None, employees: Names = None, universe: Names = None,
) -> DataFrame:
    return weekly_meetings(table, start, end, employees, universe).orderBy("week_start_date", "employee_id")
