"""Named queries: (spark, sf_dir) -> DataFrame. Each one reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions import times as T
from bookloom.functions.numbers import round_half_up
from bookloom.functions.text import blank_to_null, campaign_label, display_label, present
from bookloom.operators.bitmaps import Numbering
from bookloom.operators.lookup import map_channel_table
from bookloom.operators.running import latest_before
from bookloom.operators.selection import date_bounds, options
from bookloom.plans import blocks, compaction, gold, intake, ranges, refresh, reports, seen, sets, silver
from bookloom.queries import adapters as A
from bookloom.session import configure, work_dir
from bookloom.sinks import catalog, export, verify, versions
from bookloom.sinks.tables import overwrite_partitions, replace_days, write_table
from bookloom.sources.spend import read_spend_arrays
from bookloom.sources.tables import load_table
from bookloom.sources.webhooks import parse_bronze, read_envelopes, stream_envelopes
from bookloom.streaming.intake import start_intake
from bookloom.streaming.silver import rebuild_days, start_silver

Query = Callable[[SparkSession, str], DataFrame]

# The days the increments and reports of this registry work on; the oracle states the same ones.
START, DAY, END = "2024-01-10", "2024-01-15", "2024-01-20"
WEEKS = ["2024-01-08", "2024-01-15"]
TWO_SOURCES = [A.FACEBOOK, A.YOUTUBE]
EMPLOYEES = ["emp1", "emp2", "emp3"]
ALL_EMPLOYEES = [f"emp{n}" for n in range(1, 12)]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query under its function name."""

    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(run(configure(spark), sf_dir))

    QUERIES[run.__name__] = configured
    return run


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so that they read the same on any machine."""
    instants = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants}) if instants else df


def rounded(df: DataFrame, *columns: str, scale: int = 4) -> DataFrame:
    """Sums of doubles depend on the order of addition in the last digits; compare them without those."""
    return df.withColumns({c: round_half_up(F.col(c), scale) for c in columns})


# Silver

@query
def events_silver(spark, sf):
    return silver.flatten_events(parse_bronze(A.bronze(spark, sf)))


@query
def events_silver_mapping_table(spark, sf):
    """Channels from a mapping table instead of a literal."""
    flat = silver.flatten_events(parse_bronze(A.bronze(spark, sf)))
    mapping = A.events(spark, sf).filter(F.col("event_type").isin("click", "view")).select(
        A.event_type_url().alias("event_type_url"), F.col("event_type").alias("channel"))
    return map_channel_table(flat, mapping).select(*schemas.EVENTS.columns)


@query
def spend_silver(spark, sf):
    return silver.clean_spend(A.spend_records(spark, sf))


@query
def events_silver_from_files(spark, sf):
    """Backfill of some days from stored webhook JSON into the silver table, run twice."""
    root, path = A.stored_webhooks(spark, sf), work_dir(spark, "silver")
    for _ in range(2):
        silver.rebuild_events(spark, root, path, START, END)
    return load_table(spark, path, schemas.EVENTS)


@query
def events_silver_from_compacted(spark, sf):
    """Stored webhook JSON of some days taken into the compacted table, in two runs that overlap."""
    root, path = A.stored_webhooks(spark, sf), work_dir(spark, "compacted")
    for end in (DAY, END):
        compaction.compact(spark, root, path, START, end)
    return silver.flatten_events(compaction.read_compacted(spark, path, START, END))


@query
def spend_silver_from_files(spark, sf):
    """First the earliest file, then all of them."""
    files, path = A.spend_files(spark, sf), work_dir(spark, "spend")
    for day in (A.SPEND_FILES[0], "ALL"):
        silver.build_spend(spark, files, path, day)
    return load_table(spark, path, schemas.SPEND)


@query
def spend_silver_from_arrays(spark, sf):
    """All records in three arrays, some of them without channel or day; several tasks read each."""
    return silver.clean_spend(read_spend_arrays(spark, A.spend_arrays(spark, sf)))


# Gold

@query
def daily_bookings_by_channel_rows(spark, sf):
    return gold.daily_bookings(A.bookings(spark, sf), distinct=False)


@query
def daily_bookings_by_channel_distinct(spark, sf):
    return gold.daily_bookings(A.bookings(spark, sf))


@query
def cpb_by_channel(spark, sf):
    return rounded(gold.cpb_by_channel(A.bookings(spark, sf), A.spend(spark, sf)), "total_spend")


@query
def cumulative_bookings_by_source(spark, sf):
    return gold.cumulative_bookings(A.bookings(spark, sf))


def campaign_table(spark, sf, mode="proportional"):
    return gold.campaign_daily(A.bookings(spark, sf), A.spend(spark, sf), mode)


@query
def channel_campaign_daily_proportional(spark, sf):
    return rounded(campaign_table(spark, sf), "total_spend")


@query
def channel_campaign_daily_integer(spark, sf):
    return rounded(campaign_table(spark, sf, "integer"), "total_spend")


@query
def booking_time_features(spark, sf):
    return gold.time_features(A.bookings(spark, sf))


@query
def employee_meetings_features(spark, sf):
    return gold.meeting_features(A.bookings(spark, sf))


# Increments: the new rows

@query
def daily_bookings_increment_day(spark, sf):
    return refresh.daily_bookings_increment(A.bookings(spark, sf), DAY, DAY)


@query
def daily_bookings_increment_range(spark, sf):
    return refresh.daily_bookings_increment(A.bookings(spark, sf), START, END)


def cumulative_before(spark, sf, day):
    rows = A.bookings(spark, sf)
    return gold.cumulative_bookings(rows.filter(T.before(F.col("dt"), day)))


@query
def cumulative_increment_day(spark, sf):
    return refresh.cumulative_increment(A.bookings(spark, sf), cumulative_before(spark, sf, DAY), DAY, DAY)


@query
def cumulative_increment_range(spark, sf):
    return refresh.cumulative_increment(A.bookings(spark, sf), cumulative_before(spark, sf, START), START, END)


@query
def cumulative_latest_before(spark, sf):
    return latest_before(gold.cumulative_bookings(A.bookings(spark, sf)), "source", "dt", "cumulative_bookings", DAY)


@query
def campaign_increment_day(spark, sf):
    rows = refresh.campaign_increment(A.bookings(spark, sf), A.spend(spark, sf), DAY, DAY)
    return rounded(rows, "total_spend")


@query
def campaign_increment_range(spark, sf):
    rows = refresh.campaign_increment(A.bookings(spark, sf), A.spend(spark, sf), START, END)
    return rounded(rows, "total_spend")


@query
def time_features_increment_local_day(spark, sf):
    return refresh.time_features_on_days(A.bookings(spark, sf), [DAY])


@query
def time_features_increment_ingest_range(spark, sf):
    return refresh.time_features_received(A.bookings(spark, sf), START, END)


@query
def meeting_features_increment_day(spark, sf):
    return refresh.meeting_features_on_day(A.bookings(spark, sf), DAY)


@query
def meeting_features_increment_weeks(spark, sf):
    return refresh.meeting_features_in_weeks(A.bookings(spark, sf), WEEKS)


# Increments: tables built up to a day, then refreshed on disk, twice, and read back

def first_part(spark, sf):
    return A.bookings(spark, sf).filter(T.in_days(F.col("dt"), None, END))


AFTER_END, LAST = "2024-01-21", "2024-01-31"


@query
def refreshed_daily_bookings(spark, sf):
    path = work_dir(spark, "daily-bookings")
    refresh.build(path, schemas.DAILY_BOOKINGS, gold.daily_bookings(first_part(spark, sf)))
    for _ in range(2):
        refresh.refresh_daily_bookings(A.bookings(spark, sf), path, AFTER_END, LAST)
    return load_table(spark, path, schemas.DAILY_BOOKINGS)


@query
def refreshed_cpb(spark, sf):
    path = work_dir(spark, "cpb")
    refresh.build(path, schemas.CPB, gold.cpb_by_channel(first_part(spark, sf), A.spend(spark, sf)))
    refresh.refresh_cpb(A.bookings(spark, sf), A.spend(spark, sf), path)
    return rounded(load_table(spark, path, schemas.CPB), "total_spend")


@query
def refreshed_cpb_daily(spark, sf):
    """The table from the set of bookings seen: built up to a day, then one stretch of days at a time, one of them twice."""
    path, known = work_dir(spark, "cpb"), seen.SeenSet(work_dir(spark, "seen"), buckets=8)
    events, spend = A.bookings(spark, sf), A.spend(spark, sf)
    seen.build_cpb(first_part(spark, sf), spend, known, path)
    for start, end in ((AFTER_END, "2024-01-24"), ("2024-01-25", LAST), (AFTER_END, AFTER_END)):
        seen.refresh_cpb(events, spend, known, path, start, end)
    return rounded(versions.load_current(spark, path, schemas.CPB), "total_spend")


@query
def refreshed_cumulative(spark, sf):
    path = work_dir(spark, "cumulative")
    refresh.build(path, schemas.CUMULATIVE, gold.cumulative_bookings(first_part(spark, sf)))
    for start in (AFTER_END, DAY):
        refresh.refresh_cumulative(A.bookings(spark, sf), path, start)
    return load_table(spark, path, schemas.CUMULATIVE)


@query
def refreshed_cumulative_blocks(spark, sf):
    """Totals in weekly blocks: built up to a day, then the days after, then an early day again."""
    path, totals, events = work_dir(spark, "blocks"), work_dir(spark, "block-totals"), A.bookings(spark, sf)
    blocks.build_blocks(first_part(spark, sf).filter(F.col("dt") != DAY), path, totals, "week")
    for start, end in ((AFTER_END, LAST), (DAY, DAY)):
        blocks.refresh_blocks(events, path, totals, start, end, "week")
    return blocks.cumulative(load_table(spark, path, blocks.BLOCKS), load_table(spark, totals, blocks.TOTALS), period="week")


@query
def refreshed_campaign_daily(spark, sf):
    path, spend = work_dir(spark, "campaign"), A.spend(spark, sf)
    refresh.build(path, schemas.CAMPAIGN_DAILY, gold.campaign_daily(first_part(spark, sf), spend))
    for _ in range(2):
        refresh.refresh_campaign_daily(A.bookings(spark, sf), spend, path, AFTER_END, LAST)
    return rounded(load_table(spark, path, schemas.CAMPAIGN_DAILY), "total_spend")


@query
def refreshed_time_features(spark, sf):
    path = work_dir(spark, "time-features")
    refresh.build(path, schemas.TIME_FEATURES, gold.time_features(first_part(spark, sf)))
    refresh.refresh_time_features(A.bookings(spark, sf), path, AFTER_END, LAST, by="ingest_day")
    refresh.refresh_time_features(A.bookings(spark, sf), path, START, DAY)
    return load_table(spark, path, schemas.TIME_FEATURES)


@query
def refreshed_time_features_pruned(spark, sf):
    """Some local days rebuilt from stored events, some of them received weeks late; partitions chosen by recorded ranges."""
    path, stored, known = (work_dir(spark, n) for n in ("time-features", "events", "ranges"))
    late = F.when(F.col("organizer_email") == "emp3", F.lit("2024-02-20")).otherwise(F.col("dt"))
    write_table(A.bookings(spark, sf).withColumn("dt", late), stored, schemas.EVENTS.by)
    ranges.record(spark, stored, known, F.lit(True))
    events = load_table(spark, stored, schemas.EVENTS)
    refresh.refresh_time_features(events, path, START, DAY, ranges=ranges.load(spark, known))
    return load_table(spark, path, schemas.TIME_FEATURES)


@query
def refreshed_meeting_features(spark, sf):
    path = work_dir(spark, "meeting-features")
    refresh.build(path, schemas.MEETING_FEATURES, gold.meeting_features(first_part(spark, sf)))
    weeks = [str(T.monday_of(d)) for d in T.date_range(AFTER_END, "2024-02-04")][::7]
    refresh.refresh_meeting_features(A.bookings(spark, sf), path, weeks=sorted(set(weeks)))
    refresh.refresh_meeting_features(A.bookings(spark, sf), path, day=DAY)
    return load_table(spark, path, schemas.MEETING_FEATURES)


@query
def daily_run_bookings(spark, sf):
    """The daily run of the first table: only the day before."""
    path = work_dir(spark, "daily-run")
    refresh.refresh(schemas.DAILY_BOOKINGS.name, A.bookings(spark, sf), A.spend(spark, sf), path, as_of="2024-01-16")
    return load_table(spark, path, schemas.DAILY_BOOKINGS)


# Sinks

@query
def table_append(spark, sf):
    """Appending the same day twice doubles it."""
    path = work_dir(spark, "append")
    events = A.bookings(spark, sf)
    write_table(gold.daily_bookings(events), path, schemas.DAILY_BOOKINGS.by)
    refresh.refresh_daily_bookings(events, path, DAY, DAY, mode="append")
    return load_table(spark, path, schemas.DAILY_BOOKINGS)


@query
def table_overwrite_partitions(spark, sf):
    """Row counts in the replaced days, distinct counts in the others."""
    path = work_dir(spark, "overwrite")
    events = A.bookings(spark, sf)
    write_table(gold.daily_bookings(events), path, schemas.DAILY_BOOKINGS.by)
    rows = refresh.daily_bookings_increment(events, START, DAY, distinct=False)
    overwrite_partitions(rows, path, "booking_date", T.in_days(F.col("booking_date"), START, END))
    return load_table(spark, path, schemas.DAILY_BOOKINGS)


@query
def table_replace_days(spark, sf):
    """Silver spend with some days replaced by the records of the files."""
    path = work_dir(spark, "replace")
    write_table(A.spend(spark, sf), path, schemas.SPEND.by)
    replace_days(silver.clean_spend(A.spend_records(spark, sf)), path, "dt", T.date_range(START, END))
    return load_table(spark, path, schemas.SPEND)


CATALOG_SAMPLES = {"booking_events": ["booking_id", "channel", "invitee_email", "dt"], "events_spend": ["channel", "dt"]}


def verified(spark, sf):
    """Two silver tables registered by folder; row counts and samples from the catalog."""
    events_path, spend_path = work_dir(spark, "events"), work_dir(spark, "spend")
    write_table(silver.flatten_events(parse_bronze(A.bronze(spark, sf))), events_path, schemas.EVENTS.by)
    write_table(A.spend(spark, sf), spend_path, schemas.SPEND.by)
    database = "bookloom_check"
    catalog.register_tables(spark, database, {
        "booking_events": (events_path, schemas.EVENTS), "events_spend": (spend_path, schemas.SPEND)})
    return catalog.verify_tables(spark, {f"{database}.{name}": columns for name, columns in CATALOG_SAMPLES.items()})


@query
def catalog_row_counts(spark, sf):
    counts, _ = verified(spark, sf)
    return counts


@query
def catalog_samples(spark, sf):
    """Ten rows of each table, the same on every run."""
    _, samples = verified(spark, sf)
    shown = [rows.select(F.lit(name).alias("table_name"), F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in rows.columns]).alias("row"))
             for name, rows in samples.items()]
    return shown[0].unionByName(shown[1])


@query
def catalog_compared(spark, sf):
    """A stored table in which one day has a changed row and another day is missing, against what it should hold."""
    path, table = work_dir(spark, "spend-compared"), "bookloom_check.spend_compared"
    expected = A.spend(spark, sf)
    hurt = expected.filter(F.col("dt") != START).withColumn(
        "spend", F.when((F.col("dt") == DAY) & (F.col("channel") == A.FACEBOOK), F.col("spend") + 1).otherwise(F.col("spend")))
    write_table(hurt, path, schemas.SPEND.by)
    catalog.register_tables(spark, "bookloom_check", {"spend_compared": (path, schemas.SPEND)})
    return verify.compare(expected, spark.table(table), ["dt"])


@query
def catalog_swapped_cpb(spark, sf):
    """Full refresh by moving the catalog entry to a finished copy."""
    table, base = "bookloom_check.cpb", work_dir(spark, "cpb-versions")
    spark.sql("CREATE DATABASE IF NOT EXISTS bookloom_check")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    for events in (first_part(spark, sf), A.bookings(spark, sf)):
        catalog.swap_table(gold.cpb_by_channel(events, A.spend(spark, sf)), table, base, schemas.CPB)
    return rounded(load_table(spark, table, schemas.CPB), "total_spend")


@query
def csv_export(spark, sf):
    path = work_dir(spark, "csv")
    export.export_csv(reports.daily_detail(gold.daily_bookings(A.bookings(spark, sf))), path)
    return spark.read.schema("booking_date date, channel string, bookings bigint").option("header", True).csv(path)


# Intake

def intake_rows(bronze: DataFrame) -> DataFrame:
    """Bronze rows without the random ids and with the parts of the body that tell copies apart."""
    stable = F.col("event_id").rlike("^[0-9a-f]{64}$")
    return bronze.select(
        "dt", "event", F.when(stable, F.col("event_id")).alias("event_id"), "received_at",
        F.get_json_object("body", "$.created_at").alias("created_at"), F.get_json_object("body", "$.raw").alias("raw"))


@query
def webhook_intake(spark, sf):
    bronze, _ = intake.ingest_webhooks(read_envelopes(spark, A.landed_envelopes(spark, sf)))
    return intake_rows(bronze)


@query
def webhook_intake_rejects(spark, sf):
    _, rejects = intake.ingest_webhooks(read_envelopes(spark, A.landed_envelopes(spark, sf)))
    return rejects.drop("reject_id")


@query
def webhook_intake_by_key(spark, sf):
    """Parsed once into a staged table; which copy stays is decided on keys and times."""
    path = work_dir(spark, "staged")
    intake.staged(intake.route_webhooks(read_envelopes(spark, A.landed_envelopes(spark, sf)))).write.parquet(path)
    return intake_rows(intake.latest_staged(load_table(spark, path, schemas.STAGED)))


def run_intake(spark, sf):
    bronze, rejects, repeats, state = (work_dir(spark, n) for n in ("bronze", "rejects", "repeats", "intake-state"))
    start_intake(stream_envelopes(spark, A.landed_envelopes(spark, sf)), bronze, rejects, repeats, state).awaitTermination()
    return bronze, rejects, repeats


@query
def stream_webhook_intake(spark, sf):
    bronze, _, repeats = run_intake(spark, sf)
    return intake_rows(intake.resolve(load_table(spark, bronze, schemas.BRONZE), load_table(spark, repeats, schemas.REPEATS)))


@query
def stream_webhook_intake_rejects(spark, sf):
    _, rejects, _ = run_intake(spark, sf)
    return load_table(spark, rejects, schemas.REJECTS).drop("reject_id")


@query
def stream_webhook_intake_first_copy(spark, sf):
    """Bronze as the stream leaves it."""
    bronze, _, _ = run_intake(spark, sf)
    return intake_rows(load_table(spark, bronze, schemas.BRONZE))


@query
def stream_webhook_intake_later_copies(spark, sf):
    """Every delivery that bronze does not hold."""
    _, _, repeats = run_intake(spark, sf)
    return intake_rows(load_table(spark, repeats, schemas.REPEATS))


@query
def stream_events_silver(spark, sf):
    """The live table after micro-batches over bronze and the repeats."""
    bronze, _, repeats = run_intake(spark, sf)
    path = work_dir(spark, "live")
    start_silver(spark, bronze, repeats, path, work_dir(spark, "silver-state")).awaitTermination()
    return load_table(spark, path, schemas.LIVE_EVENTS).select(*schemas.EVENTS.columns)


@query
def events_silver_replayed(spark, sf):
    """Silver days rebuilt from the bronze table that the intake wrote."""
    path, silver_path = work_dir(spark, "bronze"), work_dir(spark, "silver")
    bronze, _ = intake.ingest_webhooks(read_envelopes(spark, A.landed_envelopes(spark, sf)))
    write_table(bronze, path, schemas.BRONZE.by)
    rebuild_days(spark, path, silver_path, T.date_range(START, END), ranges_path=work_dir(spark, "ranges"))
    return load_table(spark, silver_path, schemas.EVENTS)


# Report tab 1

def daily(spark, sf):
    return gold.daily_bookings(A.bookings(spark, sf))


@query
def report_daily_range(spark, sf):
    return date_bounds(daily(spark, sf), "booking_date")


@query
def report_daily_detail(spark, sf):
    return reports.daily_detail(daily(spark, sf), START, END)


@query
def report_daily_kpis(spark, sf):
    return reports.daily_kpis(reports.daily_detail(daily(spark, sf), START, END))


@query
def report_daily_pivot(spark, sf):
    return reports.daily_pivot(reports.daily_detail(daily(spark, sf), START, END), A.CHANNELS)


@query
def report_daily_pivot_discovered(spark, sf):
    """The column headings are looked up in the data."""
    return reports.daily_pivot(reports.daily_detail(daily(spark, sf)))


# Report tab 2

def cpb(spark, sf):
    return gold.cpb_by_channel(A.bookings(spark, sf), A.spend(spark, sf))


@query
def report_cpb_leaderboard(spark, sf):
    return rounded(reports.cpb_leaderboard(cpb(spark, sf)), "total_spend")


@query
def report_cpb_kpis(spark, sf):
    return rounded(reports.cpb_kpis(cpb(spark, sf)), "total_spend", "avg_cpb_weighted")


# Report tab 3

def cumulative(spark, sf):
    return gold.cumulative_bookings(A.bookings(spark, sf))


@query
def report_trend_sources(spark, sf):
    return options(cumulative(spark, sf), "source")


@query
def report_trend_range(spark, sf):
    return date_bounds(cumulative(spark, sf), "dt")


@query
def report_trend_daily(spark, sf):
    return reports.trend_daily(cumulative(spark, sf), START, END, TWO_SOURCES, A.CHANNELS)


@query
def report_trend_daily_kpis(spark, sf):
    return reports.trend_kpis(reports.trend_daily(cumulative(spark, sf), START, END, TWO_SOURCES, A.CHANNELS))


@query
def report_trend_daily_pivot(spark, sf):
    detail = reports.trend_daily(cumulative(spark, sf), START, END)
    return reports.trend_pivot(detail, "dt", A.CHANNELS)


@query
def report_trend_weekly(spark, sf):
    return reports.trend_weekly(cumulative(spark, sf), START, END, TWO_SOURCES, A.CHANNELS)


@query
def report_trend_weekly_kpis(spark, sf):
    return reports.trend_kpis(reports.trend_weekly(cumulative(spark, sf), START, END), "week_start")


@query
def report_trend_weekly_pivot(spark, sf):
    return reports.trend_pivot(reports.trend_weekly(cumulative(spark, sf)), "week_start", A.CHANNELS)


# Report tab 4

@query
def report_attribution_campaigns(spark, sf):
    return options(campaign_table(spark, sf), "campaign")


@query
def report_attribution_range(spark, sf):
    return date_bounds(campaign_table(spark, sf), "dt")


def attributed(spark, sf):
    return reports.attribution(campaign_table(spark, sf), START, END)


@query
def report_attribution(spark, sf):
    return attributed(spark, sf)


@query
def report_attribution_filtered(spark, sf):
    return reports.attribution(
        campaign_table(spark, sf), START, END, TWO_SOURCES, A.CHANNELS, ["cmp_3", "cmp_4"], A.CAMPAIGNS)


@query
def report_attribution_leaderboard(spark, sf):
    return reports.attribution_leaderboard(attributed(spark, sf))


@query
def report_attribution_kpis(spark, sf):
    return rounded(reports.attribution_kpis(attributed(spark, sf)), "total_spend", "blended_cpb")


@query
def report_attribution_top_sources(spark, sf):
    return rounded(reports.top_sources(attributed(spark, sf), 2), "spend", "cpb")


@query
def report_attribution_cpb_pivot(spark, sf):
    return reports.attribution_cpb_pivot(attributed(spark, sf), A.CAMPAIGNS)


@query
def report_attribution_bookings_pivot(spark, sf):
    return reports.attribution_bookings_pivot(attributed(spark, sf), A.CAMPAIGNS)


@query
def report_attribution_pages(spark, sf):
    """The cross table of bookings in blocks of two columns."""
    wide, _ = reports.attribution_pages(attributed(spark, sf), 2)
    return wide


@query
def report_attribution_page_headings(spark, sf):
    _, names = reports.attribution_pages(attributed(spark, sf), 2)
    return names


# Report tab 5

def times(spark, sf):
    return gold.time_features(A.bookings(spark, sf))


@query
def report_slots_range(spark, sf):
    return date_bounds(times(spark, sf), "booking_date_local")


@query
def report_slots_sources(spark, sf):
    return options(times(spark, sf), "source")


@query
def report_slots_heatmap(spark, sf):
    return reports.slots_heatmap(times(spark, sf), START, END)


@query
def report_slots_by_hour(spark, sf):
    return reports.slots_by_hour(times(spark, sf), START, END, TWO_SOURCES, A.CHANNELS)


@query
def report_slots_by_weekday(spark, sf):
    return reports.slots_by_weekday(times(spark, sf), START, END)


def slot_sets(spark, sf):
    """Sets of booking numbers per slot, built in two runs."""
    path, numbering = work_dir(spark, "slot-sets"), Numbering(work_dir(spark, "numbers"), buckets=8)
    late = F.col("booking_date_local") > END
    for rows in (times(spark, sf).filter(~late), times(spark, sf).filter(late)):
        sets.refresh_slot_sets(rows, numbering, path)
    return load_table(spark, path, schemas.SLOT_SETS)


@query
def report_slots_heatmap_from_sets(spark, sf):
    return reports.slots_heatmap(slot_sets(spark, sf), START, END)


@query
def report_slots_by_hour_from_sets(spark, sf):
    return reports.slots_by_hour(slot_sets(spark, sf), START, END, TWO_SOURCES, A.CHANNELS)


# Report tab 6

def meetings(spark, sf):
    return gold.meeting_features(A.bookings(spark, sf))


@query
def report_load_range(spark, sf):
    return date_bounds(meetings(spark, sf), "week_start_date")


@query
def report_load_employees(spark, sf):
    return options(meetings(spark, sf), "employee_id")


@query
def report_load_by_employee(spark, sf):
    return reports.load_by_employee(meetings(spark, sf), WEEKS[0], "2024-01-29")


@query
def report_load_by_employee_integer(spark, sf):
    return reports.load_by_employee(meetings(spark, sf), integer=True)


@query
def report_load_by_employee_selected(spark, sf):
    return reports.load_by_employee(meetings(spark, sf), WEEKS[0], WEEKS[1], EMPLOYEES, ALL_EMPLOYEES)


@query
def report_load_kpis(spark, sf):
    return reports.load_kpis(reports.load_by_employee(meetings(spark, sf), WEEKS[0], "2024-01-29"))


@query
def report_load_weekly(spark, sf):
    return reports.load_weekly(meetings(spark, sf), WEEKS[0], "2024-01-29")


@query
def report_load_by_employee_from_sets(spark, sf):
    path = work_dir(spark, "meeting-sets")
    sets.refresh_meeting_sets(meetings(spark, sf), Numbering(work_dir(spark, "numbers"), buckets=8), path)
    return reports.load_by_employee(load_table(spark, path, schemas.MEETING_SETS), WEEKS[0], "2024-01-29")


# Column functions

@query
def text_functions(spark, sf):
    rows = A.bookings(spark, sf)
    return rows.select(
        "booking_id",
        present(F.col("channel")).alias("has_channel"),
        blank_to_null(F.col("utm_campaign")).alias("campaign"),
        campaign_label(F.col("utm_campaign")).alias("campaign_display"),
        display_label(F.col("channel")).alias("channel_display"),
    ).distinct()


@query
def time_functions(spark, sf):
    local = A.bookings(spark, sf).withColumn("local", T.local_time(F.col("scheduled_event_start")))
    return local.select(
        "booking_id",
        "local",
        F.to_date("local").alias("local_date"),
        T.week_start(F.col("local")).alias("week_start"),
        F.hour("local").alias("hour_of_day"),
        T.iso_weekday(F.col("local")).alias("dow_num"),
        T.weekday_name(F.col("local")).alias("dow_name"),
        F.date_sub(F.to_date("dt"), 1).alias("day_before"),
    )
