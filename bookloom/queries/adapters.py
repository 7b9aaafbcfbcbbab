"""Bookings, ad spend and webhooks derived from the given `events` table (30 days from 2024-01-01).

`k` is the number in `props`; it spreads the edge cases (missing values, blanks, broken input) over the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom.functions.webhooks import CHANNEL_OF_EVENT_TYPE
from bookloom.session import work_dir

FACEBOOK, YOUTUBE, TIKTOK = "facebook_paid_ads", "youtube_paid_ads", "tiktok_paid_ads"
CHANNELS = [FACEBOOK, YOUTUBE, TIKTOK]
CAMPAIGNS = ["(none)", "cmp_3", "cmp_4"]
TYPE_ID = {channel: type_id for type_id, channel in CHANNEL_OF_EVENT_TYPE.items()}
API = "https://api.example.com"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_k(spark.read.parquet(f"{sf_dir}/events.parquet"))


def with_k(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "k": F.get_json_object("props", "$.k").cast("int"), "at": F.col("ts").cast("timestamp")})


# A webhook body takes some fifty times the bytes of its row in the table, so splits of the table are too large for one task.
ROWS_A_TASK = 200_000


def spread(rows: DataFrame) -> DataFrame:
    """Use every core when the input is one small file, and no task for more rows than fit it as webhook bodies; the rows
    are still narrow here."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_A_TASK))
    return rows.repartition(tasks) if rows.rdd.getNumPartitions() < tasks else rows


def seconds_later(column: str, seconds: int) -> Column:
    return F.col(column) + F.make_interval(secs=F.lit(seconds))


def pick(column: str, choices: dict, otherwise: str | None = None) -> Column:
    chosen = F.lit(otherwise)
    for value, result in choices.items():
        chosen = F.when(F.col(column) == value, F.lit(result)).otherwise(chosen)
    return chosen


def label(prefix: str, number: str) -> Column:
    return F.concat(F.lit(prefix), F.expr(number).cast("string"))


def channel() -> Column:
    return pick("event_type", {"click": FACEBOOK, "view": YOUTUBE, "purchase": TIKTOK, "signup": "  "})


def campaign() -> Column:
    remainder = F.col("k") % 5
    return (
        F.when(remainder == 1, F.lit("")).when(remainder == 2, F.lit("  "))
        .when(remainder == 3, F.lit("cmp_3")).when(remainder == 4, F.lit(" cmp_4 ")))


def status() -> Column:
    remainder = F.col("k") % 10
    return (
        F.when(remainder == 0, F.lit("canceled")).when(remainder == 1, F.lit("cancelled"))
        .when(remainder != 2, F.lit("active")))


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver events, as far as the reporting tables read them."""
    return events(spark, sf_dir).select(
        label("b", "event_id div 2").alias("booking_id"),
        label("s", "event_id div 3").alias("scheduled_event_id"),
        channel().alias("channel"),
        campaign().alias("utm_campaign"),
        F.when(F.col("k") != 7, F.col("at")).alias("booking_created_at"),
        seconds_later("at", 30).alias("webhook_received_at"),
        seconds_later("at", 26 * 3600).alias("scheduled_event_start"),
        F.when(F.col("user_id") % 12 == 0, F.lit(" ")).otherwise(label("emp", "user_id % 12")).alias("organizer_email"),
        status().alias("invitee_status"),
        F.date_format("at", "yyyy-MM-dd").alias("dt"),
    )


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver spend: one amount per day and channel; TikTok has none on even days of the month."""
    rows = events(spark, sf_dir).select(
        F.date_format("at", "yyyy-MM-dd").alias("dt"), channel().alias("channel"),
        F.col("value").cast("decimal(18,2)").alias("amount"))
    named = rows.filter(F.col("channel").isin(CHANNELS)).filter(
        (F.col("channel") != TIKTOK) | (F.day("dt") % 2 == 1))
    return named.groupBy("dt", "channel").agg(F.sum("amount").cast("double").alias("spend"))


def spend_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend records as files hold them: every event is a record of one of three files, some are broken."""
    return events(spark, sf_dir).select(
        F.when(F.col("k") != 8, F.date_format("at", "yyyy-MM-dd")).alias("date"),
        channel().alias("channel"),
        F.when(F.col("k") == 7, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("spend"),
        F.concat(F.lit("spend_data_2024-02-0"), (F.col("k") % 3 + 1).cast("string"), F.lit(".json"))
        .alias("source_file"),
    )


def event_type_url() -> Column:
    known = {"click": TYPE_ID[FACEBOOK], "view": TYPE_ID[YOUTUBE], "purchase": TYPE_ID[TIKTOK]}
    return F.concat(F.lit(f"{API}/event_types/"), pick("event_type", known, "other"))


def webhook_json(rows: DataFrame) -> Column:
    """The webhook body of an event as JSON text."""
    written = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    meeting = label(f"{API}/scheduled_events/S", "event_id div 3")
    invitee = F.concat(meeting, label("/invitees/B", "event_id div 2"))
    starts = F.date_format(seconds_later("at", 26 * 3600), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    employee = label("emp", "user_id % 12")
    members = F.when(F.col("user_id") % 12 == 0, F.array().cast(
        "array<struct<user_email:string,user_name:string,user:string>>")).otherwise(F.array(F.struct(
            employee.alias("user_email"), F.upper(employee).alias("user_name"),
            F.concat(F.lit(f"{API}/users/"), employee).alias("user"))))
    return F.to_json(F.struct(
        F.when(F.col("k") == 12, F.lit("")).when(F.col("event_type") == "error", F.lit("invitee.canceled"))
        .when(F.col("event_type") != "signup", F.lit("invitee.created")).alias("event"),
        written.alias("created_at"),
        F.lit(f"{API}/users/owner").alias("created_by"),
        F.struct(
            F.when(F.col("k") == 8, F.concat(invitee, F.lit("/x"))).when(~F.col("k").isin(9, 10), invitee).alias("uri"),
            F.when(F.col("k") == 7, F.lit("not a time")).otherwise(written).alias("created_at"),
            label("User.", "user_id").alias("email"),
            label("Name ", "user_id").alias("name"),
            status().alias("status"),
            F.lit("America/New_York").alias("timezone"),
            (F.col("k") % 2 == 0).alias("rescheduled"),
            F.struct(
                F.when(F.col("k") != 10, meeting).alias("uri"),
                event_type_url().alias("event_type"),
                starts.alias("start_time"),
                F.lit("Intro call").alias("name"),
                F.struct(F.lit("zoom").alias("type"), F.lit(f"{API}/join").alias("join_url")).alias("location"),
                members.alias("event_memberships"),
            ).alias("scheduled_event"),
            F.struct(campaign().alias("utm_campaign"), F.col("event_type").alias("utm_source")).alias("tracking"),
        ).alias("payload"),
    ))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored webhook bodies by day of receipt, one per event."""
    rows = spread(events(spark, sf_dir))
    return rows.select(
        F.date_format(seconds_later("at", 30), "yyyy-MM-dd").alias("dt"), webhook_json(rows).alias("body"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes as they arrive: some in base64, some broken, some no JSON, some no object, some empty."""
    rows = spread(events(spark, sf_dir))
    k, body = F.col("k"), webhook_json(rows)
    return rows.select(
        F.when(k == 3, F.lit("[1, 2]")).when(k == 4, label("junk ", "event_id")).when(k == 5, F.base64(body.cast("binary")))
        .when(k == 6, F.lit("abc")).when(k != 11, body).alias("body"),
        k.isin(5, 6).alias("is_base64"),
        seconds_later("at", 30).alias("received_at"),
    )


def landed_envelopes(spark: SparkSession, sf_dir: str) -> str:
    """Envelopes written as compressed JSON lines to the shared folder, `ROWS_A_TASK` a file; returns their path."""
    path = work_dir(spark, "landed")
    envelopes(spark, sf_dir).write.option("compression", "gzip").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    return path


def stored_webhooks(spark: SparkSession, sf_dir: str) -> str:
    """Webhook JSON in folders by day of receipt; returns the root."""
    root = work_dir(spark, "stored")
    bronze(spark, sf_dir).write.partitionBy("dt").text(root)
    return root


SPEND_FILES = ["2024-02-01", "2024-02-02", "2024-02-03"]


def spend_files(spark: SparkSession, sf_dir: str) -> str:
    """Three spend files, each one JSON array with a record per day and channel; returns their folder.

    The first has all days, each later one only the days from its number on, with its own amounts.
    """
    root = work_dir(spark, "spend-files")
    rows = events(spark, sf_dir).withColumn("channel", channel())
    for n, label_of_file in enumerate(SPEND_FILES):
        records = rows.filter((F.col("k") % 3 == n) & (F.day("at") > 5 * n)).groupBy(
            F.date_format("at", "yyyy-MM-dd").alias("date"), "channel").agg(
            F.sum(F.col("value").cast("decimal(18,2)")).cast("string").alias("spend"))
        # At most one record per day and channel, so the array stays short.
        array = records.agg(F.to_json(F.collect_list(F.struct("date", "channel", "spend"))).alias("value"))
        array.write.text(f"{root}/spend_data_{label_of_file}.json")
    return root


def spend_arrays(spark: SparkSession, sf_dir: str) -> str:
    """The spend records as three files with one event a record, as inside an array, and braces and quotes inside a text;
    returns their folder."""
    root = work_dir(spark, "spend-arrays")
    rows = spend_records(spark, sf_dir).withColumn("note", F.lit('a "}" and {'))
    for n in range(1, 4):
        name = f"spend_data_2024-02-0{n}.json"
        lines = rows.where(F.col("source_file") == name).select(F.to_json(F.struct("date", "channel", "spend", "note")).alias("value"))
        lines.coalesce(1).write.option("lineSep", ",\n").text(f"{root}/{name}")
    return root
