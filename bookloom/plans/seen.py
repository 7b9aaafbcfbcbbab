"""Distinct bookings per channel, kept up day by day without reading earlier days again.

A stored set holds every (channel, booking) once per day of receipt, bucketed by both, in three narrow columns. A run compares
one stretch of days with what the set holds for these days; only bookings that came or went are looked up in the other
days, bucket by bucket, and only the difference reaches the counters. Late bookings, repeated ids, days that were cleaned or
emptied since, and runs done twice all give what a full build would give.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions import times as T
from bookloom.plans.gold import cost_per_booking, with_channel
from bookloom.sinks import versions
from bookloom.sinks.catalog import escaped, quoted
from bookloom.sinks.tables import make_folder

MEMBERS = schemas.TableLayout("members", "channel string, booking string, dt string", ("dt",))
COUNTERS = schemas.TableLayout("counters", "channel string, members bigint, without_id bigint")
BY = ["channel", "booking"]


@dataclass(frozen=True)
class SeenSet:
    """The folder of one set. `buckets` is fixed when the set is first written: about one per GB that it will hold."""

    root: str
    buckets: int = 64

    @property
    def members(self) -> str:
        return f"{self.root.rstrip('/')}/members-{self.buckets}"

    @property
    def counters(self) -> str:
        return f"{self.root.rstrip('/')}/counters"


def booking_key() -> Column:
    """The id behind a mark, so that a row without one stays apart from the empty id."""
    return F.coalesce(F.concat(F.lit("="), F.col("booking_id")), F.lit(""))


def day_members(events: DataFrame, start: T.Day, end: T.Day) -> DataFrame:
    """(channel, booking, dt) once each for the days of receipt; a row without id keeps its channel."""
    rows = with_channel(events.filter(T.in_days(F.col("dt"), start, end)))
    return rows.select("channel", booking_key().alias("booking"), F.col("dt").cast("string").alias("dt")).distinct()


def members_table(spark: SparkSession, seen: SeenSet) -> str:
    """A catalog entry over the set's folder: only through the catalog does Spark know the buckets."""
    name = f"default.seen_{hashlib.sha256(seen.members.encode()).hexdigest()[:24]}"
    if not spark.catalog.tableExists(name):
        make_folder(spark, seen.members)
        spark.sql(
            f"CREATE TABLE {quoted(name)} ({MEMBERS.ddl}) USING parquet PARTITIONED BY (dt) "
            f"CLUSTERED BY ({', '.join(BY)}) INTO {seen.buckets} BUCKETS LOCATION '{escaped(seen.members)}'")
        spark.sql(f"MSCK REPAIR TABLE {quoted(name)}")
    return name


def replace_members(spark: SparkSession, table: str, rows: DataFrame, days: list[str], buckets: int) -> None:
    """Each day's part of the set becomes its rows; a day without rows is emptied. One file per bucket and day."""
    rows.repartition(buckets, *BY).createOrReplaceTempView("__seen_rows")
    for day in days:
        spark.sql(f"INSERT OVERWRITE TABLE {quoted(table)} PARTITION (dt = '{day}') "
                  f"SELECT channel, booking FROM __seen_rows WHERE dt = '{day}'")
    spark.catalog.refreshTable(table)


def build(spark: SparkSession, seen: SeenSet, events: DataFrame) -> DataFrame:
    """The set from all events, in one pass over three of their columns; returns the counters."""
    table = members_table(spark, seen)
    versions.publish(spark.createDataFrame([], COUNTERS.ddl), seen.counters)
    rows = with_channel(events).select("channel", booking_key().alias("booking"), F.col("dt").cast("string").alias("dt")).distinct()
    rows.repartition(seen.buckets, *BY).createOrReplaceTempView("__seen_rows")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "static")
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {quoted(table)} PARTITION (dt) SELECT channel, booking, dt FROM __seen_rows")
    finally:
        spark.conf.set(mode, before)
    spark.catalog.refreshTable(table)
    return publish_counters(spark, seen, recount(spark.table(table)))


def publish_counters(spark: SparkSession, seen: SeenSet, counters: DataFrame) -> DataFrame:
    versions.publish(counters, seen.counters)
    versions.drop_old(spark, seen.counters)
    return versions.load_current(spark, seen.counters, COUNTERS)


def recount(members: DataFrame) -> DataFrame:
    """The counters from the whole set."""
    return tally(members.select(*BY).distinct(), F.lit(1))


def tally(members: DataFrame, weight: Column) -> DataFrame:
    """Members of each channel added up, and those without id apart."""
    return members.groupBy("channel").agg(
        F.sum(weight).cast("long").alias("members"),
        F.sum(F.when(F.col("booking") == "", weight).otherwise(F.lit(0))).cast("long").alias("without_id"))


def difference(members: DataFrame, new: DataFrame, start: T.Day, end: T.Day, buckets: int) -> DataFrame:
    """How the counters change when `new` takes the place of the set's rows from `start` to `end`.

    A booking counts before if the set has it on any day, and after if it has it on another day or `new` has it. Bookings
    that stay on the replaced days are settled by comparing these days alone; the others are looked up elsewhere.
    """
    inside = T.in_days(F.col("dt"), start, end)
    sides = members.filter(inside).select(*BY, F.lit(1).alias("was"), F.lit(0).alias("is")).unionByName(
        new.select(*BY, F.lit(0).alias("was"), F.lit(1).alias("is")))
    changed = sides.groupBy(*BY).agg(F.max("was").alias("was"), F.max("is").alias("is")).where("was <> is")
    # The changed bookings are dealt out like the set and hashed, so that the set streams past in its buckets, neither
    # shuffled nor sorted.
    sought = changed.select(*BY).repartition(buckets, *BY).hint("shuffle_hash")
    elsewhere = members.filter(~inside).join(sought, BY).select(*BY).distinct()
    alone = changed.join(elsewhere, BY, "left_anti")
    return tally(alone, F.col("is") - F.col("was"))


def update(spark: SparkSession, seen: SeenSet, events: DataFrame, start: T.Day, end: T.Day) -> DataFrame:
    """Bring the set up to the events received from `start` to `end`; returns the counters. The first run builds the set.

    Empty counters are published before the set changes and say that it may be half-way; a run that finds them, because
    the one before died, counts the set anew. Everything else can be repeated without harm.
    """
    if versions.current(spark, seen.counters) is None:
        return build(spark, seen, events)
    days = [str(d) for d in T.date_range(start, end)]
    table = members_table(spark, seen)
    spark.catalog.refreshTable(table)
    known = versions.load_current(spark, seen.counters, COUNTERS).collect()  # one row per channel
    new = day_members(events, start, end)
    if known:
        change = difference(spark.table(table), new, start, end, seen.buckets).collect()
        versions.publish(spark.createDataFrame([], COUNTERS.ddl), seen.counters)
    replace_members(spark, table, new, days, seen.buckets)
    if not known:
        return publish_counters(spark, seen, recount(spark.table(table)))
    counters = spark.createDataFrame(known + change, COUNTERS.ddl).groupBy("channel").agg(
        F.sum("members").alias("members"), F.sum("without_id").alias("without_id")).where("members > 0")
    return publish_counters(spark, seen, counters)


def bookings_per_channel(counters: DataFrame) -> DataFrame:
    """(channel, bookings) as a distinct count over all events would give."""
    return counters.select("channel", (F.col("members") - F.col("without_id")).alias("bookings"))


def publish_cpb(counters: DataFrame, spend: DataFrame, path: str) -> str:
    """A new version of the table from the counters and the spend, which has one row per day and channel."""
    rows = cost_per_booking(bookings_per_channel(counters), spend)
    version = versions.publish(rows.select(*schemas.CPB.columns), path)
    versions.drop_old(counters.sparkSession, path)
    return version


def build_cpb(events: DataFrame, spend: DataFrame, seen: SeenSet, path: str) -> str:
    """The set and the table from all rows."""
    return publish_cpb(build(events.sparkSession, seen, events), spend, path)


def refresh_cpb(
    events: DataFrame, spend: DataFrame, seen: SeenSet, path: str, start: T.Day, end: T.Day,
) -> str:
    """The table after the days from `start` to `end`: reads these days of the events, the narrow set and the spend, and
    publishes a new version. Readers keep the version before until then. Returns the version's folder."""
    return publish_cpb(update(events.sparkSession, seen, events, start, end), spend, path)
