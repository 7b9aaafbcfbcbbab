"""Running totals in two levels, so that a late booking does not change every later day.

Each block (a month, or a week) holds the running totals inside itself, and one total per source. A day's total over all time
is the totals of the blocks before plus the one inside its block. A late booking rewrites its block and that block's
totals; all other blocks stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions import times as T
from bookloom.operators.running import running_sum
from bookloom.plans.gold import daily_by_source
from bookloom.sinks.tables import overwrite_partitions, partitions_in, write_table
from bookloom.sources.tables import load_or_empty

BLOCKS = schemas.TableLayout("cumulative_blocks", "source string, bookings bigint, inside bigint, dt date, block string", ("block",))
TOTALS = schemas.TableLayout("cumulative_block_totals", "source string, bookings bigint, block string", ("block",))


def block_of(day: Column, period: str) -> Column:
    """The block of a day, named by its first day."""
    return F.date_format(F.date_trunc(period, day), "yyyy-MM-dd")


def fill(daily: DataFrame, period: str) -> DataFrame:
    """Daily counts (source, dt, bookings) with the running total inside each block; one window group is a source's block."""
    rows = daily.withColumn("block", block_of(F.col("dt"), period)).withColumn("part", F.struct("source", "block"))
    return running_sum(rows, "part", "dt", "bookings", "inside").select(*BLOCKS.columns)


def add_up(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("source", "block").agg(F.sum("bookings").alias("bookings")).select(*TOTALS.columns)


def build_blocks(events: DataFrame, path: str, totals_path: str, period: str = "month") -> None:
    write_table(fill(daily_by_source(events), period), path, BLOCKS.by, mode="overwrite")
    write_table(add_up(load_or_empty(events.sparkSession, path, BLOCKS)), totals_path, TOTALS.by, mode="overwrite")


def refresh_blocks(events: DataFrame, path: str, totals_path: str, start: T.Day, end: T.Day, period: str = "month") -> list[str]:
    """Bring the blocks up to the events received from `start` to `end`; returns the blocks written.

    Reads these days of the events, and the stored rows of the blocks that the days lie in. At most as many blocks are
    rewritten as the days touch, however many follow. Blocks first, then their totals; a second run changes nothing.
    """
    spark = events.sparkSession
    days = [F.lit(str(d)).cast("date") for d in T.date_range(start, end)]
    touched = partitions_in(spark.range(1).select(F.explode(F.array(*days)).alias("d")).select(block_of(F.col("d"), period).alias("block")), "block")
    scope = F.col("block").isin(touched)
    kept = load_or_empty(spark, path, BLOCKS).filter(scope & ~T.in_days(F.col("dt"), start, end)).select("source", "dt", "bookings")
    new = daily_by_source(events.filter(T.in_days(F.col("dt"), start, end))).select("source", "dt", "bookings")
    written = overwrite_partitions(fill(kept.unionByName(new), period), path, "block", scope)
    overwrite_partitions(add_up(load_or_empty(spark, path, BLOCKS).filter(scope)), totals_path, "block", scope)
    return written


def cumulative(blocks: DataFrame, totals: DataFrame, start: T.Day | None = None, end: T.Day | None = None, period: str = "month") -> DataFrame:
    """The table of running totals from the two levels, for all days or some: only the blocks of these days are opened.

    The totals have one row per source and block; their own running sums are what comes before each block.
    """
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("source", "block", F.coalesce(F.sum("bookings").over(before), F.lit(0)).alias("before"))
    rows = blocks.filter(T.in_days(F.col("dt"), start, end))
    if start is not None:
        rows = rows.filter(F.col("block") >= block_of(F.lit(T.iso(start)).cast("date"), period))
    if end is not None:
        rows = rows.filter(F.col("block") <= T.iso(end))
    return rows.join(offsets, ["source", "block"]).select(
        "source", "bookings", (F.col("before") + F.col("inside")).alias("cumulative_bookings"), "dt").select(*schemas.CUMULATIVE.columns)
