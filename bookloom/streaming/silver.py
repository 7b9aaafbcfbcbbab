"""Streaming silver build: a micro-batch adds its new events and rewrites only the parts that hold an older copy."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bookloom import schemas
from bookloom.functions.times import on_any_day
from bookloom.operators.selection import aside, same_key, with_key_in
from bookloom.plans import ranges
from bookloom.plans.intake import KEY, latest_copies, resolve
from bookloom.plans.silver import SORT_EVENTS_BY, flatten_events
from bookloom.sinks.tables import laid_out, make_folder, overwrite_partitions, partitions_in, remove_folder
from bookloom.sources.tables import load_or_empty, load_table
from bookloom.sources.webhooks import parse_bronze
from bookloom.streaming.intake import BATCH, ONCE


def rebuild_days(
    spark: SparkSession, bronze_path: str, silver_path: str, days: list[str], channel_map: dict[str, str] | None = None,
    ranges_path: str | None = None, repeats_path: str | None = None,
) -> list[str]:
    """Silver events of whole days from bronze, repeated deliveries resolved. A second run changes nothing.

    Also the batch run that replays stored bronze, for example after a change of the channel mapping. With `repeats_path`
    bronze holds first copies and that table the later ones. With `ranges_path` the time ranges of these days are recorded
    there.
    """
    chosen = on_any_day(F.col("dt"), days)
    bronze = load_table(spark, bronze_path, schemas.BRONZE).filter(chosen)
    if repeats_path is None:
        last = latest_copies(bronze)
    else:
        last = resolve(bronze, load_or_empty(spark, repeats_path, schemas.REPEATS).filter(chosen))
    return write_days(spark, flatten_events(parse_bronze(last), channel_map), silver_path, days, ranges_path)


def write_days(spark: SparkSession, events: DataFrame, silver_path: str, days: list[str], ranges_path: str | None = None) -> list[str]:
    """Replace whole days of the silver table, and their recorded ranges."""
    chosen = on_any_day(F.col("dt"), days)
    if ranges_path is not None:
        ranges.forget(spark, ranges_path, chosen)
    written = overwrite_partitions(events, silver_path, "dt", chosen, sort_by=SORT_EVENTS_BY)
    if ranges_path is not None:
        ranges.record(spark, silver_path, ranges_path, chosen)
    return written


def settle_days(
    spark: SparkSession, live_path: str, silver_path: str, days: list[str], ranges_path: str | None = None,
) -> list[str]:
    """Copy days of the live table into the silver table, in few well-ordered files; nothing is parsed or compared."""
    live = load_table(spark, live_path, schemas.LIVE_EVENTS).filter(on_any_day(F.col("dt"), days))
    return write_days(spark, live.select(*schemas.EVENTS.columns), silver_path, days, ranges_path)


def write_parts(rows: DataFrame, path: str) -> None:
    (laid_out(rows.select(*schemas.LIVE_EVENTS.columns), schemas.LIVE_EVENTS.by, sort_by=SORT_EVENTS_BY)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*schemas.LIVE_EVENTS.by).parquet(path))


def live_events(copies: DataFrame, channel_map: dict[str, str] | None, part: str) -> DataFrame:
    """Bronze rows as rows of the live table."""
    parsed = copies.select(*KEY, "received_at", F.from_json("body", schemas.WEBHOOK).alias("webhook"))
    flat = flatten_events(parsed.select("webhook.*", "dt", F.struct(*KEY, "received_at").alias("delivery")), channel_map, keep=["delivery"])
    return flat.select("*", *[F.col(f"delivery.{c}").alias(c) for c in ("event", "event_id", "received_at")], F.lit(part).alias("part"))


def rewrite_parts(rows: DataFrame, path: str, parts: list[tuple[str, str]]) -> None:
    """Each (day, part) becomes its rows; one without rows is emptied. `rows` may read them."""
    written = {(r["dt"], r["part"]) for r in rows.select("dt", "part").distinct().collect()}  # narrow, and before the write
    write_parts(rows, path)
    empty = rows.sparkSession.createDataFrame([], rows.drop("dt", "part").schema)
    for dt, part in parts:
        if (dt, part) not in written:
            empty.write.mode("overwrite").parquet(f"{path.rstrip('/')}/dt={dt}/part={part}")


def fold_in(
    spark: SparkSession, arrived: DataFrame, live_path: str, part: str, staging: str,
    copies_of: Callable[[DataFrame, list[str]], DataFrame], channel_map: dict[str, str] | None = None,
) -> tuple[list[str], list[tuple[str, str]]]:
    """Bring deliveries (bronze rows) into the live table as its part `part`; returns the touched days and the rewritten
    (day, part)s.

    The index is the live table itself: key, time and part of its rows on the touched days, five narrow columns. A new key
    is added. A newer copy is added, and the part that holds the older one is rewritten without it. An older copy is left
    out. Where times are equal the contents decide: `copies_of(keys, days)` gives all deliveries of these keys.
    Readers between the two writes may see a repeated event twice, never not at all. A second run changes nothing.
    """
    days = partitions_in(arrived, "dt")
    if not days:
        return [], []
    last = latest_copies(arrived.where("dt IS NOT NULL"))
    live = load_or_empty(spark, live_path, schemas.LIVE_EVENTS).filter(on_any_day(F.col("dt"), days) & (F.col("part") != part))
    new = aside(last.withColumn("new_at", F.col("received_at")), KEY, "new_at")
    met = live.select(*KEY, "received_at", "part").join(new, same_key(KEY)).select(*KEY, "received_at", "new_at", "part")
    met.write.mode("overwrite").parquet(staging)
    met = spark.read.schema(met.schema).parquet(staging)
    newer, older = (met.where(f"new_at {sign} received_at").select(*KEY) for sign in "><")
    tied = met.where("new_at = received_at").select(*KEY)
    if not tied.isEmpty():
        best = latest_copies(copies_of(tied, days)).select(*KEY, "body")
        won = with_key_in(with_key_in(last.select(*KEY, "body"), tied, KEY), best, [*KEY, "body"]).select(*KEY)
        newer, older = newer.unionByName(won), older.unionByName(with_key_in(tied, won, KEY, inside=False))
    parts = sorted(tuple(r) for r in with_key_in(met, newer, KEY).select("dt", "part").distinct().collect())
    write_parts(live_events(with_key_in(last, older, KEY, inside=False), channel_map, part), live_path)
    if parts:
        held = reduce(Column.__or__, [(F.col("dt") == dt) & (F.col("part") == old) for dt, old in parts])
        here = load_table(spark, live_path, schemas.LIVE_EVENTS).filter(held)
        rewrite_parts(with_key_in(here, newer, KEY, inside=False), live_path, parts)
    remove_folder(spark, staging)
    return days, parts


def start_silver(
    spark: SparkSession, bronze_path: str, repeats_path: str, live_path: str, checkpoint: str, trigger: dict | None = None,
    channel_map: dict[str, str] | None = None, max_files: int | None = None,
    on_days: Callable[[list[str]], None] | None = None,
) -> StreamingQuery:
    """Follow bronze and the repeats into the live table; `on_days` hears of the days that each micro-batch touched."""

    def deliveries(path: str) -> DataFrame:
        make_folder(spark, path)
        reader = spark.readStream.schema(f"{schemas.BRONZE.ddl}, {BATCH} string")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(path).select(*schemas.BRONZE.columns)

    def copies_of(keys: DataFrame, days: list[str]) -> DataFrame:
        chosen = on_any_day(F.col("dt"), days)
        stored = [load_table(spark, path, schemas.BRONZE).filter(chosen) for path in (bronze_path, repeats_path)]
        return with_key_in(stored[0].unionByName(stored[1]), keys, KEY)

    def fold(batch: DataFrame, number: int) -> None:
        days, _ = fold_in(spark, batch, live_path, f"{number:012d}", f"{checkpoint}/staging/{number:012d}", copies_of, channel_map)
        if on_days is not None and days:
            on_days(days)

    both = deliveries(bronze_path).unionByName(deliveries(repeats_path))
    return (
        both.writeStream.foreachBatch(fold).option("checkpointLocation", f"{checkpoint}/progress")
        .trigger(**(trigger or ONCE)).start())
