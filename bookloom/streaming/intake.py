"""Streaming intake: envelopes arrive as files; each micro-batch is parsed once and dealt out to three tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bookloom import schemas
from bookloom.functions.times import on_any_day
from bookloom.plans.intake import KEY, dealt, later_rows, route_webhooks, staged, staged_rejects, staged_webhooks
from bookloom.sinks.tables import laid_out, partitions_in, remove_folder
from bookloom.sources.tables import load_table, path_exists

ONCE = {"availableNow": True}
BATCH = "batch"


def write_batch(rows: DataFrame, path: str, by: Sequence[str], batch: str) -> None:
    """Add a micro-batch's rows in partitions of its own, so that writing it again replaces them."""
    marked = rows.withColumn(BATCH, F.lit(batch))
    (laid_out(marked, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by, BATCH).parquet(path))


def stored_keys(spark: SparkSession, bronze_path: str, days: list[str], batch: str) -> DataFrame:
    """Keys that bronze holds on these days from other batches; no body is read."""
    if not days or not path_exists(spark, bronze_path):
        return spark.createDataFrame([], "dt string, event string, event_id string")
    table = spark.read.schema(schemas.BRONZE.ddl + f", {BATCH} string").parquet(bronze_path)
    return table.where(on_any_day(F.col("dt"), days) & (F.col(BATCH) != batch)).select(*KEY)


def take_in(batch_rows: DataFrame, batch: str, bronze_path: str, rejects_path: str, repeats_path: str, staging: str) -> None:
    """One micro-batch: staged, then dealt out. Running it again leaves the same rows (ids of events without URI are drawn
    anew only if it died before staging ended, and then none of them was stored)."""
    spark = batch_rows.sparkSession
    path = f"{staging}/{BATCH}={batch}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        staged(route_webhooks(batch_rows)).write.mode("overwrite").option("compression", "zstd").parquet(path)
    table = load_table(spark, path, schemas.STAGED)
    days = partitions_in(staged_webhooks(table), "dt")
    names = f"{staging}/later={batch}"  # decided once, for both tables
    later_rows(table, stored_keys(spark, bronze_path, days, batch)).write.mode("overwrite").parquet(names)
    first, later = dealt(table, spark.read.schema("row bigint").parquet(names))
    write_batch(later.select(*schemas.REPEATS.columns), repeats_path, schemas.REPEATS.by, batch)
    write_batch(first.select(*schemas.BRONZE.columns), bronze_path, schemas.BRONZE.by, batch)
    write_batch(staged_rejects(table), rejects_path, schemas.REJECTS.by, batch)
    remove_folder(spark, names)
    remove_folder(spark, path)


def start_intake(
    envelopes: DataFrame, bronze_path: str, rejects_path: str, repeats_path: str, checkpoint: str, trigger: dict | None = None,
) -> StreamingQuery:
    """Follow the envelopes: the first copy of each (day, event, id) goes to bronze, every later one to the repeats, what
    cannot be stored to the rejects.

    No state and no watermark: whether a key is known is asked of the days that a batch touches, in bronze itself, so a
    delivery may be as late as it likes and none is lost. `plans.intake.resolve` gives the last copies.
    """

    def deal_out(batch_rows: DataFrame, number: int) -> None:
        take_in(batch_rows, f"{number:012d}", bronze_path, rejects_path, repeats_path, f"{checkpoint}/staging")

    return (
        envelopes.writeStream.foreachBatch(deal_out).option("checkpointLocation", f"{checkpoint}/progress")
        .trigger(**(trigger or ONCE)).start())
