"""Webhook envelopes and stored webhook bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions.times import Day, date_range, in_days
from bookloom.sources.tables import path_exists


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes (body, is_base64, received_at) from JSON lines."""
    return spark.read.schema(schemas.ENVELOPE).json(path)


def stream_envelopes(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same as a stream over the files of a folder."""
    reader = spark.readStream.schema(schemas.ENVELOPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def read_bronze(spark: SparkSession, root: str, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Webhook JSON stored as `dt=<day>/<event>/<id>.json`, parsed.

    With both bounds only the folders of these days are listed, however many the store holds; a day without a folder
    gives no rows. `dt` stays text because the schema names it.
    """
    reader = spark.read.schema(schemas.WEBHOOK_BY_DAY).option("basePath", root)
    if start is None or end is None:
        return reader.json(root).filter(in_days(F.col("dt"), start, end))
    folders = [f"{root.rstrip('/')}/dt={day}" for day in date_range(start, end)]
    present = [folder for folder in folders if path_exists(spark, folder)]
    if not present:
        return spark.createDataFrame([], schemas.WEBHOOK_BY_DAY)
    return reader.json(present)


def parse_bronze(bronze: DataFrame) -> DataFrame:
    """Bodies of a bronze table (`body`, `dt`) parsed into the webhook columns; what does not fit is null."""
    parsed = bronze.select("dt", F.from_json("body", schemas.WEBHOOK).alias("webhook"))
    return parsed.select("webhook.*", "dt")
