"""Many small webhook objects brought together in few files, and what has been taken in already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions import times as T
from bookloom.functions.webhooks import UNKNOWN_EVENT
from bookloom.operators.selection import aside, same_key
from bookloom.sinks.tables import write_table
from bookloom.sources.tables import load_or_empty, path_exists
from bookloom.sources.webhooks import parse_bronze

COMPACTED = schemas.TableLayout(
    "bronze_compacted", "body string, object string, written_at timestamp, dt string, event string", ("dt", "event"))


def _day() -> Column:
    return F.regexp_extract("object", r"/dt=([^/]+)/", 1)


def _event() -> Column:
    """The folder between the day and the object, if there is one."""
    name = F.regexp_extract("object", r"/dt=[^/]+/([^/]+)/[^/]+$", 1)
    return F.coalesce(F.nullif(F.url_decode(name), F.lit("")), F.lit(UNKNOWN_EVENT))


def _folders(spark: SparkSession, root: str, start: T.Day, end: T.Day) -> list[str]:
    folders = [f"{root.rstrip('/')}/dt={day}" for day in T.date_range(start, end)]
    return [f for f in folders if path_exists(spark, f)]


def objects(spark: SparkSession, root: str, start: T.Day, end: T.Day) -> DataFrame:
    """(object, written_at) of the webhook objects of these days; only listed, not read."""
    folders = _folders(spark, root, start, end)
    if not folders:
        return spark.createDataFrame([], "object string, written_at timestamp")
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders).select(
        F.col("_metadata.file_path").alias("object"), F.col("_metadata.file_modification_time").alias("written_at"))


def compact(spark: SparkSession, root: str, path: str, start: T.Day, end: T.Day) -> int:
    """Add the objects of these days that the compacted table does not hold yet; returns how many.

    The table names the object behind every row and is its own list of what was taken in: two narrow columns of these
    days. An object that was written anew since is taken in again, and `read_compacted` prefers it. Files get as many rows as
    fill them, whatever the number of objects. The time of the earliest new object is stated on the file's own data, so files
    written before are not opened. A second run adds nothing.
    """
    key = ["object", "written_at"]
    days = T.in_days(F.col("dt"), start, end)
    held = load_or_empty(spark, path, COMPACTED).where(days).select(*key).distinct()
    new = objects(spark, root, start, end).join(aside(held, key), same_key(key), "left_anti")
    found = new.agg(F.count("*").alias("n"), F.min("written_at").alias("first")).first()
    if not found["n"]:
        return 0
    lines = spark.read.option("recursiveFileLookup", True).text(_folders(spark, root, start, end)).where(
        F.col("_metadata.file_modification_time") >= F.lit(found["first"])).select(
        F.col("value").alias("body"), F.col("_metadata.file_path").alias("object"), F.col("_metadata.file_modification_time").alias("written_at"))
    rows = lines.join(aside(held, key), same_key(key), "left_anti").withColumns({"dt": _day(), "event": _event()})
    write_table(rows.select(*COMPACTED.columns), path, COMPACTED.by)
    return found["n"]


def read_compacted(spark: SparkSession, path: str, start: T.Day | None = None, end: T.Day | None = None) -> DataFrame:
    """The webhooks of these days, parsed, as `read_bronze` gives them; of an object taken in more than once the last state."""
    rows = load_or_empty(spark, path, COMPACTED).where(T.in_days(F.col("dt"), start, end))
    last = rows.groupBy("object").agg(F.max("written_at").alias("last"), F.min("written_at").alias("earliest")).where("last <> earliest")
    outdated = aside(last, ["object"], "last")
    current = rows.join(outdated, same_key(["object"]) & (F.col("written_at") < F.col("last")), "left_anti")
    return parse_bronze(current.where("body <> ''"))
