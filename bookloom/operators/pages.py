"""Cross tables with any number of columns: cells in long form with numbered columns, and wide blocks of a fixed width.

A plain pivot names its columns in the plan, so Spark limits them, and a plan of 20,000 columns would not run anyway. Here
the headings are rows of a table of their own; a page is one row per line and block of `width` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.session import work_dir

PAGE, SLOT, PLACE = "page", "slot", "place"


def headings(df: DataFrame, column: str, width: int) -> DataFrame:
    """(heading, place, page, slot): the distinct non-null values of a column in order, numbered from 0.

    Sorted by ranges over many tasks and written once; where each task's numbers begin follows from the number of headings
    in the tasks before it, one row each on the driver.
    """
    spark = df.sparkSession
    path = work_dir(spark, "headings")
    names = df.select(F.col(column).cast("string").alias("heading")).where("heading IS NOT NULL").distinct()
    ordered = names.repartitionByRange("heading").sortWithinPartitions("heading")
    ordered.select("heading", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")).write.parquet(path)
    written = spark.read.schema("heading string, part int, at bigint").parquet(path)
    starts, total = [], 0
    for part, size in sorted(tuple(r) for r in written.groupBy("part").count().collect()):
        starts.append((part, total))
        total += size
    begins = spark.createDataFrame(starts, "part int, start bigint")
    place = F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)
    return written.join(F.broadcast(begins), "part").select(
        "heading", place.alias(PLACE), F.floor(place / width).alias(PAGE), (place % width).cast("int").alias(SLOT))


def cells(df: DataFrame, row: str, column: str, value: str, agg: str) -> DataFrame:
    """(row, heading, value): one row per cell that occurs. `agg` is "avg" or "sum"."""
    return df.where(F.col(column).isNotNull()).groupBy(row, F.col(column).cast("string").alias("heading")).agg(
        {"avg": F.avg, "sum": F.sum}[agg](value).alias("value"))


def paged(long: DataFrame, names: DataFrame, row: str, width: int, fill: float | None = None) -> DataFrame:
    """Wide blocks (row, page, c0 .. c<width - 1>) of the cells. A line without any cell on a page has no block there; cells
    missing from a block are null or `fill`."""
    slots = range(width)
    wide = long.join(names.select("heading", PAGE, SLOT), "heading").groupBy(row, PAGE).pivot(SLOT, list(slots)).agg(F.first("value"))
    for slot in slots:
        wide = wide.withColumnRenamed(str(slot), f"c{slot}")
    return wide.na.fill(fill, subset=[f"c{s}" for s in slots]) if fill is not None else wide


def page_of(wide: DataFrame, names: DataFrame, number: int) -> DataFrame:
    """One page with its headings as column names, as the front end shows it; at most one page of names comes to the driver."""
    here = {r[SLOT]: r["heading"] for r in names.where(F.col(PAGE) == number).select(SLOT, "heading").collect()}
    return wide.where(F.col(PAGE) == number).select(wide.columns[0], *[F.col(f"c{s}").alias(h) for s, h in sorted(here.items())])
