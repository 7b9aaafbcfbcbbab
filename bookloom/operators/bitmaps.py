"""Exact distinct counts that can be added up: ids are numbered once, and each group keeps the set of its numbers as bitmaps.

A distinct count over a range of days cannot be had from the days' counts. It can from their sets: the union of stored
bitmaps, 4 KB for 32,768 numbers, replaces reading the ids again. Ids get consecutive numbers in the order in which runs meet
them, so those of one day lie close together and fill few bitmaps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom.schemas import TableLayout
from bookloom.sinks import versions
from bookloom.sinks.catalog import escaped, quoted
from bookloom.sinks.tables import make_folder, remove_folder

NUMBERS = TableLayout("numbers", "id string, number bigint")
NEXT = TableLayout("next", "number bigint")
BUCKET, BITS = "bucket", "bits"


@dataclass(frozen=True)
class Numbering:
    """The folder in which ids have their numbers, bucketed by id. `buckets` is fixed when it is first written."""

    root: str
    buckets: int = 64

    def folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def numbers_table(spark: SparkSession, numbering: Numbering) -> str:
    """A catalog entry over the folder: only through the catalog does Spark know the buckets."""
    path = numbering.folder(f"numbers-{numbering.buckets}")
    name = f"default.numbers_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    if not spark.catalog.tableExists(name):
        make_folder(spark, path)
        spark.sql(f"CREATE TABLE {quoted(name)} ({NUMBERS.ddl}) USING parquet "
                  f"CLUSTERED BY (id) INTO {numbering.buckets} BUCKETS LOCATION '{escaped(path)}'")
    return name


def extend(numbering: Numbering, ids: DataFrame) -> None:
    """Give numbers to the ids (a column `id`) that have none yet.

    The new ids are written by bucket first; where each bucket's numbers begin follows from the sizes of the buckets
    before it, one row each on the driver. The range is reserved before it is used: a run that dies leaves a gap, never a
    number given twice. One run at a time.
    """
    spark = ids.sparkSession
    table = numbers_table(spark, numbering)
    spark.catalog.refreshTable(table)
    wanted = ids.select("id").where("id IS NOT NULL").distinct().repartition(numbering.buckets, "id").hint("shuffle_hash")
    # the wanted ids are the hashed side: the numbered ones stream past in their buckets
    known = spark.table(table).join(wanted, "id").select("id")
    new = wanted.join(known, "id", "left_anti").repartition(numbering.buckets, "id")
    staging = numbering.folder("staging")
    new.select("id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")).write.mode("overwrite").parquet(staging)
    staged = spark.read.schema("id string, part int, place bigint").parquet(staging)
    sizes = sorted(tuple(r) for r in staged.groupBy("part").count().collect())
    if sizes:
        reserved = versions.load_current(spark, numbering.folder("next"), NEXT).collect()
        first = start = reserved[0]["number"] if reserved else 1
        starts = {}
        for part, size in sizes:
            starts[part], start = start, start + size
        versions.publish(spark.createDataFrame([(start,)], NEXT.ddl), numbering.folder("next"))
        versions.drop_old(spark, numbering.folder("next"))
        begins = spark.createDataFrame(list(starts.items()), "part int, start bigint")
        # the upper bits of a place name its task, the lower 33 count inside it
        numbered = staged.join(F.broadcast(begins), "part").select("id", (F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("number"))
        numbered.repartition(numbering.buckets, "id").createOrReplaceTempView("__numbered")
        spark.sql(f"INSERT INTO {quoted(table)} SELECT id, number FROM __numbered")
        spark.catalog.refreshTable(table)
        assert start > first
    remove_folder(spark, staging)


def numbered(numbering: Numbering, df: DataFrame, id_column: str) -> DataFrame:
    """The rows with the `number` of their id, null where the id is."""
    spark = df.sparkSession
    rows = df.withColumnRenamed(id_column, "id").repartition(numbering.buckets, "id").hint("shuffle_hash")
    return spark.table(numbers_table(spark, numbering)).join(rows, "id", "right").drop("id")


def sketch(df: DataFrame, keys: Sequence[str], number: str = "number") -> DataFrame:
    """The set of numbers of each group as rows (keys, bucket, bits). A group without numbers keeps a row without bits."""
    return df.groupBy(*keys, F.bitmap_bucket_number(number).alias(BUCKET)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS))


def count_sketched(sketches: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """Distinct ids per group of `keys`, which may be fewer than those the sets were made for: unions, then sizes."""
    union = sketches.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
    return union.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(alias))
