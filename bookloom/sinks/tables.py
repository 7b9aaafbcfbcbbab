"""Partitioned tables in folders: append, replace partitions, replace days, replace all."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bookloom.functions.times import Day, iso
from bookloom.sources.tables import path_exists


def file_system(spark: SparkSession, path: str):
    """The folder as the file system's own object, and the file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, files = file_system(spark, path)
    files.delete(folder, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """The folder, empty if it did not exist; a stream cannot follow one that is missing."""
    folder, files = file_system(spark, path)
    files.mkdirs(folder)


def laid_out(df: DataFrame, by: Sequence[str], rebalance: bool = True, sort_by: str | None = None) -> DataFrame:
    """Arrange rows for writing.

    `rebalance` brings the rows of one partition together, so that it gets few files. Unlike a plain repartition,
    adaptive execution splits a partition that is too large for one task and merges small ones. `sort_by` orders the
    rows inside each file, which lets later filters on that column skip pages by their statistics.
    """
    rows = df.hint("rebalance", *by) if by and rebalance else df
    return rows.sortWithinPartitions(*by, sort_by) if sort_by else rows


def write_table(
    df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "append", fmt: str = "parquet", rebalance: bool = True,
    sort_by: str | None = None,
) -> None:
    """Write the rows. With `append` a second run adds them again; `overwrite` replaces the whole table, whatever
    overwrite mode the session has for partitions."""
    writer = laid_out(df, by, rebalance, sort_by).write.format(fmt).mode(mode)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static")
    writer.partitionBy(*by).save(path)


def partitions_in(df: DataFrame, column: str) -> list[str]:
    """The distinct days of a frame, on the driver; one short text per day."""
    days = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return sorted(str(row[0]) for row in days.collect())


def read_back(df: DataFrame, path: str) -> DataFrame:
    """The table in a folder, read with the columns and types of `df`."""
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def overwrite_partitions(
    df: DataFrame, path: str, by: str, scope: Column | None = None, rebalance: bool = True, sort_by: str | None = None,
) -> list[str]:
    """Replace the partitions that occur in `df` and keep all others; returns the replaced ones.

    `scope` is a condition on the partition column naming what was rebuilt: partitions inside it that got no rows
    are emptied, which a dynamic overwrite alone would leave as they were. A second run changes nothing.
    """
    spark = df.sparkSession
    stale: set[str] = set()
    if scope is not None and path_exists(spark, path):
        stale = set(partitions_in(read_back(df, path).filter(scope), by))
    # The written partitions are noted during the write itself; asking `df` would compute it a second time.
    seen = Observation()
    (laid_out(df, [by], rebalance, sort_by)
        .observe(seen, F.collect_set(F.col(by).cast("string")).alias("written"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))
    written = set(seen.get["written"] or [])
    empty_partitions(df, path, by, stale - written)
    return sorted(written | stale)


def empty_partitions(df: DataFrame, path: str, by: str, partitions: Iterable[str]) -> None:
    """Leave these partitions of a table with the columns of `df` without rows."""
    empty = df.sparkSession.createDataFrame([], df.drop(by).schema)
    for partition in sorted(partitions):
        empty.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{by}={partition}")


def replace_days(
    df: DataFrame, path: str, by: str, days: Iterable[Day] | None = None,
) -> list[str]:
    """Replace exactly `days` by the rows of `df` on these days; by default the days that occur in `df`."""
    if days is None:
        return overwrite_partitions(df, path, by)
    chosen = F.col(by).isin([iso(d) for d in days])
    return overwrite_partitions(df.filter(chosen), path, by, scope=chosen)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a table without partitions. `df` must not read from `path`."""
    df.write.format(fmt).mode("overwrite").save(path)
