"""Catalog entries for existing folders, and checks after a load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom.operators.selection import sample_rows
from bookloom.schemas import TableLayout
from bookloom.sinks import versions


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def escaped(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def create_external(spark: SparkSession, table: str, path: str, layout: TableLayout | None, fmt: str) -> None:
    """Point a catalog entry at a folder, replacing the entry and leaving the files alone."""
    declared = "" if layout is None or fmt == "delta" else f"({layout.ddl})"
    partitioned = f"PARTITIONED BY ({', '.join(layout.by)})" if declared and layout.by else ""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
    spark.sql(f"CREATE TABLE {quoted(table)} {declared} USING {fmt} {partitioned} LOCATION '{escaped(path)}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {quoted(table)}")


def register_tables(
    spark: SparkSession, database: str, tables: dict[str, tuple[str, TableLayout | None]], fmt: str = "parquet",
) -> None:
    """Create the database when needed and one external table per (folder, layout)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    for name, (path, layout) in tables.items():
        create_external(spark, f"{database}.{name}", path, layout, fmt)


def sync_table(spark: SparkSession, table: str, layout: TableLayout) -> None:
    """Let a registered table show what its folder holds now: partitions written since, and new files."""
    if layout.by:
        spark.sql(f"MSCK REPAIR TABLE {quoted(table)} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def swap_table(df: DataFrame, table: str, base: str, layout: TableLayout) -> str:
    """Full refresh of a table without partitions, for readers that must never see it missing or half-written.

    The rows become the next version under `base`, then the catalog entry is moved to it; older versions but the one
    before are removed. `df` may read the old table.
    """
    if layout.by:
        raise ValueError(f"{layout.name} has partitions; replace those instead")
    version = versions.publish(df.select(*layout.columns), base)
    point_at(df.sparkSession, table, version, layout)
    versions.drop_old(df.sparkSession, base)
    return version


def point_at(spark: SparkSession, table: str, path: str, layout: TableLayout) -> None:
    """Move a catalog entry to another folder, or create it."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {quoted(table)} SET LOCATION '{escaped(path)}'")
        spark.catalog.refreshTable(table)
    else:
        create_external(spark, table, path, layout, "parquet")


def count_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """Row count per table, in one job."""
    counts = [spark.table(n).agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
              for n in names]
    return reduce(DataFrame.unionAll, counts)


def verify_tables(spark: SparkSession, samples: dict[str, list[str]]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Row counts, and ten rows of the named columns of every table."""
    return (
        count_tables(spark, list(samples)),
        {name: sample_rows(spark.table(name), columns) for name, columns in samples.items()})
