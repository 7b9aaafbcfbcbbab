"""Tables by folder or by catalog name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bookloom.schemas import TableLayout


def is_path(name_or_path: str) -> bool:
    return "/" in name_or_path


def load_table(
    spark: SparkSession, name_or_path: str, layout: TableLayout | None = None, fmt: str = "parquet",
) -> DataFrame:
    """A table by catalog name, or by folder. With a layout the columns keep their declared types and order."""
    if not is_path(name_or_path):
        table = spark.table(name_or_path)
    else:
        reader = spark.read.format(fmt)
        # Delta keeps its own schema; plain files would turn a text `dt` into a date.
        if layout is not None and fmt != "delta":
            reader = reader.schema(layout.ddl)
        table = reader.load(name_or_path)
    return table.select(*layout.columns) if layout is not None else table


def path_exists(spark: SparkSession, path: str) -> bool:
    """The folder exists. Asked of the file system: a failing read would leave errors in the log."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def load_or_empty(spark: SparkSession, path: str, layout: TableLayout, fmt: str = "parquet") -> DataFrame:
    """The table, or no rows with its columns when nothing has been written yet."""
    if path_exists(spark, path):
        return load_table(spark, path, layout, fmt)
    return spark.createDataFrame([], layout.ddl)
