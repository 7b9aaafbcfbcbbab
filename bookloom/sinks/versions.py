"""Tables without partitions that are replaced as a whole while others read them.

Each write goes to a new folder `version=<number>` below the table's own; a version counts once its writer has left the
success mark. A reader therefore sees the last finished version or the one before, never none and never half of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bookloom.schemas import TableLayout
from bookloom.sinks.tables import file_system, remove_folder
from bookloom.sources.tables import load_table, path_exists

MARK = "_SUCCESS"


def _numbers(spark: SparkSession, base: str) -> list[int]:
    """The numbers of all versions, finished or not, ascending."""
    if not path_exists(spark, base):
        return []
    folder, files = file_system(spark, base)
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def version_path(base: str, number: int) -> str:
    return f"{base.rstrip('/')}/version={number:012d}"


def finished(spark: SparkSession, base: str) -> list[int]:
    return [n for n in _numbers(spark, base) if path_exists(spark, f"{version_path(base, n)}/{MARK}")]


def publish(df: DataFrame, base: str) -> str:
    """Write the rows as the next version and return its folder. `df` may read an earlier version."""
    spark = df.sparkSession
    path = version_path(base, max(_numbers(spark, base), default=0) + 1)
    df.write.mode("errorifexists").parquet(path)
    return path


def current(spark: SparkSession, base: str) -> str | None:
    """The folder of the last finished version."""
    numbers = finished(spark, base)
    return version_path(base, numbers[-1]) if numbers else None


def load_current(spark: SparkSession, base: str, layout: TableLayout) -> DataFrame:
    path = current(spark, base)
    return load_table(spark, path, layout) if path else spark.createDataFrame([], layout.ddl)


def drop_old(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Remove all but the last `keep` finished versions, and what unfinished writers left before these."""
    kept = finished(spark, base)[-keep:]
    gone = [version_path(base, n) for n in _numbers(spark, base) if kept and n < kept[0]]
    for path in gone:
        remove_folder(spark, path)
    return gone
