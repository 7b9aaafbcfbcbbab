"""Grouped counts and pivots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_ids(df: DataFrame, keys: Sequence[str | Column], id_column: str, alias: str, distinct: bool = True) -> DataFrame:
    """Ids per group.

    A single distinct count is planned as two aggregations: the first shuffles by (keys, id) after removing repeats
    inside each task, the second adds up counts. Few large groups are therefore spread over all tasks.
    """
    counted = F.count_distinct(F.col(id_column)) if distinct else F.count(id_column)
    return df.groupBy(*keys).agg(counted.alias(alias))


def count_bookings(df: DataFrame, keys: Sequence[str | Column], distinct: bool = True) -> DataFrame:
    return count_ids(df, keys, "booking_id", "bookings", distinct)


def pivot_values(df: DataFrame, column: str) -> list[str]:
    """Column headings of a pivot. Spark itself refuses more than `spark.sql.pivotMaxValues` of them."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values; name the wanted ones or raise the setting")
    return sorted(row[0] for row in found)


def pivot_fill(
    df: DataFrame,
    row: str,
    column: str,
    value: str,
    agg: str,
    values: Sequence[str] | None = None,
    fill: float | None = None,
    total: bool = False,
) -> DataFrame:
    """Cross table with one line per `row` and one column per value of `column`.

    `agg` is "avg" or "sum", `fill` replaces empty cells, `total` adds the sum of each line as TOTAL. Naming the
    `values` saves the job that looks them up.
    """
    headings = list(values) if values is not None else pivot_values(df, column)
    table = df.groupBy(row).pivot(column, headings).agg({"avg": F.avg, "sum": F.sum}[agg](value))
    if fill is not None:
        table = table.na.fill(fill, subset=headings)
    if total:
        cells = [F.coalesce(F.col(f"`{h}`"), F.lit(0)) for h in headings]
        table = table.withColumn("TOTAL", reduce(lambda a, b: a + b, cells, F.lit(0)))
    return table
