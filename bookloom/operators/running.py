"""Running sums and the look-up of the last value before a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookloom.functions.times import Day, before

CARRY = "__carry"


def latest_before(df: DataFrame, key: str, order: str, value: str, cutoff: Day, alias: str = "prev") -> DataFrame:
    """For each key the value of its last row before `cutoff`.

    An aggregate, not a sorted window: every task reduces its rows to one per key before the shuffle.
    """
    return df.filter(before(F.col(order), cutoff)).groupBy(key).agg(F.max_by(value, order).alias(alias))


def running_sum(
    df: DataFrame, part: str, order: str, value: str, alias: str, carry: DataFrame | None = None,
) -> DataFrame:
    """Sum of `value` up to and including each row, per `part` in `order`.

    `carry` holds one starting value per part (columns: `part`, then the value); parts it does not name start at 0.
    Meant for aggregated input: one window group has one row per day.
    """
    window = Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    so_far = F.sum(value).over(window)
    if carry is None:
        return df.withColumn(alias, so_far)
    start = carry.select(part, F.col(carry.columns[-1]).alias(CARRY))
    joined = df.join(start, part, "left").withColumn(alias, F.coalesce(CARRY, F.lit(0)) + so_far)
    return joined.drop(CARRY)
