"""Row selection: deduplication, option lists, optional filters, date bounds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_NUMBER = "__row_number"


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in `order`.

    Written as `row_number() = 1`, which Spark cuts down to one row per key inside every task before the shuffle,
    so a key that holds a large share of all rows does not end up in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(ROW_NUMBER, F.row_number().over(window)).filter(F.col(ROW_NUMBER) == 1).drop(ROW_NUMBER)


def aside(df: DataFrame, keys: Sequence[str], *others: str) -> DataFrame:
    """Keys under names of their own, to be joined to rows that have the same columns."""
    return df.select(*[F.col(k).alias(f"__{k}") for k in keys], *others)


def same_key(keys: Sequence[str]) -> Column:
    """Join condition with keys put `aside` in which null equals null."""
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])


def with_key_in(df: DataFrame, chosen: DataFrame, keys: Sequence[str], inside: bool = True) -> DataFrame:
    """The rows whose key is in `chosen`, or the others."""
    return df.join(aside(chosen, keys), same_key(keys), "left_semi" if inside else "left_anti")


def repeats(df: DataFrame, keys: Sequence[str], *measures: Column) -> DataFrame:
    """The keys that occur more than once, with `measures` over their rows. Repeated keys are counted inside each task
    before the shuffle; only the named columns are read."""
    return df.groupBy(*keys).agg(F.count("*").alias(ROW_NUMBER), *measures).where(F.col(ROW_NUMBER) > 1).drop(ROW_NUMBER)


def latest_by_key(df: DataFrame, keys: Sequence[str], at: str, tie: str, row: str = "row") -> DataFrame:
    """One row per key, the last by `at`, of equally late ones the one with the largest `tie`; `row` names each row.

    Same rows as `dedup_latest`, for tables with few repeated keys and wide rows: keys and times alone decide which rows
    are outdated, and only these row names are joined to the wide rows. A wide row is shuffled only where copies came at the
    same time, so that their contents must be compared. The table is read twice; store what is costly to compute.
    """
    narrow = df.select(*keys, at, row)
    last = aside(repeats(narrow, keys, F.max(at).alias("__last")), keys, "__last")
    again = narrow.join(last, same_key(keys)).select(*keys, at, row, "__last")
    newest = again.where(F.col(at).eqNullSafe(F.col("__last")))
    tied_keys = repeats(newest, keys)
    tied = with_key_in(newest, tied_keys, keys).select(row)
    outdated = again.where(~F.col(at).eqNullSafe(F.col("__last"))).select(row)
    alone = df.join(outdated.unionByName(tied), row, "left_anti")
    settled = dedup_latest(df.join(tied, row, "left_semi"), keys, [F.desc(at), F.desc(tie)])
    return alone.unionByName(settled)


def optional_in(
    df: DataFrame, column: str, selected: Sequence[str] | None, universe: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the selected values. Selecting nothing, or every known option, means no filter at all."""
    chosen = list(dict.fromkeys(selected or []))
    if not chosen or (universe is not None and set(chosen) >= set(universe)):
        return df
    return df.filter(F.col(column).isin(chosen))


def options(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in order, for a selection list."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def date_bounds(df: DataFrame, column: str) -> DataFrame:
    """First and last day of a table, one row; nulls when the table is empty."""
    return df.agg(F.min(column).alias("min_d"), F.max(column).alias("max_d"))


def sample_rows(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """`n` rows that look random but are the same on every run: those whose contents have the lowest hash."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.select(*columns).orderBy(F.sha2(F.concat_ws("|", *texts), 256), *columns).limit(n)
