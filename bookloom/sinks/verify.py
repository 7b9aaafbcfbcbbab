"""Do two copies of a table hold the same rows? Compared by partition, whatever the order and the files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNT, SUM, XOR = "n_rows", "hash_sum", "hash_xor"


def fingerprints(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, sum and exclusive or of row hashes per partition.

    One row per partition leaves each task, and no row is moved. The two figures come from different hashes, so that a row
    that changed, or one that stands there twice in place of another, shows in at least one of them.
    """
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    row, other = F.xxhash64(*columns), F.xxhash64(F.lit("other"), *columns)
    return df.groupBy(*by).agg(F.count("*").alias(COUNT), F.sum(row.cast("decimal(38,0)")).alias(SUM), F.bit_xor(other).alias(XOR))


def compare(expected: DataFrame, stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """(partition columns, n_expected, n_stored, status) per partition: same, changed, missing or unexpected.

    `stored` may have its columns in any order; it must have those of `expected`. Both are read once.
    """
    left = fingerprints(expected, by).select(*[F.col(c).alias(f"__{c}") for c in by], F.struct(COUNT, SUM, XOR).alias("was"))
    right = fingerprints(stored.select(*expected.columns), by).select(*by, F.struct(COUNT, SUM, XOR).alias("is"))
    meets = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    both = left.join(right, meets, "full")
    status = (F.when(F.col("is").isNull(), "missing").when(F.col("was").isNull(), "unexpected")
              .when(F.col("was") == F.col("is"), "same").otherwise("changed"))
    return both.select(
        *[F.when(F.col("is").isNull(), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in by],
        F.coalesce(F.col(f"was.{COUNT}"), F.lit(0)).alias("n_expected"), F.coalesce(F.col(f"is.{COUNT}"), F.lit(0)).alias("n_stored"),
        status.alias("status"))


def differing_rows(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows that one side has more often than the other, with `side` and how many too many; for partitions that differ."""
    sides = expected.withColumn("__n", F.lit(1)).unionByName(stored.select(*expected.columns).withColumn("__n", F.lit(-1)))
    counted = sides.groupBy(*[F.col(f"`{c}`") for c in expected.columns]).agg(F.sum("__n").alias("surplus")).where("surplus <> 0")
    return counted.withColumn("side", F.when(F.col("surplus") > 0, "expected").otherwise("stored")).withColumn("surplus", F.abs("surplus"))
