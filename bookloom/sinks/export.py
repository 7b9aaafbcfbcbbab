"""CSV downloads of report frames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line; nulls are empty fields. The order of `df` is kept across the part files."""
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
