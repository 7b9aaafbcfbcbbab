"""Text clean-up and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_CAMPAIGN = "(none)"


def present(column: Column) -> Column:
    """True where the text is neither null nor made of blanks only."""
    return column.isNotNull() & (F.trim(column) != "")


def default(column: Column, value: object) -> Column:
    return F.coalesce(column, F.lit(value))


def blank_to_null(column: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(F.trim(column), F.lit(""))


def campaign_label(column: Column) -> Column:
    """Null and the empty text both show as "(none)"."""
    return default(F.nullif(column, F.lit("")), NO_CAMPAIGN)


def display_label(column: Column) -> Column:
    """`facebook_paid_ads` -> `Facebook Paid Ads`; each run of letters starts with a capital."""
    runs = F.regexp_extract_all(F.replace(column, F.lit("_"), F.lit(" ")), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    titled = F.transform(runs, lambda run: F.concat(
        F.upper(F.substring(run, 1, 1)), F.lower(F.substr(run, F.lit(2)))))
    return F.array_join(titled, "")
