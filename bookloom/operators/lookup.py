"""Dimension look-up by join, for mappings too large for a literal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Mappings up to this many keys are sent to every executor.
SENT_KEYS = 50_000


def map_channel_table(events: DataFrame, mapping: DataFrame, key: str = "event_type_url") -> DataFrame:
    """Set `channel` from a table with columns (`key`, channel); unknown keys give null.

    The keys of the mapping are counted first, never more than `SENT_KEYS` and one. A mapping with few keys is broadcast, so
    the events stay in their tasks: dealt out by key they would lie in as many tasks as there are keys. Otherwise Spark sorts
    and merges, splitting a hot key of the events side.
    """
    one_per_key = mapping.groupBy(key).agg(F.max("channel").alias("channel"))
    few = one_per_key.limit(SENT_KEYS + 1).count() <= SENT_KEYS
    return events.drop("channel").join(one_per_key.hint("broadcast" if few else "merge"), key, "left")
