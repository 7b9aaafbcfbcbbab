"""Stored sets of booking and meeting numbers, refreshed by day or week, behind the reports on times and meetings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions import times as T
from bookloom.operators.bitmaps import Numbering, extend, numbered, sketch
from bookloom.sinks.tables import overwrite_partitions


def refresh_sets(
    rows: DataFrame, id_column: str, numbering: Numbering, path: str, layout: schemas.TableLayout, days: Iterable[T.Day] | None = None,
) -> list[str]:
    """Replace the sets of the days (or weeks) that `rows` holds; with `days` also of those among them that have no rows
    left. Returns the replaced ones.

    The rows are made distinct before they are numbered, so repeated ones cost nothing further. Reads the rows of the days
    and the numbers of ids; the stored sets of other days are not touched.
    """
    keys = [c for c in layout.columns if c not in ("bucket", "bits")]
    once = rows.select(*keys, id_column).distinct()
    extend(numbering, once.select(F.col(id_column).alias("id")))
    scope = None if days is None else T.on_any_day(F.col(layout.by[0]), days)
    return overwrite_partitions(sketch(numbered(numbering, once, id_column), keys).select(*layout.columns), path, layout.by[0], scope)


def refresh_slot_sets(features: DataFrame, numbering: Numbering, path: str, days: Iterable[T.Day] | None = None) -> list[str]:
    """From rows of the table of booking times: `days` are local days."""
    return refresh_sets(features, "booking_id", numbering, path, schemas.SLOT_SETS, days)


def refresh_meeting_sets(features: DataFrame, numbering: Numbering, path: str, weeks: Iterable[T.Day] | None = None) -> list[str]:
    """From rows of the table of meetings: `weeks` are Mondays."""
    return refresh_sets(features, "meeting_id", numbering, path, schemas.MEETING_SETS, weeks)
