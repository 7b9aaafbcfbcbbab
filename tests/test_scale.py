"""Bounds on what one task holds, and on what is shuffled and written."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.operators import lookup
from bookloom.plans import intake
from bookloom.queries import adapters as A
from bookloom.sources import spend
from fixtures import values


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_no_task_gets_more_rows_than_fit_it_as_bodies(spark, monkeypatch):
    monkeypatch.setattr(A, "ROWS_A_TASK", 500)
    rows = A.spread(spark.range(0, 20_000, 1, 40).coalesce(2))
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 600


@pytest.mark.parametrize("sent", [1, 50_000])
def test_channels_from_few_keys_leave_events_in_their_tasks(spark, monkeypatch, sent):
    monkeypatch.setattr(lookup, "SENT_KEYS", sent)
    events = spark.range(0, 3000, 1, 12).select(
        "id", F.when(F.col("id") % 10 != 9, F.concat(F.lit("u"), (F.col("id") % 3).cast("string"))).alias("event_type_url"), F.lit("old").alias("channel"))
    mapping = spark.createDataFrame([("u0", "a"), ("u0", "b"), ("u1", None), (None, "z")], "event_type_url string, channel string")
    found = lookup.map_channel_table(events, mapping.repartition(2))
    assert found.count() == 3000
    assert values(found.groupBy("event_type_url", "channel").count()) == values(spark.createDataFrame(
        [("u0", "b", 900), ("u1", None, 900), ("u2", None, 900), (None, None, 300)], found.groupBy("event_type_url", "channel").count().schema))
    tasks = found.select(F.spark_partition_id()).distinct().count()
    assert tasks == 12 if sent > 1 else "SortMergeJoin" in plan_of(found)


@pytest.mark.parametrize("chunk", [1, 7, 8192])
def test_pieces_of_an_array_are_counted_in_chunks(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(spend, "PIECES_A_CHUNK", chunk)
    monkeypatch.setattr(spend, "BYTES_A_TASK", 400)
    records = [{"date": f"2025-10-{n % 28 + 1:02d}", "channel": f'}}"{n}{{', "spend": n, "more": {"a": ["}"]}} for n in range(100)]
    for day in ("01", "02"):
        (tmp_path / f"spend_data_2025-10-{day}.json").write_text(json.dumps(records[: 50 * int(day)]))
    rows = spend.read_spend_arrays(spark, str(tmp_path))
    columns = ["date", "channel", "spend", "source_file"]
    assert values(rows.select(columns)) == values(spend.read_spend(spark, str(tmp_path)).select(columns))
    windows = [line for line in plan_of(rows).splitlines() if "Window [" in line and "at#" in line]
    assert windows and all("chunk#" in line for line in windows)


def test_later_copies_are_decided_in_one_join(spark):
    at = lambda h: datetime(2025, 10, 7, h)
    rows = [("a", 5, 1), ("a", 4, 2), ("b", 3, 3), ("c", 1, 4), ("c", 1, 5), ("d", None, 6), ("d", 2, 7), (None, 2, 8), (None, 3, 9), ("e", 2, 10)]
    table = spark.createDataFrame(
        [(k, "{}", None, h and at(h), None, "x", "2025-10-07", n) for k, h, n in rows], schemas.STAGED.ddl)
    known = spark.createDataFrame([("2025-10-07", "x", "b"), ("2025-10-07", "x", "c"), ("2025-10-07", "x", "none"), ("2025-10-07", "x", "none")], "dt string, event string, event_id string")
    later = intake.later_rows(table, known)
    assert sorted(r.row for r in later.collect()) == [1, 3, 4, 5, 7, 9]
    assert later._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    first, rest = intake.first_and_later(table, known)
    assert sorted(r.row for r in first.collect()) == [2, 6, 8, 10] and rest.count() == 6


def test_landed_envelopes_are_compressed(spark, tmp_path):
    spark.range(50).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-10 10:00:00' AS ts", "id AS user_id", "'click' AS event_type", "1.5D AS value",
        "concat('{\"k\": ', id, '}') AS props").write.parquet(f"{tmp_path}/events.parquet")
    path = A.landed_envelopes(spark, str(tmp_path))
    names = [p for p in os.listdir(path) if p.startswith("part-")]
    assert names and all(p.endswith(".json.gz") for p in names)
    assert spark.read.schema(schemas.ENVELOPE).json(path).count() == 50
