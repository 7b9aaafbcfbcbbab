"""Compaction takes every object in once, follows rewritten ones, and gives the silver rows of the objects."""

import json
import os

from pyspark.sql import functions as F

from bookloom.plans import compaction
from bookloom.plans.silver import flatten_events
from bookloom.sources.webhooks import read_bronze
from fixtures import values, webhook, write_bronze


def silver(df):
    return values(flatten_events(df))


def test_compaction(spark, tmp_path):
    root, path = tmp_path / "raw", f"{tmp_path}/compacted"
    days = ["2025-10-06", "2025-10-07"]
    for day in days:
        write_bronze(root, day, [webhook(booking=f"{day}-{n}") for n in range(30)])
        write_bronze(root, day, [webhook(booking=f"{day}-gone", event="invitee.canceled")], "invitee canceled")
    assert compaction.compact(spark, str(root), path, *days) == 62
    assert compaction.compact(spark, str(root), path, *days) == 0
    assert silver(compaction.read_compacted(spark, path)) == silver(read_bronze(spark, str(root), *days))
    files = list((tmp_path / "compacted").glob("dt=*/event=*/*.parquet"))
    assert len(files) <= 8
    assert {r.event for r in spark.read.parquet(path).select("event").distinct().collect()} == {"invitee.created", "invitee canceled"}
    # later: a new object, and one written anew
    again = root / "dt=2025-10-06" / "invitee.created" / "0.json"
    again.write_text(json.dumps(webhook(booking="2025-10-06-0", name="Zoe")))
    os.utime(again, (2_000_000_000, 2_000_000_000))
    write_bronze(root, days[1], [webhook(booking="new")])
    assert compaction.compact(spark, str(root), path, *days) == 2
    assert compaction.compact(spark, str(root), path, *days) == 0
    assert silver(compaction.read_compacted(spark, path, *days)) == silver(read_bronze(spark, str(root), *days))
    one = compaction.read_compacted(spark, path, days[0], days[0])
    assert one.where(F.col("payload.name") == "Zoe").count() == 1 and one.count() == 31


def test_nothing_to_take_in(spark, tmp_path):
    assert compaction.compact(spark, f"{tmp_path}/none", f"{tmp_path}/c", "2025-10-06", "2025-10-07") == 0
    assert compaction.read_compacted(spark, f"{tmp_path}/c").count() == 0
