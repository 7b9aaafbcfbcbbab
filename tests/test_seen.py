"""The set of bookings seen: daily runs equal full builds, read one day, and survive a run that died."""

import random

import pytest
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.plans import gold, seen
from bookloom.sinks import versions
from fixtures import events, spend, values

DAYS = [f"2025-10-{d:02d}" for d in range(1, 7)]


def random_day(rng, day):
    """Rows of one day of receipt: new ids, ids of other days, ids twice, blanks and missing values."""
    return [{"booking_id": rng.choice([f"b{rng.randrange(40)}", f"{day}-{rng.randrange(5)}", "", None]),
             "channel": rng.choice(["facebook_paid_ads", "youtube_paid_ads", " ", None]), "dt": day} for _ in range(rng.randrange(1, 14))]


def test_ten_random_daily_runs(spark, tmp_path):
    """Each run adds a day, brings late rows to one, or takes rows away from one, and may be repeated."""
    rng = random.Random(11)
    held = {DAYS[0]: random_day(rng, DAYS[0]), DAYS[1]: random_day(rng, DAYS[1])}
    known, path = seen.SeenSet(f"{tmp_path}/seen", buckets=4), f"{tmp_path}/cpb"
    amounts = spend(spark, (DAYS[0], "facebook_paid_ads", 3.5), (DAYS[1], "youtube_paid_ads", 0.25), (DAYS[1], "other", 1.0))
    for n in range(10):
        day = rng.choice(DAYS)
        kept = held.get(day, []) if n % 3 else []  # every third run replaces the day
        held[day] = kept + random_day(rng, day) if n != 7 else []
        now = events(spark, *[row for rows in held.values() for row in rows])
        seen.refresh_cpb(now, amounts, known, path, day, day)
        assert values(versions.load_current(spark, path, schemas.CPB)) == values(gold.cpb_by_channel(now, amounts)), n
    assert len(versions.finished(spark, path)) == 2


def test_a_run_that_died_half_way(spark, tmp_path):
    known = seen.SeenSet(f"{tmp_path}/seen", buckets=2)
    first = events(spark, {"booking_id": "a"}, {"booking_id": "b"})
    assert values(seen.bookings_per_channel(seen.update(spark, known, first, DAYS[0], DAYS[0]))) == [("facebook_paid_ads", 2)]
    both = events(spark, {"booking_id": "a"}, {"booking_id": "b"}, {"booking_id": "c", "dt": "2025-10-08"}, {"booking_id": "a", "dt": "2025-10-08"})
    # the counters were taken back, and the set holds the new day already
    versions.publish(spark.createDataFrame([], seen.COUNTERS.ddl), known.counters)
    table = seen.members_table(spark, known)
    seen.replace_members(spark, table, seen.day_members(both, "2025-10-08", "2025-10-08"), ["2025-10-08"], 2)
    counters = seen.update(spark, known, both, "2025-10-08", "2025-10-08")
    assert values(seen.bookings_per_channel(counters)) == [("facebook_paid_ads", 3)]


def test_one_day_is_read_and_the_set_is_not_shuffled(spark, tmp_path):
    rng = random.Random(3)
    rows = events(spark, *[row for day in DAYS for row in random_day(rng, day)])
    stored = f"{tmp_path}/events"
    rows.write.partitionBy("dt").parquet(stored)
    stored_events = spark.read.schema(rows.schema).parquet(stored)
    known = seen.SeenSet(f"{tmp_path}/seen", buckets=4)
    seen.build(spark, known, stored_events)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = seen.day_members(stored_events, DAYS[2], DAYS[2])
        change = seen.difference(spark.table(seen.members_table(spark, known)), new, DAYS[2], DAYS[2], 4)
        plan = change._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "ShuffledHashJoin" in plan and "Bucketed: true" in plan
    join = plan[plan.index("ShuffledHashJoin"):]
    assert f">= {DAYS[2]}" in plan and f"<= {DAYS[2]}" in plan  # of the events and of the set
    # the side that streams past is scanned straight from its buckets
    lines = join.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    assert not any("Exchange" in line for line in lines[1:scan])
    assert change.count() == 0


def test_readers_keep_the_old_version(spark, tmp_path):
    base = f"{tmp_path}/cpb"
    first = spark.createDataFrame([("a", 1.0, 2, 0.5)], schemas.CPB.ddl)
    path = versions.publish(first, base)
    held = versions.load_current(spark, base, schemas.CPB)
    unfinished = versions.version_path(base, 2)
    first.write.parquet(unfinished)
    (tmp_path / "cpb" / unfinished.rsplit("/", 1)[1] / versions.MARK).unlink()
    assert versions.current(spark, base) == path
    third = versions.publish(first.withColumn("cpb", F.lit(9.0)), base)
    assert third.endswith("3") and values(held) == [("a", 1.0, 2, 0.5)]
    versions.publish(first, base)
    assert versions.drop_old(spark, base) == [path, unfinished]
    assert versions.finished(spark, base) == [3, 4]
    assert versions.load_current(spark, f"{tmp_path}/none", schemas.CPB).count() == 0
