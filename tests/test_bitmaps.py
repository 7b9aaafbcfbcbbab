"""Counts from stored sets equal distinct counts over any range, also after days were replaced."""

import random

import pytest
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.operators import bitmaps
from bookloom.plans import reports, sets
from bookloom.sources.tables import load_table
from fixtures import values

DDL = schemas.TIME_FEATURES.ddl


def features(spark, rng, days, most=60):
    rows = []
    for day in days:
        for _ in range(rng.randrange(1, most)):
            hour, dow = rng.randrange(3), rng.randrange(2) + 1
            rows.append((rng.choice(["a", "b", None]), rng.choice([f"x{rng.randrange(50)}", "", None]), hour, dow, f"d{dow}", day))
    return spark.createDataFrame(rows, DDL.replace("booking_date_local date", "booking_date_local string")).withColumn(
        "booking_date_local", F.to_date("booking_date_local"))


@pytest.fixture
def numbering(tmp_path):
    return bitmaps.Numbering(f"{tmp_path}/numbers", buckets=4)


def test_random_ranges(spark, tmp_path, numbering):
    rng = random.Random(5)
    days = [f"2025-10-{d:02d}" for d in range(1, 8)]
    table, path = features(spark, rng, days), f"{tmp_path}/sets"
    sets.refresh_slot_sets(table.where("booking_date_local <= '2025-10-04'"), numbering, path)
    sets.refresh_slot_sets(table.where("booking_date_local > '2025-10-04'"), numbering, path)
    # a day is replaced, one is emptied
    changed = table.where("booking_date_local NOT IN ('2025-10-02', '2025-10-03')").unionByName(features(spark, rng, ["2025-10-02"]))
    now = ["2025-10-02", "2025-10-03"]
    sets.refresh_slot_sets(changed.where(F.col("booking_date_local").isin(now)), numbering, path, now)
    stored = load_table(spark, path, schemas.SLOT_SETS)
    for start, end, chosen in ((None, None, None), (days[1], days[4], ["a"]), (days[2], days[2], None), (days[0], days[6], ["b"])):
        for report in (reports.slots_heatmap, reports.slots_by_hour, reports.slots_by_weekday):
            assert values(report(stored, start, end, chosen)) == values(report(changed, start, end, chosen))


def test_numbers_are_given_once(spark, numbering):
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "id string")
    bitmaps.extend(numbering, ids("a", "b", "b", None, ""))
    table = bitmaps.numbers_table(spark, numbering)
    first = {r.id: r.number for r in spark.table(table).collect()}
    assert sorted(first.values()) == [1, 2, 3] and set(first) == {"a", "b", ""}
    bitmaps.extend(numbering, ids("a"))
    bitmaps.extend(numbering, ids("c", "a", "d"))
    second = {r.id: r.number for r in spark.table(table).collect()}
    assert second.items() >= first.items() and sorted(second.values()) == [1, 2, 3, 4, 5]
    # a run that died after it reserved numbers leaves a gap
    bitmaps.versions.publish(spark.createDataFrame([(100,)], bitmaps.NEXT.ddl), numbering.folder("next"))
    bitmaps.extend(numbering, ids("e"))
    assert spark.table(table).where("id = 'e'").first().number == 100


def test_many_numbers_fill_several_bitmaps(spark, tmp_path, numbering):
    rows = spark.range(100_000).select(
        F.lit("emp").alias("employee_id"), F.concat(F.lit("m"), F.col("id") % 70_000).alias("meeting_id"),
        F.lit("2025-10-08").cast("date").alias("meeting_date"), F.lit("2025-10-06").cast("date").alias("week_start_date"))
    sets.refresh_meeting_sets(rows, numbering, f"{tmp_path}/sets")
    stored = load_table(spark, f"{tmp_path}/sets", schemas.MEETING_SETS)
    assert stored.count() == 3 and values(reports.load_weekly(stored)) == values(reports.load_weekly(rows))
    assert values(reports.load_by_employee(stored)) == values(reports.load_by_employee(rows))


def test_the_numbers_are_not_shuffled(spark, numbering):
    bitmaps.extend(numbering, spark.range(20).select(F.col("id").cast("string").alias("id")))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(5).select(F.col("id").cast("string").alias("booking_id"))
        plan = bitmaps.numbered(numbering, rows, "booking_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Bucketed: true" in plan
    lines = plan[plan.index("HashJoin"):].splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    assert not any("Exchange" in line for line in lines[1:scan])
