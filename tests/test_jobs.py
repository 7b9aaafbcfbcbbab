"""The whole chain through the command line: files in, reporting tables out."""

import json

import pytest

from bookloom import jobs, schemas
from bookloom.plans import gold
from bookloom.sources.tables import load_table
from fixtures import SPEND, spend_records, values, webhook, write_bronze, write_spend_file


def bodies(day, n):
    return [webhook(booking=f"{day}-{i}", meeting=f"{day}-m{i}", created_at=f"{day}T1{i}:00:00Z") for i in range(n)]


def test_backfill_then_daily_runs(spark, tmp_path):
    bronze, files, lake = tmp_path / "bronze", tmp_path / "files", jobs.Lake(str(tmp_path / "lake"))
    days = list(SPEND)
    for n, day in enumerate(days, 1):
        write_bronze(bronze, day, bodies(day, n % 4 + 1))
    write_spend_file(files, "2025-10-06", spend_records("2025-10-06"))
    root = ["--lake", lake.root]
    jobs.main(["events", *root, "--bronze", str(bronze), "--start", days[0], "--end", days[6]], spark)
    jobs.main(["spend", *root, "--files", str(files), "--day", "2025-10-06"], spark)
    jobs.main(["build", *root], spark)
    write_spend_file(files, "2025-10-08", spend_records("2025-10-08"))
    jobs.main(["spend", *root, "--files", str(files)], spark)
    for day, as_of in ((days[7], "2025-10-08"), (days[8], "2025-10-09")):
        jobs.main(["events", *root, "--bronze", str(bronze), "--start", day, "--end", day], spark)
        for _ in range(2):
            jobs.main(["refresh", *root, "--as-of", as_of], spark)
    jobs.main(["refresh", *root, "--start", days[5], "--end", days[8]], spark)
    with pytest.raises(SystemExit):
        jobs.main(["refresh", *root], spark)
    assert load_table(spark, lake.ranges, schemas.EVENT_RANGES).count() == 9
    events, spend = jobs.silver_tables(spark, lake)
    assert spend.count() == 27
    for name in (schemas.DAILY_BOOKINGS, schemas.CPB, schemas.CUMULATIVE, schemas.CAMPAIGN_DAILY, schemas.TIME_FEATURES):
        full = jobs.BUILDERS[name.name](events, spend).select(*name.columns)
        assert values(jobs.load_gold(spark, lake, name.name)) == values(full)
    jobs.main(["build", *root, "--table", schemas.MEETING_FEATURES.name], spark)
    stored = load_table(spark, lake.gold(schemas.MEETING_FEATURES.name), schemas.MEETING_FEATURES)
    assert values(stored) == values(gold.meeting_features(events))
    jobs.main(["register", *root, "--database", "jobs_db"], spark)
    assert spark.table("jobs_db.events_spend").count() == 27
    assert spark.table(f"jobs_db.{schemas.CUMULATIVE.name}").count() == 9
    by_name = spark.table(f"jobs_db.{schemas.EVENTS.name}").count()
    write_bronze(bronze, "2025-10-20", bodies("2025-10-20", 2))
    jobs.main(["events", *root, "--bronze", str(bronze), "--start", "2025-10-20", "--end", "2025-10-20", "--database", "jobs_db"], spark)
    assert spark.table(f"jobs_db.{schemas.EVENTS.name}").count() == by_name + 2
    spark.sql("DROP DATABASE jobs_db CASCADE")


def test_intake_run(spark, tmp_path):
    landed, lake = tmp_path / "landed", jobs.Lake(str(tmp_path / "lake"))
    landed.mkdir()
    rows = [{"body": json.dumps(b), "is_base64": False, "received_at": f"2025-10-07T1{i}:00:00Z"}
            for i, b in enumerate(bodies("2025-10-07", 3) + bodies("2025-10-07", 1))]
    (landed / "one.json").write_text("\n".join(map(json.dumps, rows)))
    for _ in range(2):
        jobs.main(["intake", "--lake", lake.root, "--envelopes", str(landed)], spark)
    stored = values(load_table(spark, lake.events, schemas.EVENTS))
    assert len(stored) == 3
    jobs.main(["events", "--lake", lake.root, "--from-table", "--start", "2025-10-06", "--end", "2025-10-08"], spark)
    assert values(load_table(spark, lake.events, schemas.EVENTS)) == stored
