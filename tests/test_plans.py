"""What the physical plans must and must not contain."""

import contextlib
import io
import re

import pytest

from bookloom import schemas
from bookloom.plans import gold, intake, refresh
from bookloom.queries import adapters as A
from bookloom.queries.registry import QUERIES
from bookloom.sources.tables import load_table

SF = "/root/testdata/sf0.001"
# Queries that write tables and read them back; their plan is only the last read.
WRITING = ("refreshed_", "table_", "catalog_", "csv_", "stream_", "webhook_", "daily_run_")
LAZY = [n for n in sorted(QUERIES) if not n.startswith(WRITING) and not n.endswith("_from_files")]


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("silver")
    A.bookings(spark, SF).write.partitionBy("dt").parquet(f"{root}/events")
    A.spend(spark, SF).write.partitionBy("dt").parquet(f"{root}/spend")
    return (spark.read.schema(A.bookings(spark, SF).schema).parquet(f"{root}/events"),
            load_table(spark, f"{root}/spend", schemas.SPEND))


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pair_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("EvalPython", "InPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin", "ScalaUDF"):
        assert node not in text


def test_increments_read_only_their_partitions(silver):
    text = plan(refresh.campaign_increment(*silver, "2024-01-15", "2024-01-16"))
    scans = re.findall(r"FileScan.*", text)
    assert scans and all("(dt#" in s and ">= 2024-01-15" in s and "<= 2024-01-16" in s for s in scans)


def test_distinct_counts_spread_over_keys_and_ids(silver):
    text = plan(gold.cpb_by_channel(*silver))
    assert re.search(r"hashpartitioning\(channel#\d+, booking_id#\d+", text)
    assert "ReadSchema: struct<booking_id:string,channel:string>" in text


def test_time_filters_reach_the_scan(spark, silver):
    text = plan(refresh.time_features_on_days(silver[0], ["2024-01-15"]))
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(booking_created_at" in text
    text = plan(refresh.meeting_features_in_weeks(silver[0], ["2024-01-15"]))
    assert "GreaterThanOrEqual(scheduled_event_start" in text
    assert "Exchange" not in text


def test_row_tables_need_no_shuffle(silver):
    assert "Exchange" not in plan(gold.time_features(silver[0])) + plan(gold.meeting_features(silver[0]))


def test_dedup_cuts_hot_keys_before_the_shuffle(spark):
    bronze = spark.createDataFrame([], schemas.BRONZE.ddl)
    text = plan(intake.latest_copies(bronze.union(spark.createDataFrame([("i", "b", None, "d", "e")], schemas.BRONZE.ddl))))
    partial, exchange = text.index("row_number(), 1, Partial"), text.index("Exchange hashpartitioning")
    assert exchange < partial


def test_every_body_is_parsed_once(spark):
    envelopes = spark.createDataFrame([("{}", False, None)], schemas.ENVELOPE)
    stored, rejected = intake.split_rejects(intake.route_webhooks(envelopes))
    for df in (stored, rejected):
        text = plan(df)
        assert text.count("parseJson") == 1


def test_small_sides_are_not_forced_to_broadcast(spark, silver):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(gold.campaign_daily(*silver)) + plan(gold.cpb_by_channel(*silver))
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
