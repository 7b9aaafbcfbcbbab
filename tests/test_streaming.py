import json
import os
import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.plans.intake import first_and_later, ingest_webhooks, latest_copies, latest_staged, resolve, route_webhooks, staged
from bookloom.plans.silver import flatten_events
from bookloom.sources.tables import load_table
from bookloom.sources.webhooks import parse_bronze, read_envelopes, stream_envelopes
from bookloom.streaming.intake import start_intake, take_in
from bookloom.streaming.silver import fold_in, settle_days, start_silver
from fixtures import ts, values, webhook


def land(folder, *rows):
    """One more file; the stream takes files in the order of their times."""
    folder.mkdir(exist_ok=True)
    number = len(list(folder.iterdir()))
    name = folder / f"{number}.json"
    name.write_text("\n".join(json.dumps({"body": b, "is_base64": False, "received_at": at}) for b, at in rows))
    written = time.time() - 1000 + 10 * number
    os.utime(name, (written, written))


def body(booking, name="Ann"):
    return json.dumps(webhook(booking=booking, name=name))


def run(spark, tmp_path):
    source = stream_envelopes(spark, str(tmp_path / "landed"), max_files=1)
    start_intake(source, f"{tmp_path}/bronze", f"{tmp_path}/rejects", f"{tmp_path}/repeats", f"{tmp_path}/state").awaitTermination()


def tables(spark, tmp_path):
    return load_table(spark, f"{tmp_path}/bronze", schemas.BRONZE), load_table(spark, f"{tmp_path}/repeats", schemas.REPEATS)


def name():
    return F.get_json_object("body", "$.payload.name")


def keys(df):
    return values(df.select("dt", "event", "event_id", name()))


def test_stream_equals_batch(spark, tmp_path):
    landed = tmp_path / "landed"
    land(landed, (body("B1", "old"), "2025-10-07T10:00:00Z"), ("[1]", "2025-10-07T10:00:01Z"))
    land(landed, (body("B2"), "2025-10-05T10:00:00Z"), (body("B1", "new"), "2025-10-07T11:00:00Z"))
    run(spark, tmp_path)
    land(landed, (body("B1", "late"), "2025-10-01T09:00:00Z"), (body("B2"), "2025-10-05T10:00:00Z"), ('{"event": ""}', "2025-10-01T09:00:00Z"))
    run(spark, tmp_path)
    bronze, rejects = ingest_webhooks(read_envelopes(spark, str(landed)))
    first, later = tables(spark, tmp_path)
    assert first.count() + later.count() == 6
    stable = "event_id LIKE '________________________________________________________________'"
    assert keys(resolve(first, later).where(stable)) == keys(bronze.where(stable))
    assert resolve(first, later).where(f"NOT {stable}").select("event", "body").collect() == [("unknown_event", '{"event": ""}')]
    assert load_table(spark, f"{tmp_path}/rejects", schemas.REJECTS).count() == rejects.count() == 1
    assert not list((tmp_path / "state" / "staging").glob("batch=*"))


def test_first_copies_in_bronze_and_every_later_one_beside_it(spark, tmp_path):
    landed = tmp_path / "landed"
    land(landed, (body("B1", "first"), "2025-10-07T10:00:00Z"), (body("B3", "b"), "2025-10-07T09:00:00Z"), (body("B3", "a"), "2025-10-07T08:00:00Z"))
    land(landed, (body("B1", "earlier, but later here"), "2025-10-07T01:00:00Z"), (body("B2"), "2025-10-07T11:00:00Z"))
    land(landed, (body("B1", "months late"), "2025-10-07T23:00:00Z"), (body("B1", "again"), "2025-10-07T23:30:00Z"))
    run(spark, tmp_path)
    first, later = tables(spark, tmp_path)
    assert values(first.select(name())) == [("Ann",), ("a",), ("first",)]
    assert values(later.select(name())) == [("again",), ("b",), ("earlier, but later here",), ("months late",)]
    assert values(resolve(first, later).select(name())) == [("Ann",), ("again",), ("b",)]


def test_a_micro_batch_that_runs_twice(spark, tmp_path):
    landed = tmp_path / "landed"
    land(landed, (body("B1", "x"), "2025-10-07T10:00:00Z"), (body("B1", "y"), "2025-10-07T11:00:00Z"), ("{}", "2025-10-07T11:00:00Z"), ("[", "2025-10-07T11:00:00Z"))
    rows = read_envelopes(spark, str(landed))
    paths = [f"{tmp_path}/{n}" for n in ("bronze", "rejects", "repeats", "staging")]
    for batch in ("0", "0", "1"):
        take_in(rows, batch, *paths)
    first, later = tables(spark, tmp_path)
    assert first.where("body LIKE '%payload%'").count() == 1 and later.count() == 3
    assert first.where("body = '{}'").count() == 2


def test_bodies_are_parsed_once_and_joined_by_row_names(spark, tmp_path):
    landed, path = tmp_path / "landed", f"{tmp_path}/staged"
    land(landed, (body("B1", "x"), "2025-10-07T10:00:00Z"), (body("B1", "y"), "2025-10-07T11:00:00Z"), (body("B2"), "2025-10-07T11:00:00Z"))
    staged(route_webhooks(read_envelopes(spark, str(landed)))).write.parquet(path)
    table = load_table(spark, path, schemas.STAGED)
    first, _ = first_and_later(table, table.select("dt", "event", "event_id").limit(0))
    for rows in (first, latest_staged(table)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert shuffled and "parse_json" not in plan
        assert sum("body" in line for line in plan.splitlines() if "ReadSchema" in line) < sum("ReadSchema" in line for line in plan.splitlines())
    assert keys(latest_staged(table)) == keys(latest_copies(table.select(*schemas.BRONZE.columns)))


def test_equal_times_are_settled_by_contents(spark, tmp_path):
    rows = [("i", f"{{\"payload\": {{\"name\": \"{c}\"}}}}", None, at, None, "e", "2025-10-07", n) for n, (c, at) in enumerate(
        [("b", ts("2025-10-07 10:00:00")), ("c", ts("2025-10-07 10:00:00")), ("z", ts("2025-10-07 09:00:00")), ("a", ts("2025-10-07 10:00:00"))])]
    rows += [("j", "{}", None, None, None, "e", "2025-10-07", 7), ("j", "{}", None, None, None, "e", "2025-10-07", 8), ("k", "{}", None, None, None, "e", None, 9)]
    table = spark.createDataFrame(rows, schemas.STAGED.ddl)
    assert values(latest_staged(table)) == values(latest_copies(table.select(*schemas.BRONZE.columns)))
    assert latest_staged(table).count() == 3


def follow(spark, tmp_path, max_files=None):
    touched = []
    run(spark, tmp_path)
    start_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/repeats", f"{tmp_path}/live", f"{tmp_path}/silver-state", max_files=max_files,
                 on_days=touched.extend).awaitTermination()
    return sorted(set(touched))


def test_silver_follows_bronze_and_replaces_older_copies(spark, tmp_path):
    landed, silver = tmp_path / "landed", f"{tmp_path}/silver"
    land(landed, (body("B1", "old"), "2025-10-07T10:00:00Z"), (body("B9"), "2025-10-08T10:00:00Z"))
    assert follow(spark, tmp_path) == ["2025-10-07", "2025-10-08"]
    land(landed, (body("B1", "new"), "2025-10-07T12:00:00Z"), (body("B2"), "2025-10-07T13:00:00Z"))
    land(landed, (body("B1", "older"), "2025-10-07T09:00:00Z"), (body("B2", "B"), "2025-10-07T13:00:00Z"))
    assert follow(spark, tmp_path, max_files=1) == ["2025-10-07"]
    bronze, _ = ingest_webhooks(read_envelopes(spark, str(landed)))
    live = load_table(spark, f"{tmp_path}/live", schemas.LIVE_EVENTS)
    want = values(flatten_events(parse_bronze(bronze)))
    assert values(live.select(*schemas.EVENTS.columns)) == want
    settle_days(spark, f"{tmp_path}/live", silver, ["2025-10-07", "2025-10-08"])
    assert values(load_table(spark, silver, schemas.EVENTS)) == want


def bronze_rows(spark, *rows):
    return spark.createDataFrame(
        [(f"id-{b}", body(b, n), ts(at), at[:10], "invitee.created") for b, n, at in rows], schemas.BRONZE.ddl)


def test_work_follows_the_batch(spark, tmp_path):
    """Only parts that hold a repeated key are written again; files of the others stay."""
    live, held = f"{tmp_path}/live", []

    def fold(part, *rows):
        arrived = bronze_rows(spark, *rows)
        held.append(arrived)
        return fold_in(spark, arrived, live, part, f"{tmp_path}/staging", lambda k, d: reduce(DataFrame.unionByName, held).join(k, ["dt", "event", "event_id"], "left_semi"))

    day = "2025-10-07"
    assert fold("0", ("a", "1", f"{day} 10:00:00"), ("b", "1", f"{day} 10:00:00")) == ([day], [])
    assert fold("1", ("c", "1", f"{day} 10:00:00"), ("d", "1", "2025-10-06 10:00:00")) == (["2025-10-06", day], [])
    files = {p: p.stat().st_mtime_ns for p in tmp_path.glob("live/*/*/*.parquet")}
    assert fold("2", ("e", "1", f"{day} 11:00:00"), ("a", "2", f"{day} 12:00:00"), ("c", "0", f"{day} 09:00:00")) == ([day], [(day, "0")])
    kept = {p for p, at in files.items() if p.exists() and p.stat().st_mtime_ns == at}
    assert {p.parent.name for p in files} == {"part=0", "part=1"} and {p.parent.name for p in kept} == {"part=1"}
    # the only row of a part gives way: the part stays as an empty folder; equal times are settled by the body
    assert fold("3", ("d", "9", "2025-10-06 12:00:00"), ("e", "0", f"{day} 11:00:00")) == (["2025-10-06", day], [("2025-10-06", "1")])
    for _ in range(2):
        rows = load_table(spark, live, schemas.LIVE_EVENTS).select("booking_id", "invitee_name")
        assert values(rows) == [("a", "2"), ("b", "1"), ("c", "1"), ("d", "9"), ("e", "1")]
        held.pop()
        fold("3", ("d", "9", "2025-10-06 12:00:00"), ("e", "0", f"{day} 11:00:00"))  # the same micro-batch again
    assert fold("4", ("e", "2", f"{day} 11:00:00")) == ([day], [(day, "2")])
    held.pop()
    fold("4", ("e", "2", f"{day} 11:00:00"))
    rows = load_table(spark, live, schemas.LIVE_EVENTS).select("booking_id", "invitee_name")
    assert values(rows) == [("a", "2"), ("b", "1"), ("c", "1"), ("d", "9"), ("e", "2")]
    assert fold("5") == ([], [])
