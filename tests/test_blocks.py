"""Running totals in blocks equal the full build; a late booking rewrites its own block only."""

import random

import pytest

from bookloom.plans import blocks, gold
from bookloom.sources.tables import load_table
from fixtures import events, values


def random_events(rng, days):
    return [{"booking_id": f"b{rng.randrange(300)}", "channel": rng.choice(["a", "b", "c", " "]), "dt": rng.choice(days)} for _ in range(120)]


@pytest.mark.parametrize("period", ["month", "week"])
def test_late_bookings(spark, tmp_path, period):
    rng = random.Random(period)
    days = [f"2025-{m:02d}-{d:02d}" for m in (8, 9, 10) for d in (1, 3, 8, 15, 29)]
    rows, path, totals = random_events(rng, days), f"{tmp_path}/blocks", f"{tmp_path}/totals"
    blocks.build_blocks(events(spark, *rows), path, totals, period)

    def stored():
        return load_table(spark, path, blocks.BLOCKS), load_table(spark, totals, blocks.TOTALS)

    assert values(blocks.cumulative(*stored(), period=period)) == values(gold.cumulative_bookings(events(spark, *rows)))
    for day in ("2025-08-15", "2025-10-29", "2025-11-02"):
        before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("blocks/*/*.parquet")}
        rows += [{"booking_id": f"late-{day}-{n}", "channel": "a", "dt": day} for n in range(3)]
        now = events(spark, *rows)
        written = blocks.refresh_blocks(now, path, totals, day, day, period)
        assert len(written) == 1
        kept = {p for p, at in before.items() if p.exists() and p.stat().st_mtime_ns == at}
        assert {p.parent.name for p in before.keys() - kept} <= {f"block={written[0]}"}
        full = gold.cumulative_bookings(now)
        assert values(blocks.cumulative(*stored(), period=period)) == values(full)
    # all rows of a day are gone
    rows = [r for r in rows if r["dt"] != "2025-09-08"]
    now = events(spark, *rows)
    for _ in range(2):
        blocks.refresh_blocks(now, path, totals, "2025-09-08", "2025-09-08", period)
    full = gold.cumulative_bookings(now)
    assert values(blocks.cumulative(*stored(), period=period)) == values(full)
    some = blocks.cumulative(*stored(), "2025-09-02", "2025-10-08", period)
    assert values(some) == values(full.where("dt BETWEEN '2025-09-02' AND '2025-10-08'"))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan and "block#" in plan
