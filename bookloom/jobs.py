"""The runs of the pipeline over one lake folder, callable from Python or with spark-submit.

    spark-submit bookloom/jobs.py events  --lake s3a://bucket/lake --bronze s3a://bucket/raw --start 2025-09-30 --end 2025-10-06
    spark-submit bookloom/jobs.py spend   --lake ... --files s3a://bucket/spend --day ALL
    spark-submit bookloom/jobs.py build   --lake ... [--table cpb_by_channel]
    spark-submit bookloom/jobs.py events  --lake ... --from-table --start 2025-09-30 --end 2025-10-06
    spark-submit bookloom/jobs.py refresh --lake ... --as-of 2025-10-09 [--table ...] [--append] [--database marketing]
    spark-submit bookloom/jobs.py refresh --lake ... --start 2025-10-07 --end 2025-10-08 [--weeks 2025-10-06]
    spark-submit bookloom/jobs.py register --lake ... --database marketing
    spark-submit bookloom/jobs.py intake  --lake ... --envelopes s3a://bucket/landed

With `--database` a run lets the tables registered there show the partitions it wrote.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from bookloom import schemas  # noqa: E402
from bookloom.functions import times as T  # noqa: E402
from bookloom.plans import gold, ranges, refresh, seen, silver  # noqa: E402
from bookloom.session import build_session  # noqa: E402
from bookloom.sinks import versions  # noqa: E402
from bookloom.sinks.catalog import point_at, register_tables, sync_table, verify_tables  # noqa: E402
from bookloom.sources.spend import ALL  # noqa: E402
from bookloom.sinks.tables import partitions_in, remove_folder  # noqa: E402
from bookloom.sources.tables import load_table, path_exists  # noqa: E402
from bookloom.sources.webhooks import stream_envelopes  # noqa: E402
from bookloom.streaming.intake import start_intake  # noqa: E402
from bookloom.streaming.silver import rebuild_days, settle_days, start_silver  # noqa: E402


@dataclass(frozen=True)
class Lake:
    """One folder per table under a root."""

    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    @property
    def bronze(self) -> str:
        return self.path("bronze", schemas.BRONZE.name)

    @property
    def rejects(self) -> str:
        return self.path("bronze", schemas.REJECTS.name)

    @property
    def repeats(self) -> str:
        return self.path("bronze", schemas.REPEATS.name)

    @property
    def live(self) -> str:
        return self.path("silver", schemas.LIVE_EVENTS.name)

    @property
    def events(self) -> str:
        return self.path("silver", schemas.EVENTS.name)

    @property
    def ranges(self) -> str:
        return self.path("silver", schemas.EVENT_RANGES.name)

    @property
    def spend(self) -> str:
        return self.path("silver", schemas.SPEND.name)

    def gold(self, name: str) -> str:
        """The folder of a table; one without partitions holds its versions there."""
        return self.path("gold", name)

    @property
    def seen(self) -> seen.SeenSet:
        return seen.SeenSet(self.state("seen_bookings"))

    def state(self, name: str) -> str:
        return self.path("state", name)


BUILDERS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    schemas.DAILY_BOOKINGS.name: lambda events, spend: gold.daily_bookings(events),
    schemas.CPB.name: gold.cpb_by_channel,
    schemas.CUMULATIVE.name: lambda events, spend: gold.cumulative_bookings(events),
    schemas.CAMPAIGN_DAILY.name: gold.campaign_daily,
    schemas.TIME_FEATURES.name: lambda events, spend: gold.time_features(events),
    schemas.MEETING_FEATURES.name: lambda events, spend: gold.meeting_features(events),
}


def silver_tables(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    return load_table(spark, lake.events, schemas.EVENTS), load_table(spark, lake.spend, schemas.SPEND)


def build_gold(spark: SparkSession, lake: Lake, name: str) -> None:
    """Build one reporting table from all silver rows."""
    if name == schemas.CPB.name:
        seen.build_cpb(*silver_tables(spark, lake), lake.seen, lake.gold(name))
        return
    refresh.build(lake.gold(name), schemas.GOLD[name], BUILDERS[name](*silver_tables(spark, lake)))


def refresh_gold(
    spark: SparkSession, lake: Lake, name: str, start: T.Day, end: T.Day, mode: str = "overwrite",
    weeks: list[T.Day] | None = None,
) -> list[str]:
    """The days from `start` to `end` of one reporting table; of the meetings table the given weeks, if any."""
    if name == schemas.CPB.name:
        seen.refresh_cpb(*silver_tables(spark, lake), lake.seen, lake.gold(name), start, end)
        return []
    known = ranges.load(spark, lake.ranges)
    if weeks and name == schemas.MEETING_FEATURES.name:
        events, _ = silver_tables(spark, lake)
        return refresh.refresh_meeting_features(events, lake.gold(name), weeks=weeks, mode=mode, ranges=known)
    return refresh.refresh_range(name, *silver_tables(spark, lake), lake.gold(name), start, end, mode, known)


def gold_path(spark: SparkSession, lake: Lake, name: str) -> str:
    """Where the rows of a reporting table are now."""
    if schemas.GOLD[name].by:
        return lake.gold(name)
    return versions.current(spark, lake.gold(name)) or versions.version_path(lake.gold(name), 1)


def load_gold(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    return load_table(spark, gold_path(spark, lake, name), schemas.GOLD[name])


def lake_tables(spark: SparkSession, lake: Lake) -> dict[str, tuple[str, schemas.TableLayout]]:
    """Folder and layout of the silver and gold tables."""
    tables = {schemas.EVENTS.name: (lake.events, schemas.EVENTS), schemas.SPEND.name: (lake.spend, schemas.SPEND)}
    return {**tables, **{name: (gold_path(spark, lake, name), layout) for name, layout in schemas.GOLD.items()}}


def register_lake(spark: SparkSession, lake: Lake, database: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Catalog entries for the silver and gold tables; returns their row counts, and ten rows of each."""
    tables = lake_tables(spark, lake)
    register_tables(spark, database, tables)
    return verify_tables(spark, {f"{database}.{name}": layout.columns for name, (_, layout) in tables.items()})


def sync_lake(spark: SparkSession, lake: Lake, database: str) -> None:
    """Let the registered tables show what the last run wrote."""
    for name, (path, layout) in lake_tables(spark, lake).items():
        if spark.catalog.tableExists(f"{database}.{name}"):
            if not layout.by:
                point_at(spark, f"{database}.{name}", path, layout)
            sync_table(spark, f"{database}.{name}", layout)


def follow_webhooks(spark: SparkSession, lake: Lake, envelopes: str, max_files: int | None = None) -> None:
    """Take in the envelopes that have arrived, fold them into the live silver table, and settle the days they touch."""
    source = stream_envelopes(spark, envelopes, max_files)
    start_intake(source, lake.bronze, lake.rejects, lake.repeats, lake.state("intake")).awaitTermination()
    waiting = lake.state("unsettled_days")  # noted on disk, so that a run that dies leaves them to the next one

    def note(days: list[str]) -> None:
        spark.createDataFrame([(d,) for d in days], "dt string").write.mode("append").parquet(waiting)

    start_silver(spark, lake.bronze, lake.repeats, lake.live, lake.state("silver"), on_days=note).awaitTermination()
    if path_exists(spark, waiting):
        settle_days(spark, lake.live, lake.events, partitions_in(spark.read.schema("dt string").parquet(waiting), "dt"), lake.ranges)
        remove_folder(spark, waiting)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    runs = top.add_subparsers(dest="run", required=True)

    def run(name: str, *options: str, optional: tuple[str, ...] = ()) -> argparse.ArgumentParser:
        one = runs.add_parser(name)
        for option in ("--lake", *options):
            one.add_argument(option, required=True)
        for option in optional:
            one.add_argument(option)
        return one

    events = run("events", "--start", "--end", optional=("--bronze", "--database"))
    events.add_argument("--append", action="store_true")
    events.add_argument("--from-table", action="store_true", help="replay the bronze table of the lake instead of JSON folders")
    run("spend", "--files", optional=("--database",)).add_argument("--day", default=ALL)
    run("build", optional=("--table", "--database"))
    again = run("refresh", optional=("--as-of", "--start", "--end", "--table", "--database"))
    again.add_argument("--append", action="store_true")
    again.add_argument("--weeks", nargs="+", help="Mondays of the weeks to rebuild in the meetings table")
    run("register", "--database")
    run("intake", "--envelopes").add_argument("--max-files", type=int)
    return top


def asked_days(args: argparse.Namespace) -> tuple[T.Day, T.Day]:
    """The range of a refresh: `--start` to `--end`, or the day before `--as-of`."""
    return (args.start, args.end) if args.start else (T.yesterday(args.as_of), T.yesterday(args.as_of))


def check(top: argparse.ArgumentParser, args: argparse.Namespace) -> None:
    if args.run == "refresh" and (bool(args.start) != bool(args.end) or bool(args.as_of) == bool(args.start)):
        top.error("refresh takes either --as-of, or --start and --end")
    if args.run == "events" and (bool(args.bronze) == args.from_table or (args.from_table and args.append)):
        top.error("events takes either --bronze, or --from-table, which always replaces")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    top = parser()
    args = top.parse_args(argv)
    check(top, args)
    spark = spark or build_session(f"bookloom-{args.run}")
    lake = Lake(args.lake)
    mode = "append" if getattr(args, "append", False) else "overwrite"
    names = [args.table] if getattr(args, "table", None) else list(schemas.GOLD)
    if args.run == "events" and args.from_table:
        rebuild_days(spark, lake.bronze, lake.events, T.date_range(args.start, args.end), ranges_path=lake.ranges,
                     repeats_path=lake.repeats)
    elif args.run == "events":
        silver.rebuild_events(spark, args.bronze, lake.events, args.start, args.end, mode=mode, ranges_path=lake.ranges)
    elif args.run == "spend":
        silver.build_spend(spark, args.files, lake.spend, args.day)
    elif args.run == "build":
        for name in names:
            build_gold(spark, lake, name)
    elif args.run == "refresh":
        for name in names:
            refresh_gold(spark, lake, name, *asked_days(args), mode, args.weeks)
    elif args.run == "register":
        counts, samples = register_lake(spark, lake, args.database)
        counts.show(truncate=False)
        for name, rows in samples.items():
            print(name)
            rows.show(truncate=40)
    elif args.run == "intake":
        follow_webhooks(spark, lake, args.envelopes, args.max_files)
    if args.run != "register" and getattr(args, "database", None):
        sync_lake(spark, lake, args.database)


if __name__ == "__main__":
    main()
