import csv
import glob

import pytest

from bookloom import schemas
from bookloom.session import CHECKPOINT_DIR, work_dir
from bookloom.sinks import catalog
from bookloom.sinks.export import export_csv
from bookloom.sinks.tables import overwrite_partitions, replace_days, write_table
from bookloom.sources.tables import load_or_empty, load_table, path_exists
from fixtures import values


def rows(spark, *days, amount=1.0):
    return spark.createDataFrame([("a", amount, d) for d in days], schemas.SPEND.ddl)


def read(spark, path):
    return [(d, s) for _, s, d in values(load_table(spark, path, schemas.SPEND))]


def test_append_twice_doubles(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        write_table(rows(spark, "2025-10-01"), path, ["dt"])
    assert read(spark, path) == [("2025-10-01", 1.0)] * 2


def test_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(rows(spark, "2025-10-01", "2025-10-02"), path, ["dt"])
    assert overwrite_partitions(rows(spark, "2025-10-02", "2025-10-03", amount=2.0), path, "dt") == [
        "2025-10-02", "2025-10-03"]
    assert read(spark, path) == [("2025-10-01", 1.0), ("2025-10-02", 2.0), ("2025-10-03", 2.0)]
    assert overwrite_partitions(rows(spark).limit(0), path, "dt") == []
    assert len(read(spark, path)) == 3


def test_replace_days(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(rows(spark, "2025-10-01", "2025-10-02", "2025-10-03"), path, ["dt"])
    new = rows(spark, "2025-10-02", "2025-10-04", amount=2.0)
    replace_days(new, path, "dt", ["2025-10-02", "2025-10-03"])
    assert read(spark, path) == [("2025-10-01", 1.0), ("2025-10-02", 2.0)]
    replace_days(new, path, "dt")
    assert read(spark, path) == [("2025-10-01", 1.0), ("2025-10-02", 2.0), ("2025-10-04", 2.0)]


def test_load_or_empty(spark, tmp_path):
    assert load_or_empty(spark, str(tmp_path / "none"), schemas.CUMULATIVE).columns == schemas.CUMULATIVE.columns
    assert not path_exists(spark, str(tmp_path / "none")) and path_exists(spark, str(tmp_path))


def test_register_and_verify(spark, tmp_path):
    path = str(tmp_path / "it's a table")
    write_table(rows(spark, "2025-10-01", "2025-10-02"), path, ["dt"])
    for _ in range(2):
        catalog.register_tables(spark, "check_db", {"events_spend": (path, schemas.SPEND)})
    table = load_table(spark, "check_db.events_spend", schemas.SPEND)
    assert dict(table.dtypes)["dt"] == "string" and table.filter("dt = '2025-10-02'").count() == 1
    counts, samples = catalog.verify_tables(spark, {"check_db.events_spend": ["dt"]})
    assert values(counts) == [("check_db.events_spend", 2)]
    assert len(samples["check_db.events_spend"].collect()) == 2
    write_table(rows(spark, "2025-10-03"), path, ["dt"])
    catalog.sync_table(spark, "check_db.events_spend", schemas.SPEND)
    assert spark.table("check_db.events_spend").count() == 3
    spark.sql("DROP DATABASE check_db CASCADE")


def test_swap_table_may_read_what_it_replaces(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS swap_db")
    first = spark.createDataFrame([("a", 1.0, 1, 1.0)], schemas.CPB.ddl)
    catalog.swap_table(first, "swap_db.cpb", str(tmp_path), schemas.CPB)
    again = spark.table("swap_db.cpb").unionAll(first)
    catalog.swap_table(again, "swap_db.cpb", str(tmp_path), schemas.CPB)
    assert spark.table("swap_db.cpb").count() == 2
    with pytest.raises(ValueError):
        catalog.swap_table(first, "swap_db.other", str(tmp_path), schemas.SPEND)
    spark.sql("DROP DATABASE swap_db CASCADE")


def test_csv_keeps_order_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(n, None if n == 3 else f"x,{n}") for n in range(6, 0, -1)], "n int, t string")
    export_csv(df.repartition(3).orderBy("n"), str(tmp_path / "out"))
    lines = []
    for part in sorted(glob.glob(f"{tmp_path}/out/part-*.csv")):
        with open(part, newline="") as file:
            header, *body = list(csv.reader(file))
            assert header == ["n", "t"]
            lines += body
    assert lines == [[str(n), "" if n == 3 else f"x,{n}"] for n in range(1, 7)]


def test_work_dir_lies_in_the_shared_folder(spark):
    one, two = work_dir(spark, "x"), work_dir(spark, "x")
    assert one.startswith(spark.conf.get(CHECKPOINT_DIR)) and one != two
