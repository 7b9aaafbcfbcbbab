"""Large spend arrays: several tasks read one file, and the records are those of the reader of whole files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from bookloom.sources.spend import read_spend, read_spend_arrays
from fixtures import SPEND, spend_records, values, write_spend_file


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def both(spark, folder):
    columns = ["date", "channel", "spend", "source_file"]
    return values(read_spend_arrays(spark, str(folder)).select(columns)), values(read_spend(spark, str(folder)).select(columns))


def test_sample_files(spark, tmp_path, small_splits):
    for day in ("2025-10-06", "2025-10-08"):
        write_spend_file(tmp_path, day, spend_records(day))
    found, want = both(spark, tmp_path)
    assert found == want and len(found) == 48
    rows = read_spend_arrays(spark, str(tmp_path), "2025-10-08")
    assert rows.rdd.getNumPartitions() > 1 and rows.count() == 27
    assert len(SPEND) == 9


TRICKY = ["a}b", 'a"}', '"{', "}{", "\\", '\\"}', "é}ü", "{}{}", "", " ] , [ ", "\\\\}", 'x\\"{"y']


@pytest.mark.parametrize("indent", [None, 2])
def test_braces_inside_texts_and_objects(spark, tmp_path, small_splits, indent):
    rng = random.Random(3)
    records = []
    for n in range(300):
        record = {"date": f"2025-10-{n % 28 + 1:02d}", "channel": rng.choice(TRICKY), "spend": rng.choice([1.5, None, "x", 7])}
        if n % 5 == 0:
            record["more"] = {"note": rng.choice(TRICKY), "deep": {"list": [{"a": "}"}, {}]}}
        records.append(record)
    (tmp_path / "spend_data_2025-10-01.json").write_text(json.dumps(records, indent=indent, ensure_ascii=False))
    write_spend_file(tmp_path, "2025-10-06", spend_records("2025-10-06"))  # this file needs no second pass
    found, want = both(spark, tmp_path)
    assert found == want and len(found) == 321


@pytest.mark.parametrize("text", ["[]", "[ ]\n", "", '[{"date": "d", "channel": "c", "spend": 1}]', '{"date": "d", "channel": "c", "spend": 1}',
                                  '[{"date": "d", "channel": "a}", "spend": "1"}\n]\n\n'])
def test_short_files(spark, tmp_path, text):
    (tmp_path / "spend_data_2025-10-01.json").write_text(text)
    found, want = both(spark, tmp_path)
    assert found == [r for r in want if any(v is not None for v in r[:3])]


def test_the_main_path_moves_nothing(spark, tmp_path):
    write_spend_file(tmp_path, "2025-10-06", spend_records("2025-10-06"))
    rows = read_spend_arrays(spark, str(tmp_path)).where(F.col("date").isNotNull())
    assert rows.count() == 21
