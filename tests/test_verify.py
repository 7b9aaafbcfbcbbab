"""Fingerprints find changed, missing and doubled rows whatever the order; samples are the same on every run."""

from pyspark.sql import functions as F

from bookloom.operators.selection import sample_rows
from bookloom.sinks.verify import compare, differing_rows, fingerprints
from fixtures import Rows, values

DDL = "id bigint, name string, amount double, dt string"
ROWS = [(1, "a", 1.0, "d1"), (2, None, 2.0, "d1"), (2, None, 2.0, "d1"), (3, "c", None, "d2"), (4, "d", 4.0, None), (5, "e", 5.0, "d3"), (6, "f", 6.0, "d4")]


def statuses(df):
    return {r.dt: (r.n_expected, r.n_stored, r.status) for r in df.collect()}


def test_order_and_files_do_not_matter(spark):
    df = spark.createDataFrame(ROWS, DDL)
    again = df.orderBy(F.desc("id")).repartition(5).select("dt", "amount", "name", "id")
    assert values(fingerprints(df, ["dt"])) == values(fingerprints(again, ["dt"]))
    assert {s for _, _, s in statuses(compare(df, again, ["dt"])).values()} == {"same"}
    assert fingerprints(df.limit(0)).collect()[0].n_rows == 0


def test_what_differs(spark):
    df = spark.createDataFrame(ROWS, DDL)
    other = spark.createDataFrame(
        [(1, "a", 1.0, "d1"), (1, "a", 1.0, "d1"), (2, None, 2.0, "d1"),  # one row twice in place of another
         (3, "", None, "d2"), (4, "d", 4.0, None), (6, "f", 6.0, "d4"), (7, "g", 7.0, "d5")], DDL)
    found = compare(df, other, ["dt"])
    assert statuses(found) == {"d1": (3, 3, "changed"), "d2": (1, 1, "changed"), None: (1, 1, "same"), "d3": (1, 0, "missing"),
                               "d4": (1, 1, "same"), "d5": (0, 1, "unexpected")}
    assert values(differing_rows(df, other).select("id", "name", "side", "surplus")) == Rows([
        (1, "a", "stored", 1), (2, None, "expected", 1), (3, "c", "expected", 1), (3, "", "stored", 1), (5, "e", "expected", 1), (7, "g", "stored", 1)])


def test_no_row_is_shuffled(spark, tmp_path):
    spark.createDataFrame(ROWS, DDL).write.parquet(f"{tmp_path}/t")
    plan = fingerprints(spark.read.parquet(f"{tmp_path}/t"), ["dt"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan[plan.index("Exchange"):]
    assert "partial_" in exchange and "partial_" not in plan[:plan.index("Exchange")]


def test_samples(spark):
    df = spark.createDataFrame(ROWS * 3, DDL)
    first = sample_rows(df, ["id", "name"], 4).collect()
    assert first == sample_rows(df.repartition(6), ["id", "name"], 4).collect() and len(first) == 4
    assert sample_rows(df.limit(0), ["id"]).count() == 0
