"""Cross tables with more columns than a pivot may have: the same cells as the long form."""

from pyspark.sql import functions as F

from bookloom.operators.pages import cells, headings, page_of, paged
from bookloom.plans import reports
from fixtures import values


def test_twenty_thousand_campaigns(spark):
    agg = spark.range(60_000).select(
        F.concat(F.lit("s"), F.col("id") % 7).alias("source"), F.format_string("cmp_%05d", F.col("id") % 20_000).alias("campaign"),
        (F.col("id") % 11).alias("bookings"), (F.col("id") / 7).alias("cpb"))
    wide, names = reports.attribution_pages(agg, 250)
    assert names.count() == 20_000 and names.agg(F.max("page")).first()[0] == 79
    assert [r.place for r in names.orderBy("heading").collect()] == list(range(20_000))
    columns = [f"c{n}" for n in range(250)]
    back = wide.select("source", "page", F.posexplode(F.array(*columns)).alias("slot", "value")).join(
        names, ["page", "slot"]).select("source", "heading", "value")
    long = cells(agg, "source", "campaign", "bookings", "sum")
    assert values(back.where("value <> 0")) == values(long.where("value <> 0"))
    page = page_of(wide, names, 3)
    assert page.columns == ["source", *[f"cmp_{n:05d}" for n in range(750, 1000)]]
    want = {r.source: r.value for r in long.where("heading = 'cmp_00800'").collect()}
    assert {r.source: r.cmp_00800 for r in page.collect()} == {f"s{n}": want.get(f"s{n}", 0) for n in range(7)}


def test_small_tables(spark):
    ddl = "source string, campaign string, bookings bigint, cpb double"
    rows = spark.createDataFrame([("a", "x", 1, 0.5), ("a", "x", 2, 1.5), ("b", "y", 3, None), ("b", None, 4, 1.0)], ddl)
    wide, names = reports.attribution_pages(rows, 1, "cpb")
    assert values(names) == [("x", 0, 0, 0), ("y", 1, 1, 0)]
    assert values(wide) == [("a", 0, 1.0), ("b", 1, None)]
    none = headings(rows.limit(0), "campaign", 3)
    assert none.count() == 0 and paged(cells(rows.limit(0), "source", "campaign", "bookings", "sum"), none, "source", 3).count() == 0
