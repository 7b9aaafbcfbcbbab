"""What the operators share: tables written along the way, row keys, word arrays, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import bookloom
from bookloom.session import work_dir

SHIPPED: dict[str, str] = {}
NO_ID = (1 << 63) - 1  # orders rows without an id behind all others


def ship(spark: SparkSession) -> SparkSession:
    """Hand this package to the executors, once per context, as `--py-files` would; keep Arrow batches of texts small,
    by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    context = spark.sparkContext
    if SHIPPED.get(context.applicationId) is None:
        root = Path(bookloom.__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="bookloom-")) / "bookloom_package.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, str(path.relative_to(root.parent)))
        context.addPyFile(str(archive))
        SHIPPED[context.applicationId] = str(archive)
    return spark


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, and a lost executor costs nothing written."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def row_key(text: Column) -> Column:
    """Tells rows apart that share an id; rows equal in id and text share every decision."""
    return F.xxhash64(text)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Join condition on these columns in which null equals null."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def first_by_hash(rows: DataFrame, most: int, *columns: str) -> DataFrame:
    """The `most` rows with the lowest hash of these columns.

    Sorting for them makes every task offer its own `most` rows, which grows with the number of tasks. So the rows are
    counted, and a cutoff on the hash first leaves about twice as many as asked, wherever they are. If equal keys
    leave too few below it, all rows are sorted: the result is the same either way.
    """
    key, n = F.xxhash64(*columns), rows.count()
    cutoff = min(NO_ID, -(1 << 63) + (most << 65) // max(1, n))
    near = rows.where(key <= F.lit(cutoff))
    return (near if near.count() >= min(most, n) else rows).orderBy(key, *columns).limit(most)


class WordHashes:
    """64-bit hashes of words, remembered between texts up to a bound."""

    def __init__(self, most: int = 400_000):
        self.most, self.seen = most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        seen, digest = self.seen, xxhash.xxh64_intdigest
        if len(seen) > self.most:
            seen.clear()
        out = np.empty(len(words), np.uint64)
        out[:] = [seen[w] if w in seen else seen.setdefault(w, digest(w)) for w in words]
        return out


class Runs:
    """Hashes of word runs in constant time each: differences of prefix sums of hash times power, modulo 2**64."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)
    powers = inverses = np.ones(1, np.uint64)

    def __init__(self, hashes: np.ndarray):
        n = len(hashes) + 1
        if len(Runs.powers) < n:
            size = 1 << n.bit_length()
            for name, base in (("powers", self.BASE), ("inverses", self.INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(Runs, name, np.multiply.accumulate(steps))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(hashes * Runs.powers[: n - 1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of words[start:end] for each pair, whatever stands around them."""
        return mixed((self.sums[ends] - self.sums[starts]) * Runs.inverses[starts])

    def all(self, size: int) -> np.ndarray:
        """The hashes of all runs of `size` words; none if there are fewer words."""
        starts = np.arange(max(0, len(self.sums) - size))
        return self.of(starts, starts + size)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lists(batches: Iterator) -> Iterator[list[list]]:
    """The columns of each Arrow batch as Python lists, in slices that keep few texts alive at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            yield [part.column(i).to_pylist() for i in range(part.num_columns)]


def by_bytes(batches: Iterator, column: str, most: int) -> Iterator:
    """Slices of each Arrow batch whose `column` holds about `most` bytes, or a single row."""
    for batch in batches:
        values = batch.column(column)
        values = values.flatten() if hasattr(values, "flatten") and values.type.num_fields else values
        step = max(1, batch.num_rows * most // max(1, values.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link (a, b); the root is the smallest node reachable.

    Alternating stars: every node hands its neighbours to the smallest one it knows, until nothing changes. Each
    round works on at most as many edges as there were links. Minima are written before they are joined, so that
    both sides of the join are plain shuffles, of which adaptive execution splits the one around a hot node.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
                   .distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = stored(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body uses it (also inside lambdas)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_totals(numbers: Column, chunk: int = 64) -> Column:
    """Sums of an array's elements up to and with each one; by chunks, as growing one long array is quadratic."""

    def sums(values: Column) -> Column:
        return F.aggregate(values, F.array().cast("array<int>"), lambda out, x: F.concat(
            out, F.array(F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(0)) + x)))

    def whole(values: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(chunk))
        inner = F.transform(starts, lambda s: sums(F.slice(values, s, F.lit(chunk))))
        return let(inner, lambda parts: let(
            sums(F.transform(parts, lambda p: F.coalesce(F.try_element_at(p, F.lit(-1)), F.lit(0)))),
            lambda ends: F.flatten(F.zip_with(
                parts, F.concat(F.array(F.lit(0)), F.slice(ends, F.lit(1), F.size(ends) - 1)),
                lambda part, before: F.transform(part, lambda x: x + before)))))

    return let(numbers, whole)
