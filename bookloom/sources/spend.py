"""Ad-spend files: one JSON array of {date, channel, spend} per file, `spend_data_<day>.json`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions.times import Day, iso

ALL = "ALL"

# Pieces are counted in chunks of so many, dealt to tasks of about so many bytes of text: a sort of a whole split of the file
# would take several times its size in memory.
PIECES_A_CHUNK = 8192
BYTES_A_TASK = 8 * 1024**2


def spend_path(prefix: str, day: Day) -> str:
    """The file of one day, or a pattern for every file when `day` is "ALL"."""
    label = "*" if isinstance(day, str) and day.upper() == ALL else iso(day)
    return f"{prefix.rstrip('/')}/spend_data_{label}.json"


def read_spend(spark: SparkSession, prefix: str, day: Day = ALL) -> DataFrame:
    """Records as written, amounts as text, plus the `source_file` they come from."""
    records = spark.read.schema(schemas.SPEND_RECORD).option("multiLine", True).json(spend_path(prefix, day))
    return records.select("*", F.col("_metadata.file_path").alias("source_file"))


def read_spend_arrays(spark: SparkSession, prefix: str, day: Day = ALL) -> DataFrame:
    """The same records from arrays of any size: several tasks read one file.

    The text is cut at every closing brace, wherever splits fall; a piece with one opening brace and an even number of
    quotes is a whole record. Only files in which some piece is neither (a brace inside a text, or an object inside a record)
    go through a second pass that puts records together again. What stands outside objects is left out; a record that
    is no valid JSON gives nulls, where the reader of whole files would give a file of nulls.
    """
    pieces = spark.read.option("lineSep", "}").text(spend_path(prefix, day)).select(
        F.col("value"), F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))
    marked = pieces.withColumns({"quotes": _quotes(), "opened": _braces(inside=False), "opened_inside": _braces(inside=True)})
    plain = (F.col("quotes") % 2 == 0) & ((F.col("opened") == 1) | _blank())
    broken = marked.groupBy("source_file").agg(F.max(~plain).alias("broken")).where("broken").select("source_file")
    whole = marked.join(broken, "source_file", "left_anti").where("opened = 1").select(F.concat("value", F.lit("}")).alias("record"), "source_file")
    mended = _mend(marked.join(broken, "source_file", "left_semi"), _tasks(spark, spend_path(prefix, day)))
    records = whole.unionByName(mended).select(
        F.from_json(F.regexp_replace("record", r"^[\s,\[]+", ""), schemas.SPEND_RECORD).alias("r"), "source_file")
    return records.select("r.*", "source_file")


def _unescaped() -> Column:
    """A piece without escaped characters, so that every quote left opens or closes a text."""
    return F.regexp_replace("value", r"\\.", "")


def _quotes() -> Column:
    return F.length(F.regexp_replace(_unescaped(), '[^"]', ""))


def _braces(inside: bool) -> Column:
    """Opening braces outside texts, if the piece begins inside or outside of one."""
    text = F.concat(F.lit('"'), _unescaped()) if inside else _unescaped()
    return F.length(F.regexp_replace(F.regexp_replace(text, '"[^"]*("|$)', ""), r"[^{]", ""))


def _blank() -> Column:
    """What stands behind the last record, or around none."""
    return F.col("value").rlike(r"^[\s,\[\]]*$")


CHUNK = ["source_file", "block", "chunk"]


def _tasks(spark: SparkSession, path: str) -> int:
    """Tasks for the text of these files, which are only listed."""
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(spark.sparkContext.defaultParallelism, -(-size // BYTES_A_TASK))


def _before(column: str, label: str, pieces: DataFrame) -> DataFrame:
    """Pieces with the sum of `column` over all pieces of the file in front of them: inside a chunk by one window over it,
    plus the sums of the chunks before, one row each."""
    by_chunk = Window.partitionBy("source_file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*CHUNK).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sums = pieces.groupBy(*CHUNK).agg(F.sum(column).alias("__sum")).select(
        *CHUNK, F.coalesce(F.sum("__sum").over(by_chunk), F.lit(0)).alias("__before"))
    return pieces.join(sums, CHUNK).withColumn(
        label, F.col("__before") + F.coalesce(F.sum(column).over(inside), F.lit(0))).drop("__before")


def _mend(pieces: DataFrame, tasks: int) -> DataFrame:
    """Records put together from their pieces: first it is told which pieces begin inside a text, then how deep in objects
    each one ends; a record is whole where the depth is back at 0."""
    # A number of tasks that is given stays; those of a join would be merged again by their bytes in the shuffle.
    chunks = pieces.withColumn("chunk", F.col("at") - F.col("at") % PIECES_A_CHUNK).repartition(tasks, *CHUNK)
    placed = _before("quotes", "quotes_before", chunks)
    within = F.col("quotes_before") % 2 == 1
    ends_within = (F.col("quotes_before") + F.col("quotes")) % 2 == 1
    opened = F.when(within, F.col("opened_inside")).otherwise(F.col("opened"))
    deep = placed.withColumn("change", opened - F.when(ends_within, 0).otherwise(1))
    deep = _before("change", "depth", deep)
    ends = deep.withColumn("ends", (F.col("depth") + F.col("change") == 0).cast("int"))
    tail = _blank() & (F.col("depth") == 0)  # behind the last record, and no brace follows
    numbered = _before("ends", "record_no", ends).where(~tail)
    parts = numbered.groupBy("source_file", "record_no").agg(F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("parts"))
    return parts.select(F.concat(F.array_join(F.col("parts.value"), "}"), F.lit("}")).alias("record"), "source_file")
