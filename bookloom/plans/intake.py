"""Webhook envelopes -> bronze rows and rejects. The same plan serves a batch and a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom import schemas
from bookloom.functions import webhooks as W
from bookloom.operators.selection import aside, dedup_latest, latest_by_key, repeats, same_key, with_key_in

KEY = ["dt", "event", "event_id"]
BAD_BASE64 = "bad_base64"
NOT_AN_OBJECT = "not_an_object"


def route_webhooks(envelopes: DataFrame) -> DataFrame:
    """Decode and parse every envelope; `reason` is null for the rows that can be stored.

    Text that is no JSON is stored as an object with the text under "raw". The day is the UTC day of receipt.
    """
    decoded = envelopes.withColumn("content", W.decode_body(F.col("body"), F.col("is_base64")))
    texts = decoded.withColumn("text", W.text_of(F.col("content")))
    # Every body is parsed once: the random id next to the parse keeps later filters from being moved below it,
    # where they would repeat it.
    parsed = texts.withColumns({
        "members": W.parse_members(F.col("content"), F.col("text")), "random_id": F.uuid()})
    return parsed.withColumn("value", W.only_member(F.col("members"), F.col("text"))).select(
        F.date_format("received_at", "yyyy-MM-dd").alias("dt"),
        "received_at",
        "body",
        "is_base64",
        "random_id",
        "value",
        "text",
        F.when(F.col("content").isNull(), F.lit(BAD_BASE64))
        .when(F.col("value").isNotNull() & ~W.is_object(F.col("text")), F.lit(NOT_AN_OBJECT)).alias("reason"),
    )


def split_rejects(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bronze rows, and the envelopes that cannot be stored together with the reason."""
    stored = routed.filter(F.col("reason").isNull()).select(
        W.event_id(F.col("value"), F.col("random_id")).alias("event_id"),
        F.when(F.col("value").isNull(), W.raw_body(F.col("text"))).otherwise(F.col("text")).alias("body"),
        "received_at",
        "dt",
        W.event_name(F.col("value")).alias("event"),
    )
    rejected = routed.filter(F.col("reason").isNotNull()).withColumnRenamed("random_id", "reject_id")
    return stored.select(*schemas.BRONZE.columns), rejected.select(*schemas.REJECTS.columns)


def latest_copies(bronze: DataFrame) -> DataFrame:
    """One row per (day, event, id): the copy received last, as a repeated write to the same key leaves it."""
    return dedup_latest(bronze, KEY, [F.desc("received_at"), F.desc("body")])


def staged(routed: DataFrame) -> DataFrame:
    """Routed envelopes as they are written once, before anything reads them more than once."""
    good = F.col("reason").isNull()
    return routed.select(
        F.when(good, W.event_id(F.col("value"), F.col("random_id"))).otherwise(F.col("random_id")).alias("event_id"),
        F.when(~good, F.col("body")).when(F.col("value").isNull(), W.raw_body(F.col("text"))).otherwise(F.col("text")).alias("body"),
        "is_base64", "received_at", "reason",
        F.when(good, W.event_name(F.col("value"))).alias("event"), "dt", F.monotonically_increasing_id().alias("row"),
    ).select(*schemas.STAGED.columns)


def staged_webhooks(table: DataFrame) -> DataFrame:
    return table.where("reason IS NULL")


def staged_rejects(table: DataFrame) -> DataFrame:
    rejected = table.where("reason IS NOT NULL").withColumnRenamed("event_id", "reject_id")
    return rejected.select(*schemas.REJECTS.columns)


def latest_staged(table: DataFrame) -> DataFrame:
    """The same rows as `latest_copies`, decided on keys and times; bodies stay where they are."""
    return latest_by_key(staged_webhooks(table), KEY, "received_at", "body").select(*schemas.BRONZE.columns)


def later_rows(table: DataFrame, known: DataFrame) -> DataFrame:
    """Names (`row`) of the staged webhooks that are not the first of their key.

    `known` holds the keys stored before. Of the copies in the table itself the one received first counts as first. Keys
    and times decide, in one join; no body is read.
    """
    narrow = staged_webhooks(table).select(*KEY, "received_at", "row")
    copies = narrow.withColumn("known", F.lit(False)).unionByName(known.select(*KEY, F.lit(True).alias("known")), allowMissingColumns=True)
    first = F.when(~F.max("known"), F.min(F.struct("received_at", "row"))["row"]).alias("first")
    return narrow.join(aside(repeats(copies, KEY, first), KEY, "first"), same_key(KEY)).where("first IS NULL OR row <> first").select("row")


def dealt(table: DataFrame, later: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged webhooks without and with those named by `later`: the bodies are joined to names only."""
    webhooks = staged_webhooks(table)
    return webhooks.join(later, "row", "left_anti"), webhooks.join(later, "row", "left_semi")


def first_and_later(table: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged webhooks that are the first of their key, and all later copies."""
    return dealt(table, later_rows(table, known))


def resolve(bronze: DataFrame, later: DataFrame) -> DataFrame:
    """The last copy of each key from the first copies and the later ones: only keys with a later copy are compared."""
    again = later.select(*KEY).distinct()
    return with_key_in(bronze, again, KEY, inside=False).unionByName(
        latest_copies(with_key_in(bronze, again, KEY).unionByName(later)))


def ingest_webhooks(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batch intake: deduplicated bronze rows and rejects."""
    stored, rejected = split_rejects(route_webhooks(envelopes))
    return latest_copies(stored), rejected
