"""Reading webhook bodies and the identifiers inside them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path patterns of the scheduling service, the default event name and the known event types.
INVITEE_ID = r"/invitees/([^/?]+)$"
SCHEDULED_EVENT_ID = r"/scheduled_events/([^/?]+)$"
EVENT_TYPE_ID = r"/event_types/([^/?]+)$"
UNKNOWN_EVENT = "unknown_event"
CHANNEL_OF_EVENT_TYPE = {
    "d639ecd3-8718-4068-955a-436b10d72c78": "facebook_paid_ads",
    "dbb4ec50-38cd-4bcd-bbff-efb7b5a6f098": "youtube_paid_ads",
    "bb339e98-7a67-4af2-b584-8dbf95564312": "tiktok_paid_ads",
}


def decode_body(body: Column, is_base64: Column) -> Column:
    """Bytes of the body; no body gives no bytes. Null marks base64 that cannot be decoded.

    Characters outside the base64 alphabet are skipped, wrong padding is an error.
    """
    text = F.coalesce(body, F.lit(""))
    coded = F.regexp_replace(text, "[^A-Za-z0-9+/=]", "")
    well_formed = (F.length(coded) % 4 == 0) & coded.rlike("^[A-Za-z0-9+/]*={0,2}$")
    return (
        F.when(~F.coalesce(is_base64, F.lit(False)), F.encode(text, "UTF-8"))
        .when(well_formed, F.try_to_binary(coded, F.lit("base64"))))


def text_of(content: Column) -> Column:
    """Bytes as text; no bytes stand for an empty object. Bytes that are not UTF-8 are dropped."""
    text = content.cast("string")
    readable = F.when(F.is_valid_utf8(text), text).otherwise(
        F.replace(F.make_valid_utf8(text), F.lit("�"), F.lit("")))
    return F.when(F.length(content) == 0, F.lit("{}")).otherwise(readable)


def parse_members(content: Column, text: Column) -> Column:
    """The text parsed as the members of an array; null when that is no JSON or the bytes are not UTF-8.

    The parser stops behind a complete value and accepts any rest. So the text is put into an array before its own
    hash, which no text can contain: only if the text is one whole value does the hash stand second and last.
    """
    members = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), F.sha2(text, 256), F.lit('"]')))
    return F.when(F.is_valid_utf8(content.cast("string")), members)


def only_member(members: Column, text: Column) -> Column:
    """The JSON value as a variant, or null when the text is not exactly one."""
    alone = (F.try_variant_get(members, "$[1]", "string") == F.sha2(text, 256)) & F.try_variant_get(
        members, "$[2]", "variant").isNull()
    return F.when(alone, F.try_variant_get(members, "$[0]", "variant"))


def raw_body(text: Column) -> Column:
    """Text that is no JSON, kept inside an object."""
    return F.to_json(F.struct(text.alias("raw")))


def is_object(text: Column) -> Column:
    """For text already known to be JSON: its value is an object."""
    return text.rlike(r"^\s*\{")


def text_at(value: Column, path: str) -> Column:
    """Non-empty text at `path`, else null; other types do not count as text."""
    at_path = F.try_variant_get(value, path, "variant")
    return F.when(
        F.schema_of_variant(at_path) == "STRING",
        F.nullif(F.try_variant_get(value, path, "string"), F.lit("")))


def event_name(value: Column) -> Column:
    """The event's name; one that is missing, null or empty cannot name a folder and counts as unknown."""
    return F.coalesce(F.nullif(F.try_variant_get(value, "$.event", "string"), F.lit("")), F.lit(UNKNOWN_EVENT))


def event_id(value: Column, random: Column) -> Column:
    """The same id for every delivery of one event: a hash of its URI; the `random` one when it has none."""
    uri = F.coalesce(text_at(value, "$.payload.uri"), text_at(value, "$.payload.scheduled_event.uri"))
    return F.coalesce(F.sha2(uri, 256), random)


def id_in(uri: Column, pattern: str) -> Column:
    """The identifier at the end of a URI; empty text when the URI has another form, null when it is null."""
    return F.regexp_extract(uri, pattern, 1)


def first_member(members: Column, field: str) -> Column:
    """A field of the first array element; null for an empty or missing array."""
    return F.get(members, F.lit(0)).getField(field)


def map_channel(key: Column, mapping: dict[str, str]) -> Column:
    """Channel of a key; keys that are not in the mapping give null."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.create_map(*pairs)[key] if pairs else F.lit(None).cast("string")


def channel_of_event_type(url: Column, mapping: dict[str, str] | None = None) -> Column:
    """Channel of an event-type URL. A mapping may name whole URLs or the ids at their end."""
    known = CHANNEL_OF_EVENT_TYPE if mapping is None else mapping
    return reduce(lambda a, b: F.coalesce(a, b), [
        map_channel(url, known), map_channel(id_in(url, EVENT_TYPE_ID), known)])
