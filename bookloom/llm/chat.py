"""Chat formatting with Spark expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookloom.llm.common import col, let

CONTROLS = ("<s>", "</s>", "<r/>", "<t/>")
# A control string inside a text gets a backslash after its "<"; one that already has some gets one more.
ESCAPE = r"<(\\*(?:/?s|r/|t/)>)"
UNESCAPE = r"<\\(\\*(?:/?s|r/|t/)>)"


@dataclass(frozen=True)
class Template:
    """`<s>role<r/>text</s>` per block; further texts of the same role follow behind `<t/>`."""

    opens: str = "<s>"
    names: str = "<r/>"
    joins: str = "<t/>"
    closes: str = "</s>\n"
    learned: tuple[str, ...] = ("assistant",)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPE), F.lit(r"<\\$1"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(UNESCAPE), F.lit("<$1"))


def format_conversations(
    turns: DataFrame, template: Template = Template(), conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", chunk: int = 256,
) -> DataFrame:
    """One row per conversation: conv_id, n_turns, n_blocks, formatted, segments (array of piece, loss).

    The pieces joined are `formatted`; those with `loss` are what a model is trained on, one per text of a learned
    role. Turns are ordered by turn, then role, then text (nulls first). Adjacent turns of one role become one
    block that keeps a mark between its texts, so that `read_turns` gives the turns back. Null texts and roles
    count as empty, a null conv_id is a conversation of its own, repeated rows stay, an empty table gives no rows,
    other columns are not looked at.

    A first grouping by (conversation, stretch of `chunk` turn numbers) sorts and merges the turns of a stretch, so
    that the work on a long conversation is spread; the second one only joins finished blocks.
    """
    rows = turns.select(
        col(conv).alias("conv_id"),
        F.floor(col(turn) / F.lit(chunk)).alias("stretch"),
        F.struct(col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"),
                 F.coalesce(col(text), F.lit("")).alias("text")).alias("t"),
    )
    block = "array<struct<role:string,texts:array<string>>>"
    stretches = rows.groupBy("conv_id", "stretch").agg(F.sort_array(F.collect_list("t")).alias("turns")).select(
        "conv_id", "stretch", F.aggregate("turns", F.array().cast(block), _merge).alias("blocks"))
    merged = stretches.groupBy("conv_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("stretch", "blocks"))), lambda x: x["blocks"]))
        .alias("blocks"))
    before = merged.withColumn("before", F.concat(
        F.array(F.lit(None).cast("string")), F.transform("blocks", lambda b: b["role"])))
    pieces = F.flatten(F.transform(
        F.slice(F.arrays_zip("blocks", "before"), F.lit(1), F.size("blocks")),
        lambda x: _pieces(x["blocks"]["role"], x["blocks"]["texts"], x["before"], template)))
    end = F.array(F.struct(F.lit(template.closes).alias("piece"), F.lit(False).alias("loss")))
    return (
        before.select(
            "conv_id",
            F.aggregate("blocks", F.lit(0).cast("long"), lambda n, b: n + F.size(b["texts"])).alias("n_turns"),
            F.size(F.filter(F.arrays_zip("blocks", "before"), lambda x: x["blocks"].isNotNull()
                            & ~x["blocks"]["role"].eqNullSafe(x["before"]))).cast("long").alias("n_blocks"),
            F.concat(pieces, end).alias("segments"))
        .select("conv_id", "n_turns", "n_blocks",
                F.array_join(F.transform("segments", lambda s: s["piece"]), "").alias("formatted"), "segments"))


def _merge(blocks: Column, turn: Column) -> Column:
    """Add a turn to the last block if that has its role, else open one."""
    last = F.try_element_at(blocks, F.lit(-1))
    joined = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
    opened = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
    return F.when(
        last.isNotNull() & (last["role"] == turn["role"]),
        F.concat(F.slice(blocks, F.lit(1), F.size(blocks) - 1), F.array(joined)),
    ).otherwise(F.concat(blocks, F.array(opened)))


def _pieces(role: Column, texts: Column, before: Column, template: Template) -> Column:
    """The pieces of one block: its head (or a mark, if the block before has the same role), its texts, marks between."""
    head = (
        F.when(before.isNull(), F.concat(F.lit(template.opens), escape(role), F.lit(template.names)))
        .when(before == role, F.lit(template.joins))
        .otherwise(F.concat(F.lit(template.closes + template.opens), escape(role), F.lit(template.names))))
    learned = role.isin(*template.learned)
    return F.flatten(F.transform(texts, lambda text, i: F.array(
        F.struct(F.when(i == 0, head).otherwise(F.lit(template.joins)).alias("piece"), F.lit(False).alias("loss")),
        F.struct(escape(text).alias("piece"), learned.alias("loss")))))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns back from a formatted text: array of (role, text)."""
    blocks = F.split(formatted, _literal(template.closes), -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        parts = F.split(F.substr(block, F.lit(len(template.opens) + 1)), _literal(template.names), -1)
        return let(parts, lambda p: let(unescape(p[0]), lambda role: F.transform(
            F.split(p[1], _literal(template.joins), -1),
            lambda text: F.struct(role.alias("role"), unescape(text).alias("text")))))

    return F.flatten(F.transform(blocks, turns))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["piece"])), "")


def _literal(text: str) -> str:
    return r"\Q" + text + r"\E"
