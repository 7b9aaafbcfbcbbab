"""Cheapest repair of conversations into system? (user assistant)+, by block tables over normalised cost vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.llm.common import col, same, stored

# What may follow: a system turn only opens, then user and assistant take turns. A repaired conversation ends behind
# an assistant's turn, or is empty.
OPEN, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {OPEN: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
# A row is one of ten symbols: to be deleted; role s, u, a or other, each whole or truncated; filling of a block.
DELETED, FILLING, SYMBOLS = 0, 9, 10
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3  # costs; keeping costs nothing
BLOCK = 4

WHITE, ENDS = "\x20\t\n\v\f\r", frozenset(".!?")


def symbol(role: str, truncated: bool) -> int:
    return 1 + 2 * (INITIALS.find(role[:1]) if role and role[0] in INITIALS else 3) + truncated


def options(state: int, x: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may happen to a row with symbol x, in the order of the letters."""
    found = [("D", DELETE, state)]
    if x != DELETED:
        kind, extra = (x - 1) // 2, TRUNCATED * ((x - 1) % 2)
        if kind == 0 and state == OPEN:
            found.append(("K", extra, SYSTEM))
        if kind in (1, 2) and FOLLOWS[state] == (USER, ASSISTANT)[kind - 1]:
            found.append(("K", extra, FOLLOWS[state]))
        found.append(("R", REROLE + extra, FOLLOWS[state]))
    return found


def with_inserts(costs: Iterable[int]) -> tuple[int, ...]:
    """The least cost from each state when turns may be inserted first; more than two of them only lead in a circle."""
    costs = list(costs)
    for _ in range(2):
        costs = [min(c, INSERT + costs[FOLLOWS[state]]) for state, c in enumerate(costs)]
    return tuple(costs)


class Tables:
    """Cost vectors (the least cost to the end from each of the four states, less their minimum), and what symbols and
    blocks of symbols make of them, from the right to the left.

    step, step_cost: by vector and symbol; jump, jump_cost: by vector and block of `size` symbols, the leftmost symbol the
    highest digit; moves: the letters and the next state by state, symbol and vector behind the symbol.
    """

    def __init__(self, size: int = BLOCK):
        self.size = size
        end = with_inserts([0, 99, 99, 0])
        vectors, number, step, step_cost = [end], {end: 0}, [], []
        for vector in vectors:  # grows while it is walked, until no symbol leads to a new vector
            row, cost = [], []
            for x in range(SYMBOLS):
                new = vector if x == FILLING else with_inserts(
                    min(c + vector[to] for _, c, to in options(state, x)) for state in range(4))
                least = min(new)
                new = tuple(v - least for v in new)
                if new not in number:
                    number[new] = len(vectors)
                    vectors.append(new)
                row.append(number[new])
                cost.append(least)
            step.append(row)
            step_cost.append(cost)
        self.vectors, self.end = vectors, 0
        self.step, self.step_cost = np.array(step, np.int32), np.array(step_cost, np.int64)
        self.steps = step
        jump, jump_cost = np.arange(len(vectors))[:, None], np.zeros((len(vectors), 1), np.int64)
        for _ in range(size):
            both = self.step[jump], jump_cost[:, :, None] + self.step_cost[jump]
            jump, jump_cost = (b.transpose(0, 2, 1).reshape(len(vectors), -1) for b in both)
        self.jump, self.jump_cost = np.ascontiguousarray(jump.T), np.ascontiguousarray(jump_cost.T)
        self.moves = [[[self._move(state, x, v) for v in range(len(vectors))] for x in range(SYMBOLS)] for state in range(4)]
        self.last = ["", "II", "I", ""]  # inserts behind the last row

    def _move(self, state: int, x: int, behind: int) -> tuple[str, int]:
        """The least letters on a cheapest way over one row: at each point the first letter that stays on one."""
        if x == FILLING:
            return "", state
        costs, letters = self.vectors[behind], ""
        here = with_inserts(min(c + costs[to] for _, c, to in options(s, x)) for s in range(4))
        while True:
            ways = [(letter, to) for letter, c, to in options(state, x) if c + costs[to] == here[state]]
            if ways and ways[0][0] == "D":
                return letters + "D", state
            if INSERT + here[FOLLOWS[state]] == here[state]:
                letters, state = letters + "I", FOLLOWS[state]
                continue
            return letters + ways[0][0], ways[0][1]

    def codes(self, symbols: bytes) -> np.ndarray:
        """A row's symbols as blocks, the first block filled up in front."""
        padded = np.concatenate([np.full(-len(symbols) % self.size, FILLING, np.uint8), np.frombuffer(symbols, np.uint8)])
        return padded.reshape(-1, self.size) @ (SYMBOLS ** np.arange(self.size - 1, -1, -1))

    def summary(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For every vector behind the symbols the one in front of them, and the cost between."""
        at, cost = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for code in self.codes(symbols)[::-1]:
            cost += self.jump_cost[code][at]
            at = self.jump[code][at]
        return at, cost

    def trace(self, symbols: bytes, behind: int, starts: Iterable[int]) -> dict[int, str]:
        """The letters for each first state, given the vector behind the last symbol.

        A walk from the right finds the vector behind each block by lookup. Then each block is expanded, from its right
        end backward, into the vectors behind each of its rows, with which the letters are chosen forward.
        """
        codes = self.codes(symbols).tolist()
        ends = [behind] * len(codes)
        for i in range(len(codes) - 1, 0, -1):
            ends[i - 1] = int(self.jump[codes[i], ends[i]])
        starts = list(starts)
        states, letters = list(starts), [[] for _ in starts]
        fill, step = len(codes) * self.size - len(symbols), self.steps
        for i, vector in enumerate(ends):
            block = symbols[max(0, i * self.size - fill): (i + 1) * self.size - fill]
            inner = []
            for x in reversed(block):
                inner.append(vector)
                vector = step[vector][x]
            inner.reverse()
            for k, state in enumerate(states):
                for x, v in zip(block, inner, strict=True):
                    said, state = self.moves[state][x][v]
                    letters[k].append(said)
                states[k] = state
        return {s: "".join(said) for s, said in zip(starts, letters, strict=True)}


@lru_cache(maxsize=2)
def tables(size: int = BLOCK) -> Tables:
    return Tables(size)


def apply_edits(letters: str, state: int, rows: Iterable[tuple[str, str]]) -> tuple[list[tuple[str, str]], int]:
    """The repaired turns, and the state behind them."""
    rows, out = iter(rows), []
    for letter in letters:
        if letter == "I":
            state = FOLLOWS[state]
            out.append((ROLE[state], ""))
            continue
        role, text = next(rows)
        if letter == "R":
            state = FOLLOWS[state]
            out.append((ROLE[state], text))
        elif letter == "K":
            state = SYSTEM if role[:1] == "s" else FOLLOWS[state]
            out.append((role, text))
    return out, state


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, gone) with faults by crc32(`conv_id:turn`) mod 20: 0 drops the row (it stays with `gone`,
    so that its conversation does), 1 empties the text, 2 takes out `.`, `!` and `?`, 3 repeats the row, 4 makes the role
    user. Null roles and texts, and nulls in the hashed text, count as one blank; a null turn stays null."""
    blank = F.lit(" ")
    rows = turns.select(col(conv).cast("long").alias("conv_id"), col(turn).cast("long").alias("turn"),
                        F.coalesce(col(role).cast("string"), blank).alias("role"), F.coalesce(col(text).cast("string"), blank).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    hurt = rows.withColumn("fault", F.crc32(key.cast("binary")) % 20)
    fault = F.col("fault")
    return hurt.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault.isin(0, 1), "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (fault == 0).alias("gone"), F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


STRETCH = ("conv_id long, stretch long, roles array<string>, texts array<string>, marks binary, keys array<binary>, firsts array<boolean>, "
           "illegal long, head string, tail string, low long, high long, distinct long")
CHAINS = ("su", "ua", "au")


def _types(schema: str) -> list[tuple[str, pa.DataType]]:
    plain = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    pairs = [f.split() for f in schema.split(", ")]
    return [(name, pa.list_(plain[kind[6:-1]]) if kind.startswith("array<") else plain[kind]) for name, kind in pairs]


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = _types(schema)
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)], [n for n, _ in types])


def _mark(role: str, text: str) -> int:
    """A row's symbol by itself; blank rows are to be deleted."""
    shown = text.rstrip(WHITE)
    return symbol(role, shown[-1] not in ENDS) if shown else DELETED


def stretches(rows: DataFrame, most_rows: int = 1024, most_chars: int = 1 << 20) -> DataFrame:
    """The rows of each conversation in order, cut into stretches that no task finds too large.

    Order within a conversation: turn (nulls first), role, the first 64 characters of the text, a hash of it. Rows are
    dealt out by ranges of that order, so that a long conversation spreads over tasks; rows alike in all of it are the
    same and may be split anywhere. `firsts` tells whether a row is the first with its role and text in its stretch.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        chars, conv, begun = 0, None, False

        def whole() -> tuple:
            seen: set[bytes] = set()
            roles, texts = [r for _, r, _ in held], [t for _, _, t in held]
            keys = [xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode()) for role, text in zip(roles, texts, strict=True)]
            firsts = [not (k in seen or seen.add(k)) for k in keys]
            marks = bytes(_mark(role, text) for role, text in zip(roles, texts, strict=True))
            illegal = sum(a[:1] + b[:1] not in CHAINS for a, b in zip(roles, roles[1:]))
            turns = [t for t, _, _ in held if t is not None]
            ends = (roles[0][:1], roles[-1][:1]) if roles else (None, None)
            span = (turns[0], turns[-1]) if turns else (None, None)
            return conv, number, roles, texts, marks, keys, firsts, illegal, *ends, *span, len(set(turns))

        for batch in batches:
            out, size = [], 0
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if begun and (row[0] != conv or len(held) >= most_rows or held and chars + len(row[3]) > most_chars):
                    out.append(whole())
                    size += chars
                    number, held, chars = number + 1, [], 0
                    if size > most_chars:
                        yield _arrow(out, STRETCH)
                        out, size = [], 0
                conv, begun = row[0], True
                if not row[4]:
                    held.append(row[1:4])
                    chars += len(row[3])
            if out:
                yield _arrow(out, STRETCH)
        if begun:
            yield _arrow([whole()], STRETCH)

    order = ["conv_id", "turn", "role", "head", "hash"]
    keyed = rows.withColumn("head", F.substring("text", 1, 64)).withColumn("hash", F.xxhash64("text")).withColumn(
        "spread", F.monotonically_increasing_id())
    return keyed.repartitionByRange(*order, "spread").sortWithinPartitions(*order).select(
        "conv_id", "turn", "role", "text", "gone").mapInArrow(cut, STRETCH)


def first_rows(parts: DataFrame) -> DataFrame:
    """(stretch, kept): for conversations of several stretches, the places of rows with a role and text not seen before."""
    several = parts.groupBy("conv_id").count().where("count > 1").select("conv_id")
    long = parts.select("conv_id", "stretch", "keys", "firsts")
    long = long.join(several, same(long, several, "conv_id"), "left_semi")
    rows = long.select("conv_id", "stretch", F.posexplode(F.arrays_zip("keys", "firsts")).alias("place", "row"))
    rows = rows.where("row.firsts").select("conv_id", F.col("row.keys").alias("key"), F.struct("stretch", "place").alias("at"))
    kept = rows.groupBy("conv_id", "key").agg(F.min("at").alias("at")).groupBy(F.col("at.stretch").alias("stretch")).agg(
        F.sort_array(F.collect_list("at.place")).alias("kept"))
    # a stretch that brings nothing new keeps an empty list
    return long.select("stretch").join(kept, "stretch", "left").select("stretch", F.coalesce("kept", F.array().cast("array<int>")).alias("kept"))


@dataclass
class _Conversation:
    """What is known of a conversation while its stretches pass by."""

    conv: int | None
    state: int = OPEN
    cost: int | None = None
    low: int | None = None
    high: int | None = None
    distinct: int = 0
    counts: list[int] = field(default_factory=lambda: [0, 0, 0, 0])  # blank, duplicate, truncated, illegal
    before: str | None = None
    letters: list[str] = field(default_factory=list)
    digest: object = field(default_factory=hashlib.sha256)
    written: bool = False


NARROW = "stretch long, conv_id long, symbols binary, fronts binary, costs binary, blank long, duplicate long, truncated long"
BEHIND = "stretch long, vector int, opens boolean, cost long"
REPORT = "struct<gaps:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint,audit:string,repaired_sha256:string>"


def repair_conversations(rows: DataFrame, most_rows: int = 1024, most_chars: int = 1 << 20) -> DataFrame:
    """(conv_id, stretch, repaired, report): the repaired turns (role, text) in stretches by ascending number, and on the
    last stretch of each conversation its report.

    `rows` has conv_id, turn, role, text (neither role nor text null) and gone (true: the row counts for nothing, but
    keeps its conversation). Faults: blank (no visible character), duplicate (role and text seen earlier), truncated (the
    last visible character ends no sentence); the first that holds counts. Edits: keep 0, other role 3, delete 4 (blank and
    duplicate rows must go), insert an empty turn 3, an undeleted truncated row 3 more. The edits are the cheapest, of
    equally cheap ones those whose letters come first. A null conv_id is a conversation of its own; rows without turn come
    first; a conversation without rows has zeros, no letters and the digest of the empty text; an empty table gives no
    rows. `gaps` counts turn numbers missing between the smallest and the largest.

    Passes: (1) rows are sorted into stretches; (2) each stretch becomes a table from the cost vector behind it to the
    one in front; (3) per conversation, from its last stretch backward, these give the vector behind each; (4) each
    stretch is traced from every state it can begin in; (5) per conversation, forward, the traces that hold are
    picked and applied. Passes 3 and 5 read one row per stretch in sorted order and hold one conversation's letters only.
    """
    parts = stored(stretches(rows, most_rows, most_chars), "stretches")
    marked = parts.select("stretch", "conv_id", "marks", "firsts").join(first_rows(parts), "stretch", "left")
    narrow = stored(marked.select("stretch", "conv_id", "marks", "firsts", "kept").mapInArrow(_summaries, NARROW), "summaries")
    behind = narrow.select("conv_id", "stretch", "fronts", "costs").repartition("conv_id").sortWithinPartitions(
        "conv_id", F.desc("stretch")).mapInArrow(_behind, BEHIND)
    traced = narrow.drop("fronts", "costs").join(behind, "stretch")
    kept = [c for c in traced.columns if c not in ("symbols", "vector", "opens")]
    traced = traced.select("symbols", "vector", "opens", *kept).mapInArrow(_traces, "letters array<string>, " + ", ".join(
        f"{c} {traced.schema[c].dataType.simpleString()}" for c in kept))
    both = parts.drop("marks", "keys", "firsts").unionByName(traced, allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "stretch", F.col("letters").isNull())
    return both.mapInArrow(_apply, f"conv_id long, stretch long, repaired array<struct<role:string,text:string>>, report {REPORT}")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols, faults, and for each vector behind a stretch the vector in front of it with the cost between."""
    known = tables()
    for batch in batches:
        out = []
        for stretch, conv, marks, firsts, kept in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kept is not None:
                kept = set(kept)
                firsts = [i in kept for i in range(len(marks))]
            symbols = bytes(m if first else DELETED for m, first in zip(marks, firsts, strict=True))
            blank = marks.count(DELETED)
            gone = symbols.count(DELETED)
            truncated = sum(x != DELETED and (x - 1) % 2 for x in symbols)
            fronts, costs = known.summary(symbols)
            out.append((stretch, conv, symbols, fronts.astype(np.int32).tobytes(), costs.tobytes(), blank, gone - blank, truncated))
        yield _arrow(out, NARROW)


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the last stretch of each conversation backward: the vector behind each stretch, the cost from its front."""
    known = tables()
    conv, begun, vector, cost, pending = None, False, known.end, 0, None
    for batch in batches:
        out = []
        for this, stretch, fronts, costs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            fresh = not begun or this != conv
            if pending is not None:
                out.append((*pending[:2], fresh, pending[2]))
            if fresh:
                conv, begun, vector, cost = this, True, known.end, 0
            front = int(np.frombuffer(fronts, np.int32)[vector])
            cost += int(np.frombuffer(costs, np.int64)[vector])
            pending = (stretch, vector, cost + known.vectors[front][OPEN])
            vector = front
        yield _arrow(out, BEHIND)
    if pending is not None:
        yield _arrow([(*pending[:2], True, pending[2])], BEHIND)


def _traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The letters for each first state that can occur (any, but only the open one at the front)."""
    known = tables()
    for batch in batches:
        letters = []
        for symbols, vector, opens in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            found = known.trace(symbols, vector, (OPEN,) if opens else range(4))
            letters.append([found.get(s) for s in range(4)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(letters, pa.list_(pa.string())), *batch.columns[3:]], ["letters", *batch.schema.names[3:]])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forward over each conversation: the trace of a stretch comes just before its texts."""
    known = tables()
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    report = pa.struct([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")])
    now: _Conversation | None = None
    trace, pending = None, None

    def write(turns: list[tuple[str, str]]) -> None:
        for role, text in turns:
            now.digest.update((("\n" if now.written else "") + f"{role}:{text}").encode())
            now.written = True

    def closed() -> tuple:
        """The last stretch of a conversation, with the turns missing at its end, and the report."""
        conv, stretch, turns = pending
        said = known.last[now.state]
        extra, _ = apply_edits(said, now.state, ())
        write(extra)
        gaps = now.high - now.low + 1 - now.distinct if now.low is not None else 0
        return conv, stretch, turns + extra, (gaps, *now.counts, now.cost, "".join(now.letters) + said, now.digest.hexdigest())

    def emitted(out: list[tuple]) -> pa.RecordBatch:
        conv, stretch, turns, reports = list(zip(*out, strict=True)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(conv, pa.int64()), pa.array(stretch, pa.int64()),
             pa.array([[{"role": r, "text": t} for r, t in ts] for ts in turns], pa.list_(turn)),
             pa.array([r and dict(zip(report.names, r, strict=True)) for r in reports], report)],
            ["conv_id", "stretch", "repaired", "report"])

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["letters"] is not None:
                trace = row
                continue
            if now is None or now.conv != row["conv_id"]:
                if now is not None:
                    out.append(closed())
                now = _Conversation(row["conv_id"], cost=trace["cost"])
            else:
                out.append((*pending, None))
            for i, name in enumerate(("blank", "duplicate", "truncated")):
                now.counts[i] += trace[name]
            now.counts[3] += row["illegal"]
            if row["roles"]:
                now.counts[3] += now.before is not None and now.before + row["head"] not in CHAINS
                now.before = row["tail"]
            if row["low"] is not None:
                now.distinct += row["distinct"] - (now.high == row["low"])
                now.low, now.high = row["low"] if now.low is None else now.low, row["high"]
            letters = trace["letters"][now.state]
            now.letters.append(letters)
            turns, now.state = apply_edits(letters, now.state, zip(row["roles"], row["texts"], strict=True))
            write(turns)
            pending = (row["conv_id"], row["stretch"], turns)
        yield emitted(out)
    if now is not None:
        yield emitted([closed()])
