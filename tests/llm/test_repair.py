"""Repair against a plain dynamic program over strings, the block tables against single steps, and the edge cases."""

import itertools
import random
import zlib

import pytest
import xxhash
from brute import sha

from bookloom.llm import repair
from bookloom.llm.queries import QUERIES

WHITE = "\x20\t\n\v\f\r"
LEGAL = ("su", "ua", "au")


def signed(text):
    """The hash that decides between long texts of one turn and role that begin alike."""
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def damaged(rows):
    """rows: (conv, turn, role, text) -> by conversation the rows after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], signed(r[2])))
    return out


def plain(rows):
    """rows of one conversation in order: (turn, role, text) -> gaps, faults, illegal, cost, audit, digest."""
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.rstrip(WHITE)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(rows, rows[1:]))
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def offer(into, state, cost, audit, out):
        if state not in into or (cost, audit) < into[state][:2]:
            into[state] = (cost, audit, out)

    def inserts(states):
        grown = dict(states)
        for state, (cost, audit, out) in states.items():
            for _ in range(2):
                state = follows[state]
                cost, audit, out = cost + 3, audit + "I", (*out, f"{names[state]}:")
                offer(grown, state, cost, audit, out)
        return grown

    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for state, (cost, audit, out) in inserts(best).items():
            offer(new, state, cost + 4, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] == follows[state] or role[:1] == "s" and state == "":
                    offer(new, role[:1], cost + more, audit + "K", (*out, f"{role}:{text}"))
                to = follows[state]
                offer(new, to, cost + 3 + more, audit + "R", (*out, f"{names[to]}:{text}"))
        best = new
    cost, audit, out = min(way for state, way in inserts(best).items() if state in ("", "a"))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(out)))


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    for conv in range(convs):
        for turn in range(rng.randrange(longest + 1)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["a.", "b!", "c", "d? ", " ", "", None, "a.\n", "x" * 70 + ".", "x" * 70 + "!"])
            yield rng.choice([conv, conv, conv, None]), rng.choice([turn, turn, turn, turn + 3, None]), role, text


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, stretch int, `a.b` string")


def reports(found):
    return {r.conv_id: tuple(r.report) for r in found.where("report IS NOT NULL").collect()}


def test_random_conversations(spark):
    rows = list(random_rows(1, 150, 14))
    want = {conv: plain(kept) for conv, kept in damaged(rows).items()}
    hurt = repair.damage(frame(spark, rows))
    assert reports(repair.repair_conversations(hurt)) == want
    # the same with every stretch a few rows long, as a conversation of any length is treated
    assert reports(repair.repair_conversations(hurt, most_rows=3)) == want
    assert reports(repair.repair_conversations(hurt, most_chars=80)) == want


def test_one_long_conversation(spark):
    rng = random.Random(7)
    rows = [(5, t // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "", f"{t}!"])) for t in range(3000)]
    found = repair.repair_conversations(repair.damage(frame(spark, rows)), most_rows=100)
    want = plain(damaged(rows)[5])
    assert reports(found) == {5: want}
    turns = [t for r in found.orderBy("stretch").collect() for t in r.repaired]
    assert sha("\n".join(f"{t.role}:{t.text}" for t in turns)) == want[-1]
    assert [t.role[0] for t in turns[-2:]] == ["u", "a"]


def test_every_short_sequence(spark):
    """All sequences of four symbols: letters and cost of the tables equal the plain program's."""
    rows, conv = [], 0
    kinds = [("system", "."), ("user", "."), ("assistant", "."), ("tool", "."), ("user", ""), ("assistant", "x"), ("system", "x")]
    known = repair.tables()
    for choice in itertools.product(kinds, repeat=4):
        rows = [(i, role, f"{i}{end}" if end else "") for i, (role, end) in enumerate(choice)]
        symbols = bytes(repair._mark(role, text) for _, role, text in rows)
        fronts, costs = known.summary(symbols)
        want = plain(rows)
        letters = known.trace(symbols, known.end, [repair.OPEN])[repair.OPEN]
        turns, state = repair.apply_edits(letters, repair.OPEN, [(r, t) for _, r, t in rows])
        assert (costs[known.end] + known.vectors[fronts[known.end]][repair.OPEN], letters + known.last[state]) == (want[5], want[6])
        conv += 1
    assert conv == 7 ** 4


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_block_sizes_agree(size):
    rng, known, other = random.Random(size), repair.tables(), repair.Tables(size)
    for _ in range(200):
        symbols = bytes(rng.randrange(9) for _ in range(rng.randrange(40)))
        assert [x.tolist() for x in known.summary(symbols)] == [x.tolist() for x in other.summary(symbols)]
        assert known.trace(symbols, 3, range(4)) == other.trace(symbols, 3, range(4))


def test_empty_tables_and_lost_conversations(spark):
    assert repair.repair_conversations(repair.damage(frame(spark, []))).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    found = repair.repair_conversations(repair.damage(frame(spark, [(gone, 0, "user", "a.")])))
    assert reports(found) == {gone: (0, 0, 0, 0, 0, 0, "", sha(""))}


def test_a_very_long_text(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "."), (1, 1, "assistant", "x."), (1, 2, "user", "word " * 400_000 + ".")]
    assert reports(repair.repair_conversations(repair.damage(frame(spark, rows)))) == {1: plain(damaged(rows)[1])}


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op13_repair"](spark, small).collect()}
    assert found == {conv: plain(kept) for conv, kept in damaged(rows).items()}
