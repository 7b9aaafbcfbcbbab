"""The packing schedule for any number of queues: gapless, in proportion at every window, weights kept."""

import random
import time

import pytest

from bookloom.llm import packing


def stretches(plan, totals, rng=None):
    """(place, end, queue) of all tokens, asked for piece by piece."""
    out = []
    for queue, total in enumerate(totals):
        at = 0
        while at < total:
            end = min(total, at + rng.randrange(1, 200)) if rng else total
            found = list(plan.cut(queue, at, end))
            assert (found[0][0], found[-1][1]) == (at, end)
            out += [(place, place + stop - start, queue) for start, stop, place in found]
            at = end
    return sorted(out)


def test_gapless_under_any_weights():
    rng = random.Random(1)
    for _ in range(40):
        totals = [rng.randrange(3000) for _ in range(rng.randrange(1, 7))]
        weights = rng.choice([[float(n) for n in totals], [rng.choice([0, 1, 2.5, 0.3]) for _ in totals]])
        at = 0
        for start, end, _ in stretches(packing.Schedule(totals, weights, rng.choice([16, 100, 1024])), totals, rng):
            assert start == at
            at = end
        assert at == sum(totals)


def test_every_window_keeps_the_weights():
    totals, weights, size = [3000, 9000, 500, 700], [1.0, 2.0, 0.5, 0.0], 70
    plan = packing.Schedule(totals, weights, size)
    served = [0] * 4
    for start, end, queue in stretches(plan, totals):
        served[queue] += end - start
        if end % size == 0 and served[2] < 500:  # until the first queue runs out
            assert all(abs(s - end * w / 3.5) <= 1 for s, w in zip(served, weights, strict=True))
    # the queue without weight comes last
    assert {q for start, _, q in stretches(plan, totals) if start >= sum(totals) - 700} == {3}


def test_wide_numbers_take_the_other_way():
    totals = [10**13, 3 * 10**13, 7]
    plan = packing.Schedule(totals, [1.0, 1.0, 1.0], 65536)
    small = list(plan.cut(1, 10**13 - 5, 10**13 + 5))
    assert sum(stop - start for start, stop, _ in small) == 10
    near = [next(plan.cut(q, 9 * 10**12, 9 * 10**12 + 1))[2] for q in (0, 1)]
    assert abs(near[0] - near[1]) <= 65536 and near[0] != near[1]


def test_a_thousand_queues():
    rng = random.Random(3)
    totals = [rng.randrange(10**6, 10**9) for _ in range(1000)]
    begun = time.perf_counter()
    plan = packing.Schedule(totals, [rng.random() for _ in totals], 65536)
    assert time.perf_counter() - begun < 5
    assert plan.at[-1] == sum(totals)


def test_shares():
    names, totals = ["a", "b", None], [10, 30, 60]
    assert packing.shares_of(names, totals, None) == [10, 30, 60]
    assert packing.shares_of(names, totals, {"a": 2, "*": 3, "gone": 1}) == [2, 1, 2]
    assert packing.shares_of(names, totals, {"b": 1}) == [0, 1, 0]
    assert packing.shares_of([], [], {"b": 1}) == []


@pytest.mark.parametrize("weights", [None, {"s7": 5.0, "*": 1.0}])
def test_more_sources_than_sequences(spark, weights):
    from bookloom.llm.queries import tokenizer_path

    docs = spark.range(300).selectExpr("id AS doc_id", "concat('word ', id) AS text", "concat('s', id) AS source")
    pieces = packing.pack(docs, tokenizer_path(), window=32, mixture_windows=2, weights=weights).collect()
    cover = {}
    for p in pieces:
        cover.setdefault(p.sequence_id, []).append((p.offset, p.length))
    full = [sum(n for _, n in parts) for _, parts in sorted(cover.items())]
    assert {p.doc_id for p in pieces} == set(range(300)) and all(n == 32 for n in full[:-1])
    if weights:
        first = min(pieces, key=lambda p: (p.sequence_id, p.offset) if p.doc_id == 7 else (1 << 60, 0))
        assert first.sequence_id == 0  # five sixths of the first window, as long as it has tokens
