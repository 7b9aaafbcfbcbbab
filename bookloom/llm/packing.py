"""Packing tokens into sequences under a mixture of sources."""

from __future__ import annotations

import base64
import os
from array import array
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from fractions import Fraction
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookloom.llm.common import col, lists, stored, text_of

# Fixed value: how byte-level BPE of this kind cuts a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ENCODERS: dict[tuple[str, str | None], Encoder] = {}


class Encoder:
    """Token ids of texts as packed 16-bit or 32-bit values, by a byte-level BPE file of `tokenizers`.

    `ranks` may name the same vocabulary as ranks, with which `tiktoken` finds the same ids several times as fast; texts
    that hold a special token's string are left to the first file, which knows those.
    """

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.kind = "H" if self.model.get_vocab_size() <= 1 << 16 else "I"
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            return array(self.kind, self.model.encode(text, add_special_tokens=False).ids).tobytes()
        return array(self.kind, self.fast.encode_ordinary(text)).tobytes()


def encoder(path: str, ranks: str | None = None) -> Encoder:
    if (path, ranks) not in ENCODERS:
        ENCODERS[path, ranks] = Encoder(path, ranks)
    return ENCODERS[path, ranks]


class Schedule:
    """Where the tokens of each queue stand in the packed stream.

    Deficit round-robin in closed form: after w mixture windows of `size` tokens a queue has been served
    floor(w * size * share), so what a window lacks of a token's fraction is carried into the next one, over any
    number of windows and tasks. If weights ask for more of a queue than it has, a new phase begins where it runs
    out, in which the others share its part: at time t a queue has been served min(its tokens, floor(t * share)), and
    the phases begin at the times at which queues run out. Queues without a share come last. All arithmetic is on
    whole numbers and fractions; nothing is kept per phase and queue.
    """

    def __init__(self, totals: Sequence[int], weights: Sequence[float], size: int):
        self.size, self.totals = size, list(totals)
        shares = [max(0, round(w * 10**9)) for w in weights]
        last = [n if not s else 0 for n, s in zip(self.totals, shares, strict=True)]  # what no weight asks for
        self.shares = (shares, last)
        self.times = [(0, t) for t in sorted({Fraction(0), *(Fraction(n, s) for n, s in zip(self.totals, shares, strict=True) if n and s)})]
        if any(last):
            self.times.append((1, Fraction(1)))
        self.at = [sum(self.begun(q, p) for q in range(len(self.totals))) for p in range(len(self.times))]
        self.places = lru_cache(4096)(self._places)
        self.parts = lru_cache(64)(self._parts)

    def begun(self, queue: int, phase: int) -> int:
        """What a queue has been served where a phase begins."""
        (kind, time), total = self.times[phase], self.totals[queue]
        if self.shares[0][queue]:
            return total if kind else min(total, time.numerator * self.shares[0][queue] // time.denominator)
        return total if kind else 0

    def _parts(self, phase: int) -> list[int]:
        """What each queue is served in a phase."""
        return [self.begun(q, phase + 1) - self.begun(q, phase) for q in range(len(self.totals))]

    def _places(self, phase: int, window: int) -> Sequence[int]:
        """Where the part of each queue in a mixture window begins in the stream."""
        total, parts, ends = self.at[phase + 1] - self.at[phase], self.parts(phase), (window * self.size, (window + 1) * self.size)
        if total * ends[1] < 1 << 62:  # 64 bits hold every product
            wide = np.array(parts, np.int64)
            before, after = (np.minimum(wide, e * wide // total) for e in ends)
            return (self.at[phase] + before.sum() + np.concatenate([[0], np.cumsum(after - before)])).tolist()
        before, after = ([min(n, e * n // total) for n in parts] for e in ends)
        return [x + self.at[phase] + sum(before) for x in accumulate((b - a for a, b in zip(before, after, strict=True)), initial=0)]

    def cut(self, queue: int, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """(from, to, place in the stream) of each stretch of the queue's tokens start..end that stays together."""
        while start < end:
            phase = bisect_right(range(len(self.times)), start, key=lambda p: self.begun(queue, p)) - 1
            base, mine = self.begun(queue, phase), self.parts(phase)[queue]
            total = self.at[phase + 1] - self.at[phase]
            window = -(-(start - base + 1) * total // (self.size * mine)) - 1
            served, stop = (min(mine, w * self.size * mine // total) for w in (window, window + 1))
            stop = min(end, base + stop)
            yield start, stop, self.places(phase, window)[queue] + start - base - served
            start = stop


@lru_cache(2)
def schedule_of(totals: tuple[int, ...], weights: tuple[float, ...], size: int) -> Schedule:
    """Built once in each worker."""
    return Schedule(totals, weights, size)


def shares_of(names: Sequence[str | None], totals: Sequence[int], weights: dict[str, float] | None) -> list[float]:
    """The weight of each queue: its own, or its part by tokens of the weight named "*"; without weights its tokens."""
    if weights is None:
        return [float(n) for n in totals]
    rest = sum(n for name, n in zip(names, totals, strict=True) if name not in weights)
    return [weights[name] if name in weights else weights.get("*", 0.0) * n / max(1, rest) for name, n in zip(names, totals, strict=True)]


def pack(
    docs: DataFrame, tokenizer: str, window: int = 1024, mixture_windows: int = 64, weights: dict[str, float] | None = None,
    end_id: int = 0, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Pieces of documents in gapless sequences of `window` tokens: doc_id, start, length, doc_tokens, sequence_id,
    offset, ids (binary, little-endian unsigned 32-bit).

    A document is its ids and `end_id`. Each source is a queue, in the order in which its rows are read. Every
    stretch of `mixture_windows` sequences gets each queue's share of tokens: `weights`, or else the share the queue
    has in the corpus; see Schedule for the deficits. Sources that `weights` does not name share the weight named "*" by their
    tokens, or come last; a weight for a source without rows has no effect. Only the last sequence of all is not full.

    Ids are written once to the shared folder. The driver and the tasks hold a name and a total per source; positions inside
    a queue come from sums per task and queue. Null text is empty and yields the end id alone; a null source is a queue like any
    other; repeated rows are packed each; an empty table gives no rows. Unknown columns are not looked at.
    """
    names = [r[0] for r in docs.groupBy(col(source_col).cast("string").alias("q")).count()
             .orderBy(F.desc("count"), "q").select("q").collect()]
    place = {name: i for i, name in enumerate(names)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, served, model = TaskContext.get().partitionId(), [0] * len(place), encoder(tokenizer, ranks)
        end = array(model.kind, [end_id])
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                ids, texts, sources = (batch.slice(at, 500).column(i).to_pylist() for i in range(3))
                coded = [model(t) + end.tobytes() for t in texts]
                queues = [place[s] for s in sources]
                sizes, before = [len(c) // end.itemsize for c in coded], []
                for q, n in zip(queues, sizes, strict=True):
                    before.append(served[q])
                    served[q] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([part] * len(ids), pa.int32()), pa.array(queues, pa.int32()),
                     pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(coded, pa.binary())],
                    ["doc_id", "part", "queue", "before", "n", "ids"])

    rows = docs.select(col(id_col).cast("long"), text_of(text_col), col(source_col).cast("string"))
    coded = stored(rows.mapInArrow(encode, "doc_id long, part int, queue int, before long, n long, ids binary"), "ids")
    sums = stored(coded.groupBy("part", "queue").agg(F.sum("n").alias("n")), "sums")
    totals = [0] * len(names)
    for queue, n in sums.groupBy("queue").agg(F.sum("n")).collect():
        totals[queue] = n
    schedule = (tuple(totals), tuple(shares_of(names, totals, weights)), window * mixture_windows)
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(sums.select("part", "queue", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")), "offsets")
    width = _width(tokenizer)

    def place_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = schedule_of(*schedule)
        for docs_, queues, starts, sizes, ids in lists(batches):
            out = []
            for doc, queue, first, n, packed in zip(docs_, queues, starts, sizes, ids, strict=True):
                wide = np.frombuffer(packed, f"<u{width}").astype("<u4")
                for start, stop, at in plan.cut(queue, first, first + n):
                    while start < stop:
                        length = min(stop - start, window - at % window)
                        own = start - first
                        out.append((doc, own, length, n, at // window, at % window, wide[own: own + length].tobytes()))
                        start, at = start + length, at + length
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    placed = coded.join(offsets, ["part", "queue"]).select("doc_id", "queue", F.col("before") + F.col("offset"), "n", "ids")
    return placed.mapInArrow(
        place_pieces, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def _width(tokenizer: str) -> int:
    return array(encoder(tokenizer).kind).itemsize
