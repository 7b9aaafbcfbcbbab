"""Encoding with a sentence-piece BPE model in vectorised merge rounds, and decoding."""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.llm.common import by_bytes, col, text_of

SPACE = "▁"
NEVER = np.iinfo(np.int32).max
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
REMEMBERED = 300_000  # words whose ids a worker keeps between texts

# One replacement character for each byte that is not part of a character.
codecs.register_error("per_byte", lambda e: ("�", e.start + 1))


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value, at, shift = value | (byte & 127) << shift, at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at: at + size], at + size
        yield tag >> 3, value


def _word_pattern(touching: set[tuple[str, str]]) -> str:
    """How texts are cut into words that are remembered: only where no piece holds the two characters side by side.

    Spaces lead a word if no piece has one behind another character. Control characters and digits that touch nothing
    stand alone.
    """
    if any(b == SPACE != a for a, b in touching):
        return r"(?s).+"
    alone = "".join(re.escape(c) for c in map(chr, range(128)) if (c.isdigit() or ord(c) < 32) and not any(c in pair for pair in touching))
    return f" *[^ {alone}]+|[{alone}]| +" if alone else " *[^ ]+| +"


class PieceModel:
    """A BPE model with byte fallback, identity normalisation and a space put before the text.

    Symbols are numbered: the pieces by their ids, then the characters that occur inside pieces without being one.
    A character that occurs in no piece stands for itself as -1 - code point and never merges. A pair of symbols
    whose texts joined are a piece has that piece's rank (best score first, equal scores equal ranks).
    """

    def __init__(self, data: bytes):
        pieces, settings = [], {}
        for number, value in _fields(data):
            if number == 1:
                found = dict(_fields(value))
                pieces.append((found[1].decode(), struct.unpack("<f", found[2])[0] if 2 in found else 0.0, found.get(3, NORMAL)))
            elif number in (2, 3):
                settings.update({(number, n): v for n, v in _fields(value)})
        types = {t for _, _, t in pieces}
        # trainer: model type BPE, byte fallback; normaliser: no map, space in front, spaces kept, spaces marked
        wanted = {(2, 3): 2, (2, 35): 1, (3, 2): b"", (3, 3): 1, (3, 4): 0, (3, 5): 1}
        given = {(2, 3): 1, (2, 35): 0, (3, 2): b"", (3, 3): 1, (3, 4): 1, (3, 5): 1} | settings
        if any(given[k] != v for k, v in wanted.items()) or not types <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models with byte fallback and identity normalisation that keeps spaces")

        self.end = next(i for i, (p, _, t) in enumerate(pieces) if t == CONTROL and p == "</s>")
        self.bytes_from = np.zeros(256, np.int32)
        for i, (p, _, t) in enumerate(pieces):
            if t == BYTE:
                self.bytes_from[int(p[1:-1], 16)] = i
        normal = {p: i for i, (p, _, t) in enumerate(pieces) if t == NORMAL}
        symbols = dict(normal)
        for p in normal:
            for c in p:
                symbols.setdefault(c, len(pieces) + len(symbols) - len(normal))
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for p, i in symbols.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        self.n_pieces = len(pieces)

        order = {s: r for r, s in enumerate(sorted({-pieces[i][1] for i in normal.values()}))}
        pairs, touching = [], set()
        for p, i in normal.items():
            touching.update(zip(p, p[1:]))
            for cut in range(1, len(p)):
                left, right = symbols.get(p[:cut]), symbols.get(p[cut:])
                if left is not None and right is not None:
                    pairs.append((left << 32 | right, order[-pieces[i][1]], i))
        pairs.sort()
        self.keys = np.array([k for k, _, _ in pairs] or [0], np.int64)
        self.ranks = np.array([r for _, r, _ in pairs] or [NEVER], np.int32)
        self.results = np.array([i for _, _, i in pairs] or [0], np.int32)
        self.table = {k: (r, i) for k, r, i in pairs}
        # The best rank that a symbol can reach with any neighbour: a merge whose result could at once merge at its own
        # rank or a better one must not be made together with others of its word.
        self.next_rank = np.full(len(pieces) + len(symbols), NEVER, np.int32)
        np.minimum.at(self.next_rank, self.keys >> 32, self.ranks)
        np.minimum.at(self.next_rank, self.keys & 0xFFFFFFFF, self.ranks)
        self.touching = np.array(sorted(ord(a) << 32 | ord(b) for a, b in touching) or [0], np.int64)

        self.words = re.compile(_word_pattern(touching))
        self.known: dict[str, bytes] = {}

        self.normal = [t == NORMAL for _, _, t in pieces]
        self.spelled = []
        for p, _, t in pieces:
            self.spelled.append({NORMAL: p.replace(SPACE, " ").encode(), BYTE: bytes([int(p[1:-1], 16)]) if t == BYTE else b"",
                                 UNKNOWN: " ⁇ ".encode(), CONTROL: b""}[t])
        self.spelled_array = pa.array(self.spelled, pa.binary())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without marks for its ends."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, split = self.known, self.words.findall
        words = [split(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        new = list(set().union(*words).difference(known))
        at = 0
        while at < len(new):  # a bounded number of characters at once, or one word
            size, end = 0, at
            while end < len(new) and (end == at or size + len(new[end]) <= 1 << 20):
                size, end = size + len(new[end]), end + 1
            ids, ends = self.merge(new[at:end])
            data, ends = ids.tobytes(), (4 * ends).tolist()
            known.update(zip(new[at:end], [data[i:j] for i, j in zip([0, *ends], ends, strict=False)], strict=True))
            at = end
        return [np.frombuffer(b"".join(map(known.__getitem__, ws)), np.int32) for ws in words]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NEVER if no piece) and result of each pair of symbols."""
        keys = left.astype(np.int64) << 32 | right
        places = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.keys[places] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[places], NEVER), np.where(found, self.results[places], -1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words in a row, and where each word's end; in rounds over one flat array of symbols.

        Every round takes the best rank of any pair in each segment (a stretch of a word inside which pieces can
        reach), merges all leftmost pairs of that rank and drops the symbols swallowed. Segments without a pair leave
        the array. Where a result could merge again at the same rank or a better one, order matters, and the segment is
        finished one merge at a time.
        """
        points = np.frombuffer("".join(words).replace(" ", SPACE).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.array([len(w) for w in words])
        ends = np.cumsum(lengths)
        n = len(points)
        symbols = self.symbol_of[points]
        symbols = np.where(symbols < 0, -1 - points, symbols)
        pairs = points[:-1] << 32 | points[1:]
        places = np.minimum(np.searchsorted(self.touching, pairs), len(self.touching) - 1)
        apart = self.touching[places] != pairs
        starts = np.concatenate([[True], apart])
        starts[ends[:-1]] = True

        done_at, done = [], []  # place of each finished symbol in the texts, and the symbol
        where = np.arange(n)
        rank, result = np.full(n, NEVER, np.int32), np.full(n, -1, np.int32)
        self._refresh(symbols, starts, rank, result, np.arange(n - 1))
        while len(symbols):
            heads = np.flatnonzero(starts)
            best = np.minimum.reduceat(rank, heads)
            sizes = np.diff(np.append(heads, len(symbols)))
            over = np.repeat(best == NEVER, sizes)
            best = np.repeat(best, sizes)
            if over.any():
                done_at.append(where[over])
                done.append(symbols[over])
                left = ~over
                symbols, where, starts, rank, result, best = (x[left] for x in (symbols, where, starts, rank, result, best))
                if not len(symbols):
                    break
            hit = rank == best
            spots = np.flatnonzero(hit)
            unsafe = spots[self.next_rank[result[spots]] <= rank[spots]]
            if len(unsafe):
                segment = np.cumsum(starts) - 1
                slow = np.zeros(segment[-1] + 1, bool)
                slow[segment[unsafe]] = True
                # one merge possible in the segment: no order to keep
                slow &= np.bincount(segment[spots], minlength=len(slow)) > 1
                slow = slow[segment]
                if slow.any():
                    for part in np.split(np.flatnonzero(slow), np.flatnonzero(starts[slow])[1:]):
                        at, ids = self._one_by_one(symbols[part], where[part])
                        done_at.append(at)
                        done.append(ids)
                    left = ~slow
                    symbols, where, starts, rank, result, hit = (x[left] for x in (symbols, where, starts, rank, result, hit))
                    spots = np.flatnonzero(hit)
                    if not len(symbols):
                        break
            # within a run of neighbouring hits every other one, from the left
            first = np.ones(len(spots), bool)
            first[1:] = spots[1:] != spots[:-1] + 1
            run = np.maximum.accumulate(np.where(first, np.arange(len(spots)), 0))
            spots = spots[(np.arange(len(spots)) - run) % 2 == 0]
            symbols[spots] = result[spots]
            left = np.ones(len(symbols), bool)
            left[spots + 1] = False
            places = np.cumsum(left) - 1
            symbols, where, starts, rank, result = (x[left] for x in (symbols, where, starts, rank, result))
            spots = places[spots]
            changed = np.zeros(len(symbols) + 1, bool)
            changed[spots] = True
            changed[spots - 1] = True  # the place before the first one is the last, which counts for nothing
            self._refresh(symbols, starts, rank, result, np.flatnonzero(changed[:-1]))

        at = np.concatenate(done_at) if done_at else np.zeros(0, np.int64)
        order = np.argsort(at, kind="stable")
        at, symbols = at[order], np.concatenate(done)[order] if done else np.zeros(0, np.int64)
        ids, sizes = self._spell(symbols, points[at])
        owner = np.searchsorted(ends, at, side="right")
        per_word = np.bincount(owner, weights=sizes, minlength=len(words)).astype(np.int64)
        return ids, np.cumsum(per_word)

    def _refresh(self, symbols, starts, rank, result, spots: np.ndarray) -> None:
        """Look up the pairs that begin at these places anew."""
        rank[spots], result[spots] = NEVER, -1
        spots = spots[spots < len(symbols) - 1]
        spots = spots[~starts[spots + 1]]
        rank[spots], result[spots] = self.look_up(symbols[spots], symbols[spots + 1])

    def _one_by_one(self, symbols: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One segment by an agenda: the best pair first, of equal ones the leftmost."""
        n = len(symbols)
        symbol, after, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(lefts: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
            for i in lefts:
                if i >= 0 and after[i] < n:
                    a, b = symbol[i], symbol[after[i]]
                    found = self.table.get(a << 32 | b) if a >= 0 and b >= 0 else None
                    if found:
                        yield found[0], i, a, b, found[1]

        agenda.extend(offer(list(range(n))))
        heapify(agenda)
        while agenda:
            _, i, a, b, merged = heappop(agenda)
            j = after[i] if symbol[i] == a else n
            if j >= n or symbol[j] != b:
                continue
            symbol[i], symbol[j] = merged, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for entry in offer([before[i], i]):
                heappush(agenda, entry)
        left = [i for i in range(n) if symbol[i] is not None]
        return where[left], np.array([symbol[i] for i in left], np.int64)

    def _spell(self, symbols: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of finished symbols and their number each: pieces as they are, other characters byte by byte."""
        other = (symbols < 0) | (symbols >= self.n_pieces)
        sizes = np.ones(len(symbols), np.int64)
        if not other.any():
            return symbols.astype(np.int32), sizes
        spelled = [self.bytes_from[np.frombuffer(chr(p).encode(), np.uint8)] for p in points[other].tolist()]
        sizes[other] = [len(s) for s in spelled]
        ids = np.repeat(symbols, sizes).astype(np.int32)
        ids[np.repeat(other, sizes)] = np.concatenate(spelled)
        return ids, sizes

    def decode(self, ids: pa.ListArray) -> list[str]:
        """The text of each list of ids: pieces joined, one leading space of the first piece with text dropped."""
        joined = pc.binary_join(pa.ListArray.from_arrays(
            ids.offsets, self.spelled_array.take(ids.flatten() if not ids.offset else ids.values)), b"")
        texts = []
        for row, data in enumerate(joined):
            data = data.as_py()
            if data[:1] == b" ":
                first = next(i for i in ids[row].as_py() if self.spelled[i])
                data = data[1:] if self.normal[first] else data
            texts.append(data.decode("utf-8", "per_byte"))
        return texts


@lru_cache(maxsize=4)
def model_of(data: bytes) -> PieceModel:
    return PieceModel(data)


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", end: bool = True) -> DataFrame:
    """(doc_id, ids) per row: the ids of the whole text as the model's library gives them, then the end id if asked.

    `model` is the content of the model's file. Null and empty texts have no ids but the end; repeated rows are encoded
    each; a null id stays null; an empty table gives no rows; other columns are not looked at. No shuffle: a task works
    on a few megabytes of text at once, a very long text alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model_of(model)
        for part in by_bytes(batches, "t", 4 << 20):
            found = pieces.encode(part.column("t").to_pylist())
            if end:
                found = [np.append(f, np.int32(pieces.end)) for f in found]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    rows = docs.select(col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """`encoded` with the column `text` in place of nothing: every list in `ids` (null: empty) decoded, all columns kept."""
    names = list(encoded.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model_of(model)
        for part in by_bytes(batches, "ids", 8 << 20):
            ids = part.column("ids")
            ids = pa.ListArray.from_arrays(_offsets(ids), ids.flatten())
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pieces.decode(ids), pa.string())], [*names, "text"])

    return encoded.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", text string")


def _offsets(lists: pa.ListArray) -> pa.Array:
    """Offsets of the lists' values once flattened; a null list has none."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
