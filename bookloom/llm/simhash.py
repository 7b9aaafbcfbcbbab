"""SimHash near-duplicates over an inverted index of positional bytes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.llm.common import col, components, lists, row_key, stored, text_of

SEED = 42
BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
PLANES = np.arange(8) * 256
PAIRWISE = 4096  # entries up to this size are compared pair by pair, larger ones by looking up all values in reach


def simhash(text: bytes, shingle: int = 3) -> int:
    """The signed 64-bit fingerprint of a text: ASCII lower case, word shingles with repeats, XXH64 with seed 42; a
    bit is set if over half of the hashes have it. Without words it is zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:].tolist(), strict=True)]
    n = len(hashes)
    planes = np.array(hashes, np.uint64).view(np.uint8).reshape(n, 8) + PLANES
    counts = np.bincount(planes.ravel(), minlength=2048).reshape(8, 256) @ BITS_OF_BYTE
    return int(np.packbits(2 * counts > n, axis=1, bitorder="little").ravel().view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, key, fp) per row; key tells rows with the same id apart by their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, texts in lists(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()),
                 pa.array([simhash(t, shingle) for t in texts], pa.int64())], ["doc_id", "key", "fp"])

    text = text_of(text_col)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), row_key(text).alias("key"), text.cast("binary").alias("t"))
    return rows.mapInArrow(run, "doc_id long, key long, fp long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3,
) -> DataFrame:
    """(doc_id, key, fp, component_id) per row: documents whose fingerprints differ in at most `max_bits` bits are
    linked; component_id is the smallest doc_id reachable.

    With d differing bits at least 8 - d of the 8 bytes agree in place. An entry of the inverted index is a set of
    8 - max_bits positions with their bytes, so two fingerprints meet in an entry exactly if their tally of shared
    positional bytes reaches the guaranteed minimum; there the bit distance is verified. Equal fingerprints are one
    member, so copies cost nothing, and an entry has at most 256**max_bits members (2**24 for three bits). From an
    entry come the links of a spanning forest, never all pairs; no link is lost for the components.

    Null text is empty; texts without words have fingerprint zero and are linked like others. A row without id is
    linked too, but does not name a component (null if none of its component has an id). Repeated rows are
    duplicates. An empty table gives no rows; other columns are not looked at.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "classes")
    roots = components(links(classes.select("fp"), max_bits))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "smallest")
    named = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    members = stored(rooted.join(named, "root").select("fp", "component_id"), "members")
    return rows.join(members, "fp").select("doc_id", "key", "fp", "component_id")


def links(values: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b): a spanning forest of the distinct 64-bit values of column fp that lie within `max_bits` bits."""
    masks = [sum(0xFF << 8 * byte for byte in kept) for kept in combinations(range(8), 8 - max_bits)]
    entries = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])
    index = values.select("fp", F.posexplode(entries).alias("places", "bytes"))
    index = index.select(F.col("places").cast("short").alias("places"), "bytes", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places, fps in _entries(batches):
            a, b = forest(fps, _free_bits(masks[places]), max_bits)
            yield _pairs(a, b)

    def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        """Whole entries of at least two members, also where they cross batches."""
        rest: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])
            held = np.concatenate([*rest, now], axis=1) if rest and _same_entry(rest[0][:, 0], now[:, -1]) is False else None
            if held is None and rest:
                rest.append(now)
                continue
            rows = now if held is None else held
            cuts = np.flatnonzero((rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])) + 1
            edges = np.concatenate([[0], cuts])
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                if end - start > 1:
                    yield int(rows[0, start]), rows[2, start:end]
            rest = [rows[:, edges[-1]:]]
        if rest:
            rows = np.concatenate(rest, axis=1)
            if rows.shape[1] > 1:
                yield int(rows[0, 0]), rows[2]

    dealt = index.repartition("places", "bytes").sortWithinPartitions("places", "bytes")
    return dealt.mapInArrow(run, "a long, b long")


def _same_entry(x: np.ndarray, y: np.ndarray) -> bool:
    return bool(x[0] == y[0] and x[1] == y[1])


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _free_bits(mask: int) -> list[int]:
    return [bit for bit in range(64) if not mask >> bit & 1]


def forest(fps: np.ndarray, free: list[int], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what lies within `max_bits` bits among distinct values that differ in the free bits only."""
    values = fps.view(np.uint64)
    if len(values) == 2:
        near = int(np.bitwise_count(values[0] ^ values[1])) <= max_bits
        return (fps[:1], fps[1:]) if near else (fps[:0], fps[:0])
    reach = _by_pairs(values, max_bits) if len(values) <= PAIRWISE else _by_lookup(values, free, max_bits)
    open_ = np.ones(len(values), bool)
    a, b = [], []
    for seed in range(len(values)):
        if not open_[seed]:
            continue
        open_[seed] = False
        front = np.array([seed])
        while len(front):
            source, found = reach(front, open_)
            open_[found] = False
            a.append(fps[source])
            b.append(fps[found])
            front = found
    return np.concatenate(a), np.concatenate(b)


def _by_pairs(values: np.ndarray, max_bits: int):
    def reach(front: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sources, targets = [front[:0]], [front[:0]]
        left = np.flatnonzero(open_)
        for at in range(0, len(front), 256):
            if not len(left):
                break
            part = front[at: at + 256]
            near = np.bitwise_count(values[part][:, None] ^ values[left][None, :]) <= max_bits
            hit = near.any(axis=0)
            sources.append(part[near[:, hit].argmax(axis=0)])
            targets.append(left[hit])
            left = left[~hit]
        return np.concatenate(sources), np.concatenate(targets)

    return reach


def _by_lookup(values: np.ndarray, free: list[int], max_bits: int):
    """At most 2**len(free) values exist here: a table tells for each whether it is there and where."""
    local = np.zeros(len(values), np.int64)
    for place, bit in enumerate(free):
        local |= (values >> np.uint64(bit) & np.uint64(1)).astype(np.int64) << place
    where = np.full(1 << len(free), -1, np.int32)
    where[local] = np.arange(len(values), dtype=np.int32)
    steps = np.array([sum(1 << p for p in places) for k in range(1, max_bits + 1)
                      for places in combinations(range(len(free)), k)])

    def reach(front: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sources, targets = [front[:0]], [front[:0]]
        taken = np.zeros(len(values), bool)
        for at in range(0, len(front), 512):
            part = front[at: at + 512]
            found = where[local[part][:, None] ^ steps[None, :]]
            row, _ = np.nonzero(found >= 0)
            hit = found[found >= 0]
            fresh = open_[hit] & ~taken[hit]
            hit, first = np.unique(hit[fresh], return_index=True)
            taken[hit] = True
            sources.append(part[row[fresh][first]])
            targets.append(hit)
        return np.concatenate(sources), np.concatenate(targets)

    return reach


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with one of each near-duplicate group left: that with the smallest id, once if its row repeats.
    Rows without id take no part and stay. All columns are kept."""
    found = near_duplicates(docs, id_col, text_col, **options)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id", "key").distinct()
    packed = docs.select(col(id_col).cast("long").alias("doc_id"), row_key(text_of(text_col)).alias("key"), F.struct("*").alias("row"))
    one = packed.where(F.col("doc_id").isNotNull()).join(kept, ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"])
    return one.select("row").unionByName(packed.where(F.col("doc_id").isNull()).select("row")).select("row.*")
