"""Passages that repeat across documents: relative Lempel-Ziv factors over indexed reference blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.llm.common import NO_ID, Runs, WordHashes, col, lists, mixed, row_key, stored, text_of

HASHES = WordHashes()


def blocks(words: list[bytes], window: int = 50, gram: int = 8) -> tuple[np.ndarray, ...]:
    """The reference blocks of a text: (anchor hash, block hash, first window, last window) each.

    Of the grams in a window of words the one with the smallest hash is its anchor, the leftmost of equals; a block
    is a stretch of windows with one anchor. Equal windows have equal anchors wherever they stand.
    """
    n = len(words) - window + 1
    if n < 1:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    runs = Runs(HASHES(words))
    grams = runs.all(gram)
    least = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1).argmin(axis=1)
    at = least + np.arange(n)
    first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    last = np.concatenate([first[1:] - 1, [n - 1]])
    place = (at[first] - first).astype(np.uint64)
    whole = mixed(runs.of(first, last + window) ^ mixed(place) ^ (last - first).astype(np.uint64))
    return grams[at[first]].view(np.int64), whole.view(np.int64), first, last


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = 8,
) -> DataFrame:
    """(doc_id, text, n_words, n_removed, removed) per row: the words left, joined by one space, and the spans taken.

    A word goes if a window of `window` consecutive words covers it whose words also start in a document with a
    smaller id. Documents are factored against the blocks of all documents before them. A block that occurs whole in
    an earlier document continues a factor, so all its windows are duplicates. Where a factor ends, the block's
    anchor is known but the block is not: its windows are looked up one by one, among those of the blocks with that
    anchor. Blocks whose anchor no other document has are left alone. Everything is decided on the input.

    Words are runs of anything but ASCII white space. Null text has no words; rows that share an id are no
    duplicates of each other; a row without id counts as later than all others. An empty table gives no rows.
    """
    text = text_of(text_col)
    rows = docs.select(
        col(id_col).cast("long").alias("doc_id"), F.coalesce(col(id_col).cast("long"), F.lit(NO_ID)).alias("rank"),
        row_key(text).alias("key"), text.cast("binary").alias("t"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ranks, keys, texts in lists(batches):
            found = [blocks(t.split(), window, gram) for t in texts]
            sizes = [len(f[0]) for f in found]
            columns = [np.concatenate(x) for x in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ranks, sizes)), pa.array(np.repeat(keys, sizes)), pa.array(columns[0]), pa.array(columns[1]),
                 pa.array(columns[2].astype(np.int32)), pa.array(columns[3].astype(np.int32))],
                ["rank", "key", "anchor", "block", "first", "last"])

    layout = "rank long, key long, anchor long, block long, first int, last int"
    index = stored(rows.select("rank", "key", "t").mapInArrow(cut, layout), "blocks")
    shared = stored(
        index.groupBy("anchor").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi"), F.min("block").alias("b0"),
                                    F.max("block").alias("b1"))
        .where("lo < hi").select("anchor", (F.col("b0") != F.col("b1")).alias("several")), "anchors")
    met = stored(index.join(shared, "anchor"), "met")
    earliest = stored(met.groupBy("anchor", "block").agg(F.min("rank").alias("earliest")), "earliest")
    judged = met.join(earliest, ["anchor", "block"])
    whole = judged.where("rank > earliest").select("rank", "key", "first", "last")
    ends = judged.where("rank = earliest AND several").groupBy("rank", "key").agg(
        F.collect_list(F.struct("anchor", "first", "last")).alias("ends"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ranks, keys, texts, ends in lists(batches):
            for rank, key, t, end in zip(ranks, keys, texts, ends, strict=True):
                runs = Runs(HASHES(t.split()))
                first = np.array([e["first"] for e in end])
                sizes = np.array([e["last"] for e in end]) - first + 1
                at = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, rank)), pa.array(np.full(n, key)), pa.array(np.repeat([e["anchor"] for e in end], sizes)),
                     pa.array(runs.of(at, at + window).view(np.int64)), pa.array(at.astype(np.int32))],
                    ["rank", "key", "anchor", "words", "at"])

    windows = stored(
        rows.select("rank", "key", "t").join(ends, ["rank", "key"]).mapInArrow(look, "rank long, key long, anchor long, words long, at int"),
        "windows")
    repeated = stored(windows.groupBy("anchor", "words").agg(F.min("rank").alias("earliest"), F.max("rank").alias("latest"))
                      .where("earliest < latest").drop("latest"), "repeated")
    single = windows.join(repeated, ["anchor", "words"]).where("rank > earliest").select("rank", "key", "at", F.col("at").alias("last"))
    spans = whole.union(single).groupBy("rank", "key").agg(F.collect_set(F.struct("first", "last")).alias("spans"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, spans in lists(batches):
            out = [_without(t.split(), s or [], window) for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                ["doc_id", "text", "n_words", "n_removed", "removed"])

    return rows.join(spans, ["rank", "key"], "left").select("doc_id", "t", "spans").mapInArrow(
        keep, "doc_id long, text string, n_words long, n_removed long, removed array<struct<start:int,end:int>>")


def _without(words: list[bytes], spans: list[dict], window: int) -> tuple[str, int, int, list[dict]]:
    if not spans:
        return b" ".join(words).decode(), len(words), 0, []
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, [s["first"] for s in spans], 1)
    np.add.at(steps, [s["last"] + window for s in spans], -1)
    gone = np.cumsum(steps) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8)]))).tolist()
    removed = [{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2], strict=True)]
    kept = [w for w, g in zip(words, gone.tolist(), strict=False) if not g]
    return b" ".join(kept).decode(), len(words), len(words) - len(kept), removed
