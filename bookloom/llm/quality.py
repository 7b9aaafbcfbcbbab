"""Quality rules and an isolation forest on their statistics."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookloom.llm.common import col, first_by_hash, lists, row_key, stored, text_of

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_punct")
UPPER, DIGITS, PUNCT = bytes(range(65, 91)), bytes(range(48, 58)), b".,;:!?"


def statistics(text: bytes) -> list[int]:
    words = text.split()
    n = len(words)
    continued = len(text) - len(text.translate(None, bytes(range(0x80, 0xC0))))  # all code points but their first bytes
    chars = len(text) - continued - (len(text) - len(text.translate(None, BLANKS)))
    count = lambda kind: len(text) - len(text.translate(None, kind))
    lines, repeated, n_lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip(BLANKS):
            n_lines += 1
            repeated += line in lines
            lines.add(line)
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    return [n, chars, count(SYMBOLS), repeated, _repeat_words(codes, len(ids)), n_lines, len(ids), count(UPPER), count(DIGITS), count(PUNCT)]


def _repeat_words(codes: np.ndarray, distinct: int, size: int = 5) -> int:
    """Words inside windows of `size` words that occur at least twice, the first one included."""
    windows = len(codes) - size + 1
    if windows < 2 or distinct == len(codes):
        return 0
    runs, span = codes[:windows].copy(), distinct
    for k in range(1, size):
        if span * distinct >= 1 << 62:
            found, runs = np.unique(runs, return_inverse=True)
            span = len(found)
        runs = runs * distinct + codes[k: windows + k]
        span *= distinct
    _, which, counts = np.unique(runs, return_inverse=True, return_counts=True)
    steps = np.zeros(len(codes) + 1, np.int64)
    twice = np.flatnonzero(counts[which] > 1)
    np.add.at(steps, twice, 1)
    np.add.at(steps, twice + size, -1)
    return int((np.cumsum(steps) > 0).sum())


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, statistics) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, texts in lists(batches):
            table = zip(*[statistics(t) for t in texts], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), *[pa.array(c, pa.int64()) for c in table]],
                                             ["doc_id", "key", *STATS])

    text = text_of(text_col)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), row_key(text).alias("key"), text.cast("binary").alias("t"))
    return rows.mapInArrow(run, "doc_id long, key long, " + ", ".join(f"{s} long" for s in STATS))


def shape(stats: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest splits on: sizes in logs, the rest as shares."""
    s = {k: v.astype(float) for k, v in stats.items()}
    words, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1), np.maximum(s["n_lines"], 1)
    return np.stack([
        np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / words, s["n_dup_lines"] / lines, s["n_repeat_words"] / words,
        np.log1p(words / lines), s["n_distinct"] / words, s["n_upper"] / chars, s["n_digits"] / chars, s["n_punct"] / words], axis=1)


@dataclass(frozen=True)
class Forest:
    """Random trees as arrays: split column (-1 at a leaf), split value, children, path length at a leaf."""

    trees: list[tuple[np.ndarray, ...]]
    usual: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / usual length): near 1 for rows that few splits set apart."""
        total = np.zeros(len(x))
        for column, value, left, right, length in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                inner = np.flatnonzero(column[node] >= 0)
                if not len(inner):
                    break
                at = node[inner]
                node[inner] = np.where(x[inner, column[at]] < value[at], left[at], right[at])
            total += length[node]
        return 2.0 ** -(total / len(self.trees) / self.usual)


def usual_length(n: int) -> float:
    """Mean depth of a search that fails in a random binary tree of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int, rows: int, seed: int) -> Forest:
    dice = random.Random(seed)
    out = []
    for _ in range(trees):
        own = x[dice.sample(range(len(x)), min(rows, len(x)))]
        limit = math.ceil(math.log2(max(2, len(own))))
        nodes: list[list] = []

        def split(part: np.ndarray, depth: int, nodes: list[list] = nodes, limit: int = limit) -> int:
            node = len(nodes)
            nodes.append([-1, 0.0, 0, 0, depth + usual_length(len(part))])
            low, high = part.min(axis=0), part.max(axis=0)
            open_ = np.flatnonzero(high > low)
            if depth < limit and len(open_):
                column = int(dice.choice(open_.tolist()))
                value = dice.uniform(low[column], high[column])
                below = part[:, column] < value
                if below.any() and not below.all():
                    nodes[node][:2] = [column, value]
                    nodes[node][2] = split(part[below], depth + 1)
                    nodes[node][3] = split(part[~below], depth + 1)
            return node

        split(own, 0)
        out.append(tuple(np.array(c) for c in zip(*nodes, strict=True)))
    return Forest(out, max(usual_length(min(rows, len(x))), 1e-9))


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", trees: int = 100,
    rows_per_tree: int = 256, most_good_lost: float = 0.005, min_words: int = 10, max_repeat: int = 20, seed: int = 7,
) -> DataFrame:
    """(doc_id, statistics, base_failed, anomaly, kept) per row.

    base_failed: fewer than `min_words` words, or over `max_repeat` percent of them in repeated windows. Each tree of
    the forest sees `rows_per_tree` rows, as the method has it; the rows it draws from are those that pass the base
    rules with the lowest hash of their id, `trees` times that many, from the whole corpus. All labelled rows that
    pass the base rules then give the threshold: of those that cost at most the share `most_good_lost` of good rows,
    the one that finds most bad ones. Without labels of both kinds, or where no threshold finds more bad than good
    rows in proportion, the base rules decide alone.

    Null text has no words and fails. Repeated rows get the same verdict; a null id has no label; an empty table gives
    no rows; other columns are not looked at.
    """
    stats = stored(measure(docs, id_col, text_col), "statistics")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    sample = first_by_hash(stats.where(~failed), trees * rows_per_tree, "doc_id", "key").select(*STATS).collect()
    if not sample:
        return stats.select("doc_id", "key", *STATS, failed.alias("base_failed"), F.lit(0.0).alias("anomaly"), (~failed).alias("kept"))
    forest = grow(shape({s: np.array([r[s] for r in sample]) for s in STATS}), trees, rows_per_tree, seed)
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    layout = T.StructType([*stats.schema.fields, T.StructField("anomaly", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = shape({s: batch.column(batch.schema.get_field_index(s)).to_numpy() for s in STATS})
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.scores(x))], [*batch.schema.names, "anomaly"])

    scored = stored(stats.mapInArrow(run, layout), "scores")
    known = labels.where(col(label_col).isin(0, 1)).select(col(id_col).cast("long").alias("doc_id"), col(label_col).cast("int").alias("y"))
    steps = 1000
    table = scored.where(~failed).join(known, "doc_id").groupBy(F.floor(F.col("anomaly") * steps).alias("bin"), "y").count().collect()
    threshold = _threshold(table, steps, most_good_lost)
    return scored.select("doc_id", "key", *STATS, failed.alias("base_failed"), "anomaly", (~failed & (F.col("anomaly") < threshold)).alias("kept"))


def _threshold(table: list, steps: int, most_good_lost: float) -> float:
    good, bad = np.zeros(steps + 2), np.zeros(steps + 2)
    for step, y, n in table:
        (good if y else bad)[min(step, steps)] += n
    lost, found = good[::-1].cumsum()[::-1], bad[::-1].cumsum()[::-1]
    if not lost[0] or not found[0]:
        return 2.0
    open_ = np.flatnonzero((lost <= most_good_lost * lost[0]) & (found / found[0] > 2 * lost / lost[0]))
    return float(open_[0]) / steps if len(open_) else 2.0
