"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.llm.common import Runs, WordHashes, col, lists, row_key, same, stored, text_of

MATCH, MISS, GAP = 2, -1, -1
HASHES = WordHashes()
# ASCII letters in lower case, other letters and digits as they are, the rest of ASCII a blank.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
FOUND = "doc_id long, key long, item long, grams array<long>, passage binary, first long"
OUT = "doc_id long, key long, item_id long, score double, start long, end long"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def grams_of(words: list[bytes], size: int) -> np.ndarray:
    """Hashes of the runs of `size` words; of the whole text if it has fewer; none without words."""
    if not words:
        return np.zeros(0, np.uint64)
    runs = Runs(HASHES(words))
    return runs.all(size) if len(words) >= size else runs.of(np.array([0]), np.array([len(words)])) ^ np.uint64(len(words))


class SeedIndex:
    """Grams of a block of items: which items have a gram, and where. Filters a text's grams by a bitmap first."""

    def __init__(self, items: list[tuple[int, bytes]], size: int):
        self.size, self.items = size, [(item, words_of(t)) for item, t in items]
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        own = []
        for number, (_, words) in enumerate(self.items):
            grams = grams_of(words, size).tolist()
            own.append(set(grams))
            for at, gram in enumerate(grams):
                self.places[gram].append((number, at))
        shared = {gram: len({n for n, _ in places}) for gram, places in self.places.items()}
        least = [min((shared[g] for g in grams), default=0) for grams in own]
        # A gram that many more items share than the item's rarest ones is phrasing, not a trace of the item.
        self.places = {gram: kept for gram, places in self.places.items()
                       if (kept := [(n, at) for n, at in places if shared[gram] <= 2 * least[n]])}
        self.bitmap = np.zeros(1 << 22, bool)
        self.bitmap[(np.array(list(self.places), np.uint64) >> np.uint64(42)).astype(np.int64)] = True

    def passages(self, words: list[bytes]) -> list[tuple[int, list[int], int, int]]:
        """(item number, grams met, first word, end) of each stretch of a text in which an item may stand."""
        grams = grams_of(words, self.size)
        maybe = np.flatnonzero(self.bitmap[(grams >> np.uint64(42)).astype(np.int64)])
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for at, gram in zip(maybe.tolist(), grams[maybe].tolist(), strict=True):
            for number, inside in self.places.get(gram, ()):
                hits[number].append((at - inside, gram))
        out = []
        for number, found in hits.items():
            n = len(self.items[number][1])
            slack = n // 3 + 2
            found.sort()
            begin = last = found[0][0]
            met = set()
            for start, gram in [*found, (None, None)]:
                if start is None or start > last + slack:
                    out.append((number, sorted(met), max(0, begin - slack), min(len(words), last + n + slack)))
                    if start is None:
                        break
                    begin, met = start, set()
                last = start
                met.add(gram)
        return out


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best score of a local alignment of two word sequences, and where it ends in the passage."""
    best, end = 0, 0
    steps = -GAP * np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    for word in item:
        pairs = row[:-1] + np.where(passage == word, MATCH, MISS)
        now = np.maximum(row + GAP, 0)
        now[1:] = np.maximum(now[1:], pairs)
        row = np.maximum.accumulate(now + steps) - steps  # gaps in the item
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, size: int = 4, min_score: float = 0.5, block_words: int = 2_000_000,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, key, item_id, score, start, end): for each document and benchmark item the best passage that is a copy
    of the item, exact or edited; words start..end of the document in the reading of `words_of`.

    Seeds are runs of `size` words. A seed met in the corpus joins the passage around it to the items that have it if
    it is rare: in at most four times as many documents as the median seed of its item that occurs at all. So an
    item that leaked into very many documents keeps its seeds. Alignment then gives MATCH per equal word, MISS per
    replaced, GAP per word more or less; the score is that over MATCH times the item's words, and `min_score` of it
    counts as a copy.

    The benchmark is a stated query set: items are taken in blocks of about `block_words` words, each of which goes to
    every task, and all documents are read against each block. Items of fewer than `size` words match texts that
    consist of the same words only. Null texts are empty and match nothing; items with equal text are found each;
    repeated rows of a document give one row; a null id is an id like any other; empty tables give no rows.
    """
    spark = docs.sparkSession
    items = stored(benchmark.select(
        F.xxhash64(text_of(item_text_col), col(item_col).cast("long")).alias("item"), col(item_col).cast("long").alias("item_id"),
        text_of(item_text_col).cast("binary").alias("t")).distinct(), "items")
    weight = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n_blocks = max(1, -(-weight // (6 * block_words)))
    text = text_of(text_col)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), row_key(text).alias("key"), text.cast("binary").alias("t"))
    found = []
    for block in range(n_blocks):
        part = [(r["item"], bytes(r["t"])) for r in items.where(F.pmod("item", F.lit(n_blocks)) == block).collect()]
        if part:
            found.append(_passages(rows, part, size))
    if not found:
        return spark.createDataFrame([], OUT)
    met = stored(_union(found), "passages")
    seeds = met.select("doc_id", "key", "item", F.explode("grams").alias("gram"))
    spread = stored(seeds.select("gram", "doc_id", "key").distinct().groupBy("gram").agg(F.count("*").alias("n_docs")), "spread")
    of_items = stored(seeds.select("item", "gram").distinct().join(spread, "gram"), "seeds")
    usual = of_items.groupBy("item").agg(F.percentile("n_docs", F.lit(0.5)).alias("usual"))
    rare = stored(of_items.join(usual, "item").where("n_docs <= 4 * usual").select("item", "gram"), "rare")
    joined = met.select("*", F.explode("grams").alias("gram")).join(rare, ["item", "gram"], "left_semi")
    once = joined.select("doc_id", "key", "item", "first", "passage").distinct()
    pairs = once.join(items, "item").select("doc_id", "key", "item_id", "first", "passage", "t")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, numbers, firsts, passages, texts in lists(batches):
            out = []
            for doc, key, item, first, passage, t in zip(ids, keys, numbers, firsts, passages, texts, strict=True):
                own, there = HASHES(words_of(t)), HASHES(words_of(passage))
                best, end = align(own, there)
                if own.size and best >= min_score * MATCH * len(own):
                    _, back = align(own[::-1], there[:end][::-1])
                    out.append((doc, key, item, best / (MATCH * len(own)), first + end - back, first + end))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 3 + [pa.float64()] + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["doc_id", "key", "item_id", "score", "start", "end"])

    judged = pairs.mapInArrow(judge, OUT)
    best = F.max_by(F.struct("score", "start", "end"), F.struct("score", -F.col("start"), -F.col("end")))
    return judged.groupBy("doc_id", "key", "item_id").agg(best.alias("b")).select("doc_id", "key", "item_id", "b.*")


def _passages(rows: DataFrame, part: list[tuple[int, bytes]], size: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(part)
    built: list[SeedIndex] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not built:
            built.append(SeedIndex(shared.value, size))
        index = built[0]
        for ids, keys, texts in lists(batches):
            out = []
            for doc, key, t in zip(ids, keys, texts, strict=True):
                words = words_of(t)
                for number, grams, start, end in index.passages(words):
                    signed = np.array(grams, np.uint64).view(np.int64).tolist()
                    out.append((doc, key, index.items[number][0], signed, b" ".join(words[start:end]), start))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["doc_id", "key", "item", "grams", "passage", "first"])

    return rows.mapInArrow(run, FOUND)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole, *rest = parts
    for part in rest:
        whole = whole.unionByName(part)
    return whole


def drop_leaked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without a copy of a benchmark item, all columns kept."""
    leaks = stored(find_leaks(docs, benchmark, id_col=id_col, text_col=text_col, **options).select("doc_id", "key").distinct(), "leaks")
    packed = docs.select(col(id_col).cast("long").alias("doc_id"), row_key(text_of(text_col)).alias("key"), F.struct("*").alias("row"))
    return packed.join(leaks, same(packed, leaks, "doc_id", "key"), "left_anti").select("row.*")
