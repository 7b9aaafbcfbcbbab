"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posteriors."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookloom.llm.common import col, first_by_hash, lists, row_key, text_of

# Insults by kind and language, lower case.
LEXICONS: dict[str, frozenset[bytes]] = {name: frozenset(words.encode().split()) for name, words in {
    "stupidity": "idiot idiots idiotic moron morons moronic stupid stupidity imbecile imbeciles dumb dumbass dimwit halfwit fool fools retard retarded cretin",
    "contempt": "trash scum scumbag garbage filth filthy vermin parasite parasites subhuman lowlife degenerate rat swine",
    "worth": "worthless pathetic loser losers useless failure nobody coward cowards spineless",
    "disgust": "disgusting clown clowns ugly creep creepy repulsive vile gross freak freaks hideous stinking",
    "profanity": "fuck fucking fucked fucker shit shitty bullshit bitch bitches bastard bastards asshole assholes crap damn slut whore",
    "german": "arschloch idioten idiotin dummkopf trottel vollidiot abschaum dreckig dreckskerl schwachkopf widerlich missgeburt hurensohn scheiße scheisse wichser versager",
    "french": "idiote imbécile connard connasse salaud salope ordure crétin débile minable dégoûtant merde putain abruti raclure",
    "spanish": "estúpido estúpida imbécil idiota idiotas gilipollas basura escoria asqueroso asquerosa inútil mierda puta cabrón payaso",
}.items()}
YOU = frozenset("you your youre du dich dein ihr tu toi vous votre tú usted eres".encode().split())
THREAT = re.compile(rb"\b(?:kill|hurt|hate|beat|destroy|shut) (?:you|yourself|them|him|her|up)\b|\bgo (?:die|to hell)\b")
# Letters in lower case, everything else in ASCII a blank; bytes of other letters stay.
LETTERS = bytes(b if b > 127 or chr(b).isalpha() and chr(b).islower() else b + 32 if chr(b).isalpha() else 32 for b in range(256))
VOTERS = (*LEXICONS, "mined", "addressed", "threat")
ANY = frozenset().union(*LEXICONS.values())
STEMS = (4, 5, 6, 7, 8)  # bytes at the start of a word that may be mined, besides whole words
LEXICON_WEIGHT = 5.0  # log odds of a lexicon word before any label speaks
LEVELS, STEP, PER_WORD = 8, 1.25, 0.002  # evidence is cut into levels of this width, less what so many words bring by chance
REMEMBERED = 200_000


@dataclass(frozen=True)
class Model:
    """`mined`: log odds of word starts and of whole words (ending in a blank). `weights`: of the classifier."""

    mined: dict[bytes, float]
    label_model: LabelModel | None
    weights: tuple[float, ...]


class Votes:
    """Which voters fire on a text (bits), and the level of its evidence: the log odds of its distinct telling words."""

    def __init__(self, mined: dict[bytes, float]):
        self.mined = mined
        self.heads = {g.strip()[:STEMS[0]] for g in mined} | {w[:STEMS[0]] for w in ANY}  # few words begin like a telling one
        self.seen: set[bytes] = set()
        self.telling: dict[bytes, tuple[int, float]] = {}
        self.names: set[bytes] = set()

    def look_at(self, w: bytes) -> None:
        """Bits and log odds of a word, if it tells anything."""
        if w[:STEMS[0]] not in self.heads:
            return
        found = [self.mined[g] for g in (w + b" ", *(w[:n] for n in STEMS if len(w) >= n)) if g in self.mined]
        bits = sum(1 << i for i, lexicon in enumerate(LEXICONS.values()) if w in lexicon)
        if found or bits:
            self.telling[w] = bits | (bool(found) << len(LEXICONS)), max(found, default=LEXICON_WEIGHT)
            self.names.add(w)

    def __call__(self, text: bytes) -> tuple[int, int]:
        plain = text.translate(LETTERS)
        words = plain.split()
        distinct = set(words)
        if len(self.seen) > REMEMBERED:
            for memory in (self.seen, self.telling, self.names):
                memory.clear()
        new = distinct - self.seen
        for w in new:
            self.look_at(w)
        self.seen |= new
        hits = distinct & self.names
        bits, evidence = 0, -PER_WORD * len(words)
        for b, odds in sorted(self.telling[w] for w in hits):  # in order, as sums of doubles depend on it
            bits |= b
            evidence += odds
        if hits and not YOU.isdisjoint(distinct):
            near = [w in hits for w in words]
            if any(w in YOU and any(near[max(0, i - 3): i + 4]) for i, w in enumerate(words)):
                bits |= 1 << len(LEXICONS) + 1
        if THREAT.search(plain):
            bits |= 1 << len(LEXICONS) + 2
        return bits, min(LEVELS - 1, max(0, math.ceil(evidence / STEP)) if hits else 0)


class LabelModel:
    """P(label) and P(voter fires | label, its parent voter), by expectation-maximisation over patterns of votes.

    Voters repeat each other, so each may depend on one other voter besides the label: the tree with most mutual
    information given the label (the correlations). Patterns with a known label keep it.
    """

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 30):
        """patterns: rows of 0/1 votes; labels: 0, 1 or -1 where unknown."""
        self.parents = [-1] * patterns.shape[1]
        known = labels >= 0
        posterior = np.where(known, labels, np.clip(patterns.sum(axis=1) / 2, 0.02, 0.98))
        for step in range(rounds):
            if step in (0, 5):
                self.parents = _tree(patterns, counts, posterior)
            self._fit(patterns, counts, posterior)
            posterior = np.where(known, labels, self.posterior(patterns))

    def _fit(self, patterns: np.ndarray, counts: np.ndarray, posterior: np.ndarray) -> None:
        mass = np.stack([counts * (1 - posterior), counts * posterior])
        self.prior = float((mass[1].sum() + 1) / (mass.sum() + 2))
        self.fires = np.zeros((patterns.shape[1], 2, 2))  # voter, label, vote of its parent
        for voter, parent in enumerate(self.parents):
            given = patterns[:, parent] if parent >= 0 else np.zeros(len(patterns), int)
            for label in (0, 1):
                for vote in (0, 1):
                    own = mass[label] * (given == vote)
                    self.fires[voter, label, vote] = (own @ patterns[:, voter] + 0.1) / (own.sum() + 1)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        score = np.log([[1 - self.prior, self.prior]]).repeat(len(patterns), axis=0)
        for voter, parent in enumerate(self.parents):
            given = patterns[:, parent] if parent >= 0 else np.zeros(len(patterns), int)
            for label in (0, 1):
                p = self.fires[voter, label, given]
                score[:, label] += np.log(np.where(patterns[:, voter] == 1, p, 1 - p))
        return 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -700, 700)))


def _tree(patterns: np.ndarray, counts: np.ndarray, posterior: np.ndarray) -> list[int]:
    n = patterns.shape[1]
    mass = np.stack([counts * (1 - posterior), counts * posterior])
    total = mass.sum()
    gain = np.zeros((n, n))
    for i in range(n):
        for j in range(i):
            for label in (0, 1):
                table = np.array([[mass[label] @ ((patterns[:, i] == a) & (patterns[:, j] == b)) for b in (0, 1)] for a in (0, 1)])
                if table.sum() > 0:
                    joint = table / table.sum()
                    apart = joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True)
                    full = joint > 0
                    gain[i, j] += table.sum() / total * float((joint[full] * np.log(joint[full] / apart[full])).sum())
            gain[j, i] = gain[i, j]
    parents, inside = [-1] * n, [0]
    while len(inside) < n:
        i, j = max(((i, j) for i in range(n) if i not in inside for j in inside), key=lambda x: gain[x])
        parents[i] = j if gain[i, j] > 1e-4 else -1
        inside.append(i)
    return parents


def features(bits: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """What the linear classifier sees: a constant, whether each voter fires, how many do, whether each level is reached."""
    fired = (bits[:, None] >> np.arange(len(VOTERS)) & 1).astype(float)
    reached = (levels[:, None] >= np.arange(1, LEVELS)).astype(float)
    return np.concatenate([np.ones((len(bits), 1)), fired, fired.sum(axis=1, keepdims=True), reached], axis=1)


def logistic(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: np.ndarray | None = None, ridge: float = 1.0, rounds: int = 60,
) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton steps; the ridge pulls towards `prior`."""
    centre = np.zeros(x.shape[1]) if prior is None else prior
    w = centre.copy()
    for _ in range(rounds):
        p = sigmoid(x @ w)
        grad = x.T @ (weight * (p - y)) + ridge * (w - centre)
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fold(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5


def scores(found: list[tuple[int, int]], weights: np.ndarray) -> np.ndarray:
    bits, levels = np.array(found, np.int64).reshape(-1, 2).T
    return sigmoid(features(bits, levels) @ weights)


def mine(labelled: DataFrame, sizes: dict[int, int], least: float = 10.0, odds: float = 2.0) -> dict[bytes, float]:
    """Starts of words, and whole words, that tell label 1: how many texts of each label have them is compared by a
    likelihood ratio, so that what counts as enough follows from the number of texts. The weight is the log odds less its
    standard error. The result is bounded by the labelled sample."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ys, ts in lists(batches):
            seen: dict[bytes, list[int]] = {}
            for y, t in zip(ys, ts, strict=True):
                words = set(t.translate(LETTERS).split())
                for g in {w + b" " for w in words} | {w[:n] for w in words for n in STEMS if len(w) >= n}:
                    seen.setdefault(g, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array([n[0] for n in seen.values()], pa.int64()),
                 pa.array([n[1] for n in seen.values()], pa.int64())], ["gram", "clean", "toxic"])

    def cross(n: Column, of: int, share: Column) -> Column:
        """n log(share) + (of - n) log(1 - share), 0 log 0 being 0."""
        return F.when(n > 0, n * F.log(share)).otherwise(0.0) + F.when(n < of, (F.lit(of) - n) * F.log(1 - share)).otherwise(0.0)

    if not sizes.get(0) or not sizes.get(1):
        return {}
    toxic, clean, n1, n0 = F.col("toxic"), F.col("clean"), sizes[1], sizes[0]
    share = (toxic + clean) / (n1 + n0)
    ratio = 2 * (cross(toxic, n1, toxic / n1) + cross(clean, n0, clean / n0) - cross(toxic, n1, share) - cross(clean, n0, share))
    log_odds = F.log((toxic + 0.5) / (n1 + 1)) - F.log((clean + 0.5) / (n0 + 1))
    weight = log_odds - F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    counted = labelled.mapInArrow(grams, "gram binary, clean long, toxic long").groupBy("gram").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    telling = counted.where((log_odds > odds) & (ratio > least)).select("gram", weight.alias("weight"))
    return {bytes(r["gram"]): float(r["weight"]) for r in telling.collect()}


def cut(score: np.ndarray, y: np.ndarray, n: np.ndarray, slack: float = 0.02) -> float:
    """The score from which to call texts toxic: of the cuts between scores that occur whose F1 on these labels is within
    `slack` of the best, the one nearest to 0.5, as a few labels cannot tell such cuts apart."""
    values = np.unique(score)
    middles = (np.append(0.0, values) + np.append(values, 1.0)) / 2
    cuts = np.append(middles, 0.5)
    toxic = n * (y == 1)
    called = score >= cuts[:, None]
    f1 = 2 * (called @ toxic) / np.maximum(1.0, called @ n + toxic.sum())
    near = cuts[f1 >= f1.max() - slack]
    return float(near[np.abs(near - 0.5).argmin()])


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    most_labelled: int = 20_000,
) -> Model:
    """Learn from the labelled rows outside the held-out fold, at most `most_labelled` of them (those first by a hash
    of their id), and from the votes on all documents.

    Rows labelled both ways, with other labels than 0 and 1 or without id teach nothing; copies of a text count once. Word
    starts that tell label 1 become a voter of their own (`mine`). Each document gives a pattern: which voters fire, and
    the level of its evidence; of these there are at most 2**11 times 8, times the label if known. The label model learns
    from the patterns of the whole corpus, and its posteriors, known labels kept, teach the classifier. A fifth of the
    learning rows is kept back to set the cut, by a shift of the constant, so that 0.5 means the best F1.
    Without documents, or without labels of both kinds, the lexicons alone speak.
    """
    known = labels.where(col(label_col).isin(0, 1) & col(id_col).isNotNull()).select(
        col(id_col).cast("long").alias("doc_id"), col(label_col).cast("int").alias("y"))
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    known = known.where(remainder != 0).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other").drop("other")
    chosen = first_by_hash(known, most_labelled, "doc_id").withColumn("kept_back", F.crc32(F.concat(F.lit("cut "), "doc_id").cast("binary")) % 5 == 0)
    sample = F.broadcast(chosen)
    texts = docs.select(col(id_col).cast("long").alias("doc_id"), F.lower(text_of(text_col)).cast("binary").alias("t"))
    labelled = texts.join(sample, "doc_id").where("NOT kept_back").dropDuplicates(["t", "y"]).select("y", "t")
    sizes = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    mined = mine(labelled, sizes)

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes, seen = Votes(mined), {}
        for ys, backs, ts in lists(batches):
            for y, back, t in zip(ys, backs, ts, strict=True):
                key = (-1 if y is None else y, bool(back), *votes(t))
                seen[key] = seen.get(key, 0) + 1
        columns = list(zip(*seen, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip((*columns, seen.values()), (pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
            ["y", "kept_back", "bits", "level", "n"])

    rows = texts.join(sample, "doc_id", "left").select("y", "kept_back", "t").mapInArrow(
        patterns, "y int, kept_back boolean, bits int, level int, n long").groupBy("y", "kept_back", "bits", "level").agg(F.sum("n").alias("n")).collect()
    size = features(np.zeros(1, np.int64), np.zeros(1, np.int64)).shape[1]
    prior = np.zeros(size)
    prior[0], prior[1: 1 + len(LEXICONS)] = -1.0, 2.0  # a voter that never fires keeps this weight
    if not rows:
        return Model(mined, None, tuple(prior))
    y, bits, level, n = (np.array([r[c] for r in rows]) for c in ("y", "bits", "level", "n"))
    back = np.array([r["kept_back"] for r in rows]) & (y >= 0)
    n = n.astype(float)
    fired = bits[:, None] >> np.arange(len(VOTERS)) & 1
    shown = np.concatenate([fired, level[:, None] >= np.arange(1, LEVELS)], axis=1).astype(int)
    model = LabelModel(shown, n, np.where(back, -1, y))
    taught = (y >= 0) & ~back
    target = np.where(taught, y, model.posterior(shown))
    # together the other documents weigh as much as the labelled ones
    n = np.where(taught | ~taught.any(), n, n * min(1.0, n[taught].sum() / max(1.0, n[~taught].sum())))
    x = features(bits, level)
    weights = logistic(x, target, n, prior)
    if (y[back] == 1).any() and (y[back] == 0).any():
        at = cut(sigmoid(x[back] @ weights), y[back], n[back])
        weights[0] -= math.log(at / (1 - at))
    return Model(mined, model, tuple(weights))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, held_out, score, predicted) per row. Null and empty texts get the score of a text on which no voter
    fires; the id decides held_out only (a null id counts as the empty text). Other columns are not looked at."""
    mined, weights = model.mined, np.array(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = Votes(mined)
        for ids, keys, texts in lists(batches):
            p = scores([votes(t) for t in texts], weights)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array([fold(i) == 0 for i in ids], pa.bool_()), pa.array(p, pa.float64()),
                 pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "key", "held_out", "score", "predicted"])

    text = text_of(text_col)
    return docs.select(col(id_col).cast("long").alias("doc_id"), row_key(text).alias("key"), F.lower(text).cast("binary").alias("t")).mapInArrow(
        run, "doc_id long, key long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents not predicted toxic, all columns kept. One pass without a shuffle. Null and empty texts are judged as
    texts on which no voter fires; repeated rows share their verdict; an empty table stays empty."""
    mined, weights = model.mined, np.array(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = Votes(mined)
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(scores([votes(t) for t in batch.column(0).to_pylist()], weights) < 0.5))

    packed = docs.select(F.lower(text_of(text_col)).cast("binary").alias("t"), F.struct("*").alias("row"))
    return packed.mapInArrow(run, packed.schema).select("row.*")
