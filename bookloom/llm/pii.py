"""Personal data by weak supervision, with Spark expressions only."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookloom.llm.common import col, let, row_key, running_totals, text_of

KINDS = ("email", "ip", "card", "phone", "name")
LABELERS = ("strict", "gazetteer", "context", "shape")

# The base patterns, written so that long runs cost no more than their length: a run is tried at its start only
# (or where the last match ended), and taken possessively.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
# A chain of digits with 12 to 19 of them; shorter and longer chains are matches that fail.
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$"
# Looser spans that only the final classifier can admit.
HIDDEN_EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}"
                r"(?:(?:\.| ?[(\[]dot[)\]] ?)[A-Za-z0-9-]{1,63}){1,8}")
HOME_PHONE = (r"(?<!\+[0-9]{1,3}[ .-]?)(?<![0-9][ .-]?)(?<![(])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
              r"(?![ .-]?[0-9])")
# Titles and frequent given names of the four languages.
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora")
GIVEN = ("James", "Mary", "John", "Patricia", "Robert", "Jennifer", "Michael", "Linda", "William", "Elizabeth", "David", "Susan",
         "Thomas", "Sarah", "Daniel", "Anna", "Peter", "Maria", "Hans", "Klaus", "Ursula", "Monika", "Pierre", "Jean", "Claire",
         "Camille", "José", "Carlos", "Carmen", "Lucía", "Javier", "Laura")
NAME = r"\b(?:(?:%s)\.? [A-ZÀ-Þ][a-zß-ÿ]{1,30}|(?:%s))(?: [A-ZÀ-Þ][a-zß-ÿ]{1,30})+" % ("|".join(TITLES), "|".join(GIVEN))
# Per kind: what the gazetteer knows in a span, the cues in the 40 characters before it, the usual shape.
KNOWN = {
    "email": r"(?i)(?:\.|dot[)\]] ?)(?:com|org|net|edu|gov|io|info|de|fr|es|uk|at|ch)$",
    "ip": r"^(?!0+\.|127\.|255\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^(?:\+[1-9]|\(?[2-9])",
    "name": r"\b(?:%s)\b" % "|".join(GIVEN),
}
CUES = {
    "email": r"(?i)(?:e-?mail|mailto|contact|write|reach|kontakt|correo|courriel)\W*(?:\w+\W+){0,3}$",
    "ip": r"(?i)(?:\bip\b|address|host|server|adresse|from)\W*(?:\w+\W+){0,3}$",
    "card": r"(?i)(?:card|visa|master|credit|karte|carte|tarjeta)\W*(?:\w+\W+){0,3}$",
    "phone": r"(?i)(?:phone|call|tel|mobile|cell|fax|telefon|téléphone|teléfono)\W*(?:\w+\W+){0,3}$",
    "name": r"(?i)(?:name is|named|contact|signed|regards|sincerely|written by|heiße|appelle|llamo)\W*(?:\w+\W+){0,2}$",
}
SHAPES = {
    "email": r"^.{2,}(?:@|at[)\]])",
    "ip": r"^(?!.*(?:^|\.)0[0-9])",
    "card": r"^[0-9]{13,16}$|^[0-9]{4}([ -][0-9]{4}){3}$",
    "phone": r"[ ().-]",
    "name": r" .* |^\S+ \S+$",
}
SPAN = "array<struct<start:int,place:int,kind:string,end:int,base:boolean,strict:int,gazetteer:int,context:int,shape:int>>"


def matches(text: Column, pattern: str) -> Column:
    """All matches from left to right: array of (start, end, text, up to 40 characters before)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(hits: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        parts = F.zip_with(between, hits, lambda gap, hit: F.struct(
            F.length(gap).alias("gap"), F.length(hit).alias("size"), hit.alias("text"), F.right(gap, F.lit(40)).alias("before")))
        return let(parts, lambda p: F.zip_with(
            p, running_totals(F.transform(p, lambda x: x["gap"] + x["size"])),
            lambda x, end: F.struct((end - x["size"]).alias("start"), end.alias("end"), x["text"].alias("text"), x["before"].alias("before"))))

    none = F.array().cast("array<struct<start:int,end:int,text:string,before:string>>")
    return let(found, lambda hits: F.when(F.size(hits) > 0, placed(hits)).otherwise(none))


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, -i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(OCTETS),
    "card": lambda m: let(digits_of(m), luhn),
    "phone": lambda m: F.length(digits_of(m)).between(9, 15),
}


def candidates(text: Column) -> Column:
    """Base spans and looser ones, each with the votes of the labelers; sorted by start, then kind."""

    def spans(kind: str, pattern: str, base: bool, guard: Column | None = None) -> Column:
        hits = matches(text, pattern)
        if base:
            hits = F.filter(hits, lambda h: VALID[kind](h["text"]))
        voted = F.transform(hits, lambda h: F.struct(
            h["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), F.lit(kind).alias("kind"), h["end"].alias("end"),
            F.lit(base).alias("base"), F.lit(int(base)).alias("strict"), h["text"].rlike(KNOWN[kind]).cast("int").alias("gazetteer"),
            h["before"].rlike(CUES[kind]).cast("int").alias("context"), h["text"].rlike(SHAPES[kind]).cast("int").alias("shape")))
        return voted.cast(SPAN) if guard is None else F.when(guard, voted.cast(SPAN)).otherwise(F.array().cast(SPAN))

    hidden = F.contains(text, F.lit("at)")) | F.contains(text, F.lit("at]"))
    return F.array_sort(F.concat(
        spans("email", EMAIL, True, F.contains(text, F.lit("@"))), spans("ip", IP, True), spans("card", CARD, True),
        spans("phone", PHONE, True, F.contains(text, F.lit("+"))), spans("email", HIDDEN_EMAIL, False, hidden),
        spans("phone", HOME_PHONE, False), spans("name", NAME, False)))


@dataclass(frozen=True)
class Model:
    """Reliabilities per kind (share of true spans; per labeler the rate of votes on true and on false spans), and the
    classifier's weights: a constant, one per labeler, one per kind."""

    shares: dict[str, float]
    rates: dict[str, list[tuple[float, float]]]
    weights: list[float]


def train(docs: DataFrame, text_col: str = "text", rounds: int = 50) -> Model:
    """Expectation-maximisation over the counts of (kind, votes) in all texts, then a logistic classifier on its
    posteriors. There are at most 5 * 2**4 such patterns, whatever the corpus."""
    votes = [F.col(f"c.{name}") for name in LABELERS]
    table = docs.select(F.explode(candidates(text_of(text_col))).alias("c")).groupBy(F.col("c.kind"), *votes).count().collect()
    rows = [(r[0], tuple(r[1:5]), r["count"]) for r in table]
    shares = dict.fromkeys(KINDS, 0.5)
    # Before any evidence a labeler votes for nine in ten true spans and for one in five others.
    rates = {kind: [(0.9, 0.2), (0.7, 0.3), (0.5, 0.1), (0.8, 0.4)] for kind in KINDS}
    posteriors: dict[tuple, float] = {}
    for _ in range(rounds):
        for kind, vote, _n in rows:
            yes, no = shares[kind], 1 - shares[kind]
            for v, (p, q) in zip(vote, rates[kind], strict=True):
                yes, no = yes * (p if v else 1 - p), no * (q if v else 1 - q)
            posteriors[kind, vote] = yes / (yes + no)
        for kind in KINDS:
            own = [(vote, n, posteriors[kind, vote]) for k, vote, n in rows if k == kind]
            total, true = sum(n for _, n, _ in own), sum(n * p for _, n, p in own)
            shares[kind] = (true + 1) / (total + 2)
            # The first guess counts as twenty spans, so that a kind seen rarely keeps it.
            rates[kind] = [
                ((sum(n * p * v[i] for v, n, p in own) + 20 * first[0]) / (true + 20),
                 (sum(n * (1 - p) * v[i] for v, n, p in own) + 20 * first[1]) / (total - true + 20))
                for i, first in enumerate([(0.9, 0.2), (0.7, 0.3), (0.5, 0.1), (0.8, 0.4)])]
    return Model(shares, rates, _logistic([(_features(k, v), posteriors[k, v], n) for k, v, n in rows]))


def _features(kind: str, vote: tuple[int, ...]) -> list[float]:
    return [1.0, *map(float, vote), *[float(kind == k) for k in KINDS]]


def _logistic(rows: list[tuple[list[float], float, int]], rounds: int = 2000, rate: float = 0.5, ridge: float = 0.001) -> list[float]:
    weights = [0.0] * (1 + len(LABELERS) + len(KINDS))
    # Frequent patterns weigh more, but less than in proportion, so that rare kinds are learnt as well.
    sized = [(x, y, math.sqrt(n)) for x, y, n in rows]
    total = sum(n for _, _, n in sized)
    for _ in range(rounds if rows else 0):
        grads = [ridge * w for w in weights]
        for x, y, n in sized:
            p = 1 / (1 + math.exp(-sum(w * v for w, v in zip(weights, x, strict=True))))
            for i, v in enumerate(x):
                grads[i] += n / total * (p - y) * v
        weights = [w - rate * g for w, g in zip(weights, grads, strict=True)]
    return weights


def spans(text: Column, model: Model) -> Column:
    """Base spans, and others to which the classifier gives at least one half: array of (start, kind, end, base)."""

    def chance(c: Column) -> Column:
        z = F.lit(model.weights[0])
        for name, weight in zip(LABELERS, model.weights[1:], strict=False):
            z = z + c[name] * F.lit(weight)
        for kind, weight in zip(KINDS, model.weights[1 + len(LABELERS):], strict=True):
            z = z + F.when(c["kind"] == kind, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))

    return F.transform(
        F.filter(candidates(text), lambda c: c["base"] | (chance(c) >= 0.5)),
        lambda c: F.struct(c["start"].alias("start"), c["place"].alias("place"), c["kind"].alias("kind"), c["end"].alias("end"), c["base"].alias("base")))


def find_personal_data(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, spans) per row; offsets in code points, end exclusive. Without a model one is trained on these
    documents. Null text has no spans, repeated rows get the same ones, an empty table gives no rows (and a model
    that admits base spans only), other columns are not looked at."""
    model = model or train(docs, text_col)
    text = text_of(text_col)
    return docs.select(col(id_col).cast("long").alias("doc_id"), row_key(text).alias("key"), spans(text, model).alias("spans"))


def redact(docs: DataFrame, model: Model | None = None, text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """The documents with each span (overlapping ones as one) replaced by its kind in brackets; `count_col`, if there,
    is set to the new length. Texts without spans stay as they are, null stays null, all columns are kept."""
    model = model or train(docs, text_col)
    text = text_of(text_col)

    def cover(out: Column, s: Column) -> Column:
        """Join a span to the last one if they overlap."""
        last = F.try_element_at(out, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        fresh = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        return F.when(last.isNotNull() & (s["start"] < last["end"]), F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(longer))) \
            .otherwise(F.concat(out, F.array(fresh)))

    def replace(found: Column) -> Column:
        areas = F.aggregate(found, F.array().cast("array<struct<start:int,end:int,kind:string>>"), cover)
        return let(areas, lambda a: F.concat(
            F.array_join(F.transform(a, lambda x, i: F.concat(
                let(F.when(i > 0, F.try_element_at(a, i)["end"]).otherwise(F.lit(0)), lambda end: F.substr(text, end + 1, x["start"] - end)),
                F.lit("["), F.upper(x["kind"]), F.lit("]"))), ""),
            F.substr(text, F.element_at(a, -1)["end"] + 1)))

    clean = let(spans(text, model), lambda found: F.when(F.size(found) > 0, replace(found)).otherwise(col(text_col)))
    out = docs.withColumn(text_col, clean)
    if count_col in docs.columns:
        out = out.withColumn(count_col, F.length(col(text_col)).cast(docs.schema[count_col].dataType))
    return out.select(*[col(c) for c in docs.columns])
