"""Secrets in texts, and how widely each value is copied across repositories and owners."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookloom.llm.common import col, lists, row_key, same, stored, text_of

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# A run is taken whole either way; asking for its length at once spares matches that would be dropped.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# Further credential shapes: prefixed keys, signed web tokens, long mixed strings.
OTHER = re.compile(
    r"(?<![A-Za-z0-9_-])(?:(?P<key>(?:gh[pousr]_|xox[abprs]-|sk_live_|sk-|AIza|glpat-)[A-Za-z0-9_-]{16,})"
    r"|(?P<jwt>eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*)"
    r"|(?P<mixed>[A-Za-z0-9_-]{28,}))(?![A-Za-z0-9_-])")
SPAN = "struct<kind:string,start:int,end:int,value:long,base:boolean,odd:boolean>"
ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.int64()),
                            ("base", pa.bool_()), ("odd", pa.bool_())]))


def candidates(text: str) -> list[dict]:
    """Base spans (assign, access, hex) and further candidates; `odd` tells whether a value looks random."""
    out = []

    def add(kind: str, start: int, end: int, value: str, base: bool) -> None:
        digest = xxhash.xxh64_intdigest(value.encode())
        out.append({"kind": kind, "start": start, "end": end, "value": digest - (digest >> 63 << 64), "base": base, "odd": looks_random(value)})

    for m in ASSIGN.finditer(text):
        if len(m[1]) >= 6:
            add("assign", m.start(), m.end(), m[1], True)
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        for m in pattern.finditer(text):
            add(kind, m.start(), m.end(), m[0], True)
    taken = [(s["start"], s["end"]) for s in out]
    for m in OTHER.finditer(text):
        if m.lastgroup != "mixed" or looks_random(m[0]):
            if not any(s < m.end() and m.start() < e for s, e in taken):
                add(m.lastgroup, m.start(), m.end(), m[0], False)
    return out


def looks_random(value: str) -> bool:
    """Letters of both cases (or hex) with digits, spread evenly, no single character repeated on and on."""
    if len(value) < 16 or not re.search("[0-9]", value):
        return False
    if not re.fullmatch("[0-9a-f]+", value) and not (re.search("[a-z]", value) and re.search("[A-Z]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= 3.0


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None, owner: Column | None = None) -> DataFrame:
    """(doc_id, key, repo, owner, found) per row, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, repos, owners, texts in lists(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(repos, pa.string()), pa.array(owners, pa.string()),
                 pa.array([candidates(t) for t in texts], ARROW)], ["doc_id", "key", "repo", "owner", "found"])

    text = text_of(text_col)
    rows = docs.select(
        col(id_col).cast("long").alias("doc_id"), row_key(text).alias("key"), (col(id_col) if repo is None else repo).cast("string").alias("repo"),
        (F.lit(None) if owner is None else owner).cast("string").alias("owner"), text)
    return rows.mapInArrow(run, f"doc_id long, key long, repo string, owner string, found array<{SPAN}>")


def ownership(found: DataFrame) -> DataFrame:
    """(value, n_repos, n_owners, n_found) of every candidate value in the corpus.

    Counts go from (value, owner, repository) to (value, owner) to value, each summed inside the tasks before it is
    shuffled, so a value that a third of all rows share stays small.
    """
    each = found.select("repo", "owner", F.explode("found").alias("f")).groupBy("f.value", "owner", "repo").agg(F.count("*").alias("n"))
    owners = each.groupBy("value", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return owners.groupBy("value").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"), F.sum("n").alias("n_found"))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None, owner: Column | None = None,
    example_owners: int = 3,
) -> DataFrame:
    """(doc_id, spans) per row; a span is (kind, start, end, base, n_repos, n_owners, verdict), code points, end exclusive.

    Verdicts follow how widely a value is copied over the corpus: `example` if at least `example_owners` owners have
    it, `live` if fewer do and it looks random, else `weak`. Base spans (assign, access, hex) stay whatever the
    verdict; of the further shapes (prefixed keys, signed tokens, long mixed strings) only live ones are reported.

    `repo` and `owner` say whose a row is; a row is its own repository and has the null owner unless told. Null text
    has no spans, a null owner or repository is one of its own, repeated rows get the same spans and count once per
    repository, an empty table gives no rows, other columns are not looked at.
    """
    found = stored(scan(docs, id_col, text_col, repo, owner), "candidates")
    known = stored(ownership(found), "ownership")
    each = found.select("doc_id", "key", F.explode("found").alias("f")).select("doc_id", "key", "f.*").distinct()
    judged = each.join(known, "value").select(
        "doc_id", "key", "kind", "start", "end", "base", "n_repos", "n_owners",
        F.when(F.col("n_owners") >= example_owners, "example").when(F.col("odd"), "live").otherwise("weak").alias("verdict"))
    shown = judged.where("base OR verdict = 'live'").groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct(
        "start", _order(F.col("kind")).alias("order"), "kind", "end", "base", "n_repos", "n_owners", "verdict"))).alias("spans"))
    shown = stored(shown, "spans")
    rows = found.select("doc_id", "key")
    return rows.join(shown, same(rows, shown, "doc_id", "key"), "left").select(
        rows["doc_id"], F.coalesce("spans", F.array().cast(shown.schema["spans"].dataType)).alias("spans"))


def _order(kind: Column) -> Column:
    """Base kinds as listed, then the others."""
    order = F.lit(len(KINDS))
    for place, name in enumerate(KINDS):
        order = F.when(kind == name, place).otherwise(order)
    return order
