"""The contracts of the queries, spelled out plainly in Python: slow, in one process, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile("[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def chat(turns):
    """turns: (conv_id, turn, role, text)."""
    groups = defaultdict(list)
    for conv, turn, role, text in turns:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, rows in groups.items():
        rows.sort()
        learned = "".join(t for _, _, r, t in rows if r == "assistant")
        out[conv] = (len(rows), sha("".join(f"{r}\n{t}\n" for _, _, r, t in rows)), len(learned), sha(learned))
    return out


BASE_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BASE_SECRETS = {
    "assign": r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def passes(kind: str, m: re.Match) -> bool:
    digits = re.sub("[^0-9]", "", m[0])
    return {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
        "assign": lambda: len(m[2]) >= 6, "access": lambda: len(m[0]) >= 20, "hex": lambda: len(m[0]) >= 24}[kind]()


def base_spans(text: str | None, patterns: dict[str, str]) -> list[tuple[int, int, str, int]]:
    return sorted((m.start(), place, kind, m.end()) for place, (kind, p) in enumerate(patterns.items())
                  for m in re.finditer(p, text or "") if passes(kind, m))


def base_digest(spans) -> str:
    return sha(",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans))


def fingerprint(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    shingles = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, linked):
    """Smallest index reachable from each."""
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def near_duplicates(docs):
    """docs: (doc_id, text) -> list of (doc_id, hex fingerprint, component)."""
    prints = [fingerprint(t) for _, t in docs]
    distinct = sorted(set(prints))
    root = dict(zip(distinct, roots(distinct, lambda a, b: (a ^ b).bit_count() <= 3), strict=True))
    least = {}
    for (doc, _), p in zip(docs, prints, strict=True):
        if doc is not None:
            least[root[p]] = min(doc, least.get(root[p], doc))
    return [(doc, f"{p:016x}", least.get(root[p])) for (doc, _), p in zip(docs, prints, strict=True)]


def warc(pages):
    """pages: (page_id, html) -> rows of (page_id, bytes, digest, type, refers_to)."""
    first = {}
    for page, html in pages:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, html in pages:
        data = (html or "").encode()
        keeper = first.get(html or "")
        revisit = keeper is not None and page != keeper
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", keeper if revisit else None))
    return out


def repeats(docs, window=50):
    """docs: (doc_id, text) -> list of (doc_id, n_words, n_removed, sha of the rest)."""
    first = {}
    words = [WORD.findall(t or "") for _, t in docs]
    rank = [(d is None, d or 0) for d, _ in docs]
    for r, w in zip(rank, words, strict=True):
        for i in range(len(w) - window + 1):
            key = tuple(w[i: i + window])
            first[key] = min(r, first.get(key, r))
    out = []
    for (doc, _), r, w in zip(docs, rank, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i: i + window])] < r:
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def rules(text: str | None):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i: i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i: i + 5])] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


def token_ids(texts, path):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return [model.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def crc_of_ids(ids) -> int:
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
