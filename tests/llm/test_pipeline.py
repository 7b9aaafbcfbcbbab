"""The stages in a row on the smallest tables, each held against a plain version on its own input."""

import brute
import pytest

import corpus_pipeline
from bookloom.llm import toxicity
from bookloom.llm.common import load, stored
from bookloom.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def passed(spark, small):
    """The input of each stage and its output."""
    docs, out = load(spark, small, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, small), f"test-{name}")
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_columns_stay(spark, small, passed):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]
    for _, after in passed[:-1]:
        assert after.columns == load(spark, small, "documents").columns


def test_toxicity_stage(spark, small, passed):
    before, after = passed[0]
    model = toxicity.train(before, load(spark, small, "labels"))
    clean = {r.doc_id for r in toxicity.score(before, model).collect() if not r.predicted}
    assert set(texts(after)) == clean
    assert texts(after).items() <= texts(before).items()


def test_near_dedup_stage(passed):
    before, after = map(texts, passed[1])
    found = brute.near_duplicates(sorted(before.items()))
    groups = {}
    for doc, _, component in found:
        groups.setdefault(component, []).append(doc)
    assert sorted(sum(doc in after for doc in members) for members in groups.values()) == [1] * len(groups)
    assert after.items() <= before.items()


def test_decontamination_stage(spark, small, passed):
    before, after = map(texts, passed[2])
    items = [" ".join(brute.WORD.findall(r.text.lower())) for r in load(spark, small, "benchmark").collect()]
    plain = {d: " " + " ".join(brute.WORD.findall(t.lower())) + " " for d, t in before.items()}
    leaked = {d for d, t in plain.items() if any(f" {i} " in t for i in items)}
    assert not leaked & set(after)
    assert len(before) - len(after) <= len(leaked) + 0.05 * len(before)
    assert after.items() <= before.items()


def test_pii_stage(passed):
    before, after = map(texts, passed[3])
    assert set(before) == set(after)
    for doc, text in before.items():
        spans = brute.base_spans(text, brute.BASE_PII)
        if not spans:
            continue
        for start, _, kind, end in spans:
            assert text[start:end] not in after[doc] or text.count(text[start:end]) > 1 or kind == "phone"
        assert not [s for s in brute.base_spans(after[doc], {"email": brute.BASE_PII["email"]})]


def test_packing_stage(passed):
    before, pieces = texts(passed[4][0]), passed[4][1].collect()
    ids = dict(zip(before, brute.token_ids(before.values(), tokenizer_path()), strict=True))
    cover, sequences = {}, {}
    for p in pieces:
        assert brute.crc_of_ids(ids[p.doc_id][p.start: p.start + p.length]) == p.ids_crc32
        cover.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences[p.sequence_id] = sequences.get(p.sequence_id, 0) + p.length
    for doc, parts in cover.items():
        assert sum(n for _, n in parts) == len(ids[doc]) and sorted(parts)[0][0] == 0
    assert set(cover) == set(ids) and sum(n < 1024 for n in sequences.values()) <= 1 and max(sequences.values()) <= 1024
