"""Each registered query over its whole table against brute force, and against its SQL where there is some."""

import brute
import numpy as np
import pytest
from compare import connect, spark_table, spark_types, sql_table, sql_types

from pyspark.sql import functions as F

from bookloom.llm import toxicity
from bookloom.llm.common import load
from bookloom.llm.oracle import ORACLE
from bookloom.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def docs(spark, small):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small, name):
    duck = connect(small)
    df = QUERIES[name](spark, small)
    assert spark_types(df) == sql_types(duck, ORACLE[name])
    assert spark_table(df) == sql_table(duck, ORACLE[name])


def test_chat(spark, small):
    turns = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    turns += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    found = {r[0]: tuple(r[1:5]) for r in QUERIES["op1_chat_formatting"](spark, small).collect()}
    assert found == brute.chat(turns)


@pytest.mark.parametrize("name, patterns", [("op2_pii", brute.BASE_PII), ("op3_secrets", brute.BASE_SECRETS)])
def test_spans(spark, small, docs, name, patterns):
    found = rows(QUERIES[name](spark, small), "doc_id", *[f"n_{k}" for k in patterns], "base_sha256")
    want = []
    for doc, text in docs:
        spans = brute.base_spans(text, patterns)
        want.append((doc, *[sum(s[2] == k for s in spans) for k in patterns], brute.base_digest(spans)))
    assert found == sorted(want, key=repr)


def test_added_spans_keep_the_base(spark, small, docs):
    texts = dict(docs)
    for r in QUERIES["op2_pii"](spark, small).collect():
        base = {f"{k}:{s}:{e}" for s, _, k, e in brute.base_spans(texts[r.doc_id], brute.BASE_PII)}
        assert base <= set(r.spans.split(",")) | {""}


def test_simhash(spark, small, docs):
    found = rows(QUERIES["op4_simhash"](spark, small), "doc_id", "fingerprint", "component_id")
    assert found == sorted(brute.near_duplicates(docs), key=repr)


def test_warc(spark, small):
    pages = [tuple(r) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "html").collect()]
    found = rows(QUERIES["op5_warc"](spark, small), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert found == sorted(brute.warc(pages), key=repr)


def test_repeats(spark, small, docs):
    found = rows(QUERIES["op6_substring_dedup"](spark, small), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == sorted(brute.repeats(docs), key=repr)


def test_quality(spark, small, docs):
    df = QUERIES["op7_quality"](spark, small)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(df, "doc_id", *names) == sorted(((d, *brute.rules(t)) for d, t in docs), key=repr)
    assert not df.where("kept AND base_failed").count()


def test_quality_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = QUERIES["op7_quality"](spark, sf).join(labels, "doc_id").where("NOT base_failed")
    good = judged.where("quality = 1")
    assert good.where("NOT kept").count() <= 0.01 * good.count()


def test_decontamination(spark, small, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    plain = {d: " ".join(brute.WORD.findall(t.lower())) for d, t in docs}
    copies = {(d, i) for d, t in plain.items() for i, x in items if f" {' '.join(brute.WORD.findall(x.lower()))} " in f" {t} "}
    found = {(r.doc_id, r.item_id): r.score for r in QUERIES["op8_decontamination"](spark, small).collect()}
    assert copies <= set(found)
    assert all(found[pair] == 1 for pair in copies)
    assert all(0.5 <= s <= 1 for s in found.values())


def test_toxicity_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    found = QUERIES["op9_toxicity"](spark, sf)
    assert found.count() == 10000
    held = found.where("held_out").join(labels, "doc_id").collect()
    ranked = sorted(held, key=lambda r: r.score)
    positives = sum(r.toxic for r in held)
    # area under the curve by ranks, ties at their middle
    by_score = {}
    for place, r in enumerate(ranked, 1):
        by_score.setdefault(r.score, []).append(place)
    ranks = sum(sum(by_score[r.score]) / len(by_score[r.score]) for r in held if r.toxic)
    area = (ranks - positives * (positives + 1) / 2) / (positives * (len(held) - positives))
    assert area > 0.9
    assert sum(r.predicted == r.toxic for r in held) > 0.97 * len(held)
    assert all((r.score >= 0.5) == (r.predicted == 1) for r in held)


def caught(spark, share):
    """Recall and false positives of `predicted` on the held-out fold, with this share of the labels."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (load(spark, sf, t) for t in ("documents", "labels"))
    some = labels.where(F.crc32(F.concat(F.lit("s"), "doc_id").cast("binary")) % 1000 < 1000 * share)
    held = toxicity.score(docs, toxicity.train(docs, some)).where("held_out").join(labels, "doc_id").collect()
    toxic, clean = [r for r in held if r.toxic], [r for r in held if not r.toxic]
    return sum(r.predicted for r in toxic) / len(toxic), sum(r.predicted for r in clean) / len(clean)


@pytest.mark.parametrize("share, recall, wrong", [(1, 0.9, 0.01), (0.5, 0.84, 0.01), (0.2, 0.8, 0.05)])
def test_toxicity_at_the_cut(spark, share, recall, wrong):
    """Six in a hundred rows labelled toxic hold no telling word, so 0.94 is the most that can be caught."""
    found, false = caught(spark, share)
    assert found >= recall and false <= wrong


def test_lexicon_words_that_no_label_shows(spark):
    sf = "/root/testdata/sf0.1"
    model = toxicity.train(load(spark, sf, "documents"), load(spark, sf, "labels"))
    votes, weights = toxicity.Votes(model.mined), np.array(model.weights)
    harsh, plain = toxicity.scores([votes(t.encode()) for t in ("du bist ein idioten", "tu es un connard")], weights), toxicity.scores([votes(b"guten tag")], weights)
    assert harsh.min() > 10 * plain.max()


def test_cut():
    score, y = np.array([0.1, 0.2, 0.3, 0.9]), np.array([0, 0, 1, 1])
    assert toxicity.cut(score, y, np.ones(4)) == pytest.approx(0.25) or 0.2 < toxicity.cut(score, y, np.ones(4)) <= 0.3
    assert toxicity.cut(np.array([0.1, 0.9]), np.array([0, 1]), np.ones(2)) == 0.5


def test_packing(spark, small, docs):
    ids = {}
    for (doc, _), tokens in zip(docs, brute.token_ids([t for _, t in docs], tokenizer_path()), strict=True):
        ids[doc] = tokens
    pieces = QUERIES["op10_packing"](spark, small).collect()
    cover, sequences = {}, {}
    for p in pieces:
        assert brute.crc_of_ids(ids[p.doc_id][p.start: p.start + p.length]) == p.ids_crc32
        assert p.doc_tokens == len(ids[p.doc_id])
        cover.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans, whole in ((cover, {d: len(t) for d, t in ids.items()}), (sequences, None)):
        for key, parts in spans.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            assert at == whole[key] if whole else at <= 1024
    assert set(cover) == set(ids)
    assert sum(1 for parts in sequences.values() if sum(n for _, n in parts) < 1024) <= 1
