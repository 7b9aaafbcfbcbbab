"""Encoding against the model's own library, decoding of any ids, and the edge cases of the docstrings."""

import random

import pyarrow as pa
import pytest
from brute import sha

from bookloom.llm.pieces import PieceModel, decode, encode
from bookloom.llm.queries import PIECES, QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def data():
    with open(tokenizer_path(PIECES), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(data):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


@pytest.fixture(scope="module")
def model(data):
    return PieceModel(data)


def made_up(library, seed=5):
    rng = random.Random(seed)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    letters = "aeithnos -=_/\\#*. \n\t0179é▁"
    for _ in range(400):
        yield "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40)))
        yield "".join(rng.choice(letters) for _ in range(rng.randrange(1, 120)))
        yield "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x3000), rng.randrange(0x10000, 0x1FFFF)])) for _ in range(20))


EDGES = ["", " ", "  a  b ", "a\tb\nc", "▁x", "x▁▁ y", " ﬁ ①  　z", "ab​\x00c", "\r\n", "𝔘 🎉", "a" * 1000, " " * 1000, "the " * 50,
         "中文字符测试你好世界" * 20, "def f(x):\n    return x\n\n\n" * 10, "\t\t\t\t", "====== ---- ****", "</s><s> <unk> <0x41>"]


def test_ids_equal_the_library(library, model):
    texts = [*EDGES, *made_up(library)]
    assert [ids.tolist() for ids in model.encode(texts)] == [library.encode(t) for t in texts]


def test_a_long_text_without_spaces(library, model):
    rng = random.Random(2)
    for letters in ("0123456789abcdef", "abcdefghij", " ", "=-*# "):
        text = "".join(rng.choice(letters) for _ in range(30_000))
        assert model.encode([text])[0].tolist() == library.encode(text)


def test_one_merge_at_a_time_equals_rounds(library, model):
    """Where rounds could change the order, the agenda takes over; alone it gives the same ids."""
    import numpy as np

    for text in made_up(library, 9):
        points = np.array([ord(c) for c in (" " + text).replace(" ", "▁")])
        symbols = model.symbol_of[points]
        symbols = np.where(symbols < 0, -1 - points, symbols)
        _, ids = model._one_by_one(symbols, np.arange(len(points)))
        known = ids[(ids >= 0) & (ids < model.n_pieces)]
        assert [i for i in model.encode([text])[0].tolist() if not library.is_byte(i)] == known.tolist()


def test_decoding_any_ids(library, model):
    rng = random.Random(3)
    lists = [[rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(300) for _ in range(rng.randrange(12))] for _ in range(2000)]
    assert model.decode(pa.array(lists, pa.list_(pa.int32()))) == [library.decode(ids) for ids in lists]


def test_other_models_are_refused(data):
    at = data.rindex(b"identity")
    changed = data[: at + 8] + data[at + 8:].replace(b"\x18\x01", b"\x18\x00", 1)  # no space in front
    with pytest.raises(ValueError, match="BPE"):
        PieceModel(changed)


def test_rows(spark, data, library):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (None, ""), (3, "▁ a"), (4, "é" * 5000)]
    docs = spark.createDataFrame([(i, t, [9], "x") for i, t in rows], "doc_id long, text string, ids array<int>, `a.b` string")
    found = decode(encode(docs, data), data).collect()
    assert sorted(((r.doc_id, list(r.ids), r.text) for r in found), key=repr) == sorted(
        ((i, library.encode(t or "") + [2], library.decode(library.encode(t or "") + [2])) for i, t in rows), key=repr)
    assert encode(docs.limit(0), data).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in decode(nothing, data).collect()] == ["", ""]


def test_query(spark, small, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_sentencepiece"](spark, small).collect()}
    want = {}
    for doc, text in texts.items():
        ids = library.encode(text) + [library.eos_id()]
        want[doc] = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
    assert found == want
