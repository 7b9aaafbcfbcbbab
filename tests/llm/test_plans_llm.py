"""The native operators stay in Spark expressions; no operator pairs rows by a product."""

import contextlib
import io

import pytest

from bookloom.llm.queries import QUERIES

PYTHON = ("EvalPython", "InPandas", "MapInArrow", "ScalaUDF")
PRODUCTS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("name", ["op1_chat_formatting", "op2_pii"])
def test_native_operators_have_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert not [node for node in PYTHON + PRODUCTS if node in text]


@pytest.mark.parametrize("name", ["op3_secrets", "op7_quality", "op9_toxicity", "op10_packing"])
def test_no_products_of_rows(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert not [node for node in PRODUCTS if node in text]
