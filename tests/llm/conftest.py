"""The package goes to the executors before any operator runs."""

import pytest

from riskflow.llm.common import ship


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


ODD_TEXTS = [
    "one two three four five six seven", None, "", "   \n\t ", "one two three four five six seven",
    "Zażółć gęślą jaźń – ▁ 日本語 😀\x00", "word " * 3000, "a", "A b", "x" * 9000,
]


@pytest.fixture(scope="session")
def odd(llm):
    """Documents with nulls in every column, repeated rows and ids, and names that could clash."""
    rows = [(k, t, None if k % 3 else "en", "src0" if k % 2 else None, k) for k, t in enumerate(ODD_TEXTS)]
    rows += [rows[0], rows[0], (None, "one two three", None, None, None), (None, None, "de", "src1", 3)]
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    frame = llm.createDataFrame(rows, shape)
    for name in ("row", "body", "score_", "f", "handle", "bucket", "name", "slot", "label"):
        frame = frame.selectExpr("*", f"cast(doc_id as string) as {name}")
    return frame
