import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from odd_rows import CLASHING, ROWS  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return docs.selectExpr("*", "'en' AS lang", "cast(length(text) AS long) AS n_chars", *(f"'kept' AS {c}" for c in CLASHING))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
