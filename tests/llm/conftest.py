import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_rows import ROWS  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with the hard cases, and extra columns with names that the operators use themselves."""
    rows = [(i, t, "en", "s", len(t) if t is not None else None, 1, "x", "y") for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "n_words int, th string, key string").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
