import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from samples import CLASHING, FOLDER, odd_texts  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """The odd texts as documents, with columns that clash with the operators' own."""
    rows = [(d, t, None, f"s{k % 3}", len(t or ""), None, k, "f", "d", None, 1, 2, "s")
            for k, (d, t) in enumerate(odd_texts())]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    return spark.createDataFrame(rows, schema).repartition(3, "source")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def given(spark):
    """The given documents at the smallest scale, and their rows as (doc_id, text)."""
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return documents, [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x) for x in r])


@pytest.fixture(scope="session")
def same():
    def check(df, rows, *columns):
        assert ordered(df.select(*columns).collect()) == ordered(rows)
    return check
