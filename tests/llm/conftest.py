import random
import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import DATA  # noqa: E402

# clash with names that the operators use inside
EXTRA = ["row", "doc", "version", "key", "size", "label", "score", "spans", "part", "position", "text_key", "bitmap", "whole", "n"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in EXTRA]
)


@pytest.fixture(scope="session")
def llm(spark):
    from ledgerloom.llm.common import prepare

    return prepare(spark)


@pytest.fixture(scope="session")
def make(llm):
    """Documents from (doc_id, text, source) with nulls and clashing names in the other columns."""

    def build(rows):
        filled = [(i, t, None if k % 2 else "en", s, None if k % 3 else len(t or ""), *([None if k % 2 else "x"] * len(EXTRA))) for k, (i, t, s) in enumerate(rows)]
        return llm.createDataFrame(filled, SCHEMA)

    return build


@pytest.fixture(scope="session")
def empty(make):
    return make([])


@pytest.fixture(scope="session")
def documents():
    if not DATA.exists():
        pytest.skip("no test data")
    return pq.read_table(DATA / "documents.parquet").to_pandas()


@pytest.fixture(scope="session")
def ask(llm):
    """A registered query over the smallest tables."""
    from ledgerloom.llm.queries import QUERIES

    if not DATA.exists():
        pytest.skip("no test data")
    return lambda name: QUERIES[name](llm, str(DATA)).toPandas()


@pytest.fixture(scope="session")
def odd_texts():
    """Documents with the awkward cases: null and empty texts, a null id and source, repeated rows, one very long text."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Épsilon", "zeta", "eta", "theta", "naïve", "日本語"]
    long = " ".join(rng.choice(words) + str(rng.randrange(10**6)) for _ in range(40_000))
    shared = " ".join(rng.choice(words) + str(rng.randrange(1000)) for _ in range(60))
    lines = [f"{shared}\n{rng.choice(words)} only {i}\n\n  {shared.upper()} \nend" for i in range(7)]
    rows = [(1, None, "a"), (2, "", None), (3, "   \n\t", "a"), (4, "one", "b"), (5, "two words", None), (6, long, "b")]
    rows += [(10 + i, t, "abc"[i % 3]) for i, t in enumerate(lines)]
    rows += [(30, shared, "a"), (30, shared, "a"), (31, shared, "a"), (31, shared + " other", "b"), (None, shared, None), (None, None, None)]
    return rows
