import random

import pytest
from brute import DATA, contamination as plain, sha
from pyspark.sql import types as T

from ledgerloom.llm import contamination as op

ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("key", T.StringType()), T.StructField("wid", T.StringType()), T.StructField("h", T.LongType())])


@pytest.fixture(scope="module")
def items(llm):
    return lambda rows: llm.createDataFrame([(i, t, None, "x", 1) for i, t in rows], ITEM)


def rows_of(n_words, n_hit, own):
    return n_words, n_hit, len(own), sha(",".join(own)), n_hit > 0


def check(got, docs, benchmark, length=10):
    want = [(i, *rows_of(*r)) for (i, *_), r in zip(docs, plain([t for _, t, *_ in docs], benchmark, length))]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def corpus(seed=1):
    """Passages, near misses, short items, frequent words, repeated rows and copies of items."""
    rng = random.Random(seed)
    words = ["the", "of", "Élan", "naïve", "日本", "x1", "Rare", "STRASSE", "straße", "ΑΣ", "K", "a", "b"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    benchmark = [(i, text(rng.choice([1, 2, 3, 5, 9, 10, 11, 14, 30]))) for i in range(30)]
    benchmark += [(100, benchmark[5][1]), (101, benchmark[5][1].upper()), (5, benchmark[5][1]), (102, None), (103, "--- !"), (None, benchmark[7][1] + " tail"), (None, text(12)), (104, "the the the the the the the the the the the")]
    docs = []
    for i in range(120):
        item = rng.choice(benchmark)[1] or "z"
        parts = item.split(" ")
        if i % 3 == 0 and len(parts) > 2:
            del parts[rng.randrange(len(parts))]
        glue = rng.choice([" ", "-", ".\n", "__"])
        docs.append((i, f"{text(rng.randrange(30))} {glue.join(parts)} {text(rng.randrange(30))}", "s"))
    docs += [(200, None, None), (200, "", None), (None, "the " * 40, None), (201, docs[0][1], None), (201, docs[0][1], None), (202, text(60_000), None)]
    return docs, benchmark


def test_against_brute_force(make, items):
    docs, benchmark = corpus()
    check(op.report(make(docs), items(benchmark)).collect(), docs, benchmark)


def test_exchanged_sides_and_full_filter(make, items, monkeypatch):
    docs, benchmark = corpus(2)
    monkeypatch.setattr(op, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(op, "FILTER_BITS", 128)
    check(op.report(make(docs), items(benchmark)).collect(), docs, benchmark)


def test_other_windows(make, items):
    docs, benchmark = corpus(3)
    check(op.report(make(docs), items(benchmark), window=4).collect(), docs, benchmark, 4)


def test_empty_tables(make, empty, items):
    assert op.report(empty, items([(1, "a b c")])).collect() == []
    got = op.report(make([(1, "a b c", None), (2, None, None)]), items([])).collect()
    assert sorted(tuple(r) for r in got) == [(1, 3, 0, 0, sha(""), False), (2, 0, 0, 0, sha(""), False)]


def test_ranges_and_dropping(make, items):
    docs, benchmark = make([(1, "x a b c y", None), (2, "a b", None), (3, "c A-B", None)]), items([(7, "a b c"), (8, "c a")])
    found = op.contamination(docs, benchmark)
    assert {r["row"]["doc_id"]: ([tuple(x) for x in r["ranges"]], r["items"]) for r in found.collect()} == {1: ([(1, 4)], ["7"]), 2: ([], []), 3: ([(0, 2)], ["8"])}
    clean = op.drop_contaminated(docs, benchmark)
    assert clean.columns == docs.columns and [r["doc_id"] for r in clean.collect()] == [2]


def test_no_python_in_the_plan(make, items, capsys):
    op.report(make([(1, "x", None)]), items([(1, "a")])).explain()
    assert "Python" not in capsys.readouterr().out
    source = open(op.__file__).read()
    assert not any(word in source for word in ("udf", "pandas", "mapIn", ".rdd"))


def test_query(ask, documents):
    import pyarrow.parquet as pq

    bench = pq.read_table(DATA / "benchmark.parquet").to_pandas()
    got = ask("op11_decontamination")[["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]]
    assert got.contaminated.any()
    check(got.itertuples(index=False), list(zip(documents.doc_id, documents.text)), list(zip(bench.item_id, bench.text)))
